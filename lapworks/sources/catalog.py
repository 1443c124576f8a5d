"""Namespaces and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The three layers and their descriptions.
LAYERS = {
    "bronze": "Raw payloads as landed, normalised and stamped",
    "silver": "Conformed, typed, flagged and enriched tables",
    "gold": "Aggregated marts for reporting",
}


def ensure_layers(spark: SparkSession, layers: dict | None = None,
                  catalog: str = "spark_catalog") -> list[str]:
    out = []
    for name, comment in (layers or LAYERS).items():
        safe = comment.replace("'", "\\'")
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {catalog}.{name} COMMENT '{safe}'")
        out.append(f"{catalog}.{name}")
    return out


def list_layers(spark: SparkSession) -> list[str]:
    return sorted(db.name for db in spark.catalog.listDatabases())


def view_name(table: str) -> str:
    """``silver.enriched_laps`` -> ``silver_enriched_laps``."""
    return table.replace(".", "_")


def register_views(frames: dict[str, DataFrame]) -> dict[str, str]:
    names = {}
    for table, df in frames.items():
        v = view_name(table)
        df.createOrReplaceTempView(v)
        names[table] = v
    return names
