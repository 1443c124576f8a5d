"""Endpoint manifest (S2): request URLs built as a DataFrame, with the
source-side predicates (year, session type, session key, speed) in the query string."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The per-session endpoints of the racing preset (``{key}`` = session key).
RACE_ENDPOINTS = {
    "drivers": "drivers?session_key={key}",
    "laps": "laps?session_key={key}",
    "telemetry": "car_data?session_key={key}&speed>250",
}


def endpoint_manifest(keys: DataFrame, base_url: str, endpoints: dict[str, str] | None = None,
                      key_col: str = "session_key") -> DataFrame:
    """One row per (key, endpoint): ``(dataset, key, url)``; ``endpoints`` maps a
    dataset name to a path template holding ``{key}``."""
    endpoints = endpoints or RACE_ENDPOINTS
    rows = []
    for name, tpl in endpoints.items():
        pre, _, post = (base_url.rstrip("/") + "/" + tpl).partition("{key}")
        rows.append(F.struct(F.lit(name).alias("dataset"), F.lit(pre).alias("pre"), F.lit(post).alias("post")))
    ep = keys.select(F.col(key_col).alias("key"), F.explode(F.array(*rows)).alias("e"))
    return ep.select(F.col("e.dataset").alias("dataset"), "key",
                     F.concat(F.col("e.pre"), F.col("key").cast("string"), F.col("e.post")).alias("url"))


def season_urls(base_url: str, year, session_type: str | None = None):
    """The sessions request of a ``year`` column, as a column."""
    tail = f"&session_type={session_type}" if session_type else ""
    return F.concat(F.lit(f"{base_url.rstrip('/')}/sessions?year="), year.cast("string"), F.lit(tail))


def season_url(base_url: str, year: int, session_type: str | None = None) -> str:
    url = f"{base_url.rstrip('/')}/sessions?year={year}"
    return url + (f"&session_type={session_type}" if session_type else "")
