"""Row validity flags (P12), validity and retention summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapworks.functions.rules import Rule, first_failing_rule, passes_all


def lap_rules(min_duration: float, pit_col: str = "is_pit_out_lap",
              duration_col: str = "lap_duration") -> list[Rule]:
    """The racing preset, in order: pit-out lap, missing duration, too short.

    A lap of exactly ``min_duration`` is valid; a NULL pit flag falls through.
    """
    d = F.col(duration_col)
    return [
        Rule("pit_out_lap", F.col(pit_col) == F.lit(True)),
        Rule("missing_duration", d.isNull()),
        Rule("below_minimum", d < F.lit(min_duration)),
    ]


def flag(df: DataFrame, rules: list[Rule], out: str = "is_valid_lap",
         reason_col: str | None = None) -> DataFrame:
    """Attach the validity flag (and optionally the first failing rule); rows are kept."""
    cols = {out: passes_all(rules)}
    if reason_col:
        cols[reason_col] = first_failing_rule(rules)
    return df.withColumns(cols)


def valid_only(df: DataFrame, flag_col: str = "is_valid_lap") -> DataFrame:
    """Rows whose flag is true (NULL flags are dropped)."""
    return df.filter(F.col(flag_col))


def validity_summary(df: DataFrame, flag_col: str = "is_valid_lap") -> DataFrame:
    """One pass, one row: ``valid_rows`` (flag = true), ``flagged_rows`` (flag = false)."""
    f = F.col(flag_col)
    return df.agg(F.count_if(f).alias("valid_rows"), F.count_if(~f).alias("flagged_rows"))


def retention(label: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """``(label, total, kept, dropped, dropped_pct)``; pct 0.0 for an empty input, one decimal.

    Two global counts (partial aggregates); the second is a scalar subquery.
    """
    kept = after.agg(F.count(F.lit(1))).scalar()
    out = before.agg(F.count(F.lit(1)).alias("total")) \
        .select("total", kept.alias("kept")).withColumn("dropped", F.col("total") - F.col("kept"))
    pct = F.when(F.col("total") > 0,
                 F.round(F.col("dropped").cast("double") * 100.0 / F.col("total"), 1)).otherwise(F.lit(0.0))
    return out.select(F.lit(label).alias("label"), "total", "kept", "dropped", pct.alias("dropped_pct"))
