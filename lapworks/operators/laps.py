"""Silver laps: retype, driver dimension, enrichment join, unmatched laps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapworks.functions.columns import nan_to_null, safe_cast, trimmed
from lapworks.operators.conform import RECENCY, dedupe, join_dimension, recency, ts_or_now
from lapworks.operators.schema import (DRIVERS_REQUIRED, ENRICHED_LAPS_CONTRACT, LAPS_REQUIRED,
                                       assert_columns)
from lapworks.operators.validity import flag, lap_rules


def retype(laps: DataFrame, lap_type: str = "int", duration_type: str = "float") -> DataFrame:
    """Typed laps: integer lap number, floating duration (NaN -> NULL), boolean pit flag,
    trimmed text driver number.  Bad text becomes NULL instead of failing the job."""
    dur = safe_cast("lap_duration", duration_type)
    if duration_type in ("float", "double"):
        dur = nan_to_null(dur, duration_type)
    return laps.withColumns({
        "lap_number": safe_cast("lap_number", lap_type),
        "lap_duration": dur,
        "is_pit_out_lap": safe_cast("is_pit_out_lap", "boolean"),
        "driver_number": trimmed(F.col("driver_number").cast("string")),
    })


def driver_dim(drivers: DataFrame) -> DataFrame:
    """Driver lookup: five columns, three trimmed, one row per driver number: the one
    ingested last (``ingested_at``, then ``pos``, where the input has them)."""
    df = drivers.select(
        trimmed(F.col("driver_number").cast("string")).alias("driver_number"),
        trimmed("full_name").alias("full_name"),
        trimmed("team_name").alias("team_name"),
        F.col("country_code"),
        F.col("headshot_url"), *recency(drivers),
    )
    return dedupe(df, "driver_number", order=[c for c in RECENCY if c in df.columns]).drop(*RECENCY)


def enrich(laps: DataFrame, drivers: DataFrame, min_duration: float = 60.0, *,
           lap_type: str = "int", duration_type: str = "float", rules=None,
           reason_col: str | None = None, as_of=None,
           split_hot: bool = False, hot_fraction: float = 0.001) -> DataFrame:
    """Silver ``enriched_laps``: guard both inputs, retype, inner-join the deduped
    driver dimension (``split_hot``: hot drivers salted over the join's tasks),
    flag validity (rows kept), project the contract."""
    assert_columns(laps, LAPS_REQUIRED, "bronze.raw_laps")
    assert_columns(drivers, DRIVERS_REQUIRED, "bronze.raw_drivers")
    dim = driver_dim(drivers)
    typed = retype(laps, lap_type, duration_type).select(*LAPS_REQUIRED)
    joined = join_dimension(typed, dim, "driver_number", "inner",
                            split_hot=split_hot, hot_fraction=hot_fraction)
    flagged = flag(joined, rules if rules is not None else lap_rules(min_duration),
                   reason_col=reason_col)
    cols = [c for c in ENRICHED_LAPS_CONTRACT if c != "processed_at"]
    if reason_col:
        cols.append(reason_col)
    return flagged.select(*cols, ts_or_now(as_of).alias("processed_at"))


def unmatched(laps: DataFrame, drivers: DataFrame, *, lap_type: str = "int",
              duration_type: str = "float", split_hot: bool = False, hot_fraction: float = 0.001) -> DataFrame:
    """Laps the inner join drops (no driver row): a left-anti join on the trimmed key."""
    dim = driver_dim(drivers).select("driver_number")
    return join_dimension(retype(laps, lap_type, duration_type).select(*LAPS_REQUIRED), dim,
                          "driver_number", "left_anti", split_hot=split_hot, hot_fraction=hot_fraction)


def cast_failures(laps: DataFrame, lap_type: str = "int", duration_type: str = "float") -> DataFrame:
    """One pass, one row: per retyped column, how many present values did not
    survive the cast (bad text becomes NULL instead of failing the job)."""
    def lost(col: str, to: str):
        return F.count_if(F.col(col).isNotNull() & safe_cast(col, to).isNull())
    return laps.agg(lost("lap_number", lap_type).alias("lap_number_failed"),
                    lost("lap_duration", duration_type).alias("lap_duration_failed"),
                    lost("is_pit_out_lap", "boolean").alias("is_pit_out_lap_failed"),
                    F.count(F.lit(1)).alias("rows"))
