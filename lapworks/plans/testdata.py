"""Binding of the generated parquet tables to the racing data model.

laps     <- events    (user_id -> driver_number text, event_id -> lap_number,
                       value -> lap_duration, event_type 'error' -> pit-out lap)
drivers  <- customer  (c_custkey -> driver_number, c_name -> full_name,
                       c_mktsegment -> team_name, c_nationkey -> country_code)
sessions <- orders    (o_orderkey -> session_key, o_orderstatus -> session type
                       text with stray case and spaces, o_orderdate -> start)

Every binding reads whole tables; column projections reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapworks.operators import laps as laps_ops

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values of the binding: the test data carries 2-decimal durations well
# below real lap times, ids beyond the int range at scale, and no real clock.
MIN_DURATION = 1.0
LAP_TYPE = "bigint"
DURATION_TYPE = "double"
AVG_SCALE = 2
SEASON_YEAR = 2025
AS_OF = "2025-01-01 00:00:00"
STATUS_TO_TYPE = {"F": "Race", "O": " qualifying ", "P": "Practice 1"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("driver_number"),
        F.col("event_id").alias("lap_number"),
        F.col("value").alias("lap_duration"),
        (F.col("event_type") == F.lit("error")).alias("is_pit_out_lap"),
    )


def bronze_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("driver_number"),
        F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("team_name"),
        F.col("c_nationkey").cast("string").alias("country_code"),
        F.concat(F.lit("img/"), F.col("c_custkey").cast("string")).alias("headshot_url"),
    )


def _iso_utc(ntz):
    """ISO text with a ``Z`` offset from a wall-clock (NTZ) value, independent of the
    session time zone (``date_format`` would pass through the session zone)."""
    return F.concat(F.regexp_replace(ntz.cast("string"), " ", "T"), F.lit("Z"))


def bronze_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw session payload rows: ISO text dates in UTC (``...Z``, as list
    endpoints send them), untrimmed / mixed-case type text, padded names; ``pos``
    is the payload position (the order key)."""
    o = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    stype = F.when(status == "F", F.lit(STATUS_TO_TYPE["F"])) \
        .when(status == "O", F.lit(STATUS_TO_TYPE["O"])) \
        .otherwise(F.lit(STATUS_TO_TYPE["P"]))
    start = F.col("o_orderdate")
    return o.select(
        F.col("o_orderkey").alias("session_key"),
        F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")).alias("session_name"),
        stype.alias("session_type"),
        F.concat(F.lit("Circuit "), F.col("o_custkey").cast("string")).alias("location"),
        F.concat(F.lit(" "), F.col("o_orderpriority")).alias("country_name"),
        F.year(start).alias("year"),
        _iso_utc(start).alias("date_start"),
        _iso_utc(start + F.expr("INTERVAL 2 HOURS")).alias("date_end"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Baku"))
         .otherwise(F.lit("Monza")).alias("circuit_short_name"),
        F.col("o_orderkey").alias("pos"),
    )


def enriched_laps(spark: SparkSession, sf_dir: str, *, reason_col: str | None = None) -> DataFrame:
    return laps_ops.enrich(bronze_laps(spark, sf_dir), bronze_drivers(spark, sf_dir), MIN_DURATION,
                           lap_type=LAP_TYPE, duration_type=DURATION_TYPE,
                           reason_col=reason_col, as_of=AS_OF)
