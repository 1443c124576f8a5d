"""Declarative data-quality checks run as Spark aggregates (Q1-Q10).

All checks of a table are one pass and one exchange: a row stands once for the
row/missing/invalid/min/max metrics and once for each duplicate-checked value, and rows
are counted by (check, value) with partial aggregates.  Metrics that the job which wrote
the table has observed (``observable``) need no pass at all.  The result is a DataFrame,
one row per check:
``(table, check, metric, column, filter, value, op, threshold, outcome)``.
``outcome`` is ``pass``, ``fail``, or ``error`` when the metric is NULL (e.g.
``min`` over zero rows), so the gate fails closed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, DoubleType, FloatType, MapType, StringType, StructField, StructType,
                               TimestampType)

METRICS = ("row_count", "missing_count", "duplicate_count", "invalid_count", "min", "max")
OPS = ("=", "!=", ">", ">=", "<", "<=")


@dataclass(frozen=True)
class Check:
    name: str
    metric: str
    op: str
    threshold: float
    column: str | None = None
    filter: str | None = None          # Spark SQL predicate, e.g. "is_valid_lap = true"
    valid_values: tuple | None = None
    valid_min: float | None = None
    valid_max: float | None = None

    def __post_init__(self):
        if self.metric not in METRICS:
            raise ValueError(f"unknown metric {self.metric!r}")
        if self.op not in OPS:
            raise ValueError(f"unknown operator {self.op!r}")
        if self.metric != "row_count" and not self.column:
            raise ValueError(f"check {self.name} needs a column")


RESULT_SCHEMA = StructType([
    StructField("table", StringType()), StructField("check", StringType()),
    StructField("metric", StringType()), StructField("column", StringType()),
    StructField("filter", StringType()), StructField("value", DoubleType()),
    StructField("op", StringType()), StructField("threshold", DoubleType()),
    StructField("outcome", StringType()),
])


def _pred(check: Check) -> Column:
    return F.expr(check.filter) if check.filter else F.lit(True)


def metric_column(check: Check, among: Column | None = None) -> Column:
    """The single-pass aggregate for every metric except ``duplicate_count``, over the
    rows of ``among``."""
    p = _pred(check) if among is None else among & _pred(check)
    if check.metric == "row_count":
        return F.count_if(p)
    c = F.col(check.column)
    if check.metric == "missing_count":
        return F.count_if(p & c.isNull())
    if check.metric == "invalid_count":
        bad = F.lit(False)
        if check.valid_values is not None:
            bad = bad | ~c.isin(*check.valid_values)
        if check.valid_min is not None:
            bad = bad | (c < F.lit(check.valid_min))
        if check.valid_max is not None:
            bad = bad | (c > F.lit(check.valid_max))
        return F.count_if(p & c.isNotNull() & bad)
    if check.metric == "min":
        return F.min(F.when(p, c))
    if check.metric == "max":
        return F.max(F.when(p, c))
    raise ValueError(check.metric)


def observable(checks: list[Check]) -> dict[str, Column]:
    """Check name -> aggregate, for all but the duplicate checks: metrics that the job
    writing the table can observe (``sources.tables.write_table(metrics=...)``)."""
    return {c.name: metric_column(c).try_cast("double") for c in checks if c.metric != "duplicate_count"}


def _as_text(df: DataFrame, column: str) -> Column:
    """Values as text, different ones differently (and as grouping has them: 0.0 is -0.0)."""
    c, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, StringType):
        return c
    if isinstance(kind, (FloatType, DoubleType)):
        return (c + F.lit(0.0).cast(kind)).cast("string")
    if isinstance(kind, TimestampType):
        return F.unix_micros(c).cast("string")        # local text repeats an hour a year
    if isinstance(kind, BinaryType):
        return F.hex(c)
    if isinstance(kind, (ArrayType, MapType, StructType)):
        return F.to_json(F.struct(c))
    return c.cast("string")


_ROW = -1


def metric_values(df: DataFrame, checks: list[Check]) -> DataFrame:
    """``check, value`` of every check that has rows to count, in one pass over ``df``.

    Each row gives one entry for the single-pass metrics and one for each duplicate check
    it belongs to; a duplicate count is the number of distinct non-null values that occur
    more than once.  A value that holds most rows is counted in every task before the
    shuffle.
    """
    single = [c for c in checks if c.metric != "duplicate_count"]
    dups = [c for c in checks if c.metric == "duplicate_count"]
    if not dups:
        agg = df.agg(*[metric_column(c).try_cast("double").alias(f"m{i}") for i, c in enumerate(single)])
        return agg.select(F.inline(F.array(*[
            F.struct(F.lit(c.name).alias("check"), F.col(f"m{i}").alias("value")) for i, c in enumerate(single)])))
    entry = lambda i, v: F.struct(F.lit(i).alias("__check"), v.cast("string").alias("__value"))
    entries = [entry(i, F.when(_pred(c), _as_text(df, c.column))) for i, c in enumerate(dups)]
    if single:
        entries.append(entry(_ROW, F.lit(None)))
    stacked = df.select("*", F.inline(F.array(*entries))).filter((F.col("__check") == _ROW) | F.col("__value").isNotNull())
    row = F.col("__check") == _ROW
    counted = stacked.groupBy("__check", "__value").agg(
        F.count(F.lit(1)).alias("__n"),
        *[metric_column(c, row).try_cast("double").alias(f"__m{i}") for i, c in enumerate(single)])
    by_check = counted.groupBy("__check").agg(
        F.count_if(F.col("__n") > 1).cast("double").alias("__d"),
        *[F.max(f"__m{i}").alias(f"__m{i}") for i in range(len(single))])
    pair = lambda name, v: F.struct(name.alias("check"), v.alias("value"))
    out = F.array(pair(F.element_at(F.array(*[F.lit(c.name) for c in dups]), F.greatest(F.col("__check") + 1, F.lit(1))),
                       F.col("__d")))
    if single:
        out = F.when(row, F.array(*[pair(F.lit(c.name), F.col(f"__m{i}")) for i, c in enumerate(single)])).otherwise(out)
    return by_check.select(F.inline(out))


def _compare(value: Column, op: str, threshold: Column) -> Column:
    return {"=": value == threshold, "!=": value != threshold, ">": value > threshold,
            ">=": value >= threshold, "<": value < threshold, "<=": value <= threshold}[op]


def run_checks(df: DataFrame | None, checks: list[Check], table: str, known: dict | None = None) -> DataFrame:
    """Evaluate ``checks`` on ``df``; returns the result frame (lazy).

    ``known``: values of checks that were observed when the table was written (see
    ``observable``); only the others read ``df`` (which may be None if there are none).
    """
    names = [c.name for c in checks]
    if len(set(names)) != len(names):
        raise ValueError("check names must be unique per table")
    known = {n: v for n, v in (known or {}).items() if n in names}
    rest = [c for c in checks if c.name not in known]
    spark = df.sparkSession if df is not None else SparkSession.getActiveSession()
    spec = spark.createDataFrame(
        [(table, c.name, c.metric, c.column, c.filter, known.get(c.name), c.op, float(c.threshold), None)
         for c in checks], RESULT_SCHEMA).drop("outcome")
    if rest:
        # one row per check on both sides
        found = F.broadcast(metric_values(df, rest).select("check", F.col("value").alias("_found")))
        spec = spec.join(found, "check", "left").withColumn("value", F.coalesce("value", "_found"))
        # a count without rows is zero, a min or max without rows stays an error
        count = F.col("metric").isin("row_count", "missing_count", "invalid_count", "duplicate_count")
        asked = F.col("check").isin([c.name for c in rest])
        spec = spec.withColumn("value", F.when(count & asked & F.col("value").isNull(), 0.0).otherwise(F.col("value")))
    outcome = F.when(F.col("value").isNull(), F.lit("error"))
    for op in OPS:
        outcome = outcome.when((F.col("op") == op) & _compare(F.col("value"), op, F.col("threshold")),
                               F.lit("pass"))
    outcome = outcome.otherwise(F.lit("fail"))
    return spec.select("table", "check", "metric", "column", "filter", "value", "op",
                       "threshold", outcome.alias("outcome"))


class QualityGateError(RuntimeError):
    pass


def gate(results: DataFrame, label: str = "quality") -> list:
    """Raise when any check did not pass.  Collects only non-passing rows,
    bounded by the number of checks.  Returns the collected failures (empty)."""
    bad = results.filter(F.col("outcome") != "pass").orderBy("table", "check").collect()
    if bad:
        lines = ", ".join(f"{r['table']}:{r['check']}={r['value']} ({r['outcome']})" for r in bad)
        raise QualityGateError(f"{label} gate failed: {len(bad)} check(s): {lines}")
    return bad
