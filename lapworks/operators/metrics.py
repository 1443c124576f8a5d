"""Pace aggregates (A3-A7), dense rank (W1, W2) and rolling mean.

The windowed operators come in two physical forms with identical results:

* ``distributed=True`` (default) - no task holds a hot entity or the whole table.  Hot
  entities are cut by exact counts (``splits``), each bucket is windowed by itself, and
  the few rows whose result depends on an earlier bucket are completed from a bounded
  side table.
* ``distributed=False`` - the plain window, for inputs the caller knows to be small.

What is hot is counted, not estimated.
"""

from __future__ import annotations

from functools import reduce
from itertools import takewhile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, NumericType

from lapworks.functions.columns import EXACT_SCALE, exact_avg
from lapworks.operators.splits import balanced_buckets
from lapworks.session import materialize, shuffle_partitions


def _avg(value: str, avg_scale: int | None, decimals: int) -> Column:
    if avg_scale is None:
        return F.round(F.avg(value), decimals)
    return exact_avg(value, avg_scale, decimals)


def to_int(c: Column) -> Column:
    """Contract cast of a count or rank to int; an error when it does not fit."""
    return F.when(c > F.lit(2**31 - 1), F.raise_error(F.concat(F.lit("past the int range: "), c.cast("string")))
                  .cast("int")).otherwise(c.cast("int"))


def pace_columns(value: str = "lap_duration", count_col: str = "lap_number", *,
                 decimals: int = 3, avg_scale: int | None = EXACT_SCALE,
                 names: dict | None = None, with_median: bool = True,
                 with_stddev: bool = True) -> list[Column]:
    """min / avg / lower median / sample std-dev (n=1 -> 0) / non-null count.

    All are partial aggregates.  ``with_median`` adds the exact lower median as
    ``percentile_disc`` (a value-count table per group: for groups known to be small;
    ``lower_median`` gives the same values without such a table).
    """
    n = {"min": "fastest_lap_s", "avg": "avg_lap_time_s", "median": "median_lap_time_s",
         "stddev": "lap_consistency_s", "count": "total_valid_laps"}
    n.update(names or {})
    cols = [F.round(F.min(value), decimals).alias(n["min"]),
            _avg(value, avg_scale, decimals).alias(n["avg"])]
    if with_median:
        cols.append(F.round(F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{value}`)"), decimals).alias(n["median"]))
    if with_stddev:
        cols.append(F.round(F.coalesce(F.stddev(value), F.lit(0)), decimals).alias(n["stddev"]))
    # int is the contract: a count past 2^31 fails the job, it never wraps or goes missing
    cols.append(to_int(F.count(count_col)).alias(n["count"]))
    return cols


def _sort_spec(order) -> list[tuple[str, Column]]:
    """``"a"`` or ``("a", "asc")`` -> ascending, NULLs first; ``("b", "desc")`` -> descending, NULLs last."""
    out = []
    for o in order:
        name, direction = (o, "asc") if isinstance(o, str) else o
        c = F.col(name)
        out.append((name, c.asc_nulls_first() if direction == "asc" else c.desc_nulls_last()))
    return out


def dense_rank(df: DataFrame, order, out: str = "rank", *,
               distributed: bool = True, num_ranges: int | None = None) -> DataFrame:
    """``dense_rank() OVER (ORDER BY order)`` as an int column ``out``.

    Distributed form: the *distinct* sort keys are ranked (a hot key collapses in the
    map-side partial aggregate), then the rank is joined back.  The keys are
    range-partitioned and numbered inside each range; that numbered table (distinct keys
    only) is written once to the shared folder, so everything after it reads one
    assignment of keys to ranges.  Each range is shifted by the keys of all earlier ones;
    the shifts have one row per range (<= ``num_ranges``), a proven bound, so they are
    broadcast.  The join back is a null-safe equi-join left to Catalyst and AQE.
    """
    spec = _sort_spec(order)
    if not distributed:
        return df.withColumn(out, to_int(F.dense_rank().over(Window.orderBy(*[c for _, c in spec]))))
    n = num_ranges or shuffle_partitions(df.sparkSession)
    knames = [f"_k{i}" for i in range(len(spec))]
    dirs = ["asc" if isinstance(o, str) else o[1] for o in order]
    ksorts = [c for _, c in _sort_spec(list(zip(knames, dirs)))]
    keys = df.select(*[F.col(name).alias(k) for (name, _), k in zip(spec, knames)]).distinct()
    local = materialize(keys.repartitionByRange(n, *ksorts)
                        .withColumn("_pid", F.spark_partition_id())
                        .withColumn("_lr", F.row_number().over(Window.partitionBy("_pid").orderBy(*ksorts))))
    sizes = local.groupBy("_pid").agg(F.max("_lr").alias("_nk"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_nk").over(before), F.lit(0)).alias("_off"))
    ranked = local.join(F.broadcast(offsets), "_pid") \
        .select(*knames, to_int(F.col("_lr") + F.col("_off")).alias(out))
    cond = [df[name].eqNullSafe(ranked[k]) for (name, _), k in zip(spec, knames)]
    return df.join(ranked, cond, "inner").drop(*knames)


def rolling_mean(df: DataFrame, value: str, partition_by: list[str], order_by: list[str], *,
                 rows: int = 5, out: str = "rolling_mean", decimals: int = 3,
                 avg_scale: int | None = EXACT_SCALE, distributed: bool = True,
                 target_rows: int | None = None, tiebreak: bool = True) -> DataFrame:
    """Mean over the current and up to ``rows - 1`` preceding rows of the same
    entity (``ROWS BETWEEN rows-1 PRECEDING AND CURRENT ROW``), rounded.

    Rows that tie on the order go by their other columns, the value first.

    Distributed form: entities of more than ``target_rows`` rows (by default a share of all
    rows, see ``splits.balanced_buckets``) are cut into count-balanced buckets along the
    order columns and, for ties, the value (up to the first that is no number).  One exchange
    by (entity, bucket) moves every row.  The first ``rows - 1`` rows of each later bucket are
    computed again from a side table with only the first and last ``rows - 1`` rows of every
    bucket; the two disjoint parts are unioned.  Without such an entity it is the plain
    window.  Rows that agree in the order and in the value share a bucket.
    """
    k = rows - 1
    cols = df.columns
    order = [F.col(c) for c in order_by]
    if tiebreak:
        rest = [c for c in [value, *cols] if c not in order_by and c not in partition_by]
        order += [F.col(c) for c in dict.fromkeys(rest)]
    if avg_scale is None:
        def mean(w):
            return F.avg(value).over(w)
        finish = (lambda c: F.round(c, decimals))
    else:
        dec = F.col(value).cast(DecimalType(18 + avg_scale, avg_scale))

        def mean(w):
            return F.try_divide(F.sum(dec).over(w), F.count(dec).over(w))
        finish = (lambda c: F.round(c, decimals).cast("double"))
    along = [c for c in dict.fromkeys([*order_by, *([value] if tiebreak else [])]) if c not in partition_by]
    dims = list(takewhile(lambda c: isinstance(df.schema[c].dataType, NumericType), along))
    cut = balanced_buckets(df, partition_by, dims, target_rows=target_rows) if distributed and dims else None
    if cut is None:
        w = Window.partitionBy(*partition_by).orderBy(*order).rowsBetween(-k, 0)
        return df.withColumn(out, finish(mean(w)))
    run = Window.partitionBy(*partition_by, "_bucket")
    local = cut.assign(df).withColumns({
        "_i": F.row_number().over(run.orderBy(*order)),
        "_m": F.count(F.lit(1)).over(run),
    }).withColumn("_v", mean(run.orderBy(*order).rowsBetween(-k, 0)))
    # a bucket's first rows look back into the bucket before
    again = (F.coalesce("_bucket", F.lit(0)) > 0) & (F.col("_i") <= k)
    edges = local.filter(F.col("_bucket").isNotNull() & (again | (F.col("_i") > F.col("_m") - k)))
    across = Window.partitionBy(*partition_by).orderBy("_bucket", *order).rowsBetween(-k, 0)
    heads = edges.withColumn("_v", mean(across)).filter(again)
    both = local.filter(~again).select(*cols, "_v").unionByName(heads.select(*cols, "_v"))
    return both.withColumn(out, finish(F.col("_v"))).drop("_v")


def lower_median(df: DataFrame, keys: list[str], value: str, out: str = "median", *,
                 target_rows: int | None = None) -> DataFrame:
    """Per group of ``keys`` (nulls are keys like any other): the exact lower median of
    ``value``, the element at rank ceil(n/2) ascending, NULLs ignored and NaN last, as
    ``(keys..., out)``.

    Groups of more than ``target_rows`` rows are narrowed down first: the part that holds
    the median is cut again and again by counts (``splits.balanced_buckets`` around that
    rank) and only its bucket goes on.  What is left is a (group, value) histogram by
    partial count, ordered inside each group: never more than about ``target_rows`` values
    of a group, unless they are equal.
    """
    present = df.select(*keys, value).filter(F.col(value).isNotNull())
    cut = balanced_buckets(present, keys, [value], target_rows=target_rows, at_rank=lambda n: (n + 1) // 2)
    within = F.lit(None).cast("long")
    if cut is not None:
        placed = cut.assign(present)
        group = Window.partitionBy(*keys)
        # at most one row per bucket
        sizes = placed.filter("_bucket IS NOT NULL").groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        upto = F.sum("_n").over(group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
        at = sizes.withColumns({"_upto": upto, "_all": F.sum("_n").over(group)}) \
            .withColumn("_rank", F.floor((F.col("_all") + 1) / 2)) \
            .filter((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank"))) \
            .select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_gb"),
                    (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_within"))
        same = [placed[k].eqNullSafe(at[f"_g{i}"]) for i, k in enumerate(keys)] + [placed["_bucket"] == at["_gb"]]
        # one row per hot group, fewer than the pieces of ``splits``
        present = placed.join(F.broadcast(at), same, "left").filter("_bucket IS NULL OR _within IS NOT NULL")
        within = F.max("_within")
    hist = present.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"), within.alias("_within")) \
        if cut is not None else present.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c")).withColumn("_within", within)
    group = Window.partitionBy(*keys)
    cum = hist.withColumns({
        "_upto": F.sum("_c").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)),
        "_rank": F.coalesce("_within", F.floor((F.sum("_c").over(group) + 1) / 2))})
    return cum.filter((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_c") < F.col("_rank"))) \
        .select(*keys, F.col(value).alias(out))


BRACKET = 3e-4               # share of the rows on either side of the median that stays as it is
_ACCURACY = 10_000           # of the bracket's sketch: its ranks err by a third of that share at most


def within_bracket(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``df`` with a bracket ``_lo``, ``_hi`` around each group's median, from a mergeable
    sketch, and the value as ``_near``: moved to the bracket's nearer end if it is outside.
    That keeps the order, so the median of ``_near`` is that of the value."""
    kind = df.schema[value].dataType
    v, real = F.col(value), kind.typeName() in ("double", "float")
    top, nan = F.lit(float("inf")).cast(kind), F.lit(float("nan")).cast(kind)
    # the sketch has no place for NaN: it counts as infinity, and then nothing is cut above
    sketch = F.percentile_approx(F.when(F.isnan(v), top).otherwise(v) if real else v,
                                 [0.5 - BRACKET, 0.5 + BRACKET], _ACCURACY)
    lo, hi = F.col("_cut")[0], F.col("_cut")[1]
    cut = df.groupBy(*keys).agg(sketch.alias("_cut")).select(
        *[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], lo.alias("_lo"),
        (F.when(hi == top, nan).otherwise(hi) if real else hi).alias("_hi"))
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(cut[f"_g{i}"]) for i, k in enumerate(keys)])
    return df.join(F.broadcast(cut), same).select(
        *keys, value, "_lo", "_hi", F.when(v.isNotNull(), F.greatest(F.least(v, "_hi"), "_lo")).alias("_near"))


def bracketed_median(df: DataFrame, keys: list[str], value: str, out: str = "median") -> DataFrame:
    """Per group of ``keys`` (few groups; nulls are keys like any other): the exact lower
    median as ``percentile_disc`` gives it, NULLs ignored and NaN last, as ``(keys..., out)``.

    The value-count table of ``percentile_disc`` holds every distinct value of a group; here
    it holds those of ``within_bracket``, less than a hundredth of a group's rows unless that
    is small.  The rows on either side are counted: a bracket without the median fails the job.
    """
    v = F.col(value)
    found = within_bracket(df, keys, value).groupBy(*keys).agg(
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY _near)").alias("_m"), F.count(v).alias("_n"),
        F.count_if(v < F.col("_lo")).alias("_below"), F.count_if(v <= F.col("_hi")).alias("_upto"))
    rank = F.floor((F.col("_n") + 1) / 2)
    held = (F.col("_n") == 0) | ((F.col("_below") < rank) & (rank <= F.col("_upto")))
    missed = F.raise_error(F.lit("the median is outside its bracket")).cast(found.schema["_m"].dataType)
    return found.select(*keys, F.when(held, F.col("_m")).otherwise(missed).alias(out))
