"""Conforming helpers: ordered (deterministic) dedupe, audit stamps, dimension joins."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def dedupe(df: DataFrame, keys, order=None, keep: str = "max") -> DataFrame:
    """One row per ``keys``: the row with the largest (``keep='max'``) or smallest
    ``order`` tuple, ties broken by the remaining columns, so the pick is
    deterministic (``dropDuplicates`` keeps an arbitrary row).

    Built as a single ``max``/``min`` over a struct: a partial (map-side)
    aggregate, so a key that holds a third of all rows is pre-combined in
    every task before the shuffle instead of landing whole in one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order or [])
    rest = [c for c in df.columns if c not in keys and c not in order]
    payload = order + rest
    if not payload:
        return df.select(*keys).distinct()
    picker = F.max if keep == "max" else F.min
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(payload)])
    out = df.groupBy(*keys).agg(picker(packed).alias("_pick"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_pick._o{payload.index(c)}").alias(c)
                        for c in df.columns])


# Columns that say which of two versions of a row is the later one, most telling first.
RECENCY = ("_ingested", "_position")


def recency(df: DataFrame) -> list[Column]:
    """The input's ``ingested_at`` and payload position ``pos``, as far as it has them,
    under names that a projection can carry up to its dedupe."""
    have = dict(zip(("ingested_at", "pos"), RECENCY))
    return [F.col(c).alias(a) for c, a in have.items() if c in df.columns]


def ts_or_now(as_of) -> Column:
    """Audit timestamp: a fixed ``as_of`` (reproducible runs) or ``current_timestamp()``."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, (_dt.datetime, _dt.date)):
        return F.lit(as_of).cast("timestamp")
    return F.to_timestamp(F.lit(str(as_of)))


def hot_keys(fact: DataFrame, key: str, fraction: float) -> DataFrame:
    """Keys holding more than ``fraction`` of all rows: at most ``1/fraction`` rows,
    a proven bound.  Lazy: a partial count per key plus a one-row total."""
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.filter(F.col("_n") > total * F.lit(fraction)).select(key)


def join_dimension(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner", *,
                   split_hot: bool = False, hot_fraction: float = 0.001, salts: int | None = None) -> DataFrame:
    """Fact-to-dimension equi-join on ``key`` (dimension unique on ``key``), ``how``
    ``inner`` or ``left_anti``.

    Fact rows without a key meet nothing: an inner join drops them before the shuffle, an
    anti join passes them by it, so they are never dealt into one task.  The join itself is
    Catalyst's choice (AQE broadcasts a dimension it has measured and splits skewed
    partitions); nothing forces a broadcast on an estimate.

    ``split_hot``: a shuffle join on ``(key, salt)`` for facts whose hot keys are known to
    be too much for one task.  Keys with more than ``hot_fraction`` of the fact rows
    (<= 1/hot_fraction keys, by a partial count) spread their rows over ``salts`` values by
    a row hash; only their dimension rows are replicated once per salt.
    """
    keyed = fact.filter(F.col(key).isNotNull())
    rest = [fact.filter(F.col(key).isNull())] if how == "left_anti" else []
    if not split_hot:
        out = keyed.join(dim, key, how)
    else:
        from lapworks.session import shuffle_partitions
        n = salts or shuffle_partitions(fact.sparkSession)
        hot = F.broadcast(hot_keys(keyed, key, hot_fraction).withColumn("_hot", F.lit(True)))
        cols = fact.columns
        salted_fact = keyed.join(hot, key, "left").select(
            *cols, F.when(F.col("_hot"), F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(n)))
            .otherwise(F.lit(0)).cast("int").alias("_salt"))
        salted_dim = dim.join(hot, key, "left").select(
            *dim.columns, F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(n - 1)))
                                    .otherwise(F.array(F.lit(0)))).alias("_salt"))
        # the hint keeps this a shuffle join whatever the dimension's size
        out = salted_fact.join(salted_dim.hint("merge"), [key, "_salt"], how).drop("_salt")
    for r in rest:
        out = out.unionByName(r)
    return out
