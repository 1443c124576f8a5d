"""Hot groups cut by counts: rolling mean and median equal the plain forms, no task holds a group."""

import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lapworks.operators import metrics
from lapworks.operators.splits import balanced_buckets

HOW = dict(deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_million_laps_of_one_driver(many_partitions):
    """10^6 laps numbered 1 to 70: at least 16 tasks hold them, values equal the plain window."""
    spark = many_partitions
    laps = spark.range(1_000_000, numPartitions=8).select(
        F.lit("hot").alias("driver"), (F.col("id") % 70 + 1).cast("int").alias("lap"),
        (F.pmod(F.xxhash64("id"), F.lit(40_000)) / 1000 + 80).alias("v"))
    laps = laps.unionByName(spark.range(500).select(
        F.concat(F.lit("d"), F.col("id") % 50).alias("driver"), (F.col("id") / 50).cast("int").alias("lap"), F.lit(90.0).alias("v")))
    cut = balanced_buckets(laps, ["driver"], ["lap", "v"])
    sizes = {r["_bucket"]: r["n"] for r in cut.assign(laps).groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sizes.pop(None) == 500 and sum(sizes.values()) == 1_000_000
    assert len(sizes) >= 100 and max(sizes.values()) <= cut.target < 10_000
    spread = metrics.rolling_mean(laps, "v", ["driver"], ["lap"], out="r")
    per_task = laps_per_task(cut, laps)
    assert len(per_task) >= 16 and max(per_task) < 100_000
    plain = metrics.rolling_mean(laps, "v", ["driver"], ["lap"], out="r", distributed=False)
    assert plain.exceptAll(spread).count() == 0 and spread.count() == 1_000_500


def laps_per_task(cut, laps):
    """Rows of the hot driver by the partition that windows them."""
    placed = cut.assign(laps).filter("_bucket IS NOT NULL").repartition(32, "driver", "_bucket")
    return [r["n"] for r in placed.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


def test_buckets_grow_with_the_order(spark):
    rows = [("h", i % 7 if i % 11 else None, v) for i, v in enumerate(
        [None, math.nan, math.inf, -math.inf, -0.0, 0.0, 5e-324, 1e308, -1e308, *[x / 10 for x in range(400)]])]
    df = spark.createDataFrame(rows, "k string, i int, v double")
    got = balanced_buckets(df, ["k"], ["i", "v"], target_rows=9).assign(df).orderBy("i", "v").collect()
    buckets = [r["_bucket"] for r in got]
    assert buckets == sorted(buckets) and max(Counter(buckets).values()) <= 9


def test_far_apart_and_close_integers(spark):
    values = [-2**63, -2**63 + 1, 2**63 - 1, *range(2**60, 2**60 + 300), *[5] * 40]
    df = spark.createDataFrame([("h", v) for v in values], "k string, v long")
    got = balanced_buckets(df, ["k"], ["v"], target_rows=20).assign(df).orderBy("v").collect()
    buckets = [r["_bucket"] for r in got]
    assert buckets == sorted(buckets)
    sizes = Counter(buckets)
    assert sorted(sizes.values())[-1] == 40 and sorted(sizes.values())[-2] <= 20     # equal rows stay together


def test_nothing_hot(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    assert balanced_buckets(df, ["k"], ["v"]) is None
    assert balanced_buckets(df.limit(0), ["k"], ["v"]) is None


def expected_median(values):
    values = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v if not math.isnan(v) else 0))
    return repr(values[(len(values) + 1) // 2 - 1]) if values else None


@pytest.mark.parametrize("target", [None, 50])
def test_median_of_nan_and_close_values(many_partitions, target):
    """A group around 90.0 to 90.2, one that is half NaN, one all NaN, one all equal, infinities."""
    spark = many_partitions
    close = [90.0 + (i * 7919 % 20_011) / 100_055 for i in range(20_011)]
    data = {"close": close, "nan": [math.nan] * 300 + [float(i) for i in range(299)], "half": [math.nan] * 300 + [1.5] * 300,
            "all": [math.nan] * 500, "same": [7.25] * 800, "inf": [math.inf] * 200 + [-math.inf] * 201, None: [3.0, None, 1.0]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "k string, v double")
    got = {r.k: repr(r.m) for r in metrics.lower_median(df, ["k"], "v", "m", target_rows=target).collect()}
    assert got == {k: expected_median(vs) for k, vs in data.items()}


def test_median_orders_few_rows(many_partitions):
    """400,000 distinct values between 90.0 and 90.2: what is ordered is bounded by the target."""
    df = many_partitions.range(400_000).select(F.lit(1).alias("k"), (F.lit(90.0) + F.col("id") / 2_000_000).alias("v"))
    cut = balanced_buckets(df, ["k"], ["v"], at_rank=lambda n: (n + 1) // 2)
    sizes = cut.assign(df).groupBy("_bucket").count().orderBy("_bucket").collect()
    upto, at = 0, None
    for r in sizes:
        upto += r["count"]
        if at is None and upto >= 200_000:
            at = r["count"]
    assert at <= cut.target == 4096
    assert metrics.lower_median(df, ["k"], "v", "m").first().m == 90.0 + 199_999 / 2_000_000


number = st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True), st.integers(0, 3).map(float))


@settings(max_examples=10, **HOW)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), number), min_size=1, max_size=90), st.integers(1, 12))
def test_median_property(spark, rows, target):
    df = spark.createDataFrame(rows, "k string, v double")
    want = {}
    for k, v in rows:
        want.setdefault(k, []).append(v)
    want = {k: expected_median(vs) for k, vs in want.items()}
    got = {r.k: repr(r.m) for r in metrics.lower_median(df, ["k"], "v", "m", target_rows=target).collect()}
    zero = lambda d: {k: v.replace("-0.0", "0.0") if v == "-0.0" else v for k, v in d.items() if v is not None}
    assert zero(got) == zero(want)


@settings(max_examples=8, **HOW)
@given(st.lists(st.tuples(st.sampled_from(["a", None]), st.one_of(st.none(), st.integers(-3, 3), st.integers(-2**31, 2**31 - 1)),
                          st.one_of(st.none(), st.integers(0, 400).map(lambda x: x / 4))), min_size=1, max_size=90),
       st.integers(1, 12))
def test_rolling_property_with_ties(spark, rows, target):
    df = spark.createDataFrame(rows, "k string, i int, v double")
    plain, spread = (Counter(tuple(r) for r in metrics.rolling_mean(
        df, "v", ["k"], ["i"], out="r", avg_scale=2, distributed=d, target_rows=target).collect()) for d in (False, True))
    assert plain == spread


def test_bracketed_median_counts_few_values(many_partitions):
    """400,000 distinct values: the table of ``percentile_disc`` gets the few around the median."""
    df = many_partitions.range(400_000).select(
        F.lit("k").alias("k"), (F.col("id") * 7919 % 400_000 / 1_000 - 150).alias("v")).repartition(16)
    assert metrics.within_bracket(df, ["k"], "v").select("_near").distinct().count() < 400_000 // 100
    assert metrics.bracketed_median(df, ["k"], "v", "m").first().m == 199_999 / 1_000 - 150


def test_bracketed_median_of_odd_groups(many_partitions):
    spark = many_partitions
    data = {"nan": [math.nan] * 300 + [float(i) for i in range(299)], "half": [math.nan] * 300 + [1.5] * 300,
            "all": [math.nan] * 500, "same": [7.25] * 800, "inf": [math.inf] * 200 + [-math.inf] * 201,
            "top": [math.inf] * 9 + [math.nan] * 8 + [1.0], "null": [None, None], "one": [2.5], None: [3.0, None, 1.0]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "k string, v double").repartition(7)
    got = {r.k: None if r.m is None else repr(r.m) for r in metrics.bracketed_median(df, ["k"], "v", "m").collect()}
    assert got == {k: expected_median(vs) for k, vs in data.items()}
    assert metrics.bracketed_median(df.limit(0), ["k"], "v").count() == 0


def test_plain_median_of_one_group_reads_the_bracket(many_partitions, tmp_path):
    from lapworks.plans import suite
    rows = many_partitions.range(5_000).selectExpr(
        "id + 0.25 AS l_extendedprice", "id % 11 / 100 AS l_discount", "CAST(id % 50 AS DOUBLE) AS l_quantity")
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    df = suite.q_median_one_group_plain(many_partitions, str(tmp_path))
    assert "_near" in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.collect() == suite.q_median_one_group(many_partitions, str(tmp_path)).collect()
