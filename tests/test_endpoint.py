"""A list endpoint as a table: DataFrame filters become URL parameters."""

import re

import pytest
from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringStartsWith
from pyspark.sql.types import StructType

from lapworks.sources import endpoint, rest

SF = "/root/testdata/sf0.001"
SCHEMA = StructType().add("year", "integer").add("kind", "string").add("speed", "double")


def reader(**options):
    options = {"url": "https://h/v1/car_data", "filters": '{"year": "=", "speed": "= > >= < <=", "kind": "="}', **options}
    return endpoint.RestListReader(SCHEMA, {k.lower(): v for k, v in options.items()})


def urls(r):
    return [p.url for p in r.partitions()]


def test_filters_become_parameters():
    r = reader()
    assert urls(r) == ["https://h/v1/car_data"]
    known, unknown, other = EqualTo(("year",), 2025), StringStartsWith(("kind",), "R"), EqualTo(("lap",), 3)
    assert list(r.pushFilters([known, unknown, GreaterThan(("speed",), 250.0), other])) == [unknown, other]
    assert urls(r) == ["https://h/v1/car_data?year=2025&speed>250.0"]
    assert list(r.pushFilters([EqualTo(("speed",), float("nan"))])) != []        # no text for it: Spark's
    assert list(reader().pushFilters([GreaterThan(("year",), 2024)])) != []      # an operator the endpoint has not


def test_requests_are_spread():
    r = reader(url="https://h/v1/laps?session_key=9", partitionColumn="speed", lowerBound="0", upperBound="300", numPartitions="3")
    assert list(r.pushFilters([In(("kind",), ("a b", "c&d", "a b"))])) == []
    assert urls(r) == [f"https://h/v1/laps?session_key=9&kind={k}&{s}" for k in ("a%20b", "c%26d")
                       for s in ("speed<100", "speed>=100&speed<200", "speed>=200")]


def test_values_take_the_declared_types():
    kind = {f.name: f.dataType for f in
            StructType().add("i", "integer").add("d", "double").add("s", "string").add("b", "boolean")}
    got = [endpoint._typed(v, kind[k]) for k, v in [("i", 3), ("i", 3.0), ("i", 3.5), ("i", "x"), ("d", 2), ("d", None), ("d", True),
                                                    ("s", "t"), ("s", [1, {"a": None}]), ("s", 5), ("b", True), ("b", 1)]]
    assert got == [3, 3, None, None, 2.0, None, None, "t", '[1, {"a": null}]', "5", True, None]


def test_query_equals_the_filtered_table(spark):
    from lapworks.plans import suite
    df = suite.q_rest_pushdown(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    left = re.search(r"Filter .*", plan).group(0)                                # what is left to Spark
    assert "user_id" in left and "50" not in left and "17" not in left and "event_type" not in left, plan
    want = spark.read.parquet(f"{SF}/events.parquet").filter(
        "event_type IN ('purchase', 'view') AND value > 50 AND event_id >= 17 AND user_id % 2 = 0")
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.select(*df.columns).collect())) != []
    assert suite.endpoint_events(spark, SF).count() == spark.read.parquet(f"{SF}/events.parquet").count()



def test_a_failed_request_fails_the_read(spark):
    endpoint.register(spark)
    df = spark.read.format("rest_list").schema("a INT").options(
        url="https://h/x", transport=f"{rest.__name__}:gone", retryDelay="0").load()
    with pytest.raises(Exception, match="gone"):
        df.collect()
    plain = spark.read.format("rest_list").schema("a INT").options(url="file:///etc/hostname", retryDelay="0").load()
    with pytest.raises(Exception, match="client_error"):
        plain.collect()


def test_ranges_between_given_cuts():
    r = reader(partitionColumn="speed", partitionCuts="[5, 70]")
    assert urls(r) == [f"https://h/v1/car_data?{s}" for s in ("speed<5", "speed>=5&speed<70", "speed>=70")]
    assert urls(reader(partitionColumn="speed", partitionCuts="[]")) == ["https://h/v1/car_data"]


def test_cuts_follow_the_rows(spark):
    """Ids that lie close together and far apart, one of them often, some null."""
    ids = list(range(900)) + [10**12 + 10**9 * i for i in range(900)] + [5] * 150 + [None] * 50
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(5)
    cuts = endpoint.even_cuts(df, "id", 200)
    ends = [-1, *cuts, 10**15]
    sizes = [sum(a <= i < b for i in ids if i is not None) for a, b in zip(ends, ends[1:])]
    assert len(cuts) == 9 and sum(sizes) == 1950 and max(sizes) <= 200 + 150, sizes
    assert endpoint.even_cuts(df, "id", 5000) == [] != endpoint.even_cuts(df, "id", 5000, least=4)
    assert endpoint.even_cuts(df.filter("id IS NULL"), "id", 10) == endpoint.even_cuts(df.limit(0), "id", 10) == []


def test_requests_grow_with_the_table(spark, tmp_path, monkeypatch):
    """No request answers with a large part of a table whose ids go past 10,000."""
    from lapworks.plans import suite
    monkeypatch.setattr(suite, "REQUEST_ROWS", 1000)
    path = f"{tmp_path}/events.parquet"
    spark.range(20_000).selectExpr(
        "id + 7000 AS event_id", "CURRENT_TIMESTAMP() AS ts", "id % 97 AS user_id", "IF(id % 2 = 0, 'view', 'click') AS event_type",
        "CAST(id % 101 AS DOUBLE) AS value", "CAST(NULL AS STRING) AS props").write.parquet(path)
    df = suite.endpoint_events(spark, str(tmp_path))
    sizes = [len(p) for p in df.select("event_id").rdd.glom().collect()]
    assert len(sizes) == 20 and sum(sizes) == 20_000 and max(sizes) <= 1100, sizes
    got = suite.q_rest_pushdown(spark, str(tmp_path))
    want = spark.read.parquet(path).filter("event_type IN ('purchase', 'view') AND value > 50 AND user_id % 2 = 0")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect())) != []
