"""Bronze normalisation, payload parsing and the target-session resolver."""

import json
import math

from pyspark.sql import Row
from pyspark.sql import functions as F

from lapworks.operators import bronze, sessions
from lapworks.sources import payloads


def test_null_sentinels_only_in_strings(spark):
    df = spark.createDataFrame([("a", 1, 1.1), ("b", 2, 2.2), (None, 3, 3.3), ("None", 4, 4.4),
                                ("nan", 5, 5.5), ("NaN", 6, 6.6), (" None", 7, 7.7)],
                               "col_str string, col_int int, col_float double")
    out = bronze.null_sentinels(df).orderBy("col_int").collect()
    assert [r.col_str for r in out] == ["a", "b", None, None, None, None, " None"]
    assert [r.col_int for r in out] == [1, 2, 3, 4, 5, 6, 7]
    assert dict(bronze.null_sentinels(df).dtypes)["col_float"] == "double"


def test_nan_to_null_and_void_and_complex(spark):
    df = spark.createDataFrame([(float("nan"), [1, 2], Row(a=1)), (1.5, [3], Row(a=2))],
                               "d double, arr array<int>, s struct<a:int>") \
        .withColumn("v", F.lit(None))
    out = bronze.void_to_string(bronze.stringify_complex(bronze.nan_to_null(df)))
    types = dict(out.dtypes)
    assert types["v"] == "string" and types["arr"] == "string" and types["s"] == "string"
    rows = out.collect()
    assert rows[0].d is None and rows[1].d == 1.5
    assert rows[0].arr == "[1,2]" and json.loads(rows[1].s) == {"a": 2}


def test_stamp_adds_audit_columns(spark):
    df = spark.createDataFrame([(1,)], "x int")
    out = bronze.stamp(df, "Baku", as_of="2025-01-01 00:00:00")
    r = out.collect()[0]
    assert r.race_location == "Baku" and str(r.ingested_at).startswith("2025-01-01")


def test_classify_and_explode(spark):
    df = spark.createDataFrame([("a", '[{"x": 1, "y": "u"}, {"x": 2, "z": [1, 2]}]'),
                                ("b", '{"error": "bad"}'), ("c", "[]"), ("d", "not json")],
                               "source string, payload string")
    shapes = {r.source: r.shape for r in payloads.classify(df).collect()}
    assert shapes == {"a": "list", "b": "object", "c": "empty_list", "d": "unparsable"}
    typed = payloads.to_columns(payloads.explode_records(df)).orderBy("pos").collect()
    assert [(r.source, r.pos, r.x, r.y) for r in typed] == [("a", 0, 1, "u"), ("a", 1, 2, None)]
    assert typed[1].z == "[1,2]"


def _sessions(spark, rows):
    return spark.createDataFrame(rows, "pos int, session_key int, session_type string, "
                                       "circuit_short_name string")


def test_resolver_picks_matching_race(spark):
    df = _sessions(spark, [(0, 101, "Practice 1", "Silverstone"), (1, 102, "Race", "Silverstone"),
                           (2, 103, "Practice 2", "Silverstone")])
    r = sessions.resolve_target(df, "Race", "Silverstone").collect()
    assert len(r) == 1 and r[0].session_key == 102 and r[0].matched_circuit


def test_resolver_takes_last_match(spark):
    df = _sessions(spark, [(0, 201, "Race", "Silverstone"), (1, 202, "Practice 1", "Silverstone"),
                           (2, 203, "Race", "Silverstone")])
    assert sessions.resolve_target(df, "Race", "Silverstone").collect()[0].session_key == 203


def test_resolver_fallback_to_last_race(spark):
    df = _sessions(spark, [(0, 301, "Race", "Monza"), (1, 302, "Race", "Monza"),
                           (2, 303, "Practice 1", "Silverstone")])
    r = sessions.resolve_target(df, "Race", "Silverstone").collect()
    assert r[0].session_key == 302 and r[0].matched_circuit is False


def test_resolver_none(spark):
    df = _sessions(spark, [(0, 301, "Practice 1", "Monza")])
    assert sessions.resolve_target(df, "Race", "Silverstone").collect() == []
    empty = _sessions(spark, [])
    assert sessions.resolve_target(empty, "Race", "Silverstone").collect() == []


def test_resolver_is_case_sensitive(spark):
    df = _sessions(spark, [(0, 1, "race", "Silverstone"), (1, 2, "Race", "silverstone")])
    r = sessions.resolve_target(df, "Race", "Silverstone").collect()
    assert r[0].session_key == 2 and r[0].matched_circuit is False


def test_nan_average_is_fixed(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "v double")
    avg = bronze.nan_to_null(df).agg(F.avg("v")).first()[0]
    assert avg == 2.0 and not math.isnan(avg)


def test_mixed_type_field_becomes_text(spark):
    df = spark.createDataFrame([("a", '[{"x": 1, "n": 2}, {"x": "two", "n": 3}, {"x": null, "n": 4}]')],
                               "source string, payload string")
    out = payloads.to_columns(payloads.explode_records(df))
    assert dict(out.dtypes)["x"] == "string" and dict(out.dtypes)["n"] == "bigint"
    assert [r.x for r in out.orderBy("pos").collect()] == ["1", "two", None]


def test_nested_null_stays_null(spark):
    df = spark.createDataFrame([("a", '[{"seg": [1, 2]}, {"seg": null}, {}]')], "source string, payload string")
    out = payloads.to_columns(payloads.explode_records(df)).orderBy("pos").collect()
    assert [r.seg for r in out] == ["[1,2]", None, None]
