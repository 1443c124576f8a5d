"""Drift guard messages, deterministic dedupe, size-checked broadcast, and plan shape."""

import pytest
from pyspark.sql import functions as F

from lapworks.operators import conform, metrics
from lapworks.operators.schema import SchemaDriftError, assert_columns, missing_columns
from lapworks.plans import suite


def test_assert_columns_lists_all_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert missing_columns(df, ["a", "B", "c"]) == ["B", "c"]         # exact-case names
    with pytest.raises(SchemaDriftError) as ex:
        assert_columns(df, ["a", "B", "c"], "bronze.raw_laps")
    msg = str(ex.value)
    assert "bronze.raw_laps" in msg and "['B', 'c']" in msg and "['a', 'b']" in msg
    assert_columns(df, ["a", "b"], "ok")                              # no error, no job


def test_dedupe_is_deterministic_and_skew_safe(spark):
    rows = [("k", i % 3, f"name{i % 5}") for i in range(3000)] + [("j", 1, "x"), ("j", 1, "y")]
    df = spark.createDataFrame(rows, "key string, ver int, name string")
    latest = {r.key: (r.ver, r.name) for r in conform.dedupe(df, "key", order="ver").collect()}
    assert latest == {"k": (2, "name4"), "j": (1, "y")}
    first = {r.key: (r.ver, r.name) for r in conform.dedupe(df, "key", order="ver", keep="min").collect()}
    assert first == {"k": (0, "name0"), "j": (1, "x")}
    plan = conform.dedupe(df, "key")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan                                       # combined map-side


def test_dedupe_by_recency(spark):
    df = spark.createDataFrame([("k", "2025-01-02", 1, "a"), ("k", "2025-01-01", 9, "z"), ("k", "2025-01-02", 0, "zz")],
                               "k string, ingested_at string, pos int, name string")
    carried = df.select("k", "name", *conform.recency(df))
    assert conform.dedupe(carried, "k", order=list(conform.RECENCY)).collect()[0].name == "a"


def test_dimension_join_keeps_null_keys_out_of_the_shuffle(spark):
    fact = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("k"), "id")
    dim = spark.createDataFrame([("1",), ("2",)], "k string")
    out = conform.join_dimension(fact, dim, "k", "left_anti", split_hot=True, salts=4)
    assert out.count() == 898 and out.filter("k IS NULL").count() == 300
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "isnotnull(k" in plan


def test_ts_or_now(spark):
    r = spark.range(1).select(conform.ts_or_now("2025-01-01 10:00:00").alias("t"),
                              conform.ts_or_now(None).alias("n")).collect()[0]
    assert str(r.t) == "2025-01-01 10:00:00" and r.n is not None


def _plan(df):
    df.collect()                                 # runs this QueryExecution: AQE's final plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_leaderboard_plan_prunes_and_pre_aggregates(spark):
    df = suite.QUERIES["driver_leaderboard"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "Scan ExistingRDD" in plan            # the groups' figures are stored once, read twice


def test_plain_leaderboard_plan_prunes(spark):
    df = suite.QUERIES["driver_leaderboard_plain"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in plan
    assert "props" not in plan.split("ReadSchema")[1].split("\n")[0] and "partial_stddev" in plan


def test_rolling_distributed_moves_all_rows_once(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_custkey", "o_orderkey", "o_totalprice")
    df = metrics.rolling_mean(o, "o_totalprice", ["o_custkey"], ["o_orderkey"], out="r", distributed=True)
    text = _plan(df)
    assert "rangepartitioning" not in text and "hashpartitioning(o_custkey" in text


def test_cli_lists_queries(capsys):
    from lapworks.__main__ import main
    assert main(["queries"]) == 0
    out = capsys.readouterr().out
    assert "driver_leaderboard (oracle)" in out and "pipeline_status" in out


def test_assert_columns_on_a_frame_without_columns(spark):
    empty = spark.range(1).select()
    with pytest.raises(SchemaDriftError) as ex:
        assert_columns(empty, ["a", "b"], "t")
    assert "['a', 'b'] not found among []" in str(ex.value)


def test_cli_pipeline_reports_a_halted_run(spark, tmp_path, capsys):
    import os
    from lapworks.__main__ import main
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("test tables not present")
    code = main(["pipeline", "--sf-dir", "/root/testdata/sf0.001", "--location", str(tmp_path / "wh")])
    out = capsys.readouterr().out
    assert code == 1 and "gate_silver" in out and "target_session" in out


def test_recommended_conf_scales_with_input():
    from lapworks.session import recommended_conf
    small = recommended_conf(10 << 20, 8)
    big = recommended_conf(100 * (1 << 40), 8000)           # 100 TB on 8,000 slots
    assert small["spark.sql.shuffle.partitions"] == "8"
    parts = int(big["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0 and (100 * (1 << 40)) / parts <= 200 << 20


def test_bench_prints_one_json_line():
    import json
    import os
    import subprocess
    import sys
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("test tables not present")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_RUNS="1", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py"), "pace_gap"], env=env,
                         capture_output=True, text=True, timeout=600).stdout.strip().splitlines()
    assert len(out) == 1
    line = json.loads(out[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(line) and line["unit"] == "sec"
    assert set(line["queries"]) == {"pace_gap"} and line["sf"] == "0.001"
