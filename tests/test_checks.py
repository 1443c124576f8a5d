"""Declarative checks: each metric kind passing and failing, empty inputs, the gate."""

import pytest

from lapworks.operators.checks import Check, QualityGateError, gate, run_checks
from lapworks.plans.check_presets import PRESET, with_thresholds


def frame(spark):
    return spark.createDataFrame(
        [(1, "RACE", 90.0, True), (2, "QUALIFYING", 70.0, False), (2, "PRACTICE", None, True),
         (None, "RACE", 230.0, True)], "id int, kind string, dur double, ok boolean")


def outcomes(spark, checks):
    return {r.check: (r.value, r.outcome) for r in run_checks(frame(spark), checks, "t").collect()}


def test_each_metric(spark):
    got = outcomes(spark, [
        Check("rows", "row_count", "=", 4), Check("rows_gt", "row_count", ">", 4),
        Check("miss", "missing_count", "=", 0, "id"), Check("dup", "duplicate_count", "=", 0, "id"),
        Check("vals", "invalid_count", "=", 0, "kind", valid_values=("RACE", "QUALIFYING")),
        Check("range", "invalid_count", "=", 0, "dur", valid_min=80, valid_max=220),
        Check("range_f", "invalid_count", "=", 0, "dur", filter="ok = true", valid_min=80, valid_max=220),
        Check("mn", "min", ">=", 80, "dur"), Check("mx", "max", "<=", 220, "dur"),
        Check("mn_f", "min", ">=", 80, "dur", filter="ok = true"),
        Check("miss_f", "missing_count", "=", 0, "dur", filter="ok = true"),
        Check("none", "min", ">=", 0, "dur", filter="id > 100"),
    ])
    assert got["rows"] == (4.0, "pass") and got["rows_gt"] == (4.0, "fail")
    assert got["miss"] == (1.0, "fail") and got["dup"] == (1.0, "fail")
    assert got["vals"] == (1.0, "fail")
    assert got["range"] == (2.0, "fail") and got["range_f"] == (1.0, "fail")
    assert got["mn"] == (70.0, "fail") and got["mx"] == (230.0, "fail")
    assert got["mn_f"] == (90.0, "pass") and got["miss_f"] == (1.0, "fail")
    assert got["none"] == (None, "error")                  # min over zero rows fails closed


def test_gate(spark):
    ok = run_checks(frame(spark), [Check("rows", "row_count", ">", 0)], "t")
    assert gate(ok) == []
    bad = run_checks(frame(spark), [Check("rows", "row_count", ">", 10)], "t")
    with pytest.raises(QualityGateError, match="rows"):
        gate(bad)


def test_preset_shape():
    assert sum(len(v) for v in PRESET.values()) == 67
    assert [len(v) for v in PRESET.values()] == [11, 13, 16, 14, 13]
    el = with_thresholds(PRESET["silver.enriched_laps"], EL9=60)
    assert [c.threshold for c in el if c.name == "EL9"] == [60.0]


def test_bad_spec():
    with pytest.raises(ValueError):
        Check("x", "median", "=", 0, "c")
    with pytest.raises(ValueError):
        Check("x", "min", "~", 0, "c")
    with pytest.raises(ValueError):
        Check("x", "min", "=", 0)


def test_min_max_of_a_text_column_is_an_error_not_a_crash(spark):
    got = outcomes(spark, [Check("mk", "min", ">=", 0, "kind")])
    assert got["mk"] == (None, "error")


def test_one_scan_and_one_exchange_of_the_rows(spark, tmp_path):
    """Duplicate checks and all other metrics of a table are one pass over it."""
    frame(spark).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    res = run_checks(df, [Check("rows", "row_count", "=", 4), Check("d1", "duplicate_count", "=", 0, "id"),
                          Check("d2", "duplicate_count", "=", 0, "kind"), Check("mx", "max", "<=", 220, "dur")], "t")
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert {r.check: r.value for r in res.collect()} == {"rows": 4.0, "d1": 1.0, "d2": 1.0, "mx": 230.0}


def test_duplicates_of_every_type(spark):
    import datetime as dt
    from decimal import Decimal
    t = dt.datetime(2025, 3, 30, 1, 30)
    df = spark.createDataFrame(
        [(0.0, "a", t, [1, 2], Decimal("1.50"), b"x", None, True), (-0.0, "A", t, [1, 2], Decimal("1.5"), b"x", None, True),
         (float("nan"), "a", None, [2, 1], None, b"y", None, False), (float("nan"), None, t, None, Decimal(2), None, None, None)],
        "f double, s string, t timestamp, l array<int>, d decimal(9,2), b binary, n int, o boolean")
    got = {r.check: r.value for r in run_checks(
        df, [Check(c, "duplicate_count", "=", 0, c) for c in df.columns]
        + [Check("some", "duplicate_count", "=", 0, "s", filter="o = true")], "t").collect()}
    assert got == {"f": 2.0, "s": 1.0, "t": 1.0, "l": 1.0, "d": 1.0, "b": 1.0, "n": 0.0, "o": 1.0, "some": 0.0}


def test_empty_table(spark):
    got = {r.check: (r.value, r.outcome) for r in run_checks(frame(spark).limit(0), [
        Check("rows", "row_count", ">", 0), Check("d", "duplicate_count", "=", 0, "id"), Check("m", "missing_count", "=", 0, "id"),
        Check("v", "invalid_count", "=", 0, "dur", valid_min=1), Check("x", "max", "<=", 1, "dur")], "t").collect()}
    assert got == {"rows": (0.0, "fail"), "d": (0.0, "pass"), "m": (0.0, "pass"), "v": (0.0, "pass"), "x": (None, "error")}


def test_observed_metrics_equal_a_pass(spark, tmp_path):
    """What the write has observed is what a second read would give; nothing else is read."""
    from lapworks.operators.checks import observable
    from lapworks.sources.tables import write_table
    checks = [Check("rows", "row_count", "=", 4), Check("dup", "duplicate_count", "=", 0, "id"),
              Check("miss", "missing_count", "=", 0, "id"), Check("mn", "min", ">=", 80, "dur"),
              Check("none", "min", ">=", 0, "dur", filter="id > 100"),
              Check("range", "invalid_count", "=", 0, "dur", valid_min=80, valid_max=220)]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS obs LOCATION '{tmp_path}/obs.db'")
    got = write_table(frame(spark), "spark_catalog.obs.t", metrics=observable(checks))
    known = {c.name: got[c.name] for c in checks if c.metric != "duplicate_count"}
    table = spark.table("spark_catalog.obs.t")
    want = sorted(map(tuple, run_checks(table, checks, "t").collect()))
    assert sorted(map(tuple, run_checks(table, checks, "t", known).collect())) == want
    alone = run_checks(None, [c for c in checks if c.name != "dup"], "t", known)
    assert sorted(map(tuple, alone.collect())) == [w for w in want if w[1] != "dup"]


def test_thresholds_and_bounds_by_name():
    from lapworks.plans.check_presets import min_lap_thresholds
    laps = with_thresholds(with_thresholds(PRESET["silver.enriched_laps"], **min_lap_thresholds(1.0)), EL8=(None, 300), EL10=300)
    by = {c.name: c for c in laps}
    assert (by["EL8"].valid_min, by["EL8"].valid_max, by["EL8"].threshold) == (1.0, 300, 0)
    assert by["EL9"].threshold == 1.0 and by["EL10"].threshold == 300.0 and by["EL12"].threshold == 65
