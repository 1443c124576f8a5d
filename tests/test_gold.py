"""Gold marts (fixtures 4-5), rank ties, n=1 std-dev, and the distributed forms."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from lapworks.operators import marts, metrics, reports

SILVER_DDL = ("driver_number string, full_name string, team_name string, lap_number int, "
              "lap_duration float, is_valid_lap boolean")


# Five drivers of three teams; two of them tie on the rounded figures, one has one lap.
DURATIONS = {("n1", "Ada Quill", "Comet"): [70.0, 72.0, 74.0, 71.0], ("n2", "Bo Tarn", "Drift"): [80.0, 81.0],
             ("n3", "Cy Umber", "Comet"): [80.0004, 81.0004], ("n4", "Di Vane", "Ember"): [90.5],
             ("n5", "Ed Wick", "Drift"): [65.0, 99.0, 100.0, 101.0, 102.0, 103.0, 104.0]}
FALSE_START = ("n1", "Ada Quill", "Comet", 5, 12.5, False)


def silver(spark):
    rows = [(*who, i, d, True) for who, ds in DURATIONS.items() for i, d in enumerate(ds, 1)] + [FALSE_START]
    return spark.createDataFrame(rows, SILVER_DDL)


@pytest.mark.parametrize("distributed", [True, False])
def test_leaderboard(spark, distributed):
    out = marts.driver_leaderboard(silver(spark), 2028, distributed=distributed)
    got = {r.driver_number: r for r in out.collect()}
    assert {k: r.pace_rank for k, r in got.items()} == {"n1": 1, "n2": 2, "n3": 2, "n4": 3, "n5": 4}
    for (who, _, _), ds in DURATIONS.items():
        r, ds = got[who], sorted(ds)
        assert r.total_valid_laps == len(ds) and r.fastest_lap_s == pytest.approx(ds[0], abs=1e-3)
        assert r.avg_lap_time_s == pytest.approx(statistics.mean(ds), abs=1e-3)
        assert r.median_lap_time_s == pytest.approx(ds[(len(ds) + 1) // 2 - 1], abs=1e-3)
        assert r.lap_consistency_s == pytest.approx(statistics.stdev(ds) if len(ds) > 1 else 0.0, abs=1e-3)
        assert r.season_year == 2028 and r.generated_at is not None
    assert [r.pace_rank for r in out.collect()] == [1, 2, 2, 3, 4]
    assert [dict(out.dtypes)[c] for c in ("fastest_lap_s", "avg_lap_time_s", "pace_rank", "total_valid_laps")] == \
        ["float", "double", "int", "int"]


def test_standings_and_gap(spark):
    st = marts.team_standings(silver(spark), 2028)
    of_team = {t: [d for (_, _, x), ds in DURATIONS.items() if x == t for d in ds] for t in ("Comet", "Drift", "Ember")}
    got = {r.team_name: r for r in st.collect()}
    order = sorted(of_team, key=lambda t: statistics.mean(of_team[t]))
    assert {t: r.team_pace_rank for t, r in got.items()} == {t: i for i, t in enumerate(order, 1)}
    for t, ds in of_team.items():
        assert got[t].best_lap_s == pytest.approx(min(ds)) and got[t].total_valid_laps == len(ds)
        assert got[t].avg_team_pace_s == pytest.approx(statistics.mean(ds), abs=1e-3)
    gap = {r.team_name: r.pace_delta_s for r in reports.pace_gap(st).collect()}
    assert gap[order[0]] == 0.0 and all(gap[t] > 0 for t in order[1:])
    assert reports.top_team(st).collect()[0].team_name == order[0]


@pytest.mark.parametrize("distributed", [True, False])
def test_progression(spark, distributed):
    rows = marts.lap_progression(silver(spark), 2028, distributed=distributed).collect()
    got = {(r.driver_number, r.lap_number): r.rolling_avg_5lap_s for r in rows}
    want = {(who, i + 1): statistics.mean(ds[max(0, i - 4):i + 1]) for (who, _, _), ds in DURATIONS.items() for i in range(len(ds))}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(v, abs=6e-4) for k, v in want.items())
    assert [(r.full_name, r.lap_number) for r in rows] == sorted((r.full_name, r.lap_number) for r in rows)


def test_doubles_and_bigint_laps(spark):
    df = silver(spark).withColumns({"lap_duration": F.col("lap_duration").cast("double"), "lap_number": F.col("lap_number").cast("long")})
    lb = {r.driver_number: r for r in marts.driver_leaderboard(df, 2028).collect()}
    assert (lb["n1"].median_lap_time_s, lb["n2"].median_lap_time_s, lb["n5"].median_lap_time_s) == (71.0, 80.0, 101.0)
    roll = [r.rolling_avg_5lap_s for r in marts.lap_progression(df, 2028).collect() if r.driver_number == "n1"]
    assert roll == [70.0, 71.0, 72.0, 71.75]


def test_rank_ties_on_rounded_values_and_single_lap(spark):
    rows = [("1", "A", "T1", 1, 90.0001, True), ("2", "B", "T2", 1, 90.0002, True),
            ("3", "C", "T3", 1, 91.0, True), ("3", "C", "T3", 2, 93.0, True)]
    df = spark.createDataFrame(rows, "driver_number string, full_name string, team_name string, "
                                     "lap_number int, lap_duration double, is_valid_lap boolean")
    lb = {r.driver_number: r for r in marts.driver_leaderboard(df, 2025).collect()}
    assert lb["1"].pace_rank == lb["2"].pace_rank == 1 and lb["3"].pace_rank == 2
    assert lb["1"].lap_consistency_s == 0.0           # n = 1 -> 0, not NULL


def test_dense_rank_distributed_matches_window(spark):
    rnd = random.Random(7)
    data = [(i, rnd.choice([None, 1, 2, 3, 4]), rnd.choice([None, 10, 20, 30])) for i in range(3000)]
    data += [(10000 + i, 2, 20) for i in range(1000)]        # a hot key: a quarter of all rows
    df = spark.createDataFrame(data, "id int, a int, b int")
    order = [("a", "asc"), ("b", "desc")]
    want = {r.id: r.r for r in metrics.dense_rank(df, order, "r", distributed=False).collect()}
    got = {r.id: r.r for r in metrics.dense_rank(df, order, "r", num_ranges=16).collect()}
    assert got == want


def test_rolling_distributed_matches_window_with_hot_entity(spark):
    rnd = random.Random(3)
    data = [("hot", i, round(rnd.uniform(80, 120), 2)) for i in range(5000)]   # one hot driver
    data += [(f"d{k}", i, round(rnd.uniform(80, 120), 2)) for k in range(40) for i in range(rnd.randint(1, 30))]
    df = spark.createDataFrame(data, "driver string, lap int, v double")
    plain = metrics.rolling_mean(df, "v", ["driver"], ["lap"], distributed=False, out="r")
    dist = metrics.rolling_mean(df, "v", ["driver"], ["lap"], target_rows=100, out="r")
    want = {(r.driver, r.lap): r.r for r in plain.collect()}
    got = {(r.driver, r.lap): r.r for r in dist.collect()}
    assert got == want


def test_rolling_exact_decimal(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([0.01, 0.02, 0.02, 0.01, 0.01, 0.005])],
                               "k string, i int, v double")
    out = [r.r for r in metrics.rolling_mean(df, "v", ["k"], ["i"], out="r", avg_scale=3).orderBy("i").collect()]
    assert out == [0.01, 0.015, 0.017, 0.015, 0.014, 0.013]


def test_reports(spark):
    lb = marts.driver_leaderboard(silver(spark), 2028)
    assert reports.fastest_driver(lb).collect()[0].full_name == "Ed Wick"
    assert [r.full_name for r in reports.speed_consistency(lb).collect()][0] == "Ada Quill"
    pg = marts.lap_progression(silver(spark), 2028)
    tr = reports.race_trace(pg, team_name="Drift").collect()
    assert {r.full_name for r in tr} == {"Bo Tarn", "Ed Wick"} and len(tr) == 9
    fc = {r.full_name: r.row_count for r in reports.facet_counts(pg, "full_name", {"team_name": "Ember"}).collect()}
    assert fc == {"Ada Quill": 0, "Bo Tarn": 0, "Cy Umber": 0, "Di Vane": 1, "Ed Wick": 0}
    assert reports.preview(pg, 4).count() == 4
    ws = {r.team_name: r.sum_avg_team_pace_s for r in
          reports.widget_sum(marts.team_standings(silver(spark), 2028), "team_name", "avg_team_pace_s").collect()}
    assert ws["Ember"] == pytest.approx(90.5)


def test_rolling_hot_run_of_null_order_values(spark):
    rnd = random.Random(5)
    data = [("hot", None, round(rnd.uniform(1, 9), 2)) for _ in range(3000)]   # identical order key
    data += [("hot", i, round(rnd.uniform(1, 9), 2)) for i in range(200)]
    data += [("other", i, 1.0) for i in range(10)]
    df = spark.createDataFrame(data, "k string, i int, v double")
    plain = {(r.k, r.i, r.v, r.r) for r in
             metrics.rolling_mean(df, "v", ["k"], ["i"], out="r", distributed=False).collect()}
    dist_df = metrics.rolling_mean(df, "v", ["k"], ["i"], out="r", distributed=True, target_rows=100)
    assert {(r.k, r.i, r.v, r.r) for r in dist_df.collect()} == plain


def test_top1_reports_break_ties_by_name(spark):
    rows = [("2", "Zed", "T1", 1, 90.0, True), ("1", "Abe", "T2", 1, 90.0, True),
            ("3", "Kim", "T3", 1, 91.0, True)]
    df = spark.createDataFrame(rows, SILVER_DDL.replace("float", "double"))
    assert reports.fastest_driver(marts.driver_leaderboard(df, 2025)).collect()[0].full_name == "Abe"
    assert reports.top_team(marts.team_standings(df, 2025)).collect()[0].team_name == "T1"
