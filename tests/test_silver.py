"""Silver conforming: sessions, laps enrichment, validity flags (fixtures 1-3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lapworks.operators import laps, sessions, validity
from lapworks.operators.schema import SchemaDriftError

SESS_DDL = ("session_key int, session_name string, session_type string, location string, "
            "country_name string, year int, date_start timestamp, date_end timestamp, "
            "ingested_at string, source_url string")


def bronze_sessions(spark):
    """Three kept sessions (one at midnight of a leap day), a test drive, one without key."""
    T = dt.datetime
    day = T(2028, 2, 29)
    return spark.createDataFrame([
        (71, "Harbour Loop night run", "Race", " North Pier ", "  Atlantis", 2028, day, day + dt.timedelta(hours=3), None, None),
        (72, "Harbour Loop grid", "qualifying ", "North Pier", "Atlantis  ", 2028, T(2028, 2, 28, 23, 59), None, None, "u"),
        (74, "Dune sprint", "RACE", "Sand Bowl", "Lemuria", 2028, T(2028, 7, 1, 8), T(2028, 7, 1, 9), "x", None),
        (73, "Harbour Loop shakedown", "Test", "North Pier", "Atlantis", 2028, T(2028, 2, 27, 7), T(2028, 2, 27, 9), None, None),
        (None, "Unlisted", "Qualifying", "?", "?", 2028, T(2028, 3, 3), T(2028, 3, 3, 1), None, None),
    ], SESS_DDL)


def test_sessions_clean(spark):
    out = sessions.clean(bronze_sessions(spark), 2028)
    rows = {r.session_id: r for r in out.collect()}
    assert {i: r.session_type for i, r in rows.items()} == {71: "RACE", 72: "QUALIFYING", 74: "RACE"}
    assert {r.country_name for r in rows.values()} == {"Atlantis", "Lemuria"}
    assert rows[71].location == " North Pier " and rows[72].end_time is None
    assert [dict(out.dtypes)[c] for c in ("session_id", "year", "pipeline_year", "start_time")] == ["int", "int", "int", "timestamp"]
    assert {(r.pipeline_year, r.processed_at is not None) for r in rows.values()} == {(2028, True)}


def test_sessions_whose_key_does_not_fit_are_reported(spark):
    keys = ["3000000001", "3000000002", "x9", None, "5"]
    rows = [(k, "n", "Race", "L", "C", 2028, "2028-01-01T00:00:00" if k != "5" else d, None)
            for k, d in zip(keys, [None] * 4 + ["2028-01-02T00:00:00"])] + [("6", "n", "Race", "L", "C", 2028, "soon", None)]
    df = spark.createDataFrame(rows, "session_key string, session_name string, session_type string, location string, "
                                     "country_name string, year int, date_start string, date_end string")
    assert [r.session_id for r in sessions.clean(df, 2028).collect()] == [5]
    assert sorted((r.session_key or "", r.reason) for r in sessions.rejected(df).collect()) == [
        ("", "no session_key"), ("3000000001", "session_key is no int"), ("3000000002", "session_key is no int"),
        ("6", "date_start is no timestamp"), ("x9", "session_key is no int")]
    assert sorted(r.session_id for r in sessions.clean(df, 2028, id_type="bigint").collect()) == [5, 3000000001, 3000000002]


def _text_sessions(spark, rows):
    return spark.createDataFrame(rows, "session_key long, session_name string, session_type string, "
                                       "location string, country_name string, year long, "
                                       "date_start string, date_end string")


def test_sessions_text_dates_case_dedupe_and_bad_rows(spark):
    rows = [(8, "loop", "rAcE", "L", "C", 2028, "2028-05-06T07:08:09", "2028-05-06T09:00:00"),
            (8, "loop", "race  ", "L", "C", 2028, "2028-05-06T07:08:09", "2028-05-06T09:00:00"),
            (31, "grid", "  qualifying", "L", "C", 2028, "2028-05-05T10:00:00", None),
            (32, "demo", "Parade", "L", "C", 2028, "2028-05-04T10:00:00", None),
            (33, "when?", "Race", "L", "C", 2028, "tomorrow", None),
            (None, "no key", "Race", "L", "C", 2028, "2028-05-04T13:00:00", None)]
    out = sessions.clean(_text_sessions(spark, rows), 2028).orderBy("session_id").collect()
    assert [(r.session_id, r.session_type) for r in out] == [(8, "RACE"), (31, "QUALIFYING")]
    assert out[1].end_time is None                      # NULL end is kept
    assert out[0].start_time == dt.datetime(2028, 5, 6, 7, 8, 9)


def test_sessions_drift(spark):
    df = spark.createDataFrame([(1,)], "session_key int")
    with pytest.raises(SchemaDriftError, match="Schema drift detected") as ex:
        sessions.clean(df, 2028)
    assert "date_start" in str(ex.value) and "country_name" in str(ex.value)


LAPS = [("k5", n, d, p) for n, d, p in [(1, 101.25, True), (2, 74.5, False), (3, 60.0, False), (4, 59.75, False),
                                        (5, None, False), (6, 75.125, None)]]
LAPS += [("k6", 1, 80.5, False), ("k6", 2, None, True), ("stray", 1, 70.0, False), (None, 1, 70.0, False)]
DRIVERS = [("k5", "Ada Quill", "Comet", "ATL", "img/a"), (" k6 ", "Bo Tarn ", " Drift", None, None),
           ("k6", "Bo Tarn", "Drift", None, None), ("k7", "Cy Umber", "Drift", "LEM", "img/c")]


def bronze_laps(spark):
    return spark.createDataFrame(LAPS, "driver_number string, lap_number int, lap_duration float, is_pit_out_lap boolean")


def bronze_drivers(spark):
    return spark.createDataFrame(DRIVERS, "driver_number string, full_name string, team_name string, "
                                          "country_code string, headshot_url string")


def test_enrich_integration(spark):
    out = laps.enrich(bronze_laps(spark), bronze_drivers(spark), 60.0, reason_col="reason")
    got = {(r.driver_number, r.lap_number): (r.is_valid_lap, r.reason, r.team_name) for r in out.collect()}
    assert got == {("k5", 1): (False, "pit_out_lap", "Comet"), ("k5", 2): (True, None, "Comet"),
                   ("k5", 3): (True, None, "Comet"), ("k5", 4): (False, "below_minimum", "Comet"),
                   ("k5", 5): (False, "missing_duration", "Comet"), ("k5", 6): (True, None, "Comet"),
                   ("k6", 1): (True, None, "Drift"), ("k6", 2): (False, "pit_out_lap", "Drift")}
    types = dict(out.dtypes)
    assert [types[c] for c in ("lap_number", "lap_duration", "is_pit_out_lap", "is_valid_lap")] == \
        ["int", "float", "boolean", "boolean"]
    assert out.filter("processed_at IS NULL").isEmpty()
    assert out.columns[:9] == ["driver_number", "full_name", "team_name", "country_code",
                               "headshot_url", "lap_number", "lap_duration", "is_pit_out_lap",
                               "is_valid_lap"]


def test_latest_driver_row_wins(spark):
    df = spark.createDataFrame([("1", "New Name", "Alpha", None, None, "2028-02-01"), ("1", "Old Name", "Zeta", None, None, "2028-01-01")],
                               "driver_number string, full_name string, team_name string, country_code string, "
                               "headshot_url string, ingested_at string")
    out = laps.driver_dim(df)
    assert [tuple(r)[:3] for r in out.collect()] == [("1", "New Name", "Alpha")] and len(out.columns) == 5


def test_enrich_edge_rules(spark):
    lp = spark.createDataFrame([
        (" 7 ", "1", "60.0", None), ("7", "2", "59.999", "false"), ("7", "3", "NaN", "false"),
        ("7", "4", "abc", "false"), ("7", "5", "61", "True"),
    ], "driver_number string, lap_number string, lap_duration string, is_pit_out_lap string")
    dr = spark.createDataFrame([("7", "A", "T", None, None)],
                               "driver_number string, full_name string, team_name string, "
                               "country_code string, headshot_url string")
    out = {r.lap_number: r for r in laps.enrich(lp, dr, 60.0, duration_type="double").collect()}
    assert out[1].is_valid_lap is True            # exactly the minimum, NULL pit flag falls through
    assert out[2].is_valid_lap is False
    assert out[3].lap_duration is None and out[3].is_valid_lap is False     # NaN -> NULL
    assert out[4].lap_duration is None and out[4].is_valid_lap is False     # bad text -> NULL
    assert out[5].is_pit_out_lap is True and out[5].is_valid_lap is False


def test_enrich_drift(spark):
    with pytest.raises(SchemaDriftError):
        laps.enrich(bronze_laps(spark).drop("is_pit_out_lap"), bronze_drivers(spark))
    with pytest.raises(SchemaDriftError):
        laps.enrich(bronze_laps(spark), bronze_drivers(spark).drop("team_name"))


def test_unmatched_and_dim(spark):
    for split in (False, True):
        got = laps.unmatched(bronze_laps(spark), bronze_drivers(spark), split_hot=split).collect()
        assert {r.driver_number for r in got} == {"stray", None} and len(got) == 2
    assert laps.driver_dim(bronze_drivers(spark)).count() == 3


def test_summaries(spark):
    df = spark.range(1000).select((F.col("id") < 850).alias("is_valid_lap"))
    r = validity.validity_summary(df).collect()[0]
    assert (r.valid_rows, r.flagged_rows) == (850, 150)
    before = spark.range(1000)
    r = validity.retention("Laps", before, before.filter("id < 800")).collect()[0]
    assert (r.total, r.kept, r.dropped, r.dropped_pct) == (1000, 800, 200, 20.0)
    r = validity.retention("x", before.limit(0), before.limit(0)).collect()[0]
    assert (r.total, r.dropped_pct) == (0, 0.0)
    r = validity.retention("x", spark.range(20), spark.range(20)).collect()[0]
    assert r.dropped_pct == 0.0


def test_enrich_splits_a_hot_driver(spark):
    """A third of all laps on one driver: its laps are salted over many join partitions,
    whatever the dimension's size."""
    if True:
        n = 30000
        lp = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("1")).otherwise((F.col("id") % 500).cast("string"))
            .alias("driver_number"),
            F.col("id").cast("int").alias("lap_number"), F.lit(90.0).alias("lap_duration"),
            F.lit(False).alias("is_pit_out_lap"))
        dr = spark.range(1, 500).select(F.col("id").cast("string").alias("driver_number"),
                                        F.concat(F.lit("n"), F.col("id")).alias("full_name"),
                                        F.lit("t").alias("team_name"),
                                        F.lit(None).cast("string").alias("country_code"),
                                        F.lit(None).cast("string").alias("headshot_url"))
        out = laps.enrich(lp, dr, 60.0, duration_type="double", split_hot=True)
        rows = out.collect()
        want = spark.range(n).filter((F.col("id") % 3 == 0) | (F.col("id") % 500 != 0)).count()
        assert len(rows) == want
        hot = spark.range(n).filter((F.col("id") % 3 == 0) | (F.col("id") % 500 == 1)).count()
        assert sum(r.driver_number == "1" for r in rows) == hot
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "_salt" in plan and "pmod(xxhash64" in plan
        # the hot driver's laps spread over many salts (join partitions)
        salted = lp.withColumn("s", F.pmod(F.xxhash64(*lp.columns), F.lit(8))).filter("driver_number = '1'")
        assert salted.select("s").distinct().count() == 8
        miss = laps.unmatched(lp, dr, duration_type="double", split_hot=True).collect()
        assert len(miss) == n - want and {r.driver_number for r in miss} == {"0"}


def test_cast_failures_counted(spark):
    lp = spark.createDataFrame([("1", "1", "90.5", "true"), ("1", "x", "fast", "maybe"), ("1", None, None, None)],
                               "driver_number string, lap_number string, lap_duration string, is_pit_out_lap string")
    r = laps.cast_failures(lp).collect()[0]
    assert (r.lap_number_failed, r.lap_duration_failed, r.is_pit_out_lap_failed, r.rows) == (1, 1, 1, 3)
