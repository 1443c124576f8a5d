"""Table I/O, catalog and the five-stage pipeline on fixture data."""

import random

import pytest

from lapworks.plans import pipeline
from lapworks.sources import catalog
from lapworks.sources.tables import EmptyTableError, read_table, table_name, write_table


def test_roundtrip_and_errors(spark, tmp_path):
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS io_t LOCATION '{tmp_path}/io_t.db'")
    df = spark.range(5).selectExpr("id", "id * 2 AS v")
    assert write_table(df, "spark_catalog.io_t.t1")["rows"] == 5
    assert write_table(df.filter("id < 2"), "spark_catalog.io_t.t1")["rows"] == 2   # idempotent overwrite
    assert read_table(spark, "spark_catalog.io_t.t1").count() == 2
    # overwrite a table from a plan that reads it (staged)
    again = read_table(spark, "spark_catalog.io_t.t1").selectExpr("id", "v + 1 AS v", "'x' AS w")
    assert write_table(again, "spark_catalog.io_t.t1")["rows"] == 2
    assert read_table(spark, "spark_catalog.io_t.t1").columns == ["id", "v", "w"]
    write_table(df.limit(0), "spark_catalog.io_t.empty")
    with pytest.raises(EmptyTableError):
        read_table(spark, "spark_catalog.io_t.empty", on_empty="raise")
    assert read_table(spark, "spark_catalog.io_t.empty", on_empty="warn").count() == 0
    with pytest.raises(RuntimeError, match="Cannot read"):
        read_table(spark, "spark_catalog.io_t.missing")
    assert table_name("bronze", "raw_laps", 2025) == "spark_catalog.bronze.raw_laps_2025"


def test_catalog(spark):
    catalog.ensure_layers(spark, {"cat_bronze": "b", "cat_silver": "s"})
    assert {"cat_bronze", "cat_silver"} <= set(catalog.list_layers(spark))
    names = catalog.register_views({"silver.enriched_laps": spark.range(1)})
    assert names == {"silver.enriched_laps": "silver_enriched_laps"}
    assert spark.table("silver_enriched_laps").count() == 1


def racing_fixture(spark):
    rnd = random.Random(11)
    teams = ["Red Bull", "Ferrari", "McLaren", "Mercedes", "Williams"]
    drivers = [(str(n), f"Driver {n}", teams[i % 5], "XXX", None) for i, n in enumerate(range(1, 13))]
    laps = []
    for d in drivers:
        for lap in range(1, 41):
            dur = round(rnd.uniform(95, 110), 3)
            laps.append((d[0], lap, 130.0 if lap == 1 else dur, lap == 1))
    sess = [{"session_key": 9001, "session_name": "Baku GP", "session_type": "Race", "location": "Baku",
             "country_name": "Azerbaijan", "year": 2025, "date_start": "2025-09-21T11:00:00",
             "date_end": "2025-09-21T13:00:00", "circuit_short_name": "Baku", "pos": 1},
            {"session_key": 9000, "session_name": "Baku Q", "session_type": "Qualifying", "location": "Baku",
             "country_name": "Azerbaijan", "year": 2025, "date_start": "2025-09-20T14:00:00",
             "date_end": "2025-09-20T15:00:00", "circuit_short_name": "Baku", "pos": 0}]
    return {
        "sessions": lambda: spark.createDataFrame(sess),
        "laps": lambda key: spark.createDataFrame(laps if key == 9001 else [], "driver_number string, lap_number long, "
                                                    "lap_duration double, is_pit_out_lap boolean"),
        "drivers": lambda: spark.createDataFrame(drivers, "driver_number string, full_name string, "
                                                          "team_name string, country_code string, headshot_url string"),
    }


def test_pipeline_all_stages_pass(spark, tmp_path):
    opts = pipeline.Options(location=str(tmp_path / "wh"), as_of="2025-09-21 18:00:00")
    status = pipeline.run_all(spark, racing_fixture(spark), opts).collect()
    assert [s.status for s in status] == ["ok"] * len(status), status
    assert [s.stage for s in status][-2:] == ["gold", "gate_gold"]
    laps_row = next(s for s in status if s.dataset == "enriched_laps")
    assert laps_row.rows == 480 and laps_row.detail == "valid=468 flagged=12"   # one pass with the write
    lb = spark.table("spark_catalog.gold.driver_performance_metrics")
    assert lb.count() == 12 and spark.table("spark_catalog.gold.constructor_standings").count() == 5
    ds = pipeline.report_datasets(spark, opts, team_name="Ferrari")
    gap = ds["pace_gap"].collect()
    assert len(gap) == 5 and gap[0].pace_delta_s == 0.0
    assert {r.team_name for r in ds["race_trace"].collect()} == {"Ferrari"}
    assert ds["preview"].count() == 20 and ds["fastest_driver"].count() == 1


def test_pipeline_seasonal_gold(spark, tmp_path):
    opts = pipeline.Options(location=str(tmp_path / "wh4"), as_of="2025-09-21 18:00:00", seasonal_gold=True)
    status = pipeline.run_all(spark, racing_fixture(spark), opts).collect()
    assert all(s.status == "ok" for s in status), status
    assert spark.table("spark_catalog.gold.lap_progression").select("season_year").distinct().count() == 1


def test_pipeline_halts_and_records_partial_failure(spark, tmp_path):
    f = racing_fixture(spark)
    f["car_data"] = lambda: None                               # a dataset that returned nothing
    opts = pipeline.Options(location=str(tmp_path / "wh2"), as_of="2025-09-21 18:00:00")
    status = pipeline.run_all(spark, f, opts).collect()
    by = {(s.stage, s.dataset): s.status for s in status}
    assert by[("bronze", "car_data")] == "failed" and by[("bronze", "laps")] == "ok"
    assert "silver" not in {s.stage for s in status}           # halted after Bronze


def test_pipeline_needs_a_target_session(spark, tmp_path):
    f = racing_fixture(spark)
    opts = pipeline.Options(location=str(tmp_path / "wh5"),
                            settings=pipeline.Settings(race_round="Baku", session_type="Sprint"))
    with pytest.raises(pipeline.StageError, match="target session"):
        pipeline.run_bronze(spark, f, opts)


def test_pipeline_sessions_required(spark, tmp_path):
    f = racing_fixture(spark)
    f["sessions"] = lambda: None
    opts = pipeline.Options(location=str(tmp_path / "wh3"))
    with pytest.raises(pipeline.StageError, match="sessions"):
        pipeline.run_bronze(spark, f, opts)


def test_dynamic_partition_overwrite_keeps_other_seasons(spark, tmp_path):
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS io_p LOCATION '{tmp_path}/io_p.db'")
    a = spark.createDataFrame([(1, 2024), (2, 2024), (3, 2025)], "v int, season_year int")
    write_table(a, "spark_catalog.io_p.t", partition_by="season_year", dynamic=True)
    b = spark.createDataFrame([(9, 2025)], "v int, season_year int")
    assert write_table(b, "spark_catalog.io_p.t", partition_by="season_year", dynamic=True)["rows"] == 1
    got = sorted((r.v, r.season_year) for r in spark.table("spark_catalog.io_p.t").collect())
    assert got == [(1, 2024), (2, 2024), (9, 2025)]


def test_pipeline_from_landed_payloads(spark, tmp_path):
    """REST-shaped payload files -> Bronze -> Silver -> gate -> Gold -> gate."""
    import json

    rnd = random.Random(2)
    land = tmp_path / "api"
    land.mkdir()
    teams = ["Red Bull", "Ferrari", "McLaren", "Mercedes", "Williams", "Alpine"]
    sessions = [{"session_key": 7000 + i, "session_type": t, "session_name": f"S{i}", "location": "Baku",
                 "country_name": " Azerbaijan ", "year": 2025, "circuit_short_name": c,
                 "date_start": f"2025-09-{10 + i}T11:00:00+00:00", "date_end": f"2025-09-{10 + i}T13:00:00+00:00"}
                for i, (t, c) in enumerate([("Race", "Monza"), ("Race", "Baku"), ("Qualifying", "Baku"),
                                            ("Race", "Silverstone")])]
    (land / "sessions.json").write_text(json.dumps(sessions))
    drivers = [{"driver_number": n, "full_name": f"Driver {n}", "team_name": teams[n % 6], "country_code": "XX",
                "headshot_url": None} for n in range(1, 15)]
    (land / "drivers_7001.json").write_text(json.dumps(drivers))
    laps = [{"driver_number": d["driver_number"], "lap_number": k,
             "lap_duration": None if k == 1 else round(rnd.uniform(100, 110), 3),
             "is_pit_out_lap": k == 1, "segments": [1, 2]} for d in drivers for k in range(1, 31)]
    (land / "laps_7001.json").write_text(json.dumps(laps))
    folder = str(land)

    def transport(url, timeout_s):
        """The endpoints' URLs answered from the files beside: season, then session."""
        import os
        import re
        from lapworks.sources.rest import Response
        name, key = re.fullmatch(r"https://host/v1/(\w+)\?(?:session_key=(\d+)|year=2025)(?:&speed>250)?", url).groups()
        path = f"{folder}/{name}{'_' + key if key else ''}.json"
        return Response(200, open(path).read()) if os.path.exists(path) else Response(404, None)
    opts = pipeline.Options(location=str(tmp_path / "wh6"), as_of="2025-09-21 18:00:00",
                            settings=pipeline.Settings(base_url="https://host/v1", retry_delay_s=0.0))
    fetchers = pipeline.rest_fetchers(spark, opts, transport=transport)
    assert list(fetchers) == ["sessions", "drivers", "laps", "telemetry"]
    status = {(s.stage, s.dataset): (s.status, s.rows, s.detail)
              for s in pipeline.run_all(spark, fetchers, opts).collect()}
    assert status[("bronze", "target_session")][2] == "session_key=7001"     # last Race at Baku
    assert status[("bronze", "laps")][:2] == ("ok", 420)
    assert status[("bronze", "telemetry")][0] == "failed"                     # 404: recorded, others went on
    assert ("silver", "enriched_laps") not in status                           # Bronze raised at the end
    fetchers.pop("telemetry")
    status = {(s.stage, s.dataset): s.status for s in pipeline.run_all(spark, fetchers, opts).collect()}
    assert set(status.values()) == {"ok"}, status
    lb = spark.table("spark_catalog.gold.driver_performance_metrics")
    assert lb.count() == 14 and lb.agg({"total_valid_laps": "min"}).first()[0] == 29


def test_read_warns_and_write_logs_counts(spark, tmp_path, caplog):
    import logging
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS io_l LOCATION '{tmp_path}/io_l.db'")
    with caplog.at_level(logging.INFO, logger="lapworks.tables"):
        res = write_table(spark.range(7), "spark_catalog.io_l.seven")
        write_table(spark.range(0), "spark_catalog.io_l.none")
        read_table(spark, "spark_catalog.io_l.none", on_empty="warn")
    assert res["rows"] == 7
    text = caplog.text
    assert "spark_catalog.io_l.seven" in text and "'rows': 7" in text
    assert "io_l.none is empty" in text


def test_gold_gate_fails_on_one_null_rank(spark, tmp_path, monkeypatch):
    """A single NULL rank in the mart halts the run at the Gold gate, by what the write observed."""
    from pyspark.sql import functions as F

    from lapworks.operators import marts
    real = marts.driver_leaderboard

    def damaged(*a, **kw):
        df = real(*a, **kw)
        return df.withColumn("pace_rank", F.when(F.col("pace_rank") != 3, F.col("pace_rank")))
    monkeypatch.setattr(marts, "driver_leaderboard", damaged)
    opts = pipeline.Options(location=str(tmp_path / "wh7"), as_of="2025-09-21 18:00:00")
    status = pipeline.run_all(spark, racing_fixture(spark), opts).collect()
    failed = [(s.stage, s.dataset, s.detail) for s in status if s.status != "ok"]
    assert [f[0] for f in failed] == ["gate_gold", "gate_gold"]
    assert failed[1][1:] == ("gold.driver_performance_metrics", "DP3=1.0 = 0.0 (fail)")


def test_thresholds_of_a_run(spark, tmp_path):
    """The settings' minimum lap and single thresholds reach the gates."""
    settings = pipeline.Settings(min_lap_duration_s=99.0)
    kw = dict(as_of="2025-09-21 18:00:00", inject_min_lap=True)
    tight = pipeline.Options(location=str(tmp_path / "wh8"), settings=settings, thresholds={"EL10": 100}, **kw)
    status = pipeline.run_all(spark, racing_fixture(spark), tight).collect()
    assert [s.stage for s in status if s.status != "ok"] == ["gate_silver", "gate_silver"]
    assert next(s for s in status if s.dataset == "silver.enriched_laps").detail.startswith("EL10=")
    assert next(c for c in tight.checks("silver.enriched_laps") if c.name == "EL9").threshold == 99.0
    wide = pipeline.Options(location=str(tmp_path / "wh8"), settings=settings, **kw)
    assert {s.status for s in pipeline.run_all(spark, racing_fixture(spark), wide).collect()} == {"ok"}


def test_branches_run_at_the_same_time(spark):
    """Both branches are inside at once, statuses keep the given order, each has its own tag."""
    import threading
    both = threading.Barrier(2, timeout=60)
    tags = {}

    def branch(name, rows):
        def work():
            both.wait()
            tags[name] = set(spark.sparkContext.getJobTags())
            return [pipeline.Status("s", name, "ok", spark.range(rows).count())]
        return work
    out = pipeline._together(spark, "s", {"b": branch("b", 7), "a": branch("a", 5)})
    assert [(s.dataset, s.rows) for s in out] == [("b", 7), ("a", 5)]
    assert len(tags["a"]) == len(tags["b"]) == 1 and tags["a"] != tags["b"] and not spark.sparkContext.getJobTags()


def test_an_aborted_run_cancels_its_branches(spark):
    import threading

    from pyspark.sql import functions as F
    begun, ended = threading.Event(), []

    def long_one():
        begun.set()
        try:
            slow = F.udf(lambda i: __import__("time").sleep(1) or i, "long")      # would take minutes
            spark.range(0, 90, numPartitions=1).select(slow("id").alias("x")).agg(F.sum("x")).collect()
            ended.append("finished")
        except Exception as ex:
            ended.append(type(ex).__name__)
        return []

    def abort():
        begun.wait(60)
        raise KeyboardInterrupt
    with pytest.raises(KeyboardInterrupt):
        pipeline._together(spark, "s", {"stop": abort, "long": long_one})
    assert ended and ended[0] != "finished"


def test_checks_over_views(spark):
    """Checks run over registered views, as the catalog names them."""
    from lapworks.operators.checks import Check, run_checks
    names = catalog.register_views({"silver.enriched_laps": spark.range(3)})
    got = run_checks(spark.table(names["silver.enriched_laps"]), [Check("rows", "row_count", "=", 3)], "silver.enriched_laps")
    assert [r.outcome for r in got.collect()] == ["pass"]
