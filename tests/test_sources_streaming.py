"""Python Data Source, landed pages, streaming ingest (exactly once), exchange-reuse fallback."""

import json

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lapworks.operators import metrics
from lapworks.sources import payloads, rest
from lapworks.sources.manifest import endpoint_manifest, season_url
from lapworks.streaming.landing import ingest_available


def test_rest_data_source(spark):
    """One input partition per URL; what is no HTTP URL is refused in the task, at once."""
    urls = ["file:///etc/hostname", "ftp://host/x", "page"]
    rest.register(spark)
    df = spark.read.format("rest_json").option("urls", json.dumps(urls)).option("retryDelay", "0").load()
    assert df.rdd.getNumPartitions() == 3
    assert {r.url: (r.outcome, r.attempts, r.status) for r in df.collect()} == {u: ("client_error", 1, 400) for u in urls}


def test_fetch_manifest_and_pages(spark, tmp_path):
    src = spark.range(2500).select(F.col("id").alias("k"), (F.col("id") * 0.5).alias("v"),
                                   F.floor(F.col("id") / 1000).alias("page"))
    payloads.land_pages(src, str(tmp_path / "land"), "page")
    pages = payloads.read_landed(spark, str(tmp_path / "land"))
    assert pages.count() == 3
    recs = payloads.to_columns(payloads.explode_records(pages), keep=("pos",))
    rows = recs.select(F.col("k").cast("long"), F.col("v").cast("double")).collect()
    assert sorted(r.k for r in rows) == list(range(2500))
    assert all(abs(r.v - r.k * 0.5) < 1e-9 for r in rows)


def test_manifest(spark):
    keys = spark.createDataFrame([(9158,), (9157,)], "session_key int")
    m = endpoint_manifest(keys, "https://h/v1/")
    urls = sorted(r.url for r in m.collect())
    assert "https://h/v1/car_data?session_key=9157&speed>250" in urls and len(urls) == 6
    assert "https://h/v1/laps?session_key=9158" in urls
    assert season_url("https://h/v1", 2025, "Race") == "https://h/v1/sessions?year=2025&session_type=Race"


def test_stream_ingest_exactly_once(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    (land / "p0.json").write_text(json.dumps([{"a": 1, "b": "None"}, {"a": 2, "b": "x"}]))
    (land / "p1.json").write_text(json.dumps({"error": "rate limited"}))      # rejected payload
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS st LOCATION '{tmp_path}/st.db'")
    schema = StructType.fromDDL("a BIGINT, b STRING")
    ck = str(tmp_path / "ck")
    rows = ingest_available(spark, str(land), "spark_catalog.st.raw", schema, ck,
                            race_location="Baku").orderBy("a").collect()
    assert [(r.a, r.b) for r in rows] == [(1, None), (2, "x")] and rows[0].race_location == "Baku"
    (land / "p2.json").write_text(json.dumps([{"a": 3, "b": "y"}]))
    again = ingest_available(spark, str(land), "spark_catalog.st.raw", schema, ck)
    assert sorted(r.a for r in again.collect()) == [1, 2, 3]          # p0 not ingested twice
    # a replayed batch replaces its own partition instead of appending again
    from lapworks.operators import bronze as bz
    from lapworks.sources import payloads as pl
    from lapworks.sources.tables import write_table
    replay = pl.to_columns(pl.explode_records(pl.read_landed(spark, str(land / "p2.json"))), schema)
    write_table(bz.normalise(replay).withColumn("_batch", F.lit(1)), "spark_catalog.st.raw",
                partition_by="_batch", dynamic=True)
    spark.catalog.refreshTable("spark_catalog.st.raw")
    assert sorted(r.a for r in spark.table("spark_catalog.st.raw").collect()) == [1, 2, 3]


def test_windows_without_exchange_reuse(spark):
    df = spark.createDataFrame([("h", i, float(i % 7)) for i in range(400)] +
                               [("x", i, 1.0) for i in range(3)], "k string, i int, v double")
    rank = spark.createDataFrame([(i, i % 7, (i * 37) % 11) for i in range(500)], "id int, a int, b int")
    roll = lambda d: {(r.k, r.i): r.r for r in metrics.rolling_mean(
        df, "v", ["k"], ["i"], out="r", distributed=d, target_rows=20).collect()}
    ranks = lambda d: {r.id: r.r for r in metrics.dense_rank(rank, ["a", ("b", "desc")], "r", distributed=d).collect()}
    median = lambda: {r.a: r.m for r in metrics.lower_median(rank, ["a"], "b", "m").collect()}
    want = (roll(False), ranks(False), median())
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        assert (roll(True), ranks(True), median()) == want
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def _pages(tmp_path, n):
    for i in range(n):
        (tmp_path / f"p{i}.json").write_text(json.dumps([{"i": i, "j": k} for k in range(3)]))
    return [f"file:{tmp_path}/p{i}.json" for i in range(n)]


def _urls(spark, urls):
    return spark.createDataFrame([(u,) for u in urls], "url string")


def test_fetch_results_are_stored_and_checked(spark, tmp_path):
    """Bodies come from files here, so that the source can change after the read."""
    import pytest
    from lapworks.sources.rest import FetchFailed, Response, fetch_manifest, records_of
    urls = _pages(tmp_path, 12)

    def transport(url, timeout_s):
        import os
        path = url.removeprefix("file:")
        return Response(200, open(path).read()) if os.path.exists(path) else Response(404, None)
    ask = lambda us: fetch_manifest(_urls(spark, us), transport=transport, delay_s=0.0)
    recs = records_of(ask(urls))
    (tmp_path / "p0.json").write_text("[]")             # the source changes after the read
    assert recs.count() == 36 and recs.select("i").distinct().count() == 12
    (tmp_path / "p1.json").write_text('{"detail": "no"}')
    (tmp_path / "p2.json").write_text('[{"i": 1')
    gone = f"file:{tmp_path}/none.json"
    got = ask([*urls, gone])
    bad = {r.url: (r.outcome, r.status) for r in got.filter("outcome <> 'ok'").collect()}
    assert bad == {urls[1]: ("bad_format", 200), urls[2]: ("exhausted", 200), gone: ("client_error", 404)}
    with pytest.raises(FetchFailed, match="3 of 13") as ex:
        records_of(got)
    assert {r.url for r in ex.value.failures.collect()} == set(bad)       # all of them, as a table


def test_ledger_asks_each_good_url_once(spark, tmp_path):
    from lapworks.sources import rest
    ledger, calls, down = str(tmp_path / "ledger"), str(tmp_path / "calls"), tmp_path / "down"
    down.write_text("")

    def transport(url, timeout_s):
        import os
        with open(calls, "a") as f:
            f.write(url + "\n")
        n = int(url.rsplit("/", 1)[1])
        if n % 4 == 0 and os.path.exists(str(down)):
            return rest.Response(503, None)
        return rest.Response(404, None) if n == 7 else rest.Response(200, f'[{{"n": {n}}}]')
    urls = _urls(spark, [f"https://h/{i}" for i in range(10)] + ["https://h/1", None])     # one twice, a null
    kw = dict(transport=transport, max_retries=2, delay_s=0.0)
    assert rest.read_ledger(spark, ledger).count() == 0
    first = {r.url: (r.outcome, r.attempts, r.runs) for r in rest.fetch_missing(urls, ledger, **kw).collect()}
    assert first["https://h/4"] == ("exhausted", 2, 1) and first["https://h/1"] == ("ok", 1, 1) and len(first) == 10
    down.unlink()
    open(calls, "w").close()
    second = {r.url: (r.outcome, r.attempts, r.runs) for r in rest.fetch_missing(urls, ledger, **kw).collect()}
    assert sorted(open(calls).read().split()) == [f"https://h/{i}" for i in (0, 4, 7, 8)]
    assert second["https://h/4"] == ("ok", 3, 2) and second["https://h/7"] == ("client_error", 2, 2)
    assert second["https://h/1"] == ("ok", 1, 1)
    open(calls, "w").close()
    recs = rest.fetch_records(spark, urls.filter("url NOT LIKE '%7'"), ledger=ledger, schema=StructType.fromDDL("n BIGINT"), **kw)
    assert sorted(r.n for r in recs.collect()) == [0, 1, 2, 3, 4, 5, 6, 8, 9] and open(calls).read() == ""


def test_fetch_records_requests_once_in_the_tasks(spark, tmp_path):
    from lapworks.sources.rest import Response, fetch_records
    log = str(tmp_path / "calls")

    def transport(url, timeout_s):
        with open(log, "a") as f:
            f.write(url + "\n")
        return Response(200, '[{"u": "%s"}]' % url)
    recs = fetch_records(spark, [f"https://h/{i}" for i in range(9)], transport=transport, partitions=3)
    assert recs.count() == 9 and recs.select("u").distinct().count() == 9
    assert sorted(open(log).read().split()) == [f"https://h/{i}" for i in range(9)]


def test_bad_records_do_not_cost_the_columns(spark):
    from lapworks.sources import payloads as pl
    texts = ['[{"AVOID_ZONE": null, "a b": 1, "n": {"VOID": [1, 2]}}, 7, {"AVOID_ZONE": "x"}]', '{"detail": 1}', '[{"a']
    df = spark.createDataFrame([("s", t) for t in texts], "source string, payload string")
    good = pl.to_columns(pl.explode_records(df)).orderBy("pos")
    assert set(good.columns) == {"source", "pos", "AVOID_ZONE", "a b", "n"}
    assert [(r["AVOID_ZONE"], r["a b"], r["n"]) for r in good.collect()] == [(None, 1, '{"VOID":[1,2]}'), ("x", None, None)]
    bad = sorted((r.reason, r.pos, r.content) for r in pl.rejected(df).collect())
    assert [b[0] for b in bad] == ["payload is object", "payload is unparsable", "record is no object"]
    assert bad[2][1:] == (1, "7")


def test_failed_swap_keeps_the_old_rows(spark, monkeypatch):
    import pytest
    from lapworks.sources import tables
    spark.sql("CREATE SCHEMA IF NOT EXISTS sw")
    name = "spark_catalog.sw.t"
    tables.write_table(spark.range(5), name)
    real, calls = tables._rename, []

    def failing(at):
        def rename(sp, old, new):
            calls.append(old)
            if len(calls) == at:
                raise RuntimeError("rename failed")
            return real(sp, old, new)
        return rename
    for at in (1, 2):                                   # another schema: replaced by renames
        calls.clear()
        monkeypatch.setattr(tables, "_rename", failing(at))
        with pytest.raises(RuntimeError, match="Cannot write table"):
            tables.write_table(spark.range(50).withColumn("x", F.lit(1)), name)
        monkeypatch.setattr(tables, "_rename", real)
        assert spark.table(name).count() == 5 and spark.table(name).columns == ["id"]
        assert [t.name for t in spark.catalog.listTables("sw") if not t.isTemporary] == ["t"]
    tables.write_table(spark.table(name).union(spark.range(2)), name)       # reads what it replaces
    assert spark.table(name).count() == 7
    assert tables.write_table(spark.range(0), name, require_rows=True)["rows"] == 0
    assert spark.table(name).count() == 7
    tables.write_table(spark.range(3).withColumn("x", F.lit(1)), name)
    assert spark.table(name).columns == ["id", "x"] and spark.table(name).count() == 3
    assert [t.name for t in spark.catalog.listTables("sw") if not t.isTemporary] == ["t"]


def _versions(tmp_path, name):
    return sorted(p.name for p in (tmp_path / "v.db" / f"{name}.versions").iterdir())


def test_overwrite_moves_a_pointer(spark, tmp_path, monkeypatch):
    """The table is there at every step; a reader that has begun keeps the old rows."""
    import pytest
    from lapworks.sources import tables
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS ver LOCATION '{tmp_path}/v.db'")
    name = "spark_catalog.ver.t"
    tables.write_table(spark.range(5), name)
    begun = spark.table(name)
    assert begun.count() == 5                           # files listed
    real, seen = tables._point, []

    def watched(sp, full_name, path, partition=""):
        seen.append(sp.table(full_name).count())        # all is written: the old rows are there
        real(sp, full_name, path, partition)
        sp.catalog.refreshTable(full_name)
        seen.append(sp.table(full_name).count())
    monkeypatch.setattr(tables, "_point", watched)
    tables.write_table(spark.range(50), name)
    assert seen == [5, 50] and begun.count() == 5 and len(_versions(tmp_path, "t")) == 2
    tables.write_table(spark.range(7), name)            # the first version has no reader left: gone
    assert len(_versions(tmp_path, "t")) == 2 and spark.table(name).count() == 7

    def broken(*a, **kw):
        raise RuntimeError("catalog is away")
    monkeypatch.setattr(tables, "_point", broken)
    with pytest.raises(RuntimeError, match="Cannot write table"):
        tables.write_table(spark.range(9), name)
    assert spark.table(name).count() == 7 and len(_versions(tmp_path, "t")) == 2
    monkeypatch.setattr(tables, "_point", real)
    with pytest.raises(RuntimeError, match="Cannot write table"):
        tables.write_table(spark.range(9).select(F.raise_error(F.lit("no")).cast("long").alias("id")), name)
    assert spark.table(name).count() == 7 and len(_versions(tmp_path, "t")) == 2


def test_failed_season_keeps_the_old_season(spark, tmp_path, monkeypatch):
    import pytest
    from lapworks.sources import tables
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS sea LOCATION '{tmp_path}/s.db'")
    name = "spark_catalog.sea.t"
    kw = dict(partition_by=["season", "kind"], dynamic=True)
    frame = lambda season, n: spark.range(n).select("id", F.lit(season).cast("int").alias("season"), F.lit("a b/ü").alias("kind"))
    counts = lambda: {r.season: r["count"] for r in spark.table(name).groupBy("season").count().collect()}
    tables.write_table(frame(2024, 4).unionByName(frame(2025, 5)), name, **kw)
    tables.write_table(frame(2025, 6), name, **kw)
    assert counts() == {2024: 4, 2025: 6}
    bad = frame(2025, 9).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(RuntimeError, match="Cannot write table"):
        tables.write_table(bad, name, **kw)
    assert counts() == {2024: 4, 2025: 6}
    real = tables._point
    monkeypatch.setattr(tables, "_point", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("catalog is away")))
    with pytest.raises(RuntimeError, match="Cannot write table"):
        tables.write_table(frame(2025, 1), name, **kw)
    monkeypatch.setattr(tables, "_point", real)
    assert counts() == {2024: 4, 2025: 6}
    tables.write_table(frame(2026, 2), name, **kw)
    tables.write_table(frame(None, 3), name, **kw)
    assert counts() == {2024: 4, 2025: 6, 2026: 2, None: 3}
    tables.write_table(frame(2026, 1), name, partition_by=["season", "kind"])       # the whole table
    assert counts() == {2026: 1}
