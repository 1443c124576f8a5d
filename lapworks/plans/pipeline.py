"""Pipeline stages (R1-R6): Bronze -> Silver -> gate -> Gold -> gate, halting on failure.

Each stage is a handful of Spark jobs (one write per table, which also observes the
table's checks, and one aggregate per table for duplicates); a stage's independent
branches run at the same time.  The driver only sees per-table status rows and check
outcomes, both bounded by the number of tables and checks.
"""

from __future__ import annotations

import inspect
import logging
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lapworks.config import DEFAULT, Settings
from lapworks.functions.columns import EXACT_SCALE
from lapworks.operators import bronze, checks, laps, marts, sessions
from lapworks.plans import check_presets as presets
from lapworks.sources import catalog
from lapworks.sources.tables import read_table, table_name, write_table

log = logging.getLogger("lapworks.pipeline")

STATUS_SCHEMA = StructType([StructField("stage", StringType()), StructField("dataset", StringType()),
                            StructField("status", StringType()), StructField("rows", LongType()),
                            StructField("detail", StringType())])


@dataclass
class Status:
    stage: str
    dataset: str
    status: str            # ok | failed
    rows: int | None = None
    detail: str | None = None


class StageError(RuntimeError):
    def __init__(self, message: str, statuses: list[Status]):
        super().__init__(message)
        self.statuses = statuses


@dataclass
class Options:
    settings: Settings = DEFAULT
    catalog: str = "spark_catalog"
    location: str | None = None          # schema root in the shared folder
    as_of: object = None
    lap_type: str = "int"
    duration_type: str = "float"
    session_id_type: str = "int"
    avg_scale: int | None = EXACT_SCALE
    distributed: bool = True
    seasonal_gold: bool = False          # Gold partitioned by season_year, one season replaced per run
    resolve_session: bool = True         # pick the target session before the per-session datasets
    position_col: str = "pos"            # payload position of the raw sessions
    ledger: str | None = None            # shared folder of finished requests: a rerun asks for the others only
    check_sets: dict = field(default_factory=lambda: dict(presets.PRESET))
    thresholds: dict = field(default_factory=dict)   # by check name, see presets.with_thresholds
    inject_min_lap: bool = False         # the settings' minimum lap duration also bounds the checks

    def checks(self, label: str) -> list:
        """The table's checks with this run's thresholds."""
        mine = self.check_sets[label]
        if self.inject_min_lap:
            mine = presets.with_thresholds(mine, **presets.min_lap_thresholds(self.settings.min_lap_duration_s))
        return presets.with_thresholds(mine, **self.thresholds)

    def name(self, layer: str, table: str, season: int | None = None) -> str:
        return table_name(getattr(self.settings, layer), table, season, self.catalog)


def _write_checked(df: DataFrame, opts: Options, label: str, observed: dict | None, *, metrics: dict | None = None,
                   **kw) -> dict:
    """Writes a checked table; the job that writes it observes all its checks but those for
    duplicates, for the gate to use (``observed``: by table and check name)."""
    layer, name = label.split(".", 1)
    mine = checks.observable(opts.checks(label)) if observed is not None else {}
    got = write_table(df, opts.name(layer, name), metrics={**(metrics or {}), **mine}, **kw)
    if observed is not None:
        observed[label] = {n: got[n] for n in mine if n in got}
    return got


def _fail_at_end(stage: str, statuses: list[Status]) -> list[Status]:
    failed = [s for s in statuses if s.status != "ok"]
    if failed:
        raise StageError(f"{stage}: {len(failed)} dataset(s) failed: "
                         + ", ".join(f"{s.dataset} ({s.detail})" for s in failed), statuses)
    return statuses


def ensure_layers(spark: SparkSession, opts: Options) -> None:
    s = opts.settings
    layers = {s.bronze: catalog.LAYERS["bronze"], s.silver: catalog.LAYERS["silver"],
              s.gold: catalog.LAYERS["gold"]}
    if opts.location is None:
        catalog.ensure_layers(spark, layers, opts.catalog)
        return
    for name, comment in layers.items():
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {opts.catalog}.{name} COMMENT '{comment}' "
                  f"LOCATION '{opts.location.rstrip('/')}/{name}.db'")


def _together(spark: SparkSession, stage: str, branches: dict[str, Callable[[], list[Status]]]) -> list[Status]:
    """Runs the independent branches of a stage at the same time and returns their statuses
    in the order given.  Each branch's jobs carry a tag of its own; if the run is aborted,
    the jobs of all branches are cancelled."""
    run = uuid.uuid4().hex[:8]
    tags = {name: f"{stage}.{name}.{run}" for name in branches}
    try:
        sc = spark.sparkContext
        add_tag, remove_tag, cancel = sc.addJobTag, sc.removeJobTag, sc.cancelJobsWithTag
    except Exception:                        # Spark Connect: the session has them
        add_tag, remove_tag, cancel = spark.addTag, spark.removeTag, spark.interruptTag

    def tagged(name: str):
        @inheritable_thread_target(spark)
        def call():
            add_tag(tags[name])
            try:
                return branches[name]()
            finally:
                remove_tag(tags[name])
        return call
    pool = ThreadPoolExecutor(max_workers=max(len(branches), 1), thread_name_prefix=f"lapworks-{stage}")
    try:
        futures = [pool.submit(tagged(name)) for name in branches]
        return [status for f in futures for status in f.result()]
    except BaseException:
        pool.shutdown(wait=False, cancel_futures=True)
        while True:                          # a branch may be between two jobs
            for tag in tags.values():
                cancel(tag)
            if not wait(futures, timeout=1).not_done:
                raise
    finally:
        pool.shutdown(wait=True)


def _caught(stage: str, dataset: str, work: Callable[[], list[Status]]) -> Callable[[], list[Status]]:
    """``work``; a failure is recorded, the other branches go on."""
    def call():
        try:
            return work()
        except Exception as ex:
            return [Status(stage, dataset, "failed", detail=f"{type(ex).__name__}: {ex}")]
    return call


def _call(fetch, key):
    """Fetchers take the resolved session key when they accept an argument."""
    try:
        params = inspect.signature(fetch).parameters
    except (TypeError, ValueError):
        params = {}
    return fetch(key) if len(params) >= 1 else fetch()


def run_bronze(spark: SparkSession, fetchers: dict[str, Callable[..., DataFrame | None]],
               opts: Options, race_location: str | None = None) -> list[Status]:
    """``sessions`` must yield rows (else raise at once).  The target session is
    resolved from the raw sessions (type and circuit, last in payload order ``pos``;
    raise when there is none) and its key is passed to the other fetchers, which run
    at the same time.  Every other dataset that fails, is missing or empty is recorded
    and the rest continue; raise at the end."""
    ensure_layers(spark, opts)
    season = opts.settings.season_year
    loc = race_location or opts.settings.race_round
    # every source is evaluated once, by its write; what follows reads the written table
    sess = fetchers["sessions"]()
    rows = 0 if sess is None else write_table(
        bronze.normalise(sess, loc, as_of=opts.as_of, sentinels=opts.settings.null_sentinels),
        opts.name("bronze", "raw_sessions", season), require_rows=True)["rows"]
    if not rows:
        raise StageError("bronze: sessions returned no data", [Status("bronze", "sessions", "failed",
                                                                      detail="no data")])
    out = [Status("bronze", "sessions", "ok", rows)]
    key = None
    if opts.resolve_session:
        # one aggregate; a single row comes back to the driver
        written = read_table(spark, opts.name("bronze", "raw_sessions", season), on_empty="ignore")
        target = sessions.resolve_target(written, opts.settings.session_type, opts.settings.race_round,
                                         position=opts.position_col).select("session_key").first()
        if target is None:
            raise StageError("bronze: could not determine the target session",
                             out + [Status("bronze", "target_session", "failed", detail="none")])
        key = target["session_key"]
        out.append(Status("bronze", "target_session", "ok", 1, f"session_key={key}"))
    def dataset(name: str, fetch) -> list[Status]:
        df = _call(fetch, key)
        rows = 0 if df is None else write_table(
            bronze.normalise(df, loc, as_of=opts.as_of, sentinels=opts.settings.null_sentinels),
            opts.name("bronze", f"raw_{name}", season), require_rows=True)["rows"]
        return [Status("bronze", name, "ok", rows) if rows else Status("bronze", name, "failed", detail="no data")]
    out += _together(spark, "bronze", {
        name: _caught("bronze", name, partial(dataset, name, fetch)) for name, fetch in fetchers.items() if name != "sessions"})
    return _fail_at_end("bronze", out)


def _retained(what: str, before: int, after: int) -> Status:
    """A retention row: what is left, and the share that went (one decimal)."""
    share = round((before - after) * 100.0 / before, 1) if before else 0.0
    return Status("silver", f"retention_{what}", "ok", after, f"of {before}, {share}% dropped")


def rest_fetchers(spark: SparkSession, opts: Options, *, transport="http", schemas: dict | None = None,
                  endpoints: dict[str, str] | None = None) -> dict[str, Callable[..., DataFrame]]:
    """The run's datasets from the list endpoints: the season's sessions, then drivers, laps
    and telemetry of the resolved session, requested in the tasks with the settings' retry
    policy.  ``schemas``: declared record schemas by dataset (else inferred)."""
    from lapworks.sources import manifest, rest
    s = opts.settings
    policy = dict(transport=transport, max_retries=s.max_retries, delay_s=s.retry_delay_s, timeout_s=s.request_timeout_s)
    schemas = schemas or {}

    def ledger(name: str) -> str | None:
        return f"{opts.ledger.rstrip('/')}/{name}" if opts.ledger else None

    def of_season():
        return rest.fetch_records(spark, [manifest.season_url(s.base_url, s.season_year)],
                                  schema=schemas.get("sessions"), ledger=ledger("sessions"), **policy)

    def of_session(name: str, path: str):
        def fetch(key):
            keys = spark.createDataFrame([(str(key),)], "session_key string")
            urls = manifest.endpoint_manifest(keys, s.base_url, {name: path}).select("url")
            return rest.fetch_records(spark, urls, schema=schemas.get(name), ledger=ledger(name), **policy)
        return fetch
    paths = endpoints or manifest.RACE_ENDPOINTS
    return {"sessions": of_season, **{n: of_session(n, p) for n, p in paths.items()}}


def run_silver(spark: SparkSession, opts: Options, observed: dict | None = None) -> list[Status]:
    """Two independent branches (sessions, laps) at the same time, each caught; raise at the end.
    ``observed`` receives the check metrics that the writes have seen."""
    s, season = opts.settings, opts.settings.season_year

    def of_sessions() -> list[Status]:
        raw = read_table(spark, opts.name("bronze", "raw_sessions", season), on_empty="warn")
        cleaned = sessions.clean(raw, season, keep_types=s.session_types_kept,
                                 id_type=opts.session_id_type, as_of=opts.as_of)
        n = _write_checked(cleaned, opts, "silver.cleaned_sessions", observed)["rows"]
        out = [Status("silver", "cleaned_sessions", "ok", n), _retained("sessions", raw.count(), n)]
        lost = sessions.rejected(raw, keep_types=s.session_types_kept, id_type=opts.session_id_type).count()
        if lost:
            out.append(Status("silver", "rejected_sessions", "ok", lost, "no usable key or start"))
        return out

    def of_laps() -> list[Status]:
        raw_laps = read_table(spark, opts.name("bronze", "raw_laps", season), on_empty="warn")
        raw_drivers = read_table(spark, opts.name("bronze", "raw_drivers", season), on_empty="warn")
        enriched = laps.enrich(raw_laps, raw_drivers, s.min_lap_duration_s, lap_type=opts.lap_type,
                               duration_type=opts.duration_type, as_of=opts.as_of)
        flag = F.col("is_valid_lap")
        res = _write_checked(enriched, opts, "silver.enriched_laps", observed,
                             metrics={"valid": F.count_if(flag), "flagged": F.count_if(~flag)})
        log.info("enriched laps: %s valid, %s flagged", res["valid"], res["flagged"])
        return [Status("silver", "enriched_laps", "ok", res["rows"], f"valid={res['valid']} flagged={res['flagged']}"),
                _retained("laps", raw_laps.count(), res["rows"]), _retained("valid_laps", res["rows"], res["valid"])]
    return _fail_at_end("silver", _together(spark, "silver", {
        "cleaned_sessions": _caught("silver", "cleaned_sessions", of_sessions),
        "enriched_laps": _caught("silver", "enriched_laps", of_laps)}))


def check_results(spark: SparkSession, opts: Options, tables, observed: dict | None = None) -> DataFrame:
    """The check results of ``tables``: what their writes have observed is taken over, the
    rest (duplicates) is one pass over each table.  The tables are also registered as views
    (``silver_enriched_laps``), to look at what a check has found."""
    frames = []
    for label in tables:
        layer, tbl = label.split(".", 1)
        df = read_table(spark, opts.name(layer, tbl), on_empty="ignore")
        catalog.register_views({label: df})
        frames.append(checks.run_checks(df, opts.checks(label), label, (observed or {}).get(label)))
    return reduce(DataFrame.unionByName, frames)


def gate(spark: SparkSession, opts: Options, stage: str, tables, observed: dict | None = None) -> list[Status]:
    """Run the tables' checks; ``rows`` of the status is the number of checks evaluated."""
    results = check_results(spark, opts, tables, observed)
    n = sum(len(opts.check_sets[t]) for t in tables)
    # one row per check at most: bounded by the check sets
    bad = results.filter(F.col("outcome") != "pass").orderBy("table", "check").collect()
    if bad:
        failed = [Status(stage, r["table"], "failed", 1,
                         f"{r['check']}={r['value']} {r['op']} {r['threshold']} ({r['outcome']})") for r in bad]
        raise StageError(f"{stage}: {len(bad)} of {n} checks failed",
                         [Status(stage, ",".join(tables), "failed", n, f"{len(bad)} check(s)"), *failed])
    return [Status(stage, ",".join(tables), "ok", n)]


def run_gold(spark: SparkSession, opts: Options, observed: dict | None = None) -> list[Status]:
    """A strict read (a failure aborts at once) feeds three marts at the same time, each caught.
    ``observed`` receives the check metrics that the writes have seen."""
    season = opts.settings.season_year
    silver = read_table(spark, opts.name("silver", "enriched_laps"), on_empty="raise")
    builders = {
        "driver_performance_metrics": lambda: marts.driver_leaderboard(
            silver, season, avg_scale=opts.avg_scale, decimals=opts.settings.decimals,
            distributed=opts.distributed, as_of=opts.as_of, ordered=False),
        "constructor_standings": lambda: marts.team_standings(
            silver, season, avg_scale=opts.avg_scale, decimals=opts.settings.decimals,
            distributed=opts.distributed, as_of=opts.as_of, ordered=False),
        "lap_progression": lambda: marts.lap_progression(
            silver, season, rows=opts.settings.rolling_laps, decimals=opts.settings.decimals, avg_scale=opts.avg_scale,
            lap_type=opts.lap_type, distributed=opts.distributed, as_of=opts.as_of, ordered=False),
    }
    kw = {"partition_by": "season_year", "dynamic": True} if opts.seasonal_gold else {}

    def mart(name: str, build) -> list[Status]:
        return [Status("gold", name, "ok", _write_checked(build(), opts, f"gold.{name}", observed, **kw)["rows"])]
    return _fail_at_end("gold", _together(spark, "gold", {
        name: _caught("gold", name, partial(mart, name, build)) for name, build in builders.items()}))


def run_all(spark: SparkSession, fetchers, opts: Options) -> DataFrame:
    """Bronze -> Silver -> Silver gate -> Gold -> Gold gate; the first failing
    stage halts the run.  Returns the stage status table.  The gates take the metrics
    that the writes have observed; only duplicates read the tables again."""
    seen: dict[str, dict] = {}
    stages = [
        ("bronze", lambda: run_bronze(spark, fetchers, opts)),
        ("silver", lambda: run_silver(spark, opts, seen)),
        ("gate_silver", lambda: gate(spark, opts, "gate_silver", presets.SILVER_TABLES, seen)),
        ("gold", lambda: run_gold(spark, opts, seen)),
        ("gate_gold", lambda: gate(spark, opts, "gate_gold", presets.GOLD_TABLES, seen)),
    ]
    statuses: list[Status] = []
    for stage, fn in stages:
        try:
            statuses.extend(fn())
        except StageError as ex:
            statuses.extend(ex.statuses)
            log.error("stage %s failed, halting: %s", stage, ex)
            break
        except Exception as ex:
            statuses.append(Status(stage, "*", "failed", detail=f"{type(ex).__name__}: {ex}"))
            break
    return spark.createDataFrame([(s.stage, s.dataset, s.status, s.rows, s.detail) for s in statuses],
                                 STATUS_SCHEMA)


def report_datasets(spark: SparkSession, opts: Options, *, full_name: str | None = None,
                    team_name: str | None = None) -> dict[str, DataFrame]:
    """The report datasets over the written Gold tables (what a dashboard reads)."""
    from lapworks.operators import reports
    lb = read_table(spark, opts.name("gold", "driver_performance_metrics"), on_empty="raise")
    st = read_table(spark, opts.name("gold", "constructor_standings"), on_empty="raise")
    pg = read_table(spark, opts.name("gold", "lap_progression"), on_empty="raise")
    filters = {"full_name": full_name, "team_name": team_name}
    facets = reports.facet_tables(pg, ["full_name", "team_name"], filters)
    of = lambda name: facets.filter(F.col("facet") == name).select(F.col("value").alias(name), "row_count")
    return {
        "facets": facets,
        "fastest_driver": reports.fastest_driver(lb),
        "top_team": reports.top_team(st),
        "speed_consistency": reports.speed_consistency(lb),
        "pace_gap": reports.pace_gap(st),
        "race_trace": reports.race_trace(pg, full_name, team_name),
        "driver_facets": of("full_name"),
        "team_facets": of("team_name"),
        "fastest_by_driver": reports.widget_sum(lb, "full_name", "fastest_lap_s"),
        "pace_by_team": reports.widget_sum(st, "team_name", "avg_team_pace_s"),
        "trace_by_driver_lap": reports.widget_sum(pg, ["full_name", "lap_number"], "rolling_avg_5lap_s"),
        "preview": reports.preview(pg.orderBy("full_name", "lap_number"), 20),
    }
