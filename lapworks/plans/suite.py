"""Registered queries (Spark) and their DuckDB oracle SQL over the same tables.

Each query reads whole tables from ``sf_dir`` and returns a DataFrame; audit
clock columns (``generated_at``, ``processed_at``) are left out of the
registered outputs because they hold the wall clock.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from lapworks.operators import bronze, checks, conform, laps, marts, metrics, reports, sessions
from lapworks.operators import validity
from lapworks.plans import check_presets as presets
from lapworks.plans import testdata as td

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- oracle pieces
def exact_avg_sql(x: str, over: str = "", scale: int = 2) -> str:
    """HALF_UP average at 3 decimals of values of ``scale`` decimals, in exact integers."""
    s = f"sum(CAST(round({x} * {10 ** scale}) AS HUGEINT)){over}"
    n = f"count({x}){over}"
    return f"((2000 * {s} + {n} * {10 ** scale}) // (2 * {n} * {10 ** scale})) / 1000.0"


ENRICHED_CTE = """
drivers AS (
  SELECT trim(CAST(c_custkey AS VARCHAR)) AS driver_number, trim(c_name) AS full_name,
         trim(c_mktsegment) AS team_name, CAST(c_nationkey AS VARCHAR) AS country_code,
         'img/' || CAST(c_custkey AS VARCHAR) AS headshot_url
  FROM customer),
laps AS (
  SELECT trim(CAST(user_id AS VARCHAR)) AS driver_number, event_id AS lap_number,
         value AS lap_duration, event_type = 'error' AS is_pit_out_lap
  FROM events),
enriched AS (
  SELECT l.driver_number, d.full_name, d.team_name, d.country_code, d.headshot_url,
         l.lap_number, l.lap_duration, l.is_pit_out_lap,
         CASE WHEN l.is_pit_out_lap THEN false
              WHEN l.lap_duration IS NULL THEN false
              WHEN l.lap_duration < 1.0 THEN false
              ELSE true END AS is_valid_lap
  FROM laps l JOIN drivers d ON l.driver_number = d.driver_number),
valid AS (SELECT * FROM enriched WHERE is_valid_lap)"""

LEADERBOARD_CTE = ENRICHED_CTE + f""",
lb_agg AS (
  SELECT driver_number, full_name, team_name,
         round(min(lap_duration), 3) AS fastest_lap_s,
         {exact_avg_sql('lap_duration')} AS avg_lap_time_s,
         round(quantile_disc(lap_duration, 0.5), 3) AS median_lap_time_s,
         round(coalesce(stddev_samp(lap_duration), 0), 3) AS lap_consistency_s,
         CAST(count(lap_number) AS INTEGER) AS total_valid_laps
  FROM valid GROUP BY driver_number, full_name, team_name),
leaderboard AS (
  SELECT CAST(dense_rank() OVER (ORDER BY avg_lap_time_s ASC NULLS FIRST,
                                 lap_consistency_s ASC NULLS FIRST) AS INTEGER) AS pace_rank,
         full_name, team_name, driver_number, fastest_lap_s, avg_lap_time_s,
         median_lap_time_s, lap_consistency_s, total_valid_laps,
         TIMESTAMP '2025-01-01 00:00:00' AS generated_at, 2025 AS season_year
  FROM lb_agg)"""

STANDINGS_CTE = ENRICHED_CTE + f""",
st_agg AS (
  SELECT team_name, round(min(lap_duration), 3) AS best_lap_s,
         {exact_avg_sql('lap_duration')} AS avg_team_pace_s,
         CAST(count(lap_number) AS INTEGER) AS total_valid_laps
  FROM valid GROUP BY team_name),
standings AS (
  SELECT CAST(dense_rank() OVER (ORDER BY avg_team_pace_s ASC NULLS FIRST,
                                 total_valid_laps DESC NULLS LAST) AS INTEGER) AS team_pace_rank,
         team_name, best_lap_s, avg_team_pace_s, total_valid_laps,
         TIMESTAMP '2025-01-01 00:00:00' AS generated_at, 2025 AS season_year
  FROM st_agg)"""

_W5 = " OVER (PARTITION BY driver_number ORDER BY lap_number ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"
PROGRESSION_CTE = ENRICHED_CTE + f""",
progression AS (
  SELECT full_name, team_name, driver_number, lap_number,
         round(lap_duration, 3) AS lap_duration_s,
         {exact_avg_sql('lap_duration', _W5)} AS rolling_avg_5lap_s,
         TIMESTAMP '2025-01-01 00:00:00' AS generated_at, 2025 AS season_year
  FROM valid)"""


# ---------------------------------------------------------------- Spark builders
def silver_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return td.enriched_laps(spark, sf_dir)


def leaderboard(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return marts.driver_leaderboard(silver_laps(spark, sf_dir), td.SEASON_YEAR,
                                    avg_scale=td.AVG_SCALE, as_of=td.AS_OF, **kw)


def standings(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return marts.team_standings(silver_laps(spark, sf_dir), td.SEASON_YEAR,
                                avg_scale=td.AVG_SCALE, as_of=td.AS_OF, **kw)


def progression(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return marts.lap_progression(silver_laps(spark, sf_dir), td.SEASON_YEAR,
                                 avg_scale=td.AVG_SCALE, lap_type=td.LAP_TYPE, as_of=td.AS_OF, **kw)


# ---------------------------------------------------------------- Gold marts
@register("driver_leaderboard", f"WITH {LEADERBOARD_CTE} SELECT * EXCLUDE (generated_at) FROM leaderboard")
def q_driver_leaderboard(spark, sf_dir):
    return leaderboard(spark, sf_dir).drop("generated_at")


@register("driver_leaderboard_distributed",
          f"WITH {LEADERBOARD_CTE} SELECT * EXCLUDE (generated_at) FROM leaderboard")
def q_driver_leaderboard_distributed(spark, sf_dir):
    return leaderboard(spark, sf_dir, distributed=True).drop("generated_at")


# A hot driver derived from the data: every lap of one team is credited to a single
# driver (about a fifth of all laps), nothing is filtered.
_HOT_TEAM = "BUILDING"
HOT_CTE = ENRICHED_CTE.replace("valid AS (SELECT * FROM enriched WHERE is_valid_lap)", f"""valid AS (
  SELECT CASE WHEN team_name = '{_HOT_TEAM}' THEN 'hot' ELSE driver_number END AS driver_number,
         CASE WHEN team_name = '{_HOT_TEAM}' THEN 'Hot Driver' ELSE full_name END AS full_name,
         team_name, lap_number, lap_duration
  FROM enriched WHERE is_valid_lap)""")


def hot_laps(spark, sf_dir):
    lp = silver_laps(spark, sf_dir)
    hot = F.col("team_name") == F.lit(_HOT_TEAM)
    return lp.withColumns({"driver_number": F.when(hot, F.lit("hot")).otherwise(F.col("driver_number")),
                           "full_name": F.when(hot, F.lit("Hot Driver")).otherwise(F.col("full_name"))})


_HOT_PROG_SQL = HOT_CTE + f""",
progression AS (
  SELECT full_name, team_name, driver_number, lap_number, round(lap_duration, 3) AS lap_duration_s,
         {exact_avg_sql('lap_duration', _W5)} AS rolling_avg_5lap_s, 2025 AS season_year
  FROM valid)"""


@register("lap_progression_hot_driver", f"WITH {_HOT_PROG_SQL} SELECT * FROM progression")
def q_lap_progression_hot_driver(spark, sf_dir):
    return marts.lap_progression(hot_laps(spark, sf_dir), td.SEASON_YEAR, avg_scale=td.AVG_SCALE,
                                 lap_type=td.LAP_TYPE, as_of=td.AS_OF, distributed=True).drop("generated_at")


_HOT_LB_SQL = LEADERBOARD_CTE.replace(ENRICHED_CTE, HOT_CTE)


@register("driver_leaderboard_hot_driver",
          f"WITH {_HOT_LB_SQL} SELECT * EXCLUDE (generated_at) FROM leaderboard")
def q_driver_leaderboard_hot_driver(spark, sf_dir):
    return marts.driver_leaderboard(hot_laps(spark, sf_dir), td.SEASON_YEAR, avg_scale=td.AVG_SCALE,
                                    as_of=td.AS_OF, distributed=True).drop("generated_at")


# The hot driver's laps numbered 1 to 70: tens of thousands of rows tie on each number.
_FEW_LAPS = 70
_FEW_CTE = HOT_CTE.replace("team_name, lap_number, lap_duration\n  FROM enriched",
                           f"team_name, lap_number % {_FEW_LAPS} + 1 AS lap_number, lap_duration\n  FROM enriched")
_FEW_W5 = _W5.replace("ORDER BY lap_number", "ORDER BY lap_number, lap_duration, full_name, team_name")


@register("lap_progression_hot_laps", f"""WITH {_FEW_CTE}
SELECT full_name, team_name, driver_number, lap_number, round(lap_duration, 3) AS lap_duration_s,
       {exact_avg_sql('lap_duration', _FEW_W5)} AS rolling_avg_5lap_s, 2025 AS season_year FROM valid""")
def q_lap_progression_hot_laps(spark, sf_dir):
    """A hot driver whose lap numbers repeat: cut by counts along lap and duration."""
    few = hot_laps(spark, sf_dir).withColumn("lap_number", F.col("lap_number") % _FEW_LAPS + 1)
    return marts.lap_progression(few, td.SEASON_YEAR, avg_scale=td.AVG_SCALE, lap_type=td.LAP_TYPE, as_of=td.AS_OF,
                                 target_rows=64).drop("generated_at")


_NULL_CTE = ENRICHED_CTE.replace("valid AS (SELECT * FROM enriched WHERE is_valid_lap)", """valid AS (
  SELECT driver_number, CASE WHEN country_code <> '7' THEN full_name END AS full_name,
         nullif(team_name, 'BUILDING') AS team_name, lap_number, lap_duration FROM enriched WHERE is_valid_lap)""")
_NULL_SQL = f"""WITH {LEADERBOARD_CTE.replace(ENRICHED_CTE, _NULL_CTE)}
SELECT * EXCLUDE (generated_at) FROM leaderboard"""


def _null_keys(spark, sf_dir, distributed):
    lp = silver_laps(spark, sf_dir).withColumns({
        "full_name": F.when(F.col("country_code") != "7", F.col("full_name")),
        "team_name": F.nullif(F.col("team_name"), F.lit("BUILDING"))})
    return marts.driver_leaderboard(lp, td.SEASON_YEAR, as_of=td.AS_OF, distributed=distributed).drop("generated_at")


@register("leaderboard_null_keys", _NULL_SQL)
def q_leaderboard_null_keys(spark, sf_dir):
    """Drivers without a team or a name are groups like any other."""
    return _null_keys(spark, sf_dir, True)


@register("leaderboard_null_keys_plain", _NULL_SQL)
def q_leaderboard_null_keys_plain(spark, sf_dir):
    return _null_keys(spark, sf_dir, False)


@register("driver_leaderboard_plain", f"WITH {LEADERBOARD_CTE} SELECT * EXCLUDE (generated_at) FROM leaderboard")
def q_driver_leaderboard_plain(spark, sf_dir):
    return leaderboard(spark, sf_dir, distributed=False).drop("generated_at")


# The racing preset's own types: int laps, 32-bit durations, valid from 60 s on.
DEFAULT_CTE = ENRICHED_CTE.replace("value AS lap_duration", "CAST(value AS FLOAT) AS lap_duration") \
    .replace("event_id AS lap_number", "CAST(event_id AS INTEGER) AS lap_number").replace("< 1.0", "< 60.0")


def default_laps(spark, sf_dir):
    return laps.enrich(td.bronze_laps(spark, sf_dir), td.bronze_drivers(spark, sf_dir), as_of=td.AS_OF)


_DEFAULT_LB = LEADERBOARD_CTE.replace(ENRICHED_CTE, DEFAULT_CTE) \
    .replace(exact_avg_sql("lap_duration"), exact_avg_sql("CAST(lap_duration AS DOUBLE)", scale=9)) \
    .replace("lap_duration)", "CAST(lap_duration AS DOUBLE))") \
    .replace("round(min(CAST(lap_duration AS DOUBLE)), 3)", "CAST(round(min(CAST(lap_duration AS DOUBLE)), 3) AS FLOAT)") \
    .replace("round(quantile_disc(lap_duration, 0.5), 3)", "CAST(round(quantile_disc(CAST(lap_duration AS DOUBLE), 0.5), 3) AS FLOAT)")


@register("leaderboard_default_types", f"""WITH {_DEFAULT_LB} SELECT * EXCLUDE (generated_at) FROM leaderboard""")
def q_leaderboard_default_types(spark, sf_dir):
    return marts.driver_leaderboard(default_laps(spark, sf_dir), td.SEASON_YEAR, as_of=td.AS_OF).drop("generated_at")


@register("progression_default_types", f"""WITH {DEFAULT_CTE}
SELECT full_name, team_name, driver_number, lap_number,
       CAST(round(CAST(lap_duration AS DOUBLE), 3) AS FLOAT) AS lap_duration_s,
       {exact_avg_sql('CAST(lap_duration AS DOUBLE)', _W5, scale=9)} AS rolling_avg_5lap_s, 2025 AS season_year
FROM valid""")
def q_progression_default_types(spark, sf_dir):
    return marts.lap_progression(default_laps(spark, sf_dir), td.SEASON_YEAR, as_of=td.AS_OF).drop("generated_at")


_ONE_GROUP = """SELECT l_extendedprice AS v FROM lineitem UNION ALL
  SELECT -l_extendedprice * l_discount FROM lineitem UNION ALL SELECT l_quantity FROM lineitem"""


def _one_group(spark, sf_dir):
    li = td.table(spark, sf_dir, "lineitem")
    return li.select(F.lit("all").alias("k"), F.explode(F.array(
        "l_extendedprice", -F.col("l_extendedprice") * F.col("l_discount"), F.col("l_quantity").cast("double"))).alias("v"))


@register("median_one_group", f"SELECT 'all' AS k, round(quantile_disc(v, 0.5), 3) AS median FROM ({_ONE_GROUP})")
def q_median_one_group(spark, sf_dir):
    """One group with three values from every line item, either sign."""
    return metrics.lower_median(_one_group(spark, sf_dir), ["k"], "v").select("k", F.round("median", 3).alias("median"))


@register("median_one_group_plain", f"SELECT 'all' AS k, round(quantile_disc(v, 0.5), 3) AS median FROM ({_ONE_GROUP})")
def q_median_one_group_plain(spark, sf_dir):
    """The same by ``percentile_disc``, whose value-count table has the values near the median only."""
    return metrics.bracketed_median(_one_group(spark, sf_dir), ["k"], "v").select("k", F.round("median", 3).alias("median"))


_NAN_GROUPS = """SELECT event_type AS k, CASE WHEN user_id % 3 > 0 AND event_type <> 'view' THEN 'NaN'::DOUBLE ELSE value END AS v
  FROM events
  UNION ALL SELECT 'narrow', 90 + (event_id * 7919 % 1000003) / 5000015.0 FROM events
  UNION ALL SELECT 'equal', 90.5 FROM events"""


@register("median_nan_groups", f"""SELECT k, isnan(m) AS is_nan, CASE WHEN NOT isnan(m) THEN round(m, 9) END AS median
FROM (SELECT k, quantile_disc(v, 0.5) AS m FROM ({_NAN_GROUPS}) GROUP BY k)""")
def q_median_nan_groups(spark, sf_dir):
    """Groups with NaN (sorted last), one between 90.0 and 90.2, one of equal values."""
    e = td.table(spark, sf_dir, "events")
    own = F.when((F.col("user_id") % 3 > 0) & (F.col("event_type") != "view"), F.lit(float("nan"))).otherwise(F.col("value"))
    df = e.select(F.explode(F.array(
        F.struct(F.col("event_type").alias("k"), own.alias("v")),
        F.struct(F.lit("narrow").alias("k"), (F.col("event_id") * 7919 % 1000003 / F.lit(5000015.0) + 90).alias("v")),
        F.struct(F.lit("equal").alias("k"), F.lit(90.5).alias("v")))).alias("r")).select("r.k", "r.v")
    m = metrics.lower_median(df, ["k"], "v", "m", target_rows=128)
    return m.select("k", F.isnan("m").alias("is_nan"), F.when(~F.isnan("m"), F.round("m", 9)).alias("median"))


@register("team_standings", f"WITH {STANDINGS_CTE} SELECT * EXCLUDE (generated_at) FROM standings")
def q_team_standings(spark, sf_dir):
    return standings(spark, sf_dir).drop("generated_at")


@register("lap_progression", f"WITH {PROGRESSION_CTE} SELECT * EXCLUDE (generated_at) FROM progression")
def q_lap_progression(spark, sf_dir):
    return progression(spark, sf_dir).drop("generated_at")


@register("lap_progression_distributed",
          f"WITH {PROGRESSION_CTE} SELECT * EXCLUDE (generated_at) FROM progression")
def q_lap_progression_distributed(spark, sf_dir):
    return progression(spark, sf_dir, distributed=True).drop("generated_at")


# ---------------------------------------------------------------- sessions
SESSIONS_RAW_CTE = """
sessions_raw AS (
  SELECT o_orderkey AS session_key, ' ' || o_orderpriority || ' ' AS session_name,
         CASE o_orderstatus WHEN 'F' THEN 'Race' WHEN 'O' THEN ' qualifying '
              ELSE 'Practice 1' END AS session_type,
         'Circuit ' || CAST(o_custkey AS VARCHAR) AS location,
         ' ' || o_orderpriority AS country_name,
         CAST(year(o_orderdate) AS INTEGER) AS year,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS date_start,
         strftime(o_orderdate + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS date_end,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'Baku' ELSE 'Monza' END AS circuit_short_name,
         o_orderkey AS pos
  FROM orders)"""

CLEANED_CTE = SESSIONS_RAW_CTE + """,
cleaned AS (
  SELECT CAST(session_key AS BIGINT) AS session_id, trim(session_name) AS session_name,
         upper(trim(session_type)) AS session_type, location, trim(country_name) AS country_name,
         CAST(date_start AS TIMESTAMPTZ) AS start_time, CAST(date_end AS TIMESTAMPTZ) AS end_time,
         CAST(year AS INTEGER) AS year, TIMESTAMP '2025-01-01 00:00:00' AS processed_at,
         2025 AS pipeline_year
  FROM sessions_raw
  WHERE upper(trim(session_type)) IN ('RACE', 'QUALIFYING') AND session_key IS NOT NULL
    AND TRY_CAST(date_start AS TIMESTAMPTZ) IS NOT NULL)"""

CLEANED_OUT_SQL = """SELECT session_id, session_name, session_type, location, country_name,
       CAST(epoch(start_time) AS BIGINT) AS start_epoch, CAST(epoch(end_time) AS BIGINT) AS end_epoch,
       year, pipeline_year FROM cleaned"""


def cleaned_sessions(spark, sf_dir, raw=None):
    raw = raw if raw is not None else td.bronze_sessions(spark, sf_dir)
    return sessions.clean(raw, td.SEASON_YEAR, id_type="bigint", as_of=td.AS_OF)


def _sessions_out(df):
    return df.select("session_id", "session_name", "session_type", "location", "country_name",
                     F.unix_timestamp("start_time").alias("start_epoch"),
                     F.unix_timestamp("end_time").alias("end_epoch"), "year", "pipeline_year")


@register("sessions_clean", f"WITH {CLEANED_CTE} {CLEANED_OUT_SQL}")
def q_sessions_clean(spark, sf_dir):
    return _sessions_out(cleaned_sessions(spark, sf_dir))


@register("session_dedupe", f"WITH {CLEANED_CTE} {CLEANED_OUT_SQL}")
def q_session_dedupe(spark, sf_dir):
    raw = td.bronze_sessions(spark, sf_dir)
    return _sessions_out(cleaned_sessions(spark, sf_dir, raw.unionByName(raw)))


# The same sessions ingested again later under another name: the later one stays.
@register("session_dedupe_latest", f"""WITH {CLEANED_CTE}
{CLEANED_OUT_SQL.replace("session_name,", "'renamed ' || session_name AS session_name,", 1)}""")
def q_session_dedupe_latest(spark, sf_dir):
    first = td.bronze_sessions(spark, sf_dir).withColumn("ingested_at", F.lit("2025-01-01 10:00:00"))
    later = first.withColumns({"session_name": F.concat(F.lit("renamed"), F.col("session_name")),
                               "ingested_at": F.lit("2025-01-02 09:00:00")})
    return _sessions_out(cleaned_sessions(spark, sf_dir, later.unionByName(first)))


_BAD_SESSIONS = SESSIONS_RAW_CTE.replace("sessions_raw AS (", "sessions_given AS (") + """,
sessions_raw AS (
  SELECT * REPLACE (
    CASE WHEN o.r = 0 THEN NULL WHEN o.r = 1 THEN 'k' || CAST(session_key AS VARCHAR)
         WHEN o.r = 2 THEN CAST(session_key + 3000000000 AS VARCHAR) ELSE CAST(session_key AS VARCHAR) END AS session_key,
    CASE WHEN o.r = 3 THEN 'n/a' ELSE date_start END AS date_start)
  FROM sessions_given JOIN (SELECT o_orderkey AS pk, CAST(o_custkey % 9 AS INTEGER) AS r FROM orders) o ON o.pk = pos)"""


def bad_sessions(spark, sf_dir):
    """Sessions with missing, textual and too large keys and unreadable dates."""
    cust = td.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pk"), (F.col("o_custkey") % 9).alias("r"))
    s = td.bronze_sessions(spark, sf_dir)
    s = s.join(cust, s["pos"] == cust["pk"])
    key, r = F.col("session_key"), F.col("r")
    return s.withColumns({
        "session_key": F.when(r == 0, F.lit(None)).when(r == 1, F.concat(F.lit("k"), key.cast("string")))
        .when(r == 2, (key + 3000000000).cast("string")).otherwise(key.cast("string")),
        "date_start": F.when(r == 3, F.lit("n/a")).otherwise(F.col("date_start"))}).drop("pk", "r")


@register("sessions_bad_ids", f"""WITH {_BAD_SESSIONS}
SELECT CAST(session_key AS BIGINT) AS session_id, pos FROM sessions_raw
WHERE upper(trim(session_type)) IN ('RACE', 'QUALIFYING') AND TRY_CAST(session_key AS INTEGER) IS NOT NULL
  AND date_start <> 'n/a'""")
def q_sessions_bad_ids(spark, sf_dir):
    """What stays of them under int ids (as bigint), with the position they came from."""
    raw = bad_sessions(spark, sf_dir)
    got = sessions.clean(raw, td.SEASON_YEAR, as_of=td.AS_OF).select(F.col("session_id").cast("bigint"))
    return got.join(raw.select(F.col("session_key").try_cast("bigint").alias("session_id"), "pos"), "session_id")


@register("sessions_rejected", f"""WITH {_BAD_SESSIONS}
SELECT session_key, date_start, CASE WHEN session_key IS NULL THEN 'no session_key'
  WHEN TRY_CAST(session_key AS INTEGER) IS NULL THEN 'session_key is no int' ELSE 'date_start is no timestamp' END AS reason
FROM sessions_raw WHERE upper(trim(session_type)) IN ('RACE', 'QUALIFYING')
  AND (TRY_CAST(session_key AS INTEGER) IS NULL OR date_start = 'n/a')""")
def q_sessions_rejected(spark, sf_dir):
    return sessions.rejected(bad_sessions(spark, sf_dir))


# Drivers ingested again later with another name and team: the later row wins, whatever
# the alphabet says.
@register("driver_dim_latest", """SELECT trim(CAST(c_custkey AS VARCHAR)) AS driver_number,
  'A ' || trim(c_name) AS full_name, 'AAA' AS team_name, CAST(c_nationkey AS VARCHAR) AS country_code,
  'img/' || CAST(c_custkey AS VARCHAR) AS headshot_url FROM customer""")
def q_driver_dim_latest(spark, sf_dir):
    d = td.bronze_drivers(spark, sf_dir).withColumn("ingested_at", F.lit("2025-01-01 10:00:00"))
    later = d.withColumns({"full_name": F.concat(F.lit("A "), F.col("full_name")), "team_name": F.lit("AAA"),
                           "ingested_at": F.lit("2025-03-01 10:00:00")})
    return laps.driver_dim(later.unionByName(d))


_RESOLVE_SQL = """WITH {cte}
SELECT *, coalesce(circuit_short_name = '{c}', false) AS matched_circuit FROM sessions_raw
WHERE session_type = 'Race'
ORDER BY coalesce(circuit_short_name = '{c}', false) DESC, pos DESC LIMIT 1"""


@register("session_resolve", _RESOLVE_SQL.format(cte=SESSIONS_RAW_CTE, c="Baku"))
def q_session_resolve(spark, sf_dir):
    return sessions.resolve_target(td.bronze_sessions(spark, sf_dir), "Race", "Baku")


@register("session_resolve_fallback", _RESOLVE_SQL.format(cte=SESSIONS_RAW_CTE, c="Silverstone"))
def q_session_resolve_fallback(spark, sf_dir):
    return sessions.resolve_target(td.bronze_sessions(spark, sf_dir), "Race", "Silverstone")


# ---------------------------------------------------------------- silver laps
@register("retype_laps", """SELECT trim(CAST(user_id AS VARCHAR)) AS driver_number,
  event_id AS lap_number, CASE WHEN isnan(value) THEN NULL ELSE value END AS lap_duration,
  event_type = 'error' AS is_pit_out_lap FROM events""")
def q_retype_laps(spark, sf_dir):
    return laps.retype(td.bronze_laps(spark, sf_dir), td.LAP_TYPE, td.DURATION_TYPE)


@register("cast_failures", """SELECT CAST(count_if(event_id IS NOT NULL AND TRY_CAST(event_id AS BIGINT) IS NULL)
  AS BIGINT) AS lap_number_failed,
  CAST(count_if(value IS NOT NULL AND TRY_CAST(value AS DOUBLE) IS NULL) AS BIGINT) AS lap_duration_failed,
  CAST(count_if(event_type IS NOT NULL AND TRY_CAST(event_type = 'error' AS BOOLEAN) IS NULL) AS BIGINT)
  AS is_pit_out_lap_failed, count(*) AS rows FROM events""")
def q_cast_failures(spark, sf_dir):
    return laps.cast_failures(td.bronze_laps(spark, sf_dir), td.LAP_TYPE, td.DURATION_TYPE)


@register("driver_dim_dedupe", """SELECT trim(CAST(c_custkey AS VARCHAR)) AS driver_number,
  trim(c_name) AS full_name, trim(c_mktsegment) AS team_name,
  CAST(c_nationkey AS VARCHAR) AS country_code, 'img/' || CAST(c_custkey AS VARCHAR) AS headshot_url
  FROM customer""")
def q_driver_dim_dedupe(spark, sf_dir):
    d = td.bronze_drivers(spark, sf_dir)
    return laps.driver_dim(d.unionByName(d))


@register("enrich_inner", f"WITH {ENRICHED_CTE} SELECT * FROM enriched")
def q_enrich_inner(spark, sf_dir):
    return silver_laps(spark, sf_dir).drop("processed_at")


@register("enrich_hot_split", f"WITH {ENRICHED_CTE} SELECT * FROM enriched")
def q_enrich_hot_split(spark, sf_dir):
    """The large-dimension path forced on the test tables: drivers above 0.7 % of
    all laps are salted over the join partitions, the others keep salt 0."""
    return laps.enrich(td.bronze_laps(spark, sf_dir), td.bronze_drivers(spark, sf_dir), td.MIN_DURATION,
                       lap_type=td.LAP_TYPE, duration_type=td.DURATION_TYPE, as_of=td.AS_OF,
                       split_hot=True, hot_fraction=0.007).drop("processed_at")


# Drivers of some nations only, and laps without a driver: what the inner join drops.
PARTIAL_CTE = ENRICHED_CTE.replace("FROM customer)", "FROM customer WHERE c_nationkey > 4)") \
    .replace("trim(CAST(user_id AS VARCHAR)) AS driver_number, event_id",
             "trim(CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) END) AS driver_number, event_id")


def partial_inputs(spark, sf_dir):
    e = td.table(spark, sf_dir, "events")
    lp = e.select(
        F.when(F.col("event_type") != "view", F.col("user_id").cast("string")).alias("driver_number"),
        F.col("event_id").alias("lap_number"), F.col("value").alias("lap_duration"),
        (F.col("event_type") == "error").alias("is_pit_out_lap"))
    return lp, td.bronze_drivers(spark, sf_dir).filter(F.col("country_code").cast("int") > 4)


@register("unmatched_laps", f"""WITH {PARTIAL_CTE}
SELECT l.* FROM laps l WHERE NOT EXISTS (SELECT 1 FROM drivers d WHERE d.driver_number = l.driver_number)""")
def q_unmatched_laps(spark, sf_dir):
    return laps.unmatched(*partial_inputs(spark, sf_dir), lap_type=td.LAP_TYPE, duration_type=td.DURATION_TYPE)


@register("unmatched_hot_split", f"""WITH {PARTIAL_CTE}
SELECT l.* FROM laps l WHERE NOT EXISTS (SELECT 1 FROM drivers d WHERE d.driver_number = l.driver_number)""")
def q_unmatched_hot_split(spark, sf_dir):
    return laps.unmatched(*partial_inputs(spark, sf_dir), lap_type=td.LAP_TYPE, duration_type=td.DURATION_TYPE,
                          split_hot=True, hot_fraction=0.007)


@register("enrich_partial", f"WITH {PARTIAL_CTE} SELECT * FROM enriched")
def q_enrich_partial(spark, sf_dir):
    """Laps without a driver or of an unknown one drop out."""
    return laps.enrich(*partial_inputs(spark, sf_dir), td.MIN_DURATION, lap_type=td.LAP_TYPE,
                       duration_type=td.DURATION_TYPE, as_of=td.AS_OF).drop("processed_at")


@register("validity_flag", f"""WITH {ENRICHED_CTE}
SELECT driver_number, lap_number, lap_duration, is_pit_out_lap, is_valid_lap FROM enriched""")
def q_validity_flag(spark, sf_dir):
    return silver_laps(spark, sf_dir).select("driver_number", "lap_number", "lap_duration",
                                             "is_pit_out_lap", "is_valid_lap")


@register("validity_reason", f"""WITH {ENRICHED_CTE}
SELECT driver_number, lap_number, is_valid_lap,
       CASE WHEN is_pit_out_lap THEN 'pit_out_lap' WHEN lap_duration IS NULL THEN 'missing_duration'
            WHEN lap_duration < 1.0 THEN 'below_minimum' END AS invalid_reason
FROM enriched""")
def q_validity_reason(spark, sf_dir):
    return td.enriched_laps(spark, sf_dir, reason_col="invalid_reason") \
        .select("driver_number", "lap_number", "is_valid_lap", "invalid_reason")


@register("validity_summary", f"""WITH {ENRICHED_CTE}
SELECT CAST(count_if(is_valid_lap) AS BIGINT) AS valid_rows,
       CAST(count_if(NOT is_valid_lap) AS BIGINT) AS flagged_rows FROM enriched""")
def q_validity_summary(spark, sf_dir):
    return validity.validity_summary(silver_laps(spark, sf_dir))


_RET = """SELECT '{label}' AS label, t.total, k.kept, t.total - k.kept AS dropped,
  CASE WHEN t.total > 0 THEN round((t.total - k.kept) * 100.0 / t.total, 1) ELSE 0.0 END AS dropped_pct
  FROM (SELECT count(*) AS total FROM {before}) t, (SELECT count(*) AS kept FROM {after}) k"""


@register("retention_summary", f"WITH {ENRICHED_CTE}, {CLEANED_CTE.strip()} "
          + _RET.format(label="Sessions", before="sessions_raw", after="cleaned")
          + " UNION ALL " + _RET.format(label="Laps (total)", before="laps", after="enriched"))
def q_retention_summary(spark, sf_dir):
    raw_s = td.bronze_sessions(spark, sf_dir)
    raw_l = td.bronze_laps(spark, sf_dir)
    return validity.retention("Sessions", raw_s, cleaned_sessions(spark, sf_dir, raw_s)).unionByName(
        validity.retention("Laps (total)", raw_l, silver_laps(spark, sf_dir)))


# ---------------------------------------------------------------- bronze normalisation
_RAW_USER_SQL = """CASE CAST(user_id % 6 AS INTEGER) WHEN 0 THEN 'None' WHEN 1 THEN 'nan' WHEN 2 THEN 'NaN'
  WHEN 3 THEN ' None' ELSE coalesce(CAST(user_id AS VARCHAR), 'None') END"""


@register("null_sentinels", f"""SELECT event_id,
  CASE WHEN event_type IN ('None', 'nan', 'NaN') THEN NULL ELSE event_type END AS event_type,
  CASE WHEN props IN ('None', 'nan', 'NaN') THEN NULL ELSE props END AS props,
  CASE WHEN raw_user IN ('None', 'nan', 'NaN') THEN NULL ELSE raw_user END AS raw_user
  FROM (SELECT event_id, event_type, props, {_RAW_USER_SQL} AS raw_user FROM events)""")
def q_null_sentinels(spark, sf_dir):
    """Users as a stringified payload has them: missing ones as 'None', 'nan' or 'NaN'
    (these become NULL), some with a stray space (these stay)."""
    e = td.table(spark, sf_dir, "events")
    m = F.col("user_id") % 6
    raw_user = F.when(m == 0, "None").when(m == 1, "nan").when(m == 2, "NaN").when(m == 3, " None") \
        .otherwise(F.coalesce(F.col("user_id").cast("string"), F.lit("None")))
    return bronze.null_sentinels(e.select("event_id", "event_type", "props", raw_user.alias("raw_user")))


@register("nan_to_null", """SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE value END AS value,
  CASE WHEN event_type = 'view' THEN NULL ELSE CAST(value / 2 AS FLOAT) END AS half FROM events""")
def q_nan_to_null(spark, sf_dir):
    v = F.when(F.col("event_type") == "view", F.lit(float("nan"))).otherwise(F.col("value"))
    e = td.table(spark, sf_dir, "events").select("event_id", v.alias("value"), (v / 2).cast("float").alias("half"))
    return bronze.nan_to_null(e)


@register("void_to_string", """SELECT event_id, CAST(NULL AS VARCHAR) AS note FROM events""")
def q_void_to_string(spark, sf_dir):
    e = td.table(spark, sf_dir, "events").select("event_id", F.lit(None).alias("note"))
    return bronze.void_to_string(e)


@register("ingest_audit", """SELECT event_id, event_type, 'Baku' AS race_location,
  '2025-01-01 00:00:00' AS ingested_at FROM events""")
def q_ingest_audit(spark, sf_dir):
    e = td.table(spark, sf_dir, "events").select("event_id", "event_type")
    out = bronze.stamp(e, "Baku", as_of=td.AS_OF)
    return out.withColumn("ingested_at", F.col("ingested_at").cast("string"))


@register("stringify_nested", """SELECT event_id,
  to_json({'type': event_type, 'user': user_id})::VARCHAR AS who,
  to_json([user_id, event_id])::VARCHAR AS ids, props FROM events""")
def q_stringify_nested(spark, sf_dir):
    """Nested columns Spark derives from the events (a struct, an integer array)
    stringified as JSON; scalar columns are left as they are."""
    e = td.table(spark, sf_dir, "events").select(
        "event_id", F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user")).alias("who"),
        F.array("user_id", "event_id").alias("ids"), "props")
    return bronze.stringify_complex(e)


@register("stringify_complex", """SELECT vec_id, CAST(to_json(list_transform(embedding,
  lambda x: CAST(round(CAST(x AS DOUBLE) * 1000) AS INTEGER))) AS VARCHAR) AS embedding, label FROM embeddings""")
def q_stringify_complex(spark, sf_dir):
    """A vector column (in thousandths) as JSON text."""
    e = td.table(spark, sf_dir, "embeddings")
    return bronze.stringify_complex(e.withColumn("embedding", F.transform(
        "embedding", lambda x: F.round(x.cast("double") * 1000).cast("int"))))


# ---------------------------------------------------------------- reports
@register("kpi_fastest_driver", f"""WITH {LEADERBOARD_CTE}
SELECT full_name, fastest_lap_s FROM leaderboard ORDER BY fastest_lap_s ASC, full_name ASC LIMIT 1""")
def q_kpi_fastest_driver(spark, sf_dir):
    return reports.fastest_driver(leaderboard(spark, sf_dir))


@register("kpi_top_team", f"""WITH {STANDINGS_CTE}
SELECT team_name, avg_team_pace_s FROM standings ORDER BY avg_team_pace_s ASC, team_name ASC LIMIT 1""")
def q_kpi_top_team(spark, sf_dir):
    return reports.top_team(standings(spark, sf_dir))


@register("speed_consistency", f"""WITH {LEADERBOARD_CTE}
SELECT full_name, team_name, avg_lap_time_s, lap_consistency_s FROM leaderboard
WHERE avg_lap_time_s IS NOT NULL AND lap_consistency_s IS NOT NULL ORDER BY avg_lap_time_s""")
def q_speed_consistency(spark, sf_dir):
    return reports.speed_consistency(leaderboard(spark, sf_dir))


@register("pace_gap", f"""WITH {STANDINGS_CTE},
fastest AS (SELECT min(avg_team_pace_s) AS best_overall_pace FROM standings)
SELECT c.team_name, c.avg_team_pace_s, round(c.avg_team_pace_s - f.best_overall_pace, 3) AS pace_delta_s
FROM standings c CROSS JOIN fastest f ORDER BY pace_delta_s""")
def q_pace_gap(spark, sf_dir):
    return reports.pace_gap(standings(spark, sf_dir))


_TRACE = """WITH {cte}
SELECT lap_number, full_name, team_name, rolling_avg_5lap_s FROM progression
WHERE rolling_avg_5lap_s IS NOT NULL {extra} ORDER BY full_name, lap_number"""


@register("race_trace", _TRACE.format(cte=PROGRESSION_CTE, extra=""))
def q_race_trace(spark, sf_dir):
    return reports.race_trace(progression(spark, sf_dir))


@register("race_trace_filtered", _TRACE.format(cte=PROGRESSION_CTE, extra="AND team_name = 'BUILDING'"))
def q_race_trace_filtered(spark, sf_dir):
    return reports.race_trace(progression(spark, sf_dir), team_name="BUILDING")


@register("facet_counts_drivers", f"""WITH {PROGRESSION_CTE}
SELECT full_name, CAST(count_if(team_name = 'BUILDING') AS BIGINT) AS row_count FROM progression GROUP BY full_name""")
def q_facet_counts_drivers(spark, sf_dir):
    return reports.facet_counts(progression(spark, sf_dir), "full_name",
                                {"team_name": "BUILDING", "full_name": None})


@register("facet_counts_teams", f"""WITH {PROGRESSION_CTE}
SELECT team_name, CAST(count_if(full_name = 'Customer#000000001') AS BIGINT) AS row_count
FROM progression GROUP BY team_name""")
def q_facet_counts_teams(spark, sf_dir):
    return reports.facet_counts(progression(spark, sf_dir), "team_name",
                                {"full_name": "Customer#000000001", "team_name": "AUTOMOBILE"})


@register("facet_tables", f"""WITH {PROGRESSION_CTE}
SELECT 'full_name' AS facet, full_name AS value, CAST(count_if(team_name = 'BUILDING') AS BIGINT) AS row_count
FROM progression GROUP BY full_name
UNION ALL SELECT 'team_name', team_name, CAST(count_if(full_name = 'Customer#000000001') AS BIGINT)
FROM progression GROUP BY team_name""")
def q_facet_tables(spark, sf_dir):
    """Both facet tables from one aggregate; each is filtered by the other's selection."""
    return reports.facet_tables(progression(spark, sf_dir), ["full_name", "team_name"],
                                {"team_name": "BUILDING", "full_name": "Customer#000000001"})


@register("widget_fastest_by_driver", f"""WITH {LEADERBOARD_CTE}
SELECT full_name, sum(fastest_lap_s) AS sum_fastest_lap_s FROM leaderboard GROUP BY full_name""")
def q_widget_fastest_by_driver(spark, sf_dir):
    return reports.widget_sum(leaderboard(spark, sf_dir), "full_name", "fastest_lap_s")


@register("widget_pace_by_team", f"""WITH {STANDINGS_CTE}
SELECT team_name, sum(avg_team_pace_s) AS sum_avg_team_pace_s FROM standings GROUP BY team_name""")
def q_widget_pace_by_team(spark, sf_dir):
    return reports.widget_sum(standings(spark, sf_dir), "team_name", "avg_team_pace_s")


@register("widget_trace_by_driver_lap", f"""WITH {PROGRESSION_CTE}
SELECT full_name, lap_number, sum(rolling_avg_5lap_s) AS sum_rolling_avg_5lap_s FROM progression
GROUP BY full_name, lap_number""")
def q_widget_trace(spark, sf_dir):
    return reports.widget_sum(progression(spark, sf_dir), ["full_name", "lap_number"], "rolling_avg_5lap_s")


@register("preview_20", f"""WITH {PROGRESSION_CTE}
SELECT * EXCLUDE (generated_at) FROM progression ORDER BY full_name, lap_number LIMIT 20""")
def q_preview_20(spark, sf_dir):
    return reports.preview(progression(spark, sf_dir).drop("generated_at"), 20)


# ---------------------------------------------------------------- operators on other tables
@register("pace_median", """SELECT l_suppkey, round(quantile_disc(l_extendedprice, 0.5), 3) AS median_price,
  CAST(count(*) AS BIGINT) AS n_lines FROM lineitem GROUP BY l_suppkey""")
def q_pace_median(spark, sf_dir):
    li = td.table(spark, sf_dir, "lineitem")
    return li.groupBy("l_suppkey").agg(
        F.round(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY l_extendedprice)"), 3).alias("median_price"),
        F.count(F.lit(1)).alias("n_lines"))


@register("pace_median_distributed", """SELECT l_suppkey, round(quantile_disc(l_extendedprice, 0.5), 3)
  AS median_price FROM lineitem GROUP BY l_suppkey""")
def q_pace_median_distributed(spark, sf_dir):
    li = td.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice")
    med = metrics.lower_median(li, ["l_suppkey"], "l_extendedprice", "m")
    return med.select("l_suppkey", F.round("m", 3).alias("median_price"))


SUPPLIER_LB_SQL = f"""WITH src AS (
  SELECT CAST(l.l_suppkey AS VARCHAR) AS driver_number, s.s_name AS full_name,
         CAST(s.s_nationkey AS VARCHAR) AS team_name, l.l_linenumber AS lap_number,
         l.l_extendedprice AS lap_duration, l.l_returnflag <> 'R' AS is_valid_lap
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey),
agg AS (
  SELECT driver_number, full_name, team_name, round(min(lap_duration), 3) AS fastest_lap_s,
         {exact_avg_sql('lap_duration')} AS avg_lap_time_s,
         round(quantile_disc(lap_duration, 0.5), 3) AS median_lap_time_s,
         round(coalesce(stddev_samp(lap_duration), 0), 3) AS lap_consistency_s,
         CAST(count(lap_number) AS INTEGER) AS total_valid_laps
  FROM src WHERE is_valid_lap GROUP BY driver_number, full_name, team_name)
SELECT CAST(dense_rank() OVER (ORDER BY avg_lap_time_s ASC NULLS FIRST,
                               lap_consistency_s ASC NULLS FIRST) AS INTEGER) AS pace_rank,
       full_name, team_name, driver_number, fastest_lap_s, avg_lap_time_s, median_lap_time_s,
       lap_consistency_s, total_valid_laps, 2025 AS season_year FROM agg"""


@register("supplier_leaderboard", SUPPLIER_LB_SQL)
def q_supplier_leaderboard(spark, sf_dir):
    """The leaderboard over another table of timed events: suppliers ranked by the
    prices of their line items (returned lines flagged invalid); names are parameters."""
    li = td.table(spark, sf_dir, "lineitem")
    su = td.table(spark, sf_dir, "supplier")
    ev = li.join(su, li.l_suppkey == su.s_suppkey).select(
        F.col("l_suppkey").cast("string").alias("supplier"), "s_name",
        F.col("s_nationkey").cast("string").alias("nation"), "l_linenumber", "l_extendedprice",
        (F.col("l_returnflag") != "R").alias("kept"))
    cols = marts.LapColumns(driver="supplier", name="s_name", team="nation", lap="l_linenumber",
                            duration="l_extendedprice", valid="kept")
    return marts.driver_leaderboard(ev, td.SEASON_YEAR, avg_scale=2, as_of=td.AS_OF, cols=cols) \
        .drop("generated_at")


@register("pace_stddev", """SELECT l_suppkey, round(coalesce(stddev_samp(l_quantity), 0), 3) AS sd_quantity,
  round(min(l_quantity), 3) AS min_quantity FROM lineitem GROUP BY l_suppkey""")
def q_pace_stddev(spark, sf_dir):
    li = td.table(spark, sf_dir, "lineitem")
    cols = metrics.pace_columns("l_quantity", "l_quantity", with_median=False,
                                names={"stddev": "sd_quantity", "min": "min_quantity"})
    return li.groupBy("l_suppkey").agg(*cols).select("l_suppkey", "sd_quantity", "min_quantity")


_ORD_W = " OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"


@register("rolling_mean_5", f"""SELECT o_custkey, o_orderkey, o_totalprice,
  {exact_avg_sql('o_totalprice', _ORD_W)} AS rolling_price FROM orders""")
def q_rolling_mean_5(spark, sf_dir):
    o = td.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return metrics.rolling_mean(o, "o_totalprice", ["o_custkey"], ["o_orderkey"], rows=5,
                                out="rolling_price", avg_scale=2, distributed=True)


_RANK_SQL = """SELECT c_custkey, c_nationkey, c_mktsegment,
  CAST(dense_rank() OVER (ORDER BY c_nationkey ASC NULLS FIRST, c_mktsegment DESC NULLS LAST) AS INTEGER) AS rnk
  FROM customer"""


def _rank_customers(spark, sf_dir, distributed):
    c = td.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return metrics.dense_rank(c, [("c_nationkey", "asc"), ("c_mktsegment", "desc")], "rnk",
                              distributed=distributed)


@register("dense_rank_two_key", _RANK_SQL)
def q_dense_rank_two_key(spark, sf_dir):
    return _rank_customers(spark, sf_dir, distributed=False)


@register("dense_rank_distributed", _RANK_SQL)
def q_dense_rank_distributed(spark, sf_dir):
    return _rank_customers(spark, sf_dir, distributed=True)


@register("rolling_mean_distributed_vs_window", f"""SELECT o_custkey, o_orderkey,
  {exact_avg_sql('o_totalprice', _ORD_W)} AS rolling_price FROM orders""")
def q_rolling_plain(spark, sf_dir):
    o = td.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return metrics.rolling_mean(o, "o_totalprice", ["o_custkey"], ["o_orderkey"], rows=5,
                                out="rolling_price", avg_scale=2, distributed=False) \
        .drop("o_totalprice")


@register("ordered_dedupe_latest_order", """SELECT o_custkey, o_orderkey AS o_orderkey_pick FROM (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey
         ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def q_ordered_dedupe(spark, sf_dir):
    o = td.table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    d = conform.dedupe(o, "o_custkey", order=["o_orderdate", "o_orderkey"], keep="max")
    return d.select("o_custkey", F.col("o_orderkey").alias("o_orderkey_pick"))


# ---------------------------------------------------------------- data-quality results
def checks_sql(table_label: str, source: str, check_list) -> str:
    """DuckDB text of the check results for ``source`` (a CTE name)."""
    parts = []
    for c in check_list:
        pred = c.filter or "true"
        if c.metric == "row_count":
            m = f"(SELECT count(*) FROM {source} WHERE {pred})"
        elif c.metric == "missing_count":
            m = f"(SELECT count(*) FROM {source} WHERE ({pred}) AND {c.column} IS NULL)"
        elif c.metric == "duplicate_count":
            m = (f"(SELECT count(*) FROM (SELECT {c.column} FROM {source} WHERE ({pred}) AND "
                 f"{c.column} IS NOT NULL GROUP BY {c.column} HAVING count(*) > 1))")
        elif c.metric == "invalid_count":
            bad = []
            if c.valid_values is not None:
                vals = ", ".join(f"'{v}'" for v in c.valid_values)
                bad.append(f"{c.column} NOT IN ({vals})")
            if c.valid_min is not None:
                bad.append(f"{c.column} < {c.valid_min}")
            if c.valid_max is not None:
                bad.append(f"{c.column} > {c.valid_max}")
            m = (f"(SELECT count(*) FROM {source} WHERE ({pred}) AND {c.column} IS NOT NULL "
                 f"AND ({' OR '.join(bad) or 'false'}))")
        else:
            m = f"(SELECT {c.metric}({c.column}) FROM {source} WHERE {pred})"
        col = f"'{c.column}'" if c.column else "CAST(NULL AS VARCHAR)"
        flt = "'" + c.filter.replace("'", "''") + "'" if c.filter else "CAST(NULL AS VARCHAR)"
        parts.append(
            f"SELECT '{table_label}' AS \"table\", '{c.name}' AS \"check\", '{c.metric}' AS metric, "
            f"{col} AS \"column\", {flt} AS \"filter\", CAST({m} AS DOUBLE) AS value, "
            f"'{c.op}' AS op, CAST({float(c.threshold)} AS DOUBLE) AS threshold")
    body = "\nUNION ALL\n".join(parts)
    cmp = " ".join(f"WHEN op = '{o}' AND value {'<>' if o == '!=' else o} threshold THEN 'pass'"
                   for o in ("=", "!=", ">", ">=", "<", "<="))
    return (f"SELECT \"table\", \"check\", metric, \"column\", \"filter\", value, op, threshold, "
            f"CASE WHEN value IS NULL THEN 'error' {cmp} ELSE 'fail' END AS outcome FROM (\n{body})")


def _dq(name, label, cte, source, build):
    check_list = presets.PRESET[label]

    def q(spark, sf_dir):
        return checks.run_checks(build(spark, sf_dir), check_list, label)
    register(name, f"WITH {cte} " + checks_sql(label, source, check_list))(q)


_dq("dq_results_sessions", "silver.cleaned_sessions", CLEANED_CTE, "cleaned",
    lambda spark, d: cleaned_sessions(spark, d))
_dq("dq_results_laps", "silver.enriched_laps",
    ENRICHED_CTE + ", enriched_a AS (SELECT *, TIMESTAMP '2025-01-01 00:00:00' AS processed_at FROM enriched)",
    "enriched_a", lambda spark, d: silver_laps(spark, d))
_dq("dq_results_leaderboard", "gold.driver_performance_metrics", LEADERBOARD_CTE, "leaderboard",
    lambda spark, d: leaderboard(spark, d))
_dq("dq_results_standings", "gold.constructor_standings", STANDINGS_CTE, "standings",
    lambda spark, d: standings(spark, d))
_dq("dq_results_progression", "gold.lap_progression", PROGRESSION_CTE, "progression",
    lambda spark, d: progression(spark, d))

# The check kinds on a plain table (column names are parameters): lineitem.
LINEITEM_CHECKS = [
    checks.Check("LI1", "row_count", ">", 0),
    checks.Check("LI2", "missing_count", "=", 0, "l_shipdate"),
    checks.Check("LI3", "duplicate_count", "=", 0, "l_orderkey"),
    checks.Check("LI4", "invalid_count", "=", 0, "l_returnflag", valid_values=("A", "N")),
    checks.Check("LI5", "invalid_count", "=", 0, "l_discount", valid_min=0.0, valid_max=0.08),
    checks.Check("LI6", "min", ">=", 1, "l_quantity", filter="l_returnflag = 'R'"),
    checks.Check("LI7", "max", "<=", 50, "l_quantity", filter="l_returnflag = 'R'"),
    checks.Check("LI8", "missing_count", "=", 0, "l_tax", filter="l_linestatus = 'O'"),
    checks.Check("LI9", "min", ">", 0, "l_extendedprice", filter="l_quantity > 1000"),
]


@register("dq_lineitem", "WITH li AS (SELECT * FROM lineitem) " + checks_sql("lineitem", "li", LINEITEM_CHECKS))
def q_dq_lineitem(spark, sf_dir):
    return checks.run_checks(td.table(spark, sf_dir, "lineitem"), LINEITEM_CHECKS, "lineitem")


# ---------------------------------------------------------------- sources and sinks
import base64  # noqa: E402
import json  # noqa: E402
import uuid  # noqa: E402
from dataclasses import replace  # noqa: E402
from functools import reduce  # noqa: E402

from pyspark.sql.types import StructType as _ST  # noqa: E402

from lapworks.config import DEFAULT  # noqa: E402
from lapworks.plans import pipeline  # noqa: E402
from lapworks.session import remove_folder, shared_dir  # noqa: E402
from lapworks.sources import manifest as manifest_src  # noqa: E402
from lapworks.sources import long_lists, payloads, rest  # noqa: E402
from lapworks.streaming import landing  # noqa: E402

PAGE_ROWS = 2500  # records per landed payload page (bounds every file and task)
EVENT_FIELDS = ["event_id", "user_id", "event_type", "value", "props"]
EVENTS_SQL = "SELECT event_id, user_id, event_type, value, props FROM events"


_OWNED: dict[str, list[str]] = {"folders": [], "schemas": []}


def _scratch(spark, kind: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/lapworks/{kind}/{uuid.uuid4().hex}"
    _OWNED["folders"].append(path)
    return path


def cleanup(spark) -> None:
    """Drops the schemas and folders that this process's queries have made; to be called
    when their results are no longer read."""
    for name in _OWNED["schemas"]:
        spark.sql(f"DROP SCHEMA IF EXISTS spark_catalog.{name} CASCADE")
    for path in _OWNED["folders"]:
        remove_folder(spark, path)
    for names in _OWNED.values():
        names.clear()


def land_events(spark, sf_dir) -> str:
    """Events as paginated JSON-list payload files in the shared folder."""
    path = _scratch(spark, "landing")
    e = td.table(spark, sf_dir, "events").select(
        *EVENT_FIELDS, F.floor(F.col("event_id") / PAGE_ROWS).alias("page"))
    payloads.land_pages(e, path, "page", order=["event_id"])
    return path


def land_damaged(spark, sf_dir) -> str:
    """The same pages; of each fourth one the last entry is cut off, each fourth holds one
    entry that is no object, each fourth is an error object."""
    path = _scratch(spark, "landing")
    _damaged_pages(spark, sf_dir).select("value").write.text(path)
    return path


def _damaged_pages(spark, sf_dir):
    pages = payloads.read_landed(spark, land_events(spark, sf_dir)) \
        .withColumn("_page", F.regexp_extract("source", r"_page=(\d+)", 1).cast("long"))
    kind = F.pmod("_page", F.lit(4))
    body = F.regexp_replace("payload", r"\n$", "")
    text = (F.when(kind == 1, F.left(body, F.length(body) - 2))
            .when(kind == 2, F.concat(F.left(body, F.length(body) - 1), F.lit(",7]")))
            .when(kind == 3, F.lit('{"detail": "AVOID_ZONE"}')).otherwise(body))
    return pages.select(text.alias("value"), "_page")


def _typed_events(df):
    return df.select(F.col("event_id").cast("bigint"), F.col("user_id").cast("bigint"),
                     F.col("event_type").cast("string"), F.col("value").cast("double"),
                     F.col("props").cast("string"))


@register("payload_classify", f"""SELECT 'list' AS shape, count(DISTINCT floor(event_id / {PAGE_ROWS}))
  AS payloads FROM events""")
def q_payload_classify(spark, sf_dir):
    got = payloads.classify(payloads.read_landed(spark, land_events(spark, sf_dir)))
    return got.groupBy("shape").agg(F.count(F.lit(1)).alias("payloads"))


@register("payload_explode", EVENTS_SQL)
def q_payload_explode(spark, sf_dir):
    return _typed_events(payloads.read_payloads(spark, land_events(spark, sf_dir)))


_DAMAGED = f"CAST(floor(event_id / {PAGE_ROWS}) % 4 AS INTEGER)"


@register("payload_good_records", f"{EVENTS_SQL} WHERE {_DAMAGED} IN (0, 2)")
def q_payload_good_records(spark, sf_dir):
    return _typed_events(payloads.to_columns(payloads.explode_records(_damaged(spark, sf_dir))))


@register("payload_rejected", f"""SELECT CASE k WHEN 1 THEN 'payload is unparsable' WHEN 2 THEN 'record is no object'
  ELSE 'payload is object' END AS reason, CASE k WHEN 2 THEN n ELSE -1 END AS pos,
  CASE k WHEN 2 THEN '7' WHEN 3 THEN '{{"detail": "AVOID_ZONE"}}' END AS content
FROM (SELECT {_DAMAGED} AS k, floor(event_id / {PAGE_ROWS}) AS page, CAST(count(*) AS INTEGER) AS n FROM events
      GROUP BY ALL) WHERE k > 0""")
def q_payload_rejected(spark, sf_dir):
    got = payloads.rejected(_damaged(spark, sf_dir))
    return got.select("reason", F.coalesce("pos", F.lit(-1)).alias("pos"), F.when(F.col("reason") != "payload is unparsable", F.col("content")).alias("content"))


@register("payload_long_lists", f"{EVENTS_SQL} WHERE {_DAMAGED} IN (0, 2)")
def q_payload_long_lists(spark, sf_dir):
    """The same records when files are read in byte ranges instead of one row each."""
    path = _scratch(spark, "landing")
    _damaged_pages(spark, sf_dir).write.partitionBy("_page").text(path)
    recs, _ = long_lists.read_records(spark, path)
    return payloads.to_columns(recs, _ST.fromDDL(_EVENT_SCHEMA)).select(*EVENT_FIELDS)


def _damaged(spark, sf_dir):
    # one payload a line: these pages hold no line breaks
    return spark.read.text(land_damaged(spark, sf_dir)).select(F.lit("landed").alias("source"),
                                                               F.col("value").alias("payload"))


ASKED_ROWS = 100          # records of a requested page


class Answers:
    """A transport without a network.  The URL says how its server answers, attempt by
    attempt (``answers=503,timeout,ok``; the last goes on), and holds the body.  The attempts
    at a URL follow one another, so only the URL that was asked last is kept."""

    def __init__(self):
        self.url, self.attempts = None, 0

    def __call__(self, url: str, timeout_s: float):
        n = self.attempts = self.attempts + 1 if url == self.url else 1
        self.url = url
        options = dict(x.split("=", 1) for x in url.partition("?")[2].split("&"))
        script = options["answers"].split(",")
        answer = script[min(n, len(script)) - 1]
        if answer == "timeout":
            raise rest.FetchTimeout(f"no answer in {timeout_s} s")
        if answer == "reset":
            raise rest.FetchError("connection reset")
        body = base64.b64decode(options.get("body", "W10=")).decode()
        if answer == "cut":
            body = body[:-1]
        return rest.Response(200, body) if answer in ("ok", "cut") else rest.Response(int(answer), None)


def _pages(spark, sf_dir):
    """Pages of the events as ``(page, body)``, the body a JSON list in base64 (URL-safe
    but for its padding, which a query string allows)."""
    e = td.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    return e.groupBy(F.floor(F.col("event_id") / ASKED_ROWS).cast("long").alias("page")).agg(
        F.regexp_replace(F.base64(F.to_json(F.collect_list(F.struct(*EVENT_FIELDS)))), r"\s", "").alias("body"))


def _url(answers, body=None):
    """``answers``: a column with the script; ``body`` in base64 (none: an empty list)."""
    return F.concat(F.lit("https://host/events?page="), F.col("page"), F.lit("&answers="), answers,
                    *([F.lit("&body="), body] if body is not None else []))


_EVENT_SCHEMA = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


@register("rest_source", EVENTS_SQL)
def q_rest_source(spark, sf_dir):
    """All events from list endpoints; three of four pages answer only after a failure."""
    script = F.element_at(F.array(*[F.lit(x) for x in ("ok", "503,ok", "429,timeout,ok", "cut,ok")]),
                          (F.col("page") % 4 + 1).cast("int"))
    urls = _pages(spark, sf_dir).select(_url(script, F.col("body")).alias("url"))
    return rest.fetch_records(spark, urls, transport=Answers(), schema=_ST.fromDDL(_EVENT_SCHEMA), delay_s=0.0) \
        .select(*EVENT_FIELDS)


# Answers by page number modulo their count, and what the policy makes of them:
# outcome, last status (0: none), attempts.
SCRIPTS = [
    ("ok", "ok", 200, 1), ("429,ok", "ok", 200, 2), ("503,503,ok", "ok", 200, 3), ("timeout,ok", "ok", 200, 2),
    ("cut,cut,cut", "exhausted", 200, 3), ("404", "client_error", 404, 1), ("500,502,504,ok", "exhausted", 504, 3),
    ("reset,403", "client_error", 403, 2), ("timeout,timeout,timeout", "exhausted", 0, 3), ("429,reset,ok", "ok", 200, 3),
    ("401", "client_error", 401, 1), ("503,cut,ok", "ok", 200, 3), ("418,ok", "ok", 200, 2),
]
_PAGES_SQL = f"SELECT CAST(floor(event_id / {ASKED_ROWS}) AS BIGINT) AS page, count(*) AS n FROM events GROUP BY ALL"


def _case(n: int) -> str:
    return " ".join(f"WHEN {i} THEN {s[n]!r}" for i, s in enumerate(SCRIPTS))


def _scripted(spark, sf_dir):
    scripts = F.array(*[F.lit(s[0]) for s in SCRIPTS])
    return _pages(spark, sf_dir).select(
        "page", _url(F.element_at(scripts, (F.col("page") % len(SCRIPTS) + 1).cast("int")), F.col("body")).alias("url"))


@register("rest_retry_outcomes", f"""SELECT page, CASE page % {len(SCRIPTS)} {_case(1)} END AS outcome,
  CAST(CASE page % {len(SCRIPTS)} {_case(2)} END AS INTEGER) AS status,
  CAST(CASE page % {len(SCRIPTS)} {_case(3)} END AS INTEGER) AS attempts,
  CASE WHEN CASE page % {len(SCRIPTS)} {_case(1)} END = 'ok' THEN n ELSE 0 END AS records FROM ({_PAGES_SQL})""")
def q_rest_retry_outcomes(spark, sf_dir):
    """Every answer a server can give, in order, for the pages of the events: 429, 5xx, other
    statuses, timeouts, resets and cut bodies are asked again, 400/401/403/404 are not."""
    asked = _scripted(spark, sf_dir)
    got = rest.fetch_manifest(asked, transport=Answers(), delay_s=0.0)
    records = F.coalesce(F.size(F.from_json("payload", "array<struct<event_id:long>>")), F.lit(0))
    return got.select(F.regexp_extract("url", r"page=(\d+)", 1).cast("long").alias("page"), "outcome",
                      F.coalesce("status", F.lit(0)).alias("status"), "attempts", records.cast("long").alias("records"))


@register("rest_fetch_ledger", f"""SELECT page, 'ok' AS outcome, 200 AS status,
  CASE WHEN page % 3 = 1 THEN 4 ELSE 1 END AS attempts, CASE WHEN page % 3 = 1 THEN 2 ELSE 1 END AS runs,
  n AS records FROM ({_PAGES_SQL})""")
def q_rest_fetch_ledger(spark, sf_dir):
    """A run in which a third of the URLs fails and the run after it: each URL that was good
    is asked once, the others again; the attempts of both runs are kept.  (In the first run
    a server that is down is a transport of its own: the URLs are the same.)"""
    ledger = _scratch(spark, "ledger")
    urls = _pages(spark, sf_dir).select(_url(F.lit("ok"), F.col("body")).alias("url"))
    rest.fetch_missing(urls, ledger, transport=_down, delay_s=0.0)
    got = rest.fetch_missing(urls, ledger, transport=Answers(), delay_s=0.0)
    return got.select(F.regexp_extract("url", r"page=(\d+)", 1).cast("long").alias("page"), "outcome", "status", "attempts",
                      "runs", F.size(F.from_json("payload", "array<struct<event_id:long>>")).cast("long").alias("records"))


def _down(url: str, timeout_s: float):
    """As ``Answers``, but every third page is not to be had."""
    page = int(url.partition("page=")[2].partition("&")[0])
    return rest.Response(503, None) if page % 3 == 1 else Answers()(url, timeout_s)


@register("rest_fetch_status", f"""SELECT 'ok' AS outcome, 1 AS attempts, 200 AS status, count(*) AS urls FROM ({_PAGES_SQL})
UNION ALL SELECT 'client_error', 1, 404, count(*) FROM ({_PAGES_SQL})
UNION ALL SELECT 'bad_format', 1, 200, count(*) FROM ({_PAGES_SQL})""")
def q_rest_fetch_status(spark, sf_dir):
    """For each page of the events one that is there, one missing and one error object."""
    pages = _pages(spark, sf_dir)
    error = F.base64(F.lit('{"detail": "error"}').cast("binary"))
    urls = [pages.select(_url(F.lit("ok"), F.col("body")).alias("url")), pages.select(_url(F.lit("404")).alias("url")),
            pages.select(_url(F.lit("ok"), error).alias("url"))]
    fetched = rest.fetch_manifest(reduce(DataFrame.unionByName, urls), transport=Answers(), delay_s=0.0)
    return fetched.groupBy("outcome", "attempts", "status").agg(F.count(F.lit(1)).alias("urls"))


def served(url: str, timeout_s: float):
    """A transport without a network: the URL names a table file, the parameters filter it,
    the rows come back as a JSON list."""
    import re
    from urllib.parse import unquote

    import pyarrow.dataset as ds
    path, _, query = url.removeprefix("https://host").partition("?")
    data = ds.dataset(path)
    where = None
    for part in filter(None, query.split("&")):
        name, op, text = re.fullmatch(r"(\w+)(>=|<=|=|>|<)(.*)", part).groups()
        value = data.schema.field(name).type.to_pandas_dtype()(unquote(text))
        c = ds.field(name)
        term = {"=": c == value, ">": c > value, ">=": c >= value, "<": c < value, "<=": c <= value}[op]
        where = term if where is None else where & term
    # one thread and little ahead: the file may have far more rows than the answer
    found = data.scanner(filter=where, batch_readahead=1, fragment_readahead=1, use_threads=False,
                         fragment_scan_options=ds.ParquetFragmentScanOptions(pre_buffer=False, use_buffered_stream=True))
    texts = [json.dumps(b.to_pylist(), default=str)[1:-1] for b in found.to_batches() if b.num_rows]
    return rest.Response(200, f"[{', '.join(texts)}]")


REQUEST_ROWS = 200_000    # rows between two bounds, before the filters


def endpoint_events(spark, sf_dir):
    """The events behind a list endpoint that can filter, spread over ranges of ids with
    equally many rows."""
    from lapworks.sources import endpoint
    endpoint.register(spark)
    cuts = endpoint.even_cuts(td.table(spark, sf_dir, "events"), "event_id", REQUEST_ROWS, least=4)
    return spark.read.format("rest_list").schema(_EVENT_SCHEMA).options(
        url=f"https://host{sf_dir}/events.parquet", transport="lapworks.plans.suite:served", retryDelay="0",
        filters='{"event_type": "=", "value": "> >= < <=", "event_id": "= > >= < <="}',
        partitionColumn="event_id", partitionCuts=json.dumps(cuts)).load()


@register("rest_pushdown", """SELECT event_id, user_id, event_type, value FROM events
WHERE event_type IN ('purchase', 'view') AND value > 50 AND event_id >= 17 AND user_id % 2 = 0""")
def q_rest_pushdown(spark, sf_dir):
    """DataFrame filters as URL parameters; the one the endpoint does not know stays with Spark."""
    return endpoint_events(spark, sf_dir) \
        .filter("event_type IN ('purchase', 'view') AND value > 50 AND event_id >= 17 AND user_id % 2 = 0") \
        .select("event_id", "user_id", "event_type", "value")


def _spread(url: str, timeout_s: float):
    """A transport without a network: the page is in the URL; odd pages are not there."""
    page = int(url.rsplit("=", 1)[1])
    return rest.Response(404, None) if page % 2 else rest.Response(200, f'[{{"page": {page}, "twice": {2 * page}}}]')


@register("rest_fetch_manifest", f"""SELECT 'https://host/p?page=' || CAST(p AS VARCHAR) AS url,
  CASE WHEN p % 2 = 1 THEN 404 ELSE 200 END AS status, 1 AS attempts,
  CASE WHEN p % 2 = 1 THEN 'client_error' ELSE 'ok' END AS outcome
FROM (SELECT DISTINCT CAST(floor(event_id / {PAGE_ROWS}) AS BIGINT) AS p FROM events)""")
def q_rest_fetch_manifest(spark, sf_dir):
    """The retry policy run in the tasks, over a manifest derived from the events."""
    pages = td.table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / PAGE_ROWS).cast("string").alias("p"))
    urls = pages.distinct().select(F.concat(F.lit("https://host/p?page="), F.col("p")).alias("url"))
    return rest.fetch_manifest(urls, transport=_spread, delay_s=0.0).drop("payload")


@register("endpoint_manifest", f"""WITH {CLEANED_CTE}
SELECT e.dataset, c.session_id AS key,
       '{DEFAULT.base_url}/' || e.pre || CAST(c.session_id AS VARCHAR) || e.post AS url
FROM cleaned c CROSS JOIN (VALUES ('drivers', 'drivers?session_key=', ''),
                                  ('laps', 'laps?session_key=', ''),
                                  ('telemetry', 'car_data?session_key=', '&speed>250')) e(dataset, pre, post)""")
def q_endpoint_manifest(spark, sf_dir):
    keys = cleaned_sessions(spark, sf_dir).select(F.col("session_id").alias("session_key"))
    return manifest_src.endpoint_manifest(keys, DEFAULT.base_url)


@register("season_urls", f"""SELECT DISTINCT year, '{DEFAULT.base_url}/sessions?year=' || CAST(year AS VARCHAR)
  || '&session_type=Race' AS url FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)""")
def q_season_urls(spark, sf_dir):
    years = td.bronze_sessions(spark, sf_dir).select("year").distinct()
    return years.select("year", manifest_src.season_urls(DEFAULT.base_url, F.col("year"), "Race").alias("url"))


@register("table_overwrite_twice", f"WITH {LEADERBOARD_CTE} SELECT * EXCLUDE (generated_at) FROM leaderboard")
def q_table_overwrite_twice(spark, sf_dir):
    """Written, overwritten by half of itself, then by a plan that reads what it replaces."""
    from lapworks.sources.tables import read_table, write_table
    name = f"spark_catalog.{_schema(spark)}.driver_performance_metrics"
    lb = leaderboard(spark, sf_dir)
    write_table(lb.filter("pace_rank % 2 = 0"), name)
    write_table(lb.filter("pace_rank % 2 = 1").unionByName(spark.read.table(name)), name)
    return read_table(spark, name, on_empty="raise").drop("generated_at")


def _schema(spark) -> str:
    db = f"lw_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS spark_catalog.{db} LOCATION '{_scratch(spark, 'warehouse')}'")
    _OWNED["schemas"].append(db)
    return db


@register("season_partitions", """SELECT year AS season_year, count(*) AS sessions FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders) GROUP BY year""")
def q_season_partitions(spark, sf_dir):
    """A table by season: each season written by itself, one of them twice; others stay."""
    from lapworks.sources.tables import read_table, write_table
    name = f"spark_catalog.{_schema(spark)}.sessions"
    s = td.bronze_sessions(spark, sf_dir).select("session_key", F.col("year").alias("season_year"))
    first = s.agg(F.min("season_year")).first()[0]
    write_table(s.filter(F.col("season_year") == first).limit(1), name, partition_by="season_year")
    write_table(s.filter(F.col("season_year") != first), name, partition_by="season_year", dynamic=True)
    write_table(s.filter(F.col("season_year") == first), name, partition_by="season_year", dynamic=True)
    return read_table(spark, name).groupBy("season_year").agg(F.count(F.lit(1)).alias("sessions"))


@register("schema_drift", """SELECT 'session_key' AS missing, 'orders' AS table, count(*) AS rows FROM orders""")
def q_schema_drift(spark, sf_dir):
    """The guard names the column that is not there."""
    from lapworks.operators.schema import assert_columns
    s = td.bronze_sessions(spark, sf_dir)
    try:
        assert_columns(s.drop("session_key"), sessions.SESSIONS_REQUIRED, "orders")
        missing = None
    except ValueError as ex:
        missing = "session_key" if "['session_key'] not found" in str(ex) else str(ex)
    return s.agg(F.lit(missing).alias("missing"), F.lit("orders").alias("table"), F.count(F.lit(1)).alias("rows"))


@register("table_roundtrip", f"WITH {LEADERBOARD_CTE} SELECT * EXCLUDE (generated_at) FROM leaderboard")
def q_table_roundtrip(spark, sf_dir):
    from lapworks.sources.tables import read_table, write_table
    name = f"spark_catalog.{_schema(spark)}.driver_performance_metrics"
    write_table(leaderboard(spark, sf_dir), name)
    return read_table(spark, name, on_empty="raise").drop("generated_at")


@register("stream_ingest", EVENTS_SQL)
def q_stream_ingest(spark, sf_dir):
    path = land_events(spark, sf_dir)
    schema = _ST.fromDDL("event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props STRING")
    table = f"spark_catalog.{_schema(spark)}.raw_events_stream"
    out = landing.ingest_available(spark, path, table, schema, _scratch(spark, "stream-checkpoint"),
                                   race_location="Baku", as_of=td.AS_OF)
    return out.select(*EVENT_FIELDS)


def _kept_sql(what: str, before: str, after: str) -> str:
    return f"""SELECT 'silver', 'retention_{what}', 'ok', {after}, 'of ' || CAST({before} AS VARCHAR) || ', '
       || CAST(round(({before} - {after}) * 100.0 / {before}, 1) AS VARCHAR) || '% dropped'"""


_PIPELINE_HEAD = f"""SELECT 'bronze' AS stage, 'sessions' AS dataset, 'ok' AS status, count(*) AS rows,
       CAST(NULL AS VARCHAR) AS detail FROM orders
UNION ALL
SELECT 'bronze', 'target_session', 'ok', 1, 'session_key=' || CAST(max(session_key) AS VARCHAR)
FROM sessions_raw WHERE session_type = 'Race' AND circuit_short_name = 'Baku'
UNION ALL SELECT 'bronze', 'laps', 'ok', count(*), NULL FROM events
UNION ALL SELECT 'bronze', 'drivers', 'ok', count(*), NULL FROM customer
UNION ALL SELECT 'silver', 'cleaned_sessions', 'ok', count(*), NULL FROM cleaned
UNION ALL
SELECT 'silver', 'enriched_laps', 'ok', count(*),
       'valid=' || CAST(count_if(is_valid_lap) AS VARCHAR) || ' flagged='
       || CAST(count_if(NOT is_valid_lap) AS VARCHAR) FROM enriched
UNION ALL {_kept_sql("sessions", "(SELECT count(*) FROM sessions_raw)", "(SELECT count(*) FROM cleaned)")}
UNION ALL {_kept_sql("laps", "(SELECT count(*) FROM laps)", "(SELECT count(*) FROM enriched)")}
UNION ALL {_kept_sql("valid_laps", "(SELECT count(*) FROM enriched)", "(SELECT count(*) FROM valid)")}"""


def _pipeline_status_sql() -> str:
    """The stage table of ``pipeline_status``: the racing preset runs with its own
    60 s minimum lap, so the Silver gate fails and the run halts there."""
    enriched60 = ENRICHED_CTE.replace("WHEN l.lap_duration < 1.0 THEN false",
                                      "WHEN l.lap_duration < 60.0 THEN false")
    results = (checks_sql("silver.cleaned_sessions", "cleaned", presets.CLEANED_SESSIONS)
               + "\nUNION ALL\n"
               + checks_sql("silver.enriched_laps", "enriched_a", presets.ENRICHED_LAPS))
    return f"""WITH {enriched60},
enriched_a AS (SELECT *, TIMESTAMP '2025-01-01 00:00:00' AS processed_at FROM enriched),
{CLEANED_CTE.strip()},
results AS ({results}),
bad AS (SELECT * FROM results WHERE outcome <> 'pass')
{_PIPELINE_HEAD}
UNION ALL
SELECT 'gate_silver', 'silver.cleaned_sessions,silver.enriched_laps', 'failed',
       {len(presets.CLEANED_SESSIONS) + len(presets.ENRICHED_LAPS)}, CAST(count(*) AS VARCHAR) || ' check(s)' FROM bad
UNION ALL
SELECT 'gate_silver', "table", 'failed', 1, "check" || '=' || coalesce(CAST(value AS VARCHAR), 'None') || ' ' || op
       || ' ' || CAST(threshold AS VARCHAR) || ' (' || outcome || ')' FROM bad"""


@register("pipeline_status", _pipeline_status_sql())
def q_pipeline_status(spark, sf_dir):
    """The five stages over the whole test tables with the racing preset checks;
    the Silver gate halts the run (test durations are far below 80 s)."""
    return pipeline.run_all(spark, _fetchers(spark, sf_dir), _options(spark))


def _options(spark, **kw):
    """A run of its own: own location, own schemas."""
    own = uuid.uuid4().hex[:8]
    _OWNED["schemas"] += [f"{layer}_{own}" for layer in ("bronze", "silver", "gold")]
    settings = replace(DEFAULT, bronze=f"bronze_{own}", silver=f"silver_{own}", gold=f"gold_{own}",
                       min_lap_duration_s=kw.pop("min_lap", DEFAULT.min_lap_duration_s))
    return pipeline.Options(settings=settings, location=_scratch(spark, "warehouse"), as_of=td.AS_OF,
                            lap_type=td.LAP_TYPE, duration_type=td.DURATION_TYPE, session_id_type="bigint",
                            avg_scale=td.AVG_SCALE, **kw)


def _fetchers(spark, sf_dir):
    return {"sessions": lambda: td.bronze_sessions(spark, sf_dir),
            "laps": lambda: td.bronze_laps(spark, sf_dir),
            "drivers": lambda: td.bronze_drivers(spark, sf_dir)}


# Thresholds that fit the given tables: laps of 1 to 1,000 s, event ids as lap numbers, orders
# from 1995 on.  Counts of nulls, duplicates and invalid values must be zero as in the preset.
FITTED = {"EL8": (None, 1000), "EL10": 1000, "EL11": 0, "EL12": 1e9, "CS10": 1995, "DP11": 1000, "CN12": 1000,
          "LP6": 0, "LP7": 1e9, "LP9": 1000, "LP11": 1000}
_FITTED_CHECKS = {label: presets.with_thresholds(presets.with_thresholds(cs, **presets.min_lap_thresholds(td.MIN_DURATION)),
                                                 **FITTED) for label, cs in presets.PRESET.items()}


def _gate_sql(stage: str, labels, bad: str, reached: str) -> str:
    """The status rows of a gate: one for the gate, one for each failed check."""
    n = sum(len(presets.PRESET[t]) for t in labels)
    return f"""SELECT '{stage}', '{",".join(labels)}', CASE WHEN (SELECT count(*) FROM {bad}) = 0 THEN 'ok' ELSE 'failed' END, {n},
       CASE WHEN (SELECT count(*) FROM {bad}) > 0 THEN CAST((SELECT count(*) FROM {bad}) AS VARCHAR) || ' check(s)' END
WHERE {reached}
UNION ALL
SELECT '{stage}', "table", 'failed', 1, "check" || '=' || coalesce(CAST(value AS VARCHAR), 'None') || ' ' || op
       || ' ' || CAST(threshold AS VARCHAR) || ' (' || outcome || ')' FROM {bad} WHERE {reached}"""


def _complete_sql() -> str:
    source = {"silver.cleaned_sessions": "cleaned", "silver.enriched_laps": "enriched_a",
              "gold.driver_performance_metrics": "leaderboard", "gold.constructor_standings": "standings",
              "gold.lap_progression": "progression"}
    results = {layer: "\nUNION ALL\n".join(checks_sql(t, source[t], _FITTED_CHECKS[t]) for t in labels)
               for layer, labels in (("s", presets.SILVER_TABLES), ("g", presets.GOLD_TABLES))}
    passed = "(SELECT count(*) FROM bad_s) = 0"
    rest = ", ".join(x[len(ENRICHED_CTE):].lstrip(",").strip() for x in (LEADERBOARD_CTE, STANDINGS_CTE, PROGRESSION_CTE))
    return f"""WITH {ENRICHED_CTE}, {CLEANED_CTE.strip()}, {rest},
enriched_a AS (SELECT *, TIMESTAMP '2025-01-01 00:00:00' AS processed_at FROM enriched),
bad_s AS (SELECT * FROM ({results["s"]}) WHERE outcome <> 'pass'),
bad_g AS (SELECT * FROM ({results["g"]}) WHERE outcome <> 'pass')
{_PIPELINE_HEAD}
UNION ALL {_gate_sql("gate_silver", presets.SILVER_TABLES, "bad_s", "true")}
UNION ALL SELECT 'gold', 'driver_performance_metrics', 'ok', count(*), NULL FROM leaderboard HAVING {passed}
UNION ALL SELECT 'gold', 'constructor_standings', 'ok', count(*), NULL FROM standings HAVING {passed}
UNION ALL SELECT 'gold', 'lap_progression', 'ok', count(*), NULL FROM valid HAVING {passed}
UNION ALL {_gate_sql("gate_gold", presets.GOLD_TABLES, "bad_g", passed)}"""


def _fitted_options(spark):
    return _options(spark, thresholds=FITTED, inject_min_lap=True, min_lap=td.MIN_DURATION)


@register("pipeline_complete", _complete_sql())
def q_pipeline_complete(spark, sf_dir):
    """A run through all five stages; the checks' bounds fit the given tables, the gates
    fail where a check really does."""
    return pipeline.run_all(spark, _fetchers(spark, sf_dir), _fitted_options(spark))


@register("pipeline_gold_tables", f"""WITH {LEADERBOARD_CTE}, {STANDINGS_CTE[len(ENRICHED_CTE):].lstrip(",").strip()},
{PROGRESSION_CTE[len(ENRICHED_CTE):].lstrip(",").strip()}
SELECT 'driver' AS mart, driver_number AS entity, CAST(pace_rank AS BIGINT) AS place, avg_lap_time_s AS pace FROM leaderboard
UNION ALL SELECT 'team', team_name, team_pace_rank, avg_team_pace_s FROM standings
UNION ALL SELECT 'lap', driver_number, lap_number, rolling_avg_5lap_s FROM progression""")
def q_pipeline_gold_tables(spark, sf_dir):
    """The Gold tables that a complete run has written, read back."""
    opts = _fitted_options(spark)
    pipeline.run_all(spark, _fetchers(spark, sf_dir), opts)
    read = lambda t: spark.read.table(opts.name("gold", t))
    return read("driver_performance_metrics").select(
        F.lit("driver").alias("mart"), F.col("driver_number").alias("entity"), F.col("pace_rank").cast("long").alias("place"),
        F.col("avg_lap_time_s").alias("pace")) \
        .union(read("constructor_standings").select(F.lit("team"), "team_name", F.col("team_pace_rank").cast("long"),
                                                    "avg_team_pace_s")) \
        .union(read("lap_progression").select(F.lit("lap"), "driver_number", F.col("lap_number").cast("long"),
                                              "rolling_avg_5lap_s"))


# ---------------------------------------------------------------- one check kind per query
def _kind(name, table, check_list):
    def q(spark, sf_dir):
        return checks.run_checks(td.table(spark, sf_dir, table), check_list, table)
    register(name, f"WITH src AS (SELECT * FROM {table}) " + checks_sql(table, "src", check_list))(q)


_kind("dq_row_count", "orders", [checks.Check("R1", "row_count", ">", 0),
                                 checks.Check("R2", "row_count", ">=", 20000)])
_kind("dq_missing", "customer", [checks.Check("M1", "missing_count", "=", 0, "c_name"),
                                 checks.Check("M2", "missing_count", "=", 0, "c_acctbal")])
_kind("dq_duplicate", "orders", [checks.Check("D1", "duplicate_count", "=", 0, "o_orderkey"),
                                 checks.Check("D2", "duplicate_count", "=", 0, "o_custkey")])
_kind("dq_invalid_values", "orders", [checks.Check("V1", "invalid_count", "=", 0, "o_orderstatus",
                                                   valid_values=("F", "O"))])
_kind("dq_invalid_range", "part", [checks.Check("G1", "invalid_count", "=", 0, "p_size",
                                                valid_min=1, valid_max=40)])
_kind("dq_min_max", "supplier", [checks.Check("X1", "min", ">=", 0, "s_acctbal"),
                                 checks.Check("X2", "max", "<=", 9999.99, "s_acctbal")])
_kind("dq_filtered", "events", [checks.Check("FL1", "min", ">", 0, "value", filter="event_type = 'purchase'"),
                                checks.Check("FL2", "row_count", ">", 0, filter="event_type = 'purchase'"),
                                checks.Check("FL3", "max", "<=", 400, "value", filter="event_type = 'view'")])
