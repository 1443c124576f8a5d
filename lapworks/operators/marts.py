"""Gold marts: driver leaderboard (A1), team standings (A2), lap progression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapworks.functions.columns import EXACT_SCALE
from lapworks.operators.conform import ts_or_now
from lapworks.operators.metrics import dense_rank, lower_median, pace_columns, rolling_mean
from lapworks.operators.validity import valid_only
from lapworks.session import materialize


@dataclass(frozen=True)
class LapColumns:
    """Input column names of a timed-event table; the defaults are the Silver laps."""
    driver: str = "driver_number"
    name: str = "full_name"
    team: str = "team_name"
    lap: str = "lap_number"
    duration: str = "lap_duration"
    valid: str = "is_valid_lap"


LAPS = LapColumns()


def conformed(events: DataFrame, cols: LapColumns = LAPS) -> DataFrame:
    """Any timed-event table in the mart input shape (a projection; names only)."""
    if cols == LAPS:
        return events
    return events.select(F.col(cols.driver).alias("driver_number"), F.col(cols.name).alias("full_name"),
                         F.col(cols.team).alias("team_name"), F.col(cols.lap).alias("lap_number"),
                         F.col(cols.duration).alias("lap_duration"), F.col(cols.valid).alias("is_valid_lap"))


def _audit(season_year: int, as_of):
    return [ts_or_now(as_of).alias("generated_at"), F.lit(season_year).cast("int").alias("season_year")]


def _order(df: DataFrame, ordered: bool, *cols) -> DataFrame:
    """Global sort for report outputs; for table writes (order is not kept on
    re-read) a per-partition sort clusters the files without a range shuffle."""
    return df.orderBy(*cols) if ordered else df.sortWithinPartitions(*cols)


def driver_leaderboard(laps: DataFrame, season_year: int, *, decimals: int = 3,
                       avg_scale: int | None = EXACT_SCALE,
                       distributed: bool = True, target_rows: int | None = None, as_of=None,
                       ordered: bool = True, cols: LapColumns = LAPS) -> DataFrame:
    """Per (driver, name, team) pace metrics over valid laps, dense-ranked on the
    *rounded* (average asc, std-dev asc) pair, so equal rounded pairs tie.

    The median is the exact lower median in either form; groups with a null driver, name
    or team are groups like any other."""
    keys = ["driver_number", "full_name", "team_name"]
    valid = valid_only(conformed(laps, cols))
    if distributed:
        stats = valid.groupBy(*keys).agg(*pace_columns("lap_duration", "lap_number", decimals=decimals,
                                                       avg_scale=avg_scale, with_median=False))
        med = lower_median(valid, keys, "lap_duration", "_med", target_rows=target_rows) \
            .select(*[F.col(k).alias(f"_m{i}") for i, k in enumerate(keys)], "_med")
        # one row a group, read by the ranking and by the join back: written once
        agg = materialize(stats.join(med, [stats[k].eqNullSafe(med[f"_m{i}"]) for i, k in enumerate(keys)], "left").select(
            *keys, "fastest_lap_s", "avg_lap_time_s", F.round("_med", decimals).alias("median_lap_time_s"),
            "lap_consistency_s", "total_valid_laps"))
    else:
        agg = valid.groupBy(*keys).agg(
            *pace_columns("lap_duration", "lap_number", decimals=decimals, avg_scale=avg_scale))
    ranked = dense_rank(agg, [("avg_lap_time_s", "asc"), ("lap_consistency_s", "asc")],
                        "pace_rank", distributed=distributed)
    ranked = ranked.select(
        "pace_rank", "full_name", "team_name", "driver_number", "fastest_lap_s",
        "avg_lap_time_s", "median_lap_time_s", "lap_consistency_s", "total_valid_laps",
        *_audit(season_year, as_of))
    return _order(ranked, ordered, "pace_rank")


def team_standings(laps: DataFrame, season_year: int, *, decimals: int = 3,
                   avg_scale: int | None = EXACT_SCALE, distributed: bool = True,
                   as_of=None, ordered: bool = True, cols: LapColumns = LAPS) -> DataFrame:
    """Per team: best lap, lap-weighted average (not a mean of driver means), lap count;
    dense-ranked on (average asc, laps desc)."""
    agg = valid_only(conformed(laps, cols))
    agg = agg.groupBy("team_name").agg(
        *pace_columns("lap_duration", "lap_number", decimals=decimals, avg_scale=avg_scale,
                      with_median=False, with_stddev=False,
                      names={"min": "best_lap_s", "avg": "avg_team_pace_s"}))
    agg = materialize(agg) if distributed else agg
    ranked = dense_rank(agg, [("avg_team_pace_s", "asc"), ("total_valid_laps", "desc")],
                        "team_pace_rank", distributed=distributed)
    out = ranked.select("team_pace_rank", "team_name", "best_lap_s", "avg_team_pace_s",
                        "total_valid_laps", *_audit(season_year, as_of))
    return _order(out, ordered, "team_pace_rank")


def lap_progression(laps: DataFrame, season_year: int, *, rows: int = 5, decimals: int = 3,
                    avg_scale: int | None = EXACT_SCALE, lap_type: str = "int",
                    partition_by=("driver_number",), distributed: bool = True,
                    target_rows: int | None = None, as_of=None, ordered: bool = True, cols: LapColumns = LAPS) -> DataFrame:
    """Valid laps with the rolling mean of the last ``rows`` *valid* laps of the
    driver (the filter runs first, so gaps are skipped), ordered by name, lap."""
    base = valid_only(conformed(laps, cols)).select("full_name", "team_name", "driver_number", "lap_number",
                                   "lap_duration", *[c for c in partition_by
                                                     if c not in ("driver_number",)])
    rolled = rolling_mean(base, "lap_duration", list(partition_by), ["lap_number"], rows=rows,
                          out="rolling_avg_5lap_s", decimals=decimals, avg_scale=avg_scale,
                          distributed=distributed, target_rows=target_rows)
    out = rolled.select(
        "full_name", "team_name", "driver_number", F.col("lap_number").try_cast(lap_type).alias("lap_number"),
        F.round("lap_duration", decimals).alias("lap_duration_s"), "rolling_avg_5lap_s",
        *_audit(season_year, as_of))
    return _order(out, ordered, "full_name", "lap_number")
