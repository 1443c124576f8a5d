"""Report datasets over the Gold marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fastest_driver(leaderboard: DataFrame) -> DataFrame:
    """Top-1 by fastest lap, name as tie-break (a per-task top-k, then a merge)."""
    return leaderboard.select("full_name", "fastest_lap_s") \
        .orderBy(F.col("fastest_lap_s").asc(), F.col("full_name").asc()).limit(1)


def top_team(standings: DataFrame) -> DataFrame:
    return standings.select("team_name", "avg_team_pace_s") \
        .orderBy(F.col("avg_team_pace_s").asc(), F.col("team_name").asc()).limit(1)


def speed_consistency(leaderboard: DataFrame) -> DataFrame:
    return (leaderboard
            .filter(F.col("avg_lap_time_s").isNotNull() & F.col("lap_consistency_s").isNotNull())
            .select("full_name", "team_name", "avg_lap_time_s", "lap_consistency_s")
            .orderBy(F.col("avg_lap_time_s").asc()))


def pace_gap(standings: DataFrame, decimals: int = 3) -> DataFrame:
    """Each team's gap to the fastest team average.  The best average is a
    scalar subquery over a global (partial) aggregate: one value, no join."""
    best = standings.agg(F.min("avg_team_pace_s")).scalar()
    return (standings
            .select("team_name", "avg_team_pace_s",
                    F.round(F.col("avg_team_pace_s") - best, decimals).alias("pace_delta_s"))
            .orderBy(F.col("pace_delta_s").asc()))


def race_trace(progression: DataFrame, full_name: str | None = None,
               team_name: str | None = None) -> DataFrame:
    """Rolling averages per lap, optional single-select filters on driver and team."""
    df = progression.filter(F.col("rolling_avg_5lap_s").isNotNull())
    if full_name is not None:
        df = df.filter(F.col("full_name") == F.lit(full_name))
    if team_name is not None:
        df = df.filter(F.col("team_name") == F.lit(team_name))
    return df.select("lap_number", "full_name", "team_name", "rolling_avg_5lap_s") \
        .orderBy("full_name", "lap_number")


def facet_counts(df: DataFrame, facet: str, filters: dict | None = None) -> DataFrame:
    """For each value of ``facet``: how many rows pass the *other* active filters
    (``COUNT_IF`` of their conjunction).  A partial aggregate per task."""
    pred = F.lit(True)
    for col, val in (filters or {}).items():
        if col != facet and val is not None:
            pred = pred & (F.col(col) == F.lit(val))
    return df.groupBy(facet).agg(F.count_if(pred).alias("row_count"))


def facet_tables(df: DataFrame, facets: list[str], filters: dict | None = None) -> DataFrame:
    """``facet, value, row_count``: ``facet_counts`` of several facets from one scan and one
    aggregate (GROUPING SETS), each facet counting the rows that pass all other filters.
    A null facet value is a value; values are given as text."""
    filters = filters or {}

    def passing(facet):
        pred = F.lit(True)
        for col, val in filters.items():
            if col != facet and val is not None:
                pred = pred & (F.col(col) == F.lit(val))
        return pred
    # the facets stand beside the filtered columns, which grouping sets would null out
    rows = df.select(*[F.col(f).cast("string").alias(f"_f{i}") for i, f in enumerate(facets)],
                     *[passing(f).alias(f"_p{i}") for i, f in enumerate(facets)])
    keys = [F.col(f"_f{i}") for i in range(len(facets))]
    agg = rows.groupingSets([[k] for k in keys], *keys).agg(
        *[F.count_if(f"_p{i}").alias(f"_n{i}") for i in range(len(facets))],
        *[F.grouping(f"_f{i}").alias(f"_g{i}") for i in range(len(facets))])
    facet = value = count = F.lit(None)
    for i, f in enumerate(facets):
        own = F.col(f"_g{i}") == 0
        facet = F.when(own, F.lit(f)).otherwise(facet)
        value = F.when(own, F.col(f"_f{i}")).otherwise(value)
        count = F.when(own, F.col(f"_n{i}")).otherwise(count)
    return agg.select(facet.alias("facet"), value.alias("value"), count.alias("row_count"))


def widget_sum(df: DataFrame, by, measure: str) -> DataFrame:
    """The chart aggregate ``SUM(measure)`` by the chart dimensions."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.sum(measure).alias(f"sum_{measure}"))


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows of an ordered mart (the limit is the feature)."""
    return df.limit(n)
