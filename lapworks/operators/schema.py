"""Schema drift guard and column contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame


class SchemaDriftError(ValueError):
    pass


def missing_columns(df: DataFrame, required) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def assert_columns(df: DataFrame, required, label: str) -> None:
    """Raise listing *every* missing column (exact-case names); no Spark job runs."""
    missing = missing_columns(df, required)
    if missing:
        raise SchemaDriftError(
            f"Schema drift detected in '{label}': {missing} not found among {df.columns}")


# Required input columns and output column orders of the contract.
SESSIONS_REQUIRED = ["date_start", "date_end", "session_type", "session_key",
                     "session_name", "location", "country_name", "year"]
LAPS_REQUIRED = ["driver_number", "lap_number", "lap_duration", "is_pit_out_lap"]
DRIVERS_REQUIRED = ["driver_number", "full_name", "team_name", "country_code", "headshot_url"]

SESSIONS_CONTRACT = ["session_id", "session_name", "session_type", "location", "country_name",
                     "start_time", "end_time", "year", "processed_at", "pipeline_year"]
ENRICHED_LAPS_CONTRACT = ["driver_number", "full_name", "team_name", "country_code", "headshot_url",
                          "lap_number", "lap_duration", "is_pit_out_lap", "is_valid_lap", "processed_at"]
LEADERBOARD_CONTRACT = ["pace_rank", "full_name", "team_name", "driver_number", "fastest_lap_s",
                        "avg_lap_time_s", "median_lap_time_s", "lap_consistency_s", "total_valid_laps",
                        "generated_at", "season_year"]
STANDINGS_CONTRACT = ["team_pace_rank", "team_name", "best_lap_s", "avg_team_pace_s",
                      "total_valid_laps", "generated_at", "season_year"]
PROGRESSION_CONTRACT = ["full_name", "team_name", "driver_number", "lap_number", "lap_duration_s",
                        "rolling_avg_5lap_s", "generated_at", "season_year"]
