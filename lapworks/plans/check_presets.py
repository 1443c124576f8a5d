"""The racing preset: 67 checks over the five Silver and Gold tables."""

from __future__ import annotations

from dataclasses import replace

from lapworks.config import SESSION_TYPES_KEPT
from lapworks.operators.checks import Check

VALID = "is_valid_lap = true"

# The preset checks, in file order, with their thresholds.
# (Lap-duration bounds are 80..220 s, lap numbers 1..65, seasons 2023..2030.)
CLEANED_SESSIONS = [
    Check("CS1", "row_count", ">", 0),
    Check("CS2", "row_count", ">=", 2),
    Check("CS3", "missing_count", "=", 0, "session_id"),
    Check("CS4", "duplicate_count", "=", 0, "session_id"),
    Check("CS5", "invalid_count", "=", 0, "session_type", valid_values=SESSION_TYPES_KEPT),
    Check("CS6", "missing_count", "=", 0, "start_time"),
    Check("CS7", "missing_count", "=", 0, "end_time"),
    Check("CS8", "missing_count", "=", 0, "processed_at"),
    Check("CS9", "missing_count", "=", 0, "pipeline_year"),
    Check("CS10", "min", ">=", 2023, "year"),
    Check("CS11", "max", "<=", 2030, "year"),
]

ENRICHED_LAPS = [
    Check("EL1", "row_count", ">", 0),
    Check("EL2", "missing_count", "=", 0, "driver_number"),
    Check("EL3", "missing_count", "=", 0, "full_name"),
    Check("EL4", "missing_count", "=", 0, "team_name"),
    Check("EL5", "missing_count", "=", 0, "lap_number"),
    Check("EL6", "missing_count", "=", 0, "is_valid_lap"),
    Check("EL7", "missing_count", "=", 0, "lap_duration", filter=VALID),
    Check("EL8", "invalid_count", "=", 0, "lap_duration", filter=VALID, valid_min=80, valid_max=220),
    Check("EL9", "min", ">=", 80, "lap_duration", filter=VALID),
    Check("EL10", "max", "<=", 220, "lap_duration", filter=VALID),
    Check("EL11", "min", ">=", 1, "lap_number"),
    Check("EL12", "max", "<=", 65, "lap_number"),
    Check("EL13", "missing_count", "=", 0, "processed_at"),
]

DRIVER_PERFORMANCE = [
    Check("DP1", "row_count", ">", 0),
    Check("DP2", "row_count", ">=", 10),
    Check("DP3", "missing_count", "=", 0, "pace_rank"),
    Check("DP4", "min", "=", 1, "pace_rank"),
    Check("DP5", "duplicate_count", "=", 0, "pace_rank"),
    Check("DP6", "duplicate_count", "=", 0, "driver_number"),
    Check("DP7", "missing_count", "=", 0, "fastest_lap_s"),
    Check("DP8", "missing_count", "=", 0, "avg_lap_time_s"),
    Check("DP9", "missing_count", "=", 0, "total_valid_laps"),
    Check("DP10", "min", ">=", 80, "fastest_lap_s"),
    Check("DP11", "max", "<=", 220, "fastest_lap_s"),
    Check("DP12", "min", ">=", 80, "avg_lap_time_s"),
    Check("DP13", "min", ">=", 0, "lap_consistency_s"),
    Check("DP14", "min", ">=", 1, "total_valid_laps"),
    Check("DP15", "missing_count", "=", 0, "generated_at"),
    Check("DP16", "missing_count", "=", 0, "season_year"),
]

CONSTRUCTOR_STANDINGS = [
    Check("CN1", "row_count", ">", 0),
    Check("CN2", "row_count", ">=", 5),
    Check("CN3", "missing_count", "=", 0, "team_pace_rank"),
    Check("CN4", "min", "=", 1, "team_pace_rank"),
    Check("CN5", "duplicate_count", "=", 0, "team_pace_rank"),
    Check("CN6", "duplicate_count", "=", 0, "team_name"),
    Check("CN7", "missing_count", "=", 0, "best_lap_s"),
    Check("CN8", "missing_count", "=", 0, "avg_team_pace_s"),
    Check("CN9", "missing_count", "=", 0, "total_valid_laps"),
    Check("CN10", "min", ">=", 80, "best_lap_s"),
    Check("CN11", "min", ">=", 80, "avg_team_pace_s"),
    Check("CN12", "max", "<=", 220, "avg_team_pace_s"),
    Check("CN13", "missing_count", "=", 0, "generated_at"),
    Check("CN14", "missing_count", "=", 0, "season_year"),
]

LAP_PROGRESSION = [
    Check("LP1", "row_count", ">", 0),
    Check("LP2", "missing_count", "=", 0, "driver_number"),
    Check("LP3", "missing_count", "=", 0, "lap_number"),
    Check("LP4", "missing_count", "=", 0, "lap_duration_s"),
    Check("LP5", "missing_count", "=", 0, "rolling_avg_5lap_s"),
    Check("LP6", "min", ">=", 1, "lap_number"),
    Check("LP7", "max", "<=", 65, "lap_number"),
    Check("LP8", "min", ">=", 80, "lap_duration_s"),
    Check("LP9", "max", "<=", 220, "lap_duration_s"),
    Check("LP10", "min", ">=", 80, "rolling_avg_5lap_s"),
    Check("LP11", "max", "<=", 220, "rolling_avg_5lap_s"),
    Check("LP12", "missing_count", "=", 0, "generated_at"),
    Check("LP13", "missing_count", "=", 0, "season_year"),
]

PRESET = {
    "silver.cleaned_sessions": CLEANED_SESSIONS,
    "silver.enriched_laps": ENRICHED_LAPS,
    "gold.driver_performance_metrics": DRIVER_PERFORMANCE,
    "gold.constructor_standings": CONSTRUCTOR_STANDINGS,
    "gold.lap_progression": LAP_PROGRESSION,
}
SILVER_TABLES = ("silver.cleaned_sessions", "silver.enriched_laps")
GOLD_TABLES = ("gold.driver_performance_metrics", "gold.constructor_standings", "gold.lap_progression")


# The checks that hold the minimum lap duration.
MIN_LAP_CHECKS = ("EL8", "EL9", "DP10", "DP12", "CN10", "CN11", "LP8", "LP10")


def with_thresholds(checks: list[Check], **overrides) -> list[Check]:
    """Re-parameterise checks by name: a number is the threshold (``EL9=60``), a pair the
    valid range of an ``invalid_count`` (``EL8=(60, 220)``, None leaves that end as it is).
    Thresholds are real parameters, not text patches."""
    def changed(c: Check) -> Check:
        if c.name not in overrides:
            return c
        new = overrides[c.name]
        if c.metric != "invalid_count" or not isinstance(new, (tuple, list)):
            return replace(c, threshold=float(new))
        lo, hi = new
        return replace(c, valid_min=c.valid_min if lo is None else lo, valid_max=c.valid_max if hi is None else hi)
    return [changed(c) for c in checks]


def min_lap_thresholds(min_lap_duration_s: float) -> dict:
    """The minimum lap duration of the settings as overrides of the checks that hold it."""
    return {n: (min_lap_duration_s, None) if n == "EL8" else min_lap_duration_s for n in MIN_LAP_CHECKS}
