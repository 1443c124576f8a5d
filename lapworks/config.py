"""Constants of the racing preset, gathered in one frozen dataclass."""

from __future__ import annotations

from dataclasses import dataclass


# Fixed values that must equal the original pipeline's behaviour:
# layer names, season, target round and session type, fetch policy
# (3 attempts, 5 s apart, 30 s timeout), minimum credible lap of 60 s,
# rolling window of 5 laps, 3-decimal rounding,
# the session types kept in Silver and the texts that mean "no value".
SESSION_TYPES_KEPT = ("RACE", "QUALIFYING")
NULL_SENTINELS = ("None", "nan", "NaN")


@dataclass(frozen=True)
class Settings:
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    season_year: int = 2025
    race_round: str = "Baku"
    session_type: str = "Race"
    max_retries: int = 3
    retry_delay_s: float = 5.0
    request_timeout_s: float = 30.0
    min_lap_duration_s: float = 60.0
    rolling_laps: int = 5
    decimals: int = 3
    base_url: str = "https://api.openf1.org/v1"
    session_types_kept: tuple = SESSION_TYPES_KEPT
    null_sentinels: tuple = NULL_SENTINELS


DEFAULT = Settings()
