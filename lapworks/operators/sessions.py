"""Silver sessions (P2-P9, A8) and the target-session resolver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapworks.config import SESSION_TYPES_KEPT
from lapworks.functions.columns import parse_timestamp, safe_cast, trimmed, upper_trimmed
from lapworks.operators.conform import RECENCY, dedupe, recency, ts_or_now
from lapworks.operators.schema import SESSIONS_REQUIRED, assert_columns


def clean(bronze: DataFrame, pipeline_year: int, *, keep_types=SESSION_TYPES_KEPT,
          id_type: str = "int", as_of=None) -> DataFrame:
    """Normalise first, filter on the normalised values, project, then dedupe.

    ``start_time``/``end_time`` parsed from text (bad text -> NULL), country and
    name trimmed (location is not), type upper-cased and trimmed; rows kept when
    the type is in ``keep_types`` and key and start are present (a NULL end is
    kept); one row per ``session_id``: the one ingested last (``ingested_at``, then
    payload position ``pos``, where the input has them).

    A key that does not fit ``id_type`` is no key: ``rejected`` has these sessions.
    """
    assert_columns(bronze, SESSIONS_REQUIRED, "bronze.raw_sessions")
    df = (bronze
          .withColumns({"start_time": parse_timestamp("date_start"),
                        "end_time": parse_timestamp("date_end"),
                        "country_name": trimmed("country_name"),
                        "session_type": upper_trimmed("session_type")})
          .filter(F.col("session_type").isin(*keep_types))
          .filter(safe_cast("session_key", id_type).isNotNull())
          .filter(F.col("start_time").isNotNull())
          .select(safe_cast("session_key", id_type).alias("session_id"),
                  trimmed("session_name").alias("session_name"),
                  "session_type", "location", "country_name", "start_time", "end_time",
                  safe_cast("year", "int").alias("year"), *recency(bronze)))
    return dedupe(df, "session_id", order=[c for c in RECENCY if c in df.columns]).drop(*RECENCY).select(
        "*", ts_or_now(as_of).alias("processed_at"),
        F.lit(pipeline_year).cast("int").alias("pipeline_year"))


def rejected(bronze: DataFrame, *, keep_types=SESSION_TYPES_KEPT, id_type: str = "int") -> DataFrame:
    """Sessions of the kept types that ``clean`` leaves out, with the ``reason``."""
    key = F.col("session_key")
    reason = (F.when(key.isNull(), F.lit("no session_key"))
              .when(safe_cast("session_key", id_type).isNull(), F.lit(f"session_key is no {id_type}"))
              .when(parse_timestamp("date_start").isNull(), F.lit("date_start is no timestamp")))
    return bronze.filter(upper_trimmed("session_type").isin(*keep_types)).select(
        key.cast("string").alias("session_key"), "date_start", reason.alias("reason")).filter("reason IS NOT NULL")


def resolve_target(sessions: DataFrame, session_type: str = "Race", circuit: str = "Baku", *,
                   position: str = "pos", type_col: str = "session_type",
                   circuit_col: str = "circuit_short_name") -> DataFrame:
    """The session to ingest: among rows whose raw type equals ``session_type``
    (exact, case-sensitive), the last in payload order that is at ``circuit``;
    when none is, the last of that type (``matched_circuit`` = false); no row
    when there is no session of that type.

    One global aggregate (``max_by`` over (match, position)), partial per task.
    """
    cand = sessions.filter(F.col(type_col) == F.lit(session_type))
    match = F.coalesce(F.col(circuit_col) == F.lit(circuit), F.lit(False))
    picked = cand.agg(
        F.max_by(F.struct(*[F.col(c) for c in sessions.columns]),
                 F.struct(match.alias("m"), F.col(position).alias("p"))).alias("_s"),
        F.max(match).alias("matched_circuit"))
    return picked.filter(F.col("_s").isNotNull()).select("_s.*", "matched_circuit")
