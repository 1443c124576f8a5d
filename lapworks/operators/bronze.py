"""Bronze normalisation of landed payload rows (S4-S7) in one projection each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, FloatType, MapType, NullType, StringType,
                               StructType)

from lapworks.config import NULL_SENTINELS
from lapworks.functions.columns import nan_to_null as _nan_expr
from lapworks.functions.columns import null_if_sentinel
from lapworks.operators.conform import ts_or_now


def null_sentinels(df: DataFrame, sentinels=NULL_SENTINELS) -> DataFrame:
    """In string columns only: exact sentinel text -> NULL (one select, not a column loop)."""
    return df.select(*[
        null_if_sentinel(f.name, sentinels).alias(f.name) if isinstance(f.dataType, StringType)
        else F.col(f.name) for f in df.schema.fields])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Every float/double column: NaN -> NULL."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            t = "double" if isinstance(f.dataType, DoubleType) else "float"
            out.append(_nan_expr(f.name, t).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def void_to_string(df: DataFrame) -> DataFrame:
    """All-NULL (``NullType``) columns become nullable strings."""
    return df.select(*[F.col(f.name).cast("string").alias(f.name)
                       if isinstance(f.dataType, NullType) else F.col(f.name)
                       for f in df.schema.fields])


def stringify_complex(df: DataFrame) -> DataFrame:
    """Nested (struct / array / map) columns become JSON text; scalars are untouched."""
    return df.select(*[F.to_json(F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, (StructType, ArrayType, MapType)) else F.col(f.name)
                       for f in df.schema.fields])


def stamp(df: DataFrame, race_location: str | None = None, *, as_of=None) -> DataFrame:
    """Ingest audit columns ``ingested_at`` and ``race_location``."""
    return df.withColumns({"ingested_at": ts_or_now(as_of),
                           "race_location": F.lit(race_location).cast("string")})


def normalise(df: DataFrame, race_location: str | None = None, *, as_of=None,
              sentinels=NULL_SENTINELS) -> DataFrame:
    """Full Bronze step: stringify nested, sentinels -> NULL, NaN -> NULL, void -> string, audit."""
    out = void_to_string(nan_to_null(null_sentinels(stringify_complex(df), sentinels)))
    return stamp(out, race_location, as_of=as_of)
