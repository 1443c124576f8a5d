"""JSON-list payloads to typed rows (S3, S3b) without a driver-side middle-man.

A payload is the text of one API response: a JSON *list* of objects is good,
``[]`` is good and empty, an object (an error body) or unparsable text is bad.
Payloads are parsed as VARIANT on the executors, classified per payload, and
exploded with their position (payload order is kept for the resolver).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, MapType, NullType, StringType, StructField, StructType, VariantType,
                               _parse_datatype_string)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed payload file: ``(source, payload)`` (whole file text)."""
    return spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("source"), F.col("value").alias("payload"))


def classify(payloads: DataFrame, text_col: str = "payload") -> DataFrame:
    """Adds ``shape``: ``list``, ``empty_list``, ``object`` (rejected) or ``unparsable``."""
    v = F.try_parse_json(F.col(text_col))
    sch = F.schema_of_variant(v)
    shape = (F.when(v.isNull(), F.lit("unparsable"))
             .when(sch == F.lit("ARRAY<VOID>"), F.lit("empty_list"))
             .when(sch.startswith("ARRAY"), F.lit("list"))
             .when(sch.startswith("OBJECT"), F.lit("object"))
             .otherwise(F.lit("scalar")))
    return payloads.withColumn("shape", shape)


def parsed(payloads: DataFrame, text_col: str = "payload", keep=("source",)) -> DataFrame:
    """Every list entry and every payload that is no list, from one parse: ``(keep..., pos,
    rec, reason, content)``.  Records are VARIANT objects without a ``reason``; others have
    one, and their text (payloads with ``pos`` null)."""
    shaped = classify(payloads, text_col).filter(F.col("shape") != "empty_list")
    is_list = F.col("shape") == "list"
    entries = F.when(is_list, F.try_parse_json(F.col(text_col)).cast("array<variant>"))
    rows = shaped.select(*keep, F.when(~is_list, F.col("shape")).alias("_shape"),
                         F.when(~is_list, F.col(text_col)).alias("_body"), F.posexplode_outer(entries).alias("pos", "rec"))
    is_object = F.coalesce(F.schema_of_variant("rec").startswith("OBJECT"), F.lit(False))
    reason = F.when(F.col("_shape").isNotNull(), F.concat(F.lit("payload is "), "_shape")) \
        .when(~is_object, F.lit("record is no object"))
    content = F.when(F.col("_shape").isNotNull(), F.col("_body")).when(~is_object, F.to_json("rec"))
    return rows.select(*keep, "pos", "rec", reason.alias("reason"), content.alias("content"))


def rejected(payloads: DataFrame, text_col: str = "payload", keep=("source",)) -> DataFrame:
    """What ``explode_records`` leaves out, with the reason: payloads that are no JSON list
    (``pos`` null) and list entries that are no object.  ``(keep..., pos, reason, content)``."""
    return parsed(payloads, text_col, keep).filter("reason IS NOT NULL").drop("rec")


def explode_records(payloads: DataFrame, text_col: str = "payload",
                    keep=("source",)) -> DataFrame:
    """Object entries of list payloads as ``(keep..., pos, rec)``, ``rec`` a VARIANT; what
    else there is, ``rejected`` gives."""
    return parsed(payloads, text_col, keep).filter("reason IS NULL").drop("reason", "content")


def _spark_type(t):
    """The merged type of a field: an untyped one (only JSON nulls) is text."""
    if isinstance(t, NullType):
        return StringType()
    if isinstance(t, StructType):
        return StructType([StructField(f.name, _spark_type(f.dataType)) for f in t.fields])
    if isinstance(t, ArrayType):
        return ArrayType(_spark_type(t.elementType))
    return t


def infer_record_schema(records: DataFrame, rec_col: str = "rec") -> StructType:
    """Merged schema of all records: one global aggregate, a single (bounded) row.  The
    type text is read as a type, field names are never touched."""
    text = records.agg(F.schema_of_variant_agg(rec_col)).first()[0]
    if not text or not text.startswith("OBJECT<"):
        return StructType([])
    return _spark_type(_parse_variant_type(text))


def _parse_variant_type(text: str):
    """``OBJECT<name: TYPE, ...>`` as ``schema_of_variant_agg`` writes it; names that are
    not plain identifiers come in back-quotes (a quote in them doubled)."""
    plain = {"VOID": NullType(), "VARIANT": VariantType()}

    def parse(i: int):
        if text.startswith("OBJECT<", i):
            i += len("OBJECT<")
            fields = []
            while text[i] != ">":
                if text[i] == "`":
                    j = i + 1
                    while text[j] != "`" or text[j + 1] == "`":
                        j += 2 if text[j] == "`" else 1
                    name, i = text[i + 1:j].replace("``", "`"), j + 1
                else:
                    j = text.index(":", i)
                    name, i = text[i:j], j
                i += 1 + (text[i + 1] == " ")
                kind, i = parse(i)
                fields.append(StructField(name, kind))
                if text[i] == ",":
                    i += 1 + (text[i + 1] == " ")
            return StructType(fields), i + 1
        if text.startswith("ARRAY<", i):
            kind, i = parse(i + len("ARRAY<"))
            return ArrayType(kind), i + 1
        j, depth = i, 0
        while j < len(text) and (depth or text[j] not in ",>"):
            depth += {"(": 1, ")": -1}.get(text[j], 0)
            j += 1
        word = text[i:j].strip()
        return plain.get(word) or _parse_datatype_string(word), j
    return parse(0)[0]


def to_columns(records: DataFrame, schema: StructType | None = None, rec_col: str = "rec",
               keep=("source", "pos")) -> DataFrame:
    """Typed columns from VARIANT records; nested lists / objects stay JSON text
    (the Bronze stringify rule), scalars get their inferred type, and a field
    whose scalar type differs between records becomes text."""
    schema = schema if schema is not None else infer_record_schema(records, rec_col)
    cols = []
    for f in schema.fields:
        path = "$['" + f.name.replace("'", "\\'") + "']"
        if isinstance(f.dataType, VariantType):
            # mixed scalar types across records (e.g. 1 and "1"): text, as the JSON reader would
            v = F.try_variant_get(F.col(rec_col), path, "variant")
            text = F.coalesce(F.try_variant_get(F.col(rec_col), path, "string"), F.to_json(v))
            cols.append(F.when(v.isNull() | F.is_variant_null(v), F.lit(None).cast("string"))
                        .otherwise(text).alias(f.name))
        elif isinstance(f.dataType, (StructType, ArrayType, MapType)):
            v = F.try_variant_get(F.col(rec_col), path, "variant")
            cols.append(F.when(v.isNull() | F.is_variant_null(v), F.lit(None).cast("string"))
                        .otherwise(F.to_json(v)).alias(f.name))
        else:
            cols.append(F.try_variant_get(F.col(rec_col), path, f.dataType.simpleString()).alias(f.name))
    return records.select(*keep, *cols)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed payload files -> typed record rows with ``source`` and ``pos``."""
    recs = explode_records(read_landed(spark, path))
    return to_columns(recs)


def land_pages(df: DataFrame, path: str, page_col: str, order: list[str] | None = None) -> None:
    """Write ``df`` as JSON-list payload files, one file per page (``page_col``), the shape
    a paginated list endpoint returns, entries in the order of ``order`` (else of their
    JSON text).  The caller's pages bound each file."""
    fields = [c for c in df.columns if c != page_col]
    body = df.select(F.col(page_col).alias("_page"), F.struct(*[F.col(c) for c in order or []],
                                                              F.to_json(F.struct(*fields)).alias("_j")).alias("_e"))
    pages = body.groupBy("_page").agg(F.array_sort(F.collect_list("_e")).alias("_es")).select(
        "_page", F.concat(F.lit("["), F.array_join(F.transform("_es", lambda e: e["_j"]), ","), F.lit("]")).alias("value"))
    pages.write.mode("overwrite").partitionBy("_page").text(path)
