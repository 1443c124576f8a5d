"""Token counts as delta-maintained rollups.

Changes are signed: an insert counts +1, a delete -1, a revision is the old row with -1
and the new one with +1.  A batch of them becomes additive totals by source, language and
tokenizer version, written once; the current totals are the sum over all committed batches.
A batch is committed by an entry in the store's manifest: with it, it is never applied
again; without it, nothing that was written for it counts.
"""

from __future__ import annotations

import uuid
from collections import Counter

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapworks.llm import tokens, words
from lapworks.llm.common import prepare, table
from lapworks.session import shared_dir

WORDS = "words-1"                        # runs outside \x20 and \x09-\x0D
VERSIONS = (WORDS, tokens.TOKENIZER)
_TOTALS = "source string, lang string, tokenizer string, docs long, tokens long"


def _count(versions: tuple[str, ...]):
    def run(batches):
        docs, total = Counter(), Counter()
        for b in batches:
            sign, source, lang = (b.column(i).to_pylist() for i in range(3))
            buf, off = words.buffers(b.column(3))
            raw = memoryview(buf)
            for i, j in words.slices(off):
                split = [bytes(raw[off[k]:off[k + 1]]).split() for k in range(i, j)]
                for v in versions:
                    n = [len(w) for w in split] if v == WORDS else [len(e) // 4 for e in tokens.encode_words(split, v)]
                    for k, x in enumerate(n, start=i):
                        key = (source[k], lang[k], v)
                        docs[key] += sign[k]
                        total[key] += sign[k] * x
        keys = list(docs)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in keys], pa.string()) for i in range(3)]
            + [pa.array([c[k] for k in keys], pa.int64()) for c in (docs, total)],
            ["source", "lang", "tokenizer", "docs", "tokens"])
    return run


def delta(changes: DataFrame, versions: tuple[str, ...] = VERSIONS) -> DataFrame:
    """``source, lang, tokenizer, docs, tokens`` of ``changes(sign, source, lang, text)``:
    summed in each task (a task sends one row a group, however hot), then over all."""
    rows = changes.select(F.col("sign").cast("int").alias("sign"), F.col("source").cast("string").alias("source"),
                          F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_count(tuple(versions)), _TOTALS).groupBy("source", "lang", "tokenizer") \
        .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


def _entry(spark: SparkSession, store: str, batch_id: str):
    """The manifest entry of a batch: a path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/commits/{batch_id}")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _commit(spark: SparkSession, store: str, batch_id: str, folder: str) -> bool:
    """Moves the batch's manifest entry, which names its folder, into its place in one
    rename: of several writers of a batch exactly one's folder counts."""
    path, fs = _entry(spark, store, batch_id)
    written = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/pending/{folder}")
    out = fs.create(written, True)
    out.write(bytearray(folder.encode()))
    out.close()
    fs.mkdirs(path.getParent())
    if not fs.exists(path) and fs.rename(written, path):
        return _named(spark, path, fs) == folder
    fs.delete(written, False)
    return False


def _named(spark: SparkSession, path, fs) -> str:
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def apply_batch(store: str, batch_id: str, changes: DataFrame, versions: tuple[str, ...] = VERSIONS) -> bool:
    """Commits a batch to ``store``; False if it was committed before.

    A batch is written to a folder of its own attempt and counts from the moment that its
    manifest entry exists; what a failed or a losing attempt has written never counts.
    Null source or language: a group of its own.  Null text: no tokens.  A batch without
    rows commits as empty.
    """
    spark = changes.sparkSession
    prepare(spark)
    if not batch_id or any(c in batch_id for c in "/=\\:") or batch_id[0] in "._":
        raise ValueError(f"not a batch id: {batch_id!r}")
    path, fs = _entry(spark, store, batch_id)
    if fs.exists(path):
        return False
    folder = uuid.uuid4().hex
    delta(changes, versions).coalesce(1).write.parquet(f"{store}/data/{folder}")      # a row a group
    return _commit(spark, store, batch_id, folder)


def totals(spark: SparkSession, store: str) -> DataFrame:
    """Current totals: the sum over all committed batches, without groups that are empty
    again.  A store without batches has no groups."""
    try:
        named = spark.read.text(f"{store}/commits", wholetext=True).select(F.col("value").alias("_folder"))
        rows = spark.read.schema(_TOTALS).parquet(f"{store}/data/*")
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _TOTALS)
    folder = F.regexp_extract(F.col("_metadata.file_path"), "/data/([^/]+)/", 1)
    return rows.withColumn("_folder", folder).join(named, "_folder", "left_semi") \
        .groupBy("source", "lang", "tokenizer") \
        .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0 OR tokens <> 0")


def signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.select(F.lit(sign).alias("sign"), "source", "lang", "text")


SHORT_CHARS = 200


def changes_of(docs: DataFrame) -> list[tuple[str, DataFrame]]:
    """Three batches over a document table: all rows come in; those with ``|`` come again
    with it taken out; those under ``SHORT_CHARS`` characters leave (as they then are)."""
    plain = lambda c: F.translate(c, "|", " ")
    barred = docs.filter(F.contains("text", F.lit("|")))
    short = docs.withColumn("text", plain(F.col("text"))).filter(F.length("text") < SHORT_CHARS)
    return [("1-load", signed(docs, 1)),
            ("2-revise", signed(barred, -1).unionByName(signed(barred.withColumn("text", plain(F.col("text"))), 1))),
            ("3-drop-short", signed(short, -1))]


def query(spark, sf_dir):
    """All batches, the second one sent twice."""
    prepare(spark)
    store = f"{shared_dir(spark)}/rollup-{uuid.uuid4().hex}"
    batches = changes_of(table(spark, sf_dir, "documents"))
    for name, changes in [*batches[:2], batches[1], *batches[2:]]:
        apply_batch(store, name, changes)
    return totals(spark, store)
