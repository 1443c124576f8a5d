"""Exact dedup: group by a 128-bit content hash, keep one stable id, compare bytes
inside the groups so that a hash collision never joins different texts."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapworks.llm.common import NULL_ID, id_in, id_out, materialize, prepare, unused


def normalised(text: str = "text") -> Column:
    """Null as empty; A-Z lower-cased, nothing else changed."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def content_hash(sha: Column) -> Column:
    """The first 128 bits of the SHA-256 of the text."""
    return F.substring(sha, 1, 16)


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 keep: str = "smallest", hash_of=content_hash) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows belong together when their normalised texts are equal byte by byte.  The
    groups are counted by (hash, text): the map side collapses the copies of a hot
    text before the shuffle, and grouping by the text itself is the byte comparison.
    Rows then find their group by the hash alone; only where two texts share a hash
    (none is expected) by the text as well.  A hot hash is split by AQE's skew join,
    as its other side has one row.

    Null text: equal to the empty text.  Null id: a row as any other; it is kept only
    if no row of its group has an id (its ``keep_id`` is then null).  Rows that repeat
    the kept id are all marked kept.  Other columns of ``docs`` are not read.
    ``keep``: "smallest" or "largest" id.  ``hash_of`` maps the binary SHA-256 to the
    group hash (tests pass a short one to force collisions).
    """
    prepare(docs.sparkSession)
    sha = F.unhex(F.sha2(F.col("_t"), 256))
    texts = docs.select(id_in(id_col).alias("_id"), normalised(text_col).alias("_t"))
    hashed = texts.withColumn("_sha", sha).withColumn("_h", hash_of(F.col("_sha")))
    seen = id_out("_id")
    stays = {"smallest": F.min, "largest": F.max}[keep](seen)
    classes = hashed.groupBy("_h", "_t").agg(stays.alias("_keep"), F.count(F.lit(1)).alias("_n"))
    # the group's text is not needed any more: narrow rows, one per distinct text
    groups = materialize(classes.select("_h", "_keep", "_n"))
    rows = hashed.select("_id", "_sha", "_h")
    clash = groups.groupBy("_h").agg(F.count(F.lit(1)).alias("_texts")).filter("_texts > 1").select("_h")
    if clash.isEmpty():
        out = rows.join(groups, "_h")       # both sides straight from their shuffle: AQE can split a hot hash
    else:
        single = rows.join(groups.join(clash, "_h", "left_anti"), "_h")
        mixed = hashed.join(clash, "_h", "left_semi").select("_id", "_sha", "_h", "_t") \
            .join(classes.join(clash, "_h", "left_semi"), ["_h", "_t"]).drop("_t")
        out = single.unionByName(mixed)
    return out.select(id_out("_id").alias("doc_id"), F.col("_keep").alias("keep_id"),
                      F.col("_n").alias("group_size"), id_out("_id").eqNullSafe(F.col("_keep")).alias("kept"),
                      F.lower(F.hex("_sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever they are called: one
    per distinct normalised text (of rows that repeat the kept id with the same text, any
    one).  Null text: equal to the empty text.  No rows: no rows."""
    k, sha = unused(docs, "_key", "_sha")
    stay = exact_groups(docs, id_col=id_col, text_col=text_col, keep=keep).filter("kept") \
        .select(F.coalesce("doc_id", F.lit(NULL_ID)).alias(k), F.unhex("text_sha256").alias(sha)).distinct()
    # the copies go before anything else is done with whole rows
    kept = docs.withColumns({k: id_in(id_col), sha: F.unhex(F.sha2(normalised(text_col), 256))}).join(stay, [k, sha], "left_semi")
    return kept.dropDuplicates([k, sha]).select(*docs.columns)


def query(spark, sf_dir):
    from lapworks.llm.common import table
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


ORACLE = """WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)"""
