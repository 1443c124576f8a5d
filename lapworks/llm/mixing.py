"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key ``-ln(u) / weight``, u from a hash of its id:
ordered by the key, the documents of a source are a weighted sample without
replacement of any length.  A source first gives its complete epochs; the rest of its
budget is filled in key order up to the prefix sum that reaches it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapworks.llm import words
from lapworks.llm.common import id_out, materialize, prepare, shuffle_partitions, table, unused

WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3


def _letters() -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[65:91] = t[97:123] = t[128:] = True
    return t


def _measure(id_col: str, text_col: str, source_col: str):
    def run(batches):
        letters = _letters()
        for b in batches:
            buf, off = words.buffers(b.column(b.schema.get_field_index(text_col)))
            size = words.word_counts(buf, off)
            share = np.zeros(len(size))
            for i, j in words.slices(off):
                if off[j] == off[i]:
                    continue
                acc = np.concatenate([[0], np.cumsum(letters[buf[off[i]:off[j]]], dtype=np.int64)])
                at = off[i:j + 1] - off[i]
                share[i:j] = (acc[at[1:]] - acc[at[:-1]]) / np.maximum(np.diff(at), 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.ids_of(b.column(b.schema.get_field_index(id_col)))),
                 b.column(b.schema.get_field_index(source_col)).cast(pa.string()), pa.array(size),
                 pa.array(np.clip(share, 0.1, 1.0))], ["_id", "source", "size", "weight"])
    return run


def measure(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """``_id, source, size, weight``: words of the text and its quality weight, the
    share of letters among its bytes (0.1 to 1)."""
    narrow = docs.select(F.col(id_col), F.col(text_col), F.col(source_col).cast("string").alias(source_col))
    return narrow.mapInArrow(_measure(id_col, text_col, source_col),
                             "_id long, source string, size long, weight double")


def targets(sizes: DataFrame, weights=WEIGHTS, most: float = MOST_EPOCHS) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    The sources, by code point and null last, weigh ``weights`` in turn and share the
    sum of all sizes; no target is over ``most`` times its source, the excess goes to
    the others by weight.  Sources are capped in the order of size / weight, so the
    level of the uncapped ones follows from prefix sums: no iteration.  One row a
    source: the single-partition windows see sources, not documents.
    """
    n = len(weights)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    s = sizes.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(n)) + 1))
    s = s.withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    s = s.withColumns({
        "_capped": F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "_rest": F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing)),
        "_all": F.sum("source_size").over(Window.partitionBy())})
    s = s.withColumn("_level", (F.col("_all") - F.col("_capped")) / F.col("_rest"))
    # the first source in this order that is under its cap sets the level for all after it
    free = F.when(F.col("_cap") > F.col("_level") * F.col("_w"), F.col("_level"))
    s = s.withColumn("_at", F.first(free, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return s.select("source", "source_size",
                    F.when(F.col("_at").isNull(), F.col("_cap")).otherwise(F.col("_at") * F.col("_w")).alias("target"))


def mix(measured: DataFrame, *, weights=WEIGHTS, most: float = MOST_EPOCHS, seed: int = 17) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` from ``_id, source, size, weight``.

    ``taken`` is the document's words in the mix, repeats counted: its size times the
    source's complete epochs, once more if it is drawn for the fractional one.  The
    one document a source whose words pass the budget is cut there, so the taken words
    of a source miss its target by less than one word.  Keys depend on id and seed
    alone: reruns agree.  Ties in the key go by id, then size; rows repeating an id are drawn as
    separate rows.  Null source: a source of its own.  Empty texts take 0.  Weights
    null or below 1e-6 count as 1e-6.

    Prefix sums of a hot source: rows are dealt into buckets by the logarithm of the key,
    which spreads them alike whatever their weights (of equally weighted rows a bucket has
    one in ``4 * steps`` at most), the buckets' totals give each bucket's start, and only
    the one bucket a source in which the budget ends is ordered.
    """
    spark = measured.sparkSession
    steps = max(64, 2 * shuffle_partitions(spark))          # buckets from a key to its double
    w = F.greatest(F.coalesce(F.col("weight"), F.lit(1e-6)), F.lit(1e-6))
    bits = F.call_function("shiftrightunsigned", F.xxhash64(F.col("_id"), F.lit(seed)), F.lit(11))
    u = (bits.cast("double") + 0.5) / F.lit(float(1 << 53))
    rows = materialize(measured.withColumn("_key", -F.log(u) / w).withColumn(
        "_b", F.floor(F.log2("_key") * steps).cast("int")))
    totals = rows.groupBy("source", "_b").agg(F.sum("size").alias("_words"))
    of_source = targets(totals.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, most)
    of_source = of_source.withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(
        F.col("target") / F.col("source_size") + 1e-12)).otherwise(F.lit(0)).cast("long"))
    of_source = materialize(of_source.withColumn("_rest", F.greatest(F.lit(0), F.round(
        F.col("target") - F.col("_epochs") * F.col("source_size"))).cast("long")))
    before = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("_start", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    limits = starts.join(of_source, starts["source"].eqNullSafe(of_source["source"])).select(
        starts["source"].alias("_s"), F.col("_b").alias("_bb"), "_start", "_words", "source_size", "target",
        "_epochs", "_rest")
    joined = rows.join(limits, rows["source"].eqNullSafe(limits["_s"]) & (rows["_b"] == limits["_bb"]))
    whole = F.col("_start") + F.col("_words") <= F.col("_rest")
    none = F.col("_start") >= F.col("_rest")
    clear = joined.filter(whole | none).withColumn("_drawn", F.when(whole, F.col("size")).otherwise(F.lit(0)))
    run = Window.partitionBy("source").orderBy("_key", "_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    edge = joined.filter(~(whole | none)).withColumn("_to", F.col("_start") + F.sum("size").over(run))
    edge = edge.withColumn("_drawn", F.greatest(F.lit(0), F.least(
        F.col("size"), F.col("_rest") - (F.col("_to") - F.col("size"))))).drop("_to")
    return clear.unionByName(edge).select(
        id_out("_id").alias("doc_id"), "source", "size", "source_size", "target",
        (F.col("_epochs") * F.col("size") + F.col("_drawn")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself, with the columns of ``docs``, whatever others it has: a row for each
    time a document is taken whole, and a cut row for the one document a source where the
    budget ends.  Rows that repeat an id and source are each taken as often as the one taken
    most.  Null and empty texts have no words and are never taken; a null source is a source
    of its own.  No rows: no rows."""
    prepare(docs.sparkSession)
    doc, source, size, taken, copy = unused(docs, "_doc", "_src", "_size", "_taken", "_copy")
    m = mix(measure(docs), **kw).filter("taken > 0") \
        .groupBy(F.col("doc_id").alias(doc), F.col("source").alias(source)) \
        .agg(F.max("size").alias(size), F.max("taken").alias(taken))
    d = docs.join(m, docs["doc_id"].eqNullSafe(m[doc]) & docs["source"].eqNullSafe(m[source]))
    times = F.ceil(F.col(taken) / F.col(size)).cast("int")
    d = d.withColumn(copy, F.explode(F.sequence(F.lit(1), times)))
    left = F.col(taken) - (F.col(copy) - 1) * F.col(size)
    ws = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda x: x != "")
    text = F.when(left >= F.col(size), F.col("text")).otherwise(
        F.array_join(F.slice(ws, F.lit(1), F.greatest(left, F.lit(1)).cast("int")), " "))
    out = d.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def query(spark, sf_dir):
    prepare(spark)
    return mix(measure(table(spark, sf_dir, "documents"))).drop("source")
