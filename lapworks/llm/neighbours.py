"""Approximate nearest neighbours with a permutation index.

A vector is represented by the order of its nearest pivots, the first ``PREFIX`` of them.
Blocks of vectors keep pivot inverted files: by pivot, the vectors that list it and at
which place.  A query reads the files of its own pivots only, adds up what each shared
pivot takes off the footrule distance, and reranks the vectors of least distance by their
cosine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapworks.llm.common import materialize, prepare, table

PIVOTS = 256          # fitted on a bounded sample: so many rows, chosen by a hash of their id
PREFIX = 96
RERANK = 1500         # vectors of a block that a query reranks
BLOCK = 8192          # vectors of an index block
QUERY_BLOCK = 2048


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``_id, v`` (double): rows with an id whose vector is not null, not empty, not zero
    and holds finite numbers only."""
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    zero = F.forall(v, lambda x: x == 0)
    return vectors.filter(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0)) \
        .filter(~bad & ~zero).select(F.col(id_col).cast("long").alias("_id"), v.alias("v"))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)       # no overflow in the squares
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def permutation(unit: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each row, nearest first."""
    near = -(unit @ pivots.T)
    prefix = min(prefix, len(pivots))
    part = np.argpartition(near, prefix - 1, axis=1)[:, :prefix]
    order = np.argsort(np.take_along_axis(near, part, axis=1), axis=1, kind="stable")
    return np.take_along_axis(part, order, axis=1)


def search_block(ids: np.ndarray, vecs: np.ndarray, qids: np.ndarray, qvecs: np.ndarray, pivots: np.ndarray,
                 k: int, prefix: int, rerank: int):
    """``query, id, score`` of the best found for each query in one block."""
    order = np.argsort(ids, kind="stable")
    ids, vecs = ids[order], vecs[order]
    # equal vectors are one entry of the index, with the ids a query can need of it
    _, entry, which = np.unique(np.ascontiguousarray(vecs).view(f"V{vecs.shape[1] * 8}").ravel(),
                                return_index=True, return_inverse=True)
    rank = np.argsort(entry)                            # entries by their smallest id
    place = np.empty_like(rank)
    place[rank] = np.arange(len(rank))
    entry, which = entry[rank], place[which]
    by = np.argsort(which, kind="stable")
    first = np.searchsorted(which[by], np.arange(len(entry) + 1))
    unit = _unit(vecs[entry])
    perm = permutation(unit, pivots, prefix)
    m = perm.shape[1]
    flat = np.argsort(perm.ravel(), kind="stable")       # the inverted files, one pivot after another
    files = np.searchsorted(perm.ravel()[flat], np.arange(len(pivots) + 1))
    member, at = flat // m, flat % m
    qunit = _unit(qvecs)
    qperm = permutation(qunit, pivots, prefix)
    out = []
    for q in range(len(qids)):
        saved = np.zeros(len(entry), dtype=np.int64)
        for place_q, p in enumerate(qperm[q]):
            s = slice(files[p], files[p + 1])
            # |a - b| in place of (m - a) + (m - b), the footrule of a pivot that only one lists
            saved[member[s]] += 2 * (m - np.maximum(at[s], place_q))
        n = min(len(entry), rerank)
        if n < len(entry):
            least = np.partition(saved, len(entry) - n)[len(entry) - n]
            sure = np.flatnonzero(saved > least)
            tied = np.flatnonzero(saved == least)[:n - len(sure)]      # ties: smaller ids
            near = np.concatenate([sure, tied])
        else:
            near = np.arange(len(entry))
        score = (unit[near] * qunit[q]).sum(axis=1)
        # the k best rows, the query's own aside
        top = near[np.lexsort((entry[near], -score))[:k + 1]]
        best = dict(zip(near.tolist(), score.tolist()))
        rows = [(-best[e], int(i)) for e in top.tolist() for i in ids[by[first[e]:first[e + 1]][:k + 1]] if i != qids[q]]
        out += [(int(qids[q]), i, -s) for s, i in sorted(rows)[:k]]
    return out


def nearest(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 50, k: int = 5,
            pivots: int = PIVOTS, prefix: int = PREFIX, rerank: int = RERANK, block: int = BLOCK,
            query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every``,
    the ``k`` rows of largest cosine found, its own left out.

    Vectors null, empty, zero or holding null or non-finite numbers take no part, nor do
    rows without id or with another length than the most frequent one.  Rows that repeat
    an id are one row, with the smallest vector.  Ties go by id.  An empty table gives no
    rows.  Each block of ``block`` vectors contributes its own ``rerank`` nearest, so
    recall does not fall as the table grows.  Pivots are ``pivots`` rows picked by a hash
    of the id; every row is indexed.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = usable(vectors.select(F.col(id_col), F.col(vec_col)), id_col, vec_col)
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    schema = "query_id long, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("v") == sizes[0]["d"]).groupBy("_id").agg(F.min("v").alias("v"))
    rows = materialize(rows)
    n = rows.count()
    sample = rows.orderBy(F.xxhash64("_id"), "_id").limit(pivots).select("v").collect()      # bounded by ``pivots``
    pivot_rows = _unit(np.array([r["v"] for r in sample], dtype=np.float64))
    blocks = -(-n // block)
    is_query = F.pmod("_id", F.lit(every)) == 0
    qblocks = max(1, -(-n // (every * query_block)))
    deal = lambda m, salt: F.pmod(F.xxhash64("_id", F.lit(salt)), F.lit(m)).cast("int")
    base = rows.select("_id", "v", deal(blocks, 1).alias("b"), F.explode(
        F.sequence(F.lit(0), F.lit(qblocks - 1))).alias("q"))
    asked = rows.filter(is_query).select("_id", "v", deal(qblocks, 2).alias("q"), F.explode(
        F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        got = search_block(left["_id"].to_numpy(), _matrix(left["v"]), right["_id"].to_numpy(), _matrix(right["v"]),
                           pivot_rows, k, prefix, rerank) if left.num_rows and right.num_rows else []
        q, i, s = zip(*got) if got else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(i, pa.int64()),
                         "score": pa.array(s, pa.float64())})

    found = base.groupBy("b", "q").cogroup(asked.groupBy("b", "q")).applyInArrow(search, schema)
    # a query has k rows from each block: they are merged by a partial top-k, as arrays
    best = found.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(
        F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("p", "x")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
        (-F.col("x.s")).alias("score"))


def query(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"))
