"""Packing by shortest-pack-first over the length histogram.

Documents are cut into pieces of at most ``capacity`` ids; the pieces' histogram has at
most ``capacity`` bins, so it goes to the driver whatever the table's size.  Lengths are
placed longest first, each into the shortest packs that have room, whole runs of equal
packs at a time; the resulting patterns (lengths in a pack, number of such packs) are
joined back to the pieces by their rank among the pieces of their length.
"""

from __future__ import annotations

import heapq
import zlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapworks.llm import tokens, words
from lapworks.llm.common import id_in, id_out, materialize, position, prepare, table

CAPACITY = 4096
END_ID = 2


def _pieces(tokenizer: str, capacity: int, end_id: int):
    tail = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches):
        for b in batches:
            ids = words.ids_of(b.column(0))
            buf, off = words.buffers(b.column(1))
            raw = memoryview(buf)
            out = [[] for _ in range(5)]
            for i, j in words.slices(off):
                texts = [bytes(raw[off[k]:off[k + 1]]).split() for k in range(i, j)]
                for k, enc in enumerate(tokens.encode_words(texts, tokenizer), start=i):
                    enc += tail
                    n = len(enc) // 4
                    for s in range(0, n, capacity):
                        part = enc[4 * s:4 * (s + capacity)]
                        for col, v in zip(out, (ids[k], s, len(part) // 4, zlib.crc32(part), n)):
                            col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                             ["_id", "start", "length", "ids_crc32", "doc_tokens"])
        words.trim()
    return run


def pieces(docs: DataFrame, *, id_col="doc_id", text_col="text", tokenizer: str = tokens.TOKENIZER,
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``_id, start, length, ids_crc32, doc_tokens``: each document's ids, ``end_id``
    last, cut at the multiples of ``capacity``."""
    narrow = docs.select(id_in(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))
    return narrow.mapInArrow(_pieces(tokenizer, capacity, end_id),
                             "_id long, start long, length long, ids_crc32 long, doc_tokens long")


def patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths, packs)``: every length of the histogram placed, longest first, into
    the shortest packs with room for it; where no pack has room, into new packs of as many
    equal pieces as go in.

    A length leaves at most one new pattern of full stacks, one of the rest and one for each
    run of packs that it splits: the patterns' lengths together are in the order of
    ``capacity * log(capacity)`` for ``capacity`` bins, whatever the counts."""
    open_: list[tuple[int, int, tuple[int, ...], int]] = []     # total, order, lengths, packs
    done: list[tuple[tuple[int, ...], int]] = []
    order = 0
    for length in sorted((n for n, c in histogram.items() if c), reverse=True):
        left = histogram[length]
        while left:
            if open_ and open_[0][0] + length <= capacity:
                total, _, pack, count = heapq.heappop(open_)
                # as many of them in each pack as go in and as there are
                high = max(min((capacity - total) // length, left // count), 1)
                n = min(count, left // high)
                if count > n:
                    order += 1
                    heapq.heappush(open_, (total, order, pack, count - n))
            else:
                total, pack = 0, ()
                high = min(capacity // length, left)
                n = left // high
            left -= high * n
            new = (total + high * length, (*pack, *[length] * high), n)
            if new[0] >= capacity:
                done.append(new[1:])
            else:
                order += 1
                heapq.heappush(open_, (new[0], order, *new[1:]))
    return done + [(p, c) for _, _, p, c in open_]


def _runs(plan: list[tuple[tuple[int, ...], int]]):
    """By length, in rank order: where each run of pieces ends, where it begins, its first
    sequence, the offset of its first piece there, and how many equal pieces stand side by
    side in a sequence."""
    runs: dict[int, tuple[list, ...]] = {}
    base = 0
    for pack, count in plan:
        offset = 0
        for n, same in groupby(pack):
            high = len(list(same))
            ends, starts, first, at, stack = runs.setdefault(n, ([], [], [], [], []))
            start = ends[-1] if ends else 0
            for column, value in zip((ends, starts, first, at, stack), (start + count * high, start, base, offset, high)):
                column.append(value)
            offset += n * high
        base += count
    return [(n, *r) for n, r in runs.items()]


def pack(docs: DataFrame, *, capacity: int = CAPACITY, **kw) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset``.

    Null text: empty, so the end id alone.  Null ids and repeated rows: documents of
    their own.  Pieces equal in id, start and ids are interchangeable.  An empty table
    gives no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = materialize(pieces(docs, capacity=capacity, **kw))
    histogram = dict(rows.groupBy("length").count().collect())      # at most ``capacity`` rows
    plan = _runs(patterns(histogram, capacity))
    plan = spark.createDataFrame(plan, "length long, _ends array<long>, _starts array<long>, _first array<long>, "
                                       "_at array<long>, _stack array<long>")
    ranked = position(rows, ["length"], ["_id", "start", "ids_crc32"], "_rank", F.xxhash64("_id", "start"))
    run = F.size(F.filter("_ends", lambda e: e <= F.col("_rank")))
    own = lambda name: F.get(name, F.col("_run"))
    inside = F.col("_rank") - own("_starts")
    # at most ``capacity`` rows; their runs are bounded by the patterns, see there
    return ranked.join(F.broadcast(plan), "length").withColumn("_run", run).select(
        id_out("_id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens",
        (own("_first") + F.floor(inside / own("_stack"))).cast("long").alias("sequence_id"),
        (own("_at") + F.pmod(inside, own("_stack")) * F.col("length")).cast("long").alias("offset"))


def query(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))
