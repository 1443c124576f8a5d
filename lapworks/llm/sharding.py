"""Sharding by longest-processing-time-first scheduling.

Groups that must stay together (equal texts) go, largest first, to the least-loaded
shard.  The schedule is made on the histogram of group sizes, whose number of bins is
bounded whatever the table's size: sizes keep 11 significant bits (exact below 2048,
within 0.1 % above).  The groups of a bin count as equal; they are handed to a heap of
shard loads, whole rounds at a time and the last few one by one.
Each bin's shares are then joined back to the groups by their rank in the bin.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapworks.llm.common import id_in, id_out, materialize, position, prepare, table

SIZE_BITS = 11


def size_bin(size: Column) -> Column:
    """``size`` cut to its first ``SIZE_BITS`` binary digits."""
    drop = F.greatest(F.lit(0), F.length(F.bin(size)) - SIZE_BITS).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", size, drop), drop)


def schedule(bins: list[tuple[int, int, int]], shards: int) -> dict[int, list[tuple[int, int]]]:
    """``bins``: (bin, groups, bytes).  Returns by bin the runs ``(shard, groups)``, in
    rank order.  Longest first; every group goes to the shard with the least load."""
    loads = [0.0] * shards
    runs: dict[int, list[tuple[int, int]]] = {}
    for size_class, groups, total in sorted(bins, reverse=True):
        each = total / groups
        got = _rounds(loads, groups, each)
        loads = [load + n * each for load, n in zip(loads, got)]
        heap = [(load, s) for s, load in enumerate(loads)]
        heapq.heapify(heap)
        for _ in range(groups - sum(got)):
            load, s = heap[0]
            heapq.heapreplace(heap, (load + each, s))
            got[s] += 1
            loads[s] = load + each
        runs[size_class] = [(s, n) for s, n in enumerate(got) if n]
    return runs


def _rounds(loads: list[float], groups: int, each: float) -> list[int]:
    """What the heap hands out of ``groups`` equal groups while every shard stays under
    one common level, the highest that they can fill: only a few are left after it."""
    if each <= 0:
        return [groups // len(loads)] * len(loads)
    low, high = min(loads), max(loads) + each * (groups // len(loads) + 1)
    fill = lambda level: [max(0, int((level - x) / each)) for x in loads]
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(fill(mid)) <= groups else (low, mid)
    return fill(low)


def shard(docs: DataFrame, shards: int = 24, *, id_col: str = "doc_id", text_col: str = "text",
          overhead: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row.

    Law "bytes": the shards' sizes are near equal; equal texts share a shard (so a
    text whose copies outweigh an even share makes its shard the largest).  ``size``
    is the UTF-8 length plus ``overhead``; ``slot`` is gapless from 0 in each shard.
    Null text: as the empty one.  Null ids and repeated rows: rows as any other.  An
    empty table gives no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(id_in(id_col).alias("_id"), (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.unhex(F.md5(text)).alias("_h"))
    groups = rows.groupBy("_h").agg(F.sum("size").alias("_bytes"))
    groups = materialize(groups.withColumn("_bin", size_bin(F.col("_bytes"))))
    # at most 2**(SIZE_BITS - 1) bins for each binary order of magnitude
    bins = groups.groupBy("_bin").agg(F.count(F.lit(1)), F.sum("_bytes")).collect()
    runs = schedule([tuple(b) for b in bins], shards)
    plan = [(b, [s for s, _ in r], _ends([n for _, n in r])) for b, r in runs.items()]
    plan = spark.createDataFrame(plan, "_bin long, _shards array<int>, _ends array<long>")
    ranked = position(groups, ["_bin"], ["_h"], "_rank", F.xxhash64("_h"))
    at = F.size(F.filter("_ends", lambda e: e <= F.col("_rank")))
    placed = ranked.join(plan, "_bin").select("_h", F.get("_shards", at).alias("shard"))
    out = rows.join(placed, "_h")
    out = position(out, ["shard"], ["_id", "_h"], "slot", F.xxhash64("_id", "_h"))
    return out.select(id_out("_id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      "slot", F.lit(None).cast("int").alias("grown_shard"))


def _ends(counts: list[int]) -> list[int]:
    out, at = [], 0
    for n in counts:
        at += n
        out.append(at)
    return out


def query(spark, sf_dir):
    return shard(table(spark, sf_dir, "documents"))
