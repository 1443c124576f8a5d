"""Long JSON lists read by many tasks (S3): one payload file need not fit in a row.

Spark's text reader cuts a file at byte ranges and gives the text between two closing braces
as a row.  Where a range begins, inside a string or how deep, is not known to its task, so
there are two passes.  The first sums up each range for either start: whether it leaves an
open string, how the depth changes, how many entries end at each depth.  A window over a
file's ranges (a few numbers each) makes these sums into the state at each range's start.
The second pass cuts each range at the commas between the list's entries; only an entry that
crosses ranges is put together from its parts afterwards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapworks.session import materialize, ship_package

_QUOTE, _ESCAPE, _COMMA, _OPEN, _CLOSE = b'"'[0], b"\\"[0], b","[0], b"[{", b"]}"
_STEP = np.zeros(256, dtype=np.int8)
_STEP[list(_OPEN)], _STEP[list(_CLOSE)] = 1, -1
_BLANK = b" \t\r\n"

_SUMMARY = ("source string, block long, quotes int, change0 long, change1 long, commas0 map<long,long>, "
            "commas1 map<long,long>, ends0 map<long,long>, ends1 map<long,long>, first string, last string, "
            "bytes long, size long")


class _Scan:
    """The bytes of a range, piece by piece: what is inside a string, and how deep, relative
    to a start outside of a string (``inside`` False) or inside one."""

    def __init__(self, inside: bool):
        self.inside, self.depth, self.escapes = inside, 0, 0

    def step(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each byte: whether it is outside of strings, and the depth after it."""
        # a quote after an odd run of backslashes is none
        at = np.arange(len(raw))
        no_escape = np.where(raw != _ESCAPE, at, -1 - self.escapes)
        before = np.maximum.accumulate(np.concatenate([[-1 - self.escapes], no_escape[:-1]]))
        quote = (raw == _QUOTE) & ((at - 1 - before) % 2 == 0)
        tail = len(raw) - 1 - int(np.maximum.accumulate(no_escape)[-1])
        self.escapes = tail
        parity = np.cumsum(quote)
        outside = (parity + self.inside) % 2 == 0
        outside &= ~quote
        depth = self.depth + np.cumsum(np.where(outside, _STEP[raw], 0))
        self.inside = bool((parity[-1] + self.inside) % 2)
        self.depth = int(depth[-1])
        return outside, depth


def _pieces(batches):
    """The rows of Arrow batches (source, block, ..., text last) as ``(key, columns, bytes,
    end)``: a range's bytes, batch by batch.  The reader takes the braces off; they are put
    back, but for the range's last row (``end``), of which only the file can tell."""
    key, row, held = None, None, None
    for b in batches:
        cols = [b.column(i).to_pylist() for i in range(b.num_columns - 1)]
        out = []
        for *own, text in zip(*cols, b.column(b.num_columns - 1).to_pylist()):
            if (own[0], own[1]) != key:
                if key is not None:
                    yield key, row, b"".join([*out, held]), True
                key, row, out = (own[0], own[1]), own, []
            else:
                out.append(held + b"}")
            held = (text or "").encode()
        if out:
            yield key, row, b"".join(out), False
    if key is not None:
        yield key, row, held, True


def _summaries(batches):
    def add(counts, depths):
        for d, n in zip(*np.unique(depths, return_counts=True)):
            counts[int(d)] = counts.get(int(d), 0) + int(n)

    rows, s = [], None
    for (source, block), row, data, end in _pieces(batches):
        s = s or {"scans": (_Scan(False), _Scan(True)), "commas": ({}, {}), "ends": ({}, {}), "first": None, "last": None,
                  "bytes": 0}
        s["bytes"] += len(data)
        if data:
            raw = np.frombuffer(data, np.uint8)
            for scan, commas, ends in zip(s["scans"], s["commas"], s["ends"]):
                outside, depth = scan.step(raw)
                add(commas, depth[outside & (raw == _COMMA)])
                add(ends, depth[outside & (_STEP[raw] < 0)])
            text = data.strip(_BLANK)
            if text:
                s["first"] = s["first"] or text[:1].decode("ascii", "replace")
                s["last"] = text[-1:].decode("ascii", "replace")
        if end:
            rows.append((source, block, int(s["scans"][0].inside), s["scans"][0].depth, s["scans"][1].depth,
                         *[list(c.items()) for c in (*s["commas"], *s["ends"])], s["first"], s["last"], s["bytes"], row[2]))
            s = None
    count = pa.map_(pa.int64(), pa.int64())
    types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), count, count, count, count, pa.string(), pa.string(),
             pa.int64(), pa.int64()]
    cols = list(zip(*rows)) if rows else [()] * len(types)
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [f.split()[0] for f in _SUMMARY.split(", ")])


def _starts(summaries: DataFrame) -> DataFrame:
    """Each range's state at its start, and whether its file is one JSON list: the sums of the
    ranges before it (a file's ranges, a few numbers each, are in one task)."""
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    file = Window.partitionBy("source")
    total = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    of = lambda name: F.when(F.col("inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    at = lambda counts, depth: F.coalesce(F.try_element_at(counts, depth), F.lit(0))
    final = F.col("block") == F.max("block").over(file)
    df = summaries.withColumn("inside", total("quotes", before) % 2 == 1).withColumn("final", final)
    # the brace after a range's last row, unless the file ends there
    brace = ~F.col("final") & ((F.col("inside").cast("int") + F.col("quotes")) % 2 == 0)
    df = df.withColumn("change", of("change") - brace.cast("long"))
    df = df.withColumn("depth", total("change", before))
    df = df.withColumns({
        "commas": at(of("commas"), 1 - F.col("depth")),
        "ends": at(of("ends"), -F.col("depth")) + (brace & (F.col("depth") + F.col("change") == 0)).cast("long")})
    # a brace as the very last byte is not in any row
    read = F.sum("bytes").over(file) + F.count(F.lit(1)).over(file) - 1
    one_list = (read == F.max("size").over(file)) & (F.sum("change").over(file) == 0) & (F.sum("quotes").over(file) % 2 == 0) & (F.sum("ends").over(file) == 1) \
        & (F.min_by("first", "block").over(file) == "[") & (F.max_by("last", "block").over(file) == "]")
    shape = F.when(one_list, "list").when(F.min_by("first", "block").over(file) == "{", "object").otherwise("unparsable")
    return df.select("source", "block", "inside", "depth", total("commas", before).alias("pos"), "final",
                     F.coalesce(shape, F.lit("unparsable")).alias("shape"),
                     (F.sum("commas").over(file) == 0).alias("single"))


_PARTS = "source string, block long, pos long, whole boolean, single boolean, content string"


def _parts(batches):
    """Entries, and the parts of those that cross a range's borders, of (source, block,
    inside, depth, pos, final, single, text) rows."""
    def batch_of(rows):
        types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                          [f.split()[0] for f in _PARTS.split(", ")])

    scan = None
    for (source, block), row, data, end in _pieces(batches):
        _, _, inside, depth0, pos0, final, single = row
        if scan is None:
            scan, pos, whole, held = _Scan(inside), pos0, depth0 == 0, []
            scan.depth = depth0
        if end and not final:
            data += b"}"
        out, start = [], 0
        if data:
            raw = np.frombuffer(data, np.uint8)
            outside, depth = scan.step(raw)
            step = np.where(outside, _STEP[raw], 0)
            cuts = np.flatnonzero((outside & (raw == _COMMA) & (depth == 1)) | ((step > 0) & (depth == 1))
                                  | ((step < 0) & (depth == 0)))
            for c in cuts.tolist():
                piece, start = data[start:c], c + 1
                if step[c] > 0:                          # the list begins
                    held, whole = [], True
                    continue
                out.append((source, block, pos, whole, single, b"".join([*held, piece]).decode()))
                held, whole, pos = [], True, pos + 1
            held.append(data[start:])
        if end:
            rest = b"".join(held)
            if rest and scan.depth > 0:
                out.append((source, block, pos, False, single, rest.decode()))
            scan = None
        if out:
            yield batch_of(out)


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("_seq"), F.col("value").alias("_text"))


def read_entries(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(entries, bad)`` of the payload files under ``path``: the lists' entries as
    ``(source, pos, content)``, ``content`` being JSON text, and the files that are no JSON
    list as ``(source, shape)``.

    Files are split as text files are (``spark.sql.files.maxPartitionBytes``); what must fit in
    a task is an Arrow batch of rows and the longest entry.  An empty list has no entries; files
    of no bytes are not read at all.  Whether each entry is valid JSON is for the reader of
    ``content`` to see.
    """
    ship_package(spark)
    rows = _rows(spark, path)
    starts = materialize(_starts(rows.select("source", "block", "size", "_text").mapInArrow(_summaries, _SUMMARY)))
    good = starts.filter("shape = 'list'").drop("shape")
    # the rows of a range in their order, however they were joined
    told = rows.join(good.withColumnsRenamed({"source": "_s", "block": "_b"}),
                     (F.col("source") == F.col("_s")) & (F.col("block") == F.col("_b"))) \
        .sortWithinPartitions("source", "block", "_seq") \
        .select("source", "block", "inside", "depth", "pos", "final", "single", "_text")
    parts = materialize(told.mapInArrow(_parts, _PARTS))
    whole = parts.filter("whole").select("source", "pos", "single", "content")
    # at most two parts a range, and one for each range that a long entry covers
    joined = parts.filter("NOT whole").groupBy("source", "pos").agg(
        F.first("single").alias("single"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "content"))), lambda x: x["content"]), "")
        .alias("content"))
    entries = whole.unionByName(joined).filter(~(F.col("single") & (F.trim(F.translate("content", "\t\r\n", "   ")) == "")))
    files = spark.read.option("recursiveFileLookup", True).format("binaryFile").load(path) \
        .select(F.col("_metadata.file_path").alias("source"))
    known = starts.select("source", "shape").distinct()
    bad = files.join(known, "source", "left").filter("shape IS NULL OR shape <> 'list'") \
        .select("source", F.coalesce("shape", F.lit("unparsable")).alias("shape"))
    return entries.select("source", "pos", "content"), bad


def read_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(records, rejected)``: object entries as ``(source, pos, rec)``, ``rec`` a VARIANT, for
    ``payloads.to_columns``; and ``(source, pos, reason, content)`` of files that are no list
    (``pos`` and content null: they may be long) and entries that are no object."""
    entries, bad = read_entries(spark, path)
    rec = entries.withColumn("rec", F.try_parse_json("content"))
    is_object = F.coalesce(F.schema_of_variant("rec").startswith("OBJECT"), F.lit(False))
    why = F.when(F.col("rec").isNull(), "record is unparsable").otherwise("record is no object")
    rejected = bad.select("source", F.lit(None).cast("long").alias("pos"), F.concat(F.lit("payload is "), "shape").alias("reason"),
                          F.lit(None).cast("string").alias("content")) \
        .unionByName(rec.filter(~is_object).select("source", "pos", why.alias("reason"), "content"))
    return rec.filter(is_object).select("source", "pos", "rec"), rejected
