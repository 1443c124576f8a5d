"""Substring dedup with difference-cover anchors.

A window is ``WIDTH`` consecutive words of one document; a word goes when a window over
it also starts earlier (smaller id, or further up in the same document).

Anchors are windows of ``ANCHOR`` words at the positions whose residue modulo ``PERIOD``
is in a difference cover: any two positions have a shift below ``PERIOD`` that brings
both onto the cover, so two equal windows always share an anchor at the same place in
both (``ANCHOR + PERIOD - 1 <= WIDTH``).  Only 4 of 13 positions are hashed and shuffled
to find the anchors that repeat; a window is extended to its full width, and shuffled,
only if it holds a repeated anchor.

What is shuffled is packed: a row holds the anchors (or windows, or positions) that one
task has for one bucket, as arrays.  Before, whatever repeats inside the task is resolved
there and leaves one representative, so a passage that a third of the documents hold
reaches its bucket once a task.  There are as many buckets as shuffle partitions (more
would leave a task's packed rows small and many); a task holds one bucket at a time, and
of its texts one packed row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapworks.llm import words
from lapworks.llm.common import doc_key, prepare, shuffle_partitions, table
from lapworks.llm.packed import (batch_of, bucket_of, key_bucket, keys_in, keys_out, large, pos_in, pos_out, small,
                                 split)

WIDTH = 20
PERIOD = 13
COVER = (0, 1, 3, 9)      # differences of these give every residue modulo 13
ANCHOR = WIDTH - PERIOD + 1
CHUNK = 1 << 19           # anchors that a task compares among themselves at a time
PACK_BYTES = 16 << 20     # text that a task gathers before it packs it by bucket
LEAST_BUCKETS = 8

ALONE, FIRST, AGAIN = 0, 1, 2      # in the task: seen once, first of several, a later one
_TEXTS = "db int, ids binary, named binary, ends binary, text binary"
_MARKS = "db int, n int, base long, ids binary, pos binary"
_KEYS = "bucket int, db int, n int, base long, ids binary, pos binary, keys binary, state binary"


# ------------------------------------------------------------------ packing
def _marks(ids: np.ndarray, pos: np.ndarray, dbs: int) -> list[tuple]:
    out = []
    for db, rows in split(bucket_of(ids, dbs), dbs):
        base, packed = small(ids[rows])
        out.append((db, len(rows), base, packed, pos_out(pos[rows])))
    return out


def _keys(key: np.ndarray, width: int, bucket: np.ndarray, ids, pos, state, buckets: int, dbs: int) -> pa.RecordBatch:
    """Packed rows: open ones by the bucket of their key, resolved ones by document."""
    done = state == AGAIN
    out = []
    for db, n, base, i, p in _marks(ids[done], pos[done], dbs):
        out.append(((db * 31 + int(base)) % buckets, db, n, base, i, p, None, None))
    key, bucket, ids, pos, state = (v[~done] for v in (key, bucket, ids, pos, state))
    for b, rows in split(bucket, buckets):
        base, i = small(ids[rows])
        out.append((b, None, len(rows), base, i, pos_out(pos[rows]), keys_out(key[rows], width),
                    state[rows].astype(np.int8).tobytes()))
    return batch_of(out, _KEYS)


def _compare(key: np.ndarray, key2: np.ndarray | None, ids: np.ndarray, pos: np.ndarray):
    """Order by key, id, place (equal rows once), and of each row the first of its key."""
    order = np.lexsort((pos, ids, key) if key2 is None else (pos, ids, key2, key))
    key, ids, pos = key[order], ids[order], pos[order]
    key2 = key2[order] if key2 is not None else None
    same = np.zeros(len(key), dtype=bool)
    same[1:] = key[1:] == key[:-1]
    if key2 is not None:
        same[1:] &= key2[1:] == key2[:-1]
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = ~same[1:] | (ids[1:] != ids[:-1]) | (pos[1:] != pos[:-1])
    key, ids, pos, same = key[fresh], ids[fresh], pos[fresh], same[fresh]
    state = np.where(same, AGAIN, ALONE)
    state[np.flatnonzero(same[1:] & ~same[:-1])] = FIRST
    return key, (key2[fresh] if key2 is not None else None), ids, pos, state


# ------------------------------------------------------------------ steps
def _pack_texts(dbs: int):
    """``_id, text, doc_id`` to the texts of each document bucket, compressed."""
    def run(batches):
        codec = pa.Codec("zstd", compression_level=3)
        held, size = {}, 0

        def flush():
            out = []
            for db, docs in held.items():
                text = b"".join(t for _, _, t in docs)
                out.append((db, np.array([i for i, _, _ in docs], "<i8").tobytes(),
                            bytes(n for _, n, _ in docs), np.cumsum([len(t) for _, _, t in docs]).astype("<i8").tobytes(),
                            codec.compress(text, asbytes=True) if text else b""))
                if len(out) == 64:
                    yield batch_of(out, _TEXTS)
                    out = []
            if out:
                yield batch_of(out, _TEXTS)
            held.clear()

        for b in batches:
            ids = words.ids_of(b.column(0))
            named = b.column(2).is_valid().to_pylist()
            buf, off = words.buffers(b.column(1))
            raw = memoryview(buf)
            for k, db in enumerate(bucket_of(ids, dbs).tolist()):
                t = bytes(raw[off[k]:off[k + 1]])
                held.setdefault(db, []).append((int(ids[k]), named[k], t))
                size += len(t) + 64
                if size > PACK_BYTES:
                    yield from flush()
                    size = 0
        yield from flush()
    return run


def _texts(t: pa.Table):
    """Of each packed row: ids, whether each is the document's own, bytes, offsets."""
    codec = pa.Codec("zstd")
    for row in t.select(["ids", "named", "ends", "text"]).to_pylist():
        ids = np.frombuffer(row["ids"], "<i8")
        off = np.concatenate([[0], np.frombuffer(row["ends"], "<i8")])
        buf = np.frombuffer(codec.decompress(row["text"], int(off[-1])), np.uint8) if off[-1] else np.zeros(0, np.uint8)
        yield ids, np.frombuffer(row["named"], np.uint8).astype(bool), buf, off


def _anchors(buckets: int, dbs: int):
    def run(batches):
        cover = np.zeros(PERIOD, dtype=bool)
        cover[list(COVER)] = True
        parts, held = [], 0

        def flush():
            key, ids, pos = (np.concatenate(c) for c in zip(*parts))
            key, _, ids, pos, state = _compare(key, None, ids, pos)
            back = np.lexsort((pos, ids))            # by document: ids and places pack well
            key = key[back]
            return _keys(key, 5, key_bucket(key, buckets), ids[back], pos[back], state[back], buckets, dbs)

        for b in batches:
            ids = words.ids_of(b.column(0))
            buf, off = words.buffers(b.column(1))
            for i, j in words.slices(off):
                h, at = words.word_hashes(buf, off[i:j + 1])
                n = len(h) - ANCHOR + 1
                if n <= 0:
                    continue
                row, place = words.within(at)
                take = np.flatnonzero(cover[place[:n] % PERIOD] & (place[:n] + ANCHOR <= np.diff(at)[row[:n]]))
                parts.append((words.window_hashes(h, ANCHOR)[take], ids[i:j][row[take]], place[take]))
                held += len(take)
                if held >= CHUNK:
                    yield flush()
                    parts, held = [], 0
        if held:
            yield flush()
    return run


def _meet(width: int, later: bool, dbs: int):
    """Rows by bucket to marked places, by document: of ``later``, all but the first place
    of each key; else every place of a key that has several."""
    def run(batches):
        marked, held, rows, at = [], 0, [], None

        def resolve():
            cols = []
            for r in rows:
                n = r["n"]
                cols.append((keys_in(r["keys"], n, width), large(r["base"], r["ids"], n), pos_in(r["pos"], n),
                             np.frombuffer(r["state"], np.int8)))
            key, ids, pos, state = (np.concatenate(c) for c in zip(*cols))
            if later:
                _, _, ids, pos, state = _compare(key, None, ids, pos)
                hit = state == AGAIN
            else:
                order = np.argsort(key, kind="stable")
                key, ids, pos, state = key[order], ids[order], pos[order], state[order]
                same = key[1:] == key[:-1]
                hit = state == FIRST
                hit[1:] |= same
                hit[:-1] |= same
            marked.append((ids[hit], pos[hit]))
            return int(hit.sum())

        def flush():
            ids, pos = (np.concatenate(c) for c in zip(*marked))
            marked.clear()
            order = np.lexsort((pos, ids))
            return batch_of(_marks(ids[order], pos[order], dbs), _MARKS)

        for b in batches:
            ready = b.filter(b.column(1).is_valid())
            if ready.num_rows:
                yield ready.select(["db", "n", "base", "ids", "pos"])
            for r in b.filter(b.column(1).is_null()).to_pylist():
                if r["bucket"] != at and rows:
                    held += resolve()
                    rows = []
                    if held >= CHUNK:
                        yield flush()
                        held = 0
                at = r["bucket"]
                rows.append(r)
        if rows:
            resolve()
        if marked:
            yield flush()
    return run


def _places(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Marked places, by id."""
    if not t.num_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    got = [(large(r["base"], r["ids"], r["n"]), pos_in(r["pos"], r["n"]))
           for r in t.select(["n", "base", "ids", "pos"]).to_pylist()]
    ids, pos = (np.concatenate(c) for c in zip(*got))
    order = np.argsort(ids, kind="stable")
    return ids[order], pos[order]


def _of_rows(ids: np.ndarray, mark_ids: np.ndarray, mark_pos: np.ndarray):
    """Marks of the rows ``ids``: the row, the place (a row that repeats an id gets all)."""
    lo, hi = np.searchsorted(mark_ids, ids, "left"), np.searchsorted(mark_ids, ids, "right")
    n = hi - lo
    row = np.repeat(np.arange(len(ids)), n)
    return row, mark_pos[lo[row] + np.arange(len(row)) - (np.cumsum(n) - n)[row]]


def _windows(buckets: int, dbs: int):
    """Full windows that hold a repeated anchor, of one document bucket."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        mark_ids, mark_pos = _places(right)
        parts = []
        for ids, _, buf, off in _texts(left) if len(mark_ids) else ():
            for i, j in words.slices(off):
                row_of, marks = _of_rows(ids[i:j], mark_ids, mark_pos)
                if not len(marks):
                    continue
                h, at = words.word_hashes(buf, off[i:j + 1])
                n = len(h) - WIDTH + 1
                if n <= 0:
                    continue
                row, place = words.within(at)
                inside = marks < np.diff(at)[row_of]      # (rows that repeat an id may differ in length)
                marks = (marks + at[row_of])[inside]
                # anchors lie 0 .. PERIOD - 1 words into their windows
                delta = np.bincount(np.maximum(marks - PERIOD + 1, 0), minlength=len(h) + 1) \
                    - np.bincount(marks + 1, minlength=len(h) + 1)
                take = np.flatnonzero((np.cumsum(delta)[:n] > 0) & (place[:n] + WIDTH <= np.diff(at)[row[:n]]))
                parts.append((words.window_hashes(h, WIDTH)[take], words.window_hashes(h, WIDTH, words.BASE_B)[take],
                              ids[i:j][row[take]], place[take]))
        if not parts:
            return pa.Table.from_batches([batch_of([], _KEYS)])
        key, second, ids, pos, state = _compare(*[np.concatenate(c) for c in zip(*parts)])
        back = np.lexsort((pos, ids))
        bucket = (second[back] % np.uint64(buckets)).astype(np.int64)
        return pa.Table.from_batches([_keys(key[back], 8, bucket, ids[back], pos[back], state[back], buckets, dbs)])
    return run


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _cut(left: pa.Table, right: pa.Table) -> pa.Table:
    """The result's rows of one document bucket."""
    mark_ids, mark_pos = _places(right)
    out = []
    for ids, named, buf, off in _texts(left):
        lo, hi = np.searchsorted(mark_ids, ids, "left"), np.searchsorted(mark_ids, ids, "right")
        raw = memoryview(buf)
        for k in range(len(ids)):
            ws = bytes(raw[off[k]:off[k + 1]]).split()
            n = len(ws)
            marks = mark_pos[lo[k]:hi[k]]
            marks = marks[marks < n]
            if len(marks):
                delta = np.bincount(marks, minlength=n + 1) - np.bincount(np.minimum(marks + WIDTH, n), minlength=n + 1)
                ws = [w for w, gone in zip(ws, (np.cumsum(delta)[:-1] > 0).tolist()) if not gone]
            kept = b" ".join(ws)
            out.append((int(ids[k]) if named[k] else None, n, n - len(ws), hashlib.sha256(kept).hexdigest(),
                        kept.decode("utf-8", "replace")))
    return pa.Table.from_batches([batch_of(out, _RESULT)])


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept``: the words of each document, how
    many of them go, the others joined by one space and that text's SHA-256.

    Windows are judged on the input, not on what is left.  Null text: no words.  Ids are
    expected to be unique; rows that repeat an id count as one document and share their
    positions, so equal rows give equal results and none goes because of the other.
    Null ids sort after all others, among themselves by a hash of the text.  Texts under
    ``WIDTH`` words stay whole.  Other columns are not read.  An anchor's key may be met
    by chance (that costs one hash of a full window); a full window has 64 key bits
    besides those that choose its bucket.
    """
    spark = docs.sparkSession
    prepare(spark)
    buckets = dbs = max(LEAST_BUCKETS, shuffle_partitions(spark))
    rows = docs.select(doc_key(id_col, text_col).alias("_id"), F.col(text_col).cast("string").alias("_t"),
                       F.col(id_col).cast("long").alias("doc_id"))
    texts = rows.mapInArrow(_pack_texts(dbs), _TEXTS)      # one shuffle, read by both cogroups
    anchors = rows.select("_id", "_t").mapInArrow(_anchors(buckets, dbs), _KEYS)
    by_bucket = lambda d: d.repartition("bucket").sortWithinPartitions("bucket")
    repeated = by_bucket(anchors).mapInArrow(_meet(5, False, dbs), _MARKS)
    windows = texts.groupBy("db").cogroup(repeated.groupBy("db")).applyInArrow(_windows(buckets, dbs), _KEYS)
    later = by_bucket(windows).mapInArrow(_meet(8, True, dbs), _MARKS)
    return texts.groupBy("db").cogroup(later.groupBy("db")).applyInArrow(_cut, _RESULT)


def query(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
