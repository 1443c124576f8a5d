"""Document fingerprints by winnowing.

A text's ``k``-grams of code points get rolling hashes; of every ``window`` consecutive
hashes the least is selected, the rightmost of equal ones, and kept with its position.
Two texts that share ``k + window - 1`` code points in a row share a fingerprint, at the
places where the passage has it; a passage of fewer than ``k`` never makes one.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapworks.llm import words
from lapworks.llm.common import materialize, prepare, table
from lapworks.session import shuffle_partitions

K, WINDOW = 20, 32
LONGEST_K = 64               # beyond it polynomial hashes of two-letter patterns lose too many bits
BLOCK = 1 << 19              # code points hashed at a time
SAMPLE_PER_RANGE = 64        # keys drawn for each boundary between ranges of ids

_U = np.uint64
_SEED = _U(0x9E3779B97F4A7C15)
_LETTER = words.mix(np.arange(1 << 16, dtype=np.uint64) + _SEED)


def _letters(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    h = _LETTER[np.minimum(cp, 0xFFFF)]
    far = np.flatnonzero(cp > 0xFFFF)
    h[far] = words.mix(cp[far].astype(np.uint64) + _SEED)
    return h


def _least(h: np.ndarray, window: int) -> np.ndarray:
    """For each ``window`` consecutive hashes the place of the least, rightmost of equals."""
    n, span = len(h), 1
    at, low = np.arange(n, dtype=np.int32), h

    def join(shift):
        right = low[shift:] <= low[:len(low) - shift]
        return (np.where(right, at[shift:], at[:len(at) - shift]), np.minimum(low[shift:], low[:len(low) - shift]))

    while 2 * span <= window:
        at, low = join(span)
        span *= 2
    return join(window - span)[0] if span < window else at


def _winnow_block(h: np.ndarray, off: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Selected places in the hash lists that ``off`` bounds (each at least ``window``
    long), ascending, and their bounds by list."""
    at = _least(h, window)
    first = np.arange(len(at))
    whole = np.ones(len(at), dtype=bool)
    for cut in off[1:-1]:                                  # windows across two lists
        whole[max(cut - window + 1, 0):cut] = False
    at = at[whole]
    at = at[np.flatnonzero(np.diff(at, prepend=-1))]
    return at, np.searchsorted(at, off)


def winnow(texts: list[str], k: int = K, window: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, positions) of each text: unsigned 64-bit, code points from 0, ascending.

    A text of fewer than ``k`` code points has one k-gram, itself; one of fewer than
    ``window`` k-grams one window.  An empty text has none.  Texts are hashed together,
    a long one in blocks, so memory is bounded by the texts themselves.
    """
    if not 1 <= k <= LONGEST_K or window < 1:
        raise ValueError(f"k must be 1 to {LONGEST_K}, window at least 1")
    out: list = [None] * len(texts)
    lists, rows, size = [], [], 0

    def flush():
        nonlocal lists, rows, size
        if rows:
            pads = [max(window - len(x), 0) for x in lists]
            full = [np.concatenate([np.full(p, ~_U(0)), x]) if p else x for p, x in zip(pads, lists)]
            off = np.concatenate([[0], np.cumsum([len(x) for x in full])])
            h = np.concatenate(full)
            at, cut = _winnow_block(h, off, window)
            for j, i in enumerate(rows):
                own = at[cut[j]:cut[j + 1]]
                out[i] = (h[own], own - off[j] - pads[j])
        lists, rows, size = [], [], 0

    for i, t in enumerate(texts):
        if not t:
            out[i] = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        elif len(t) <= BLOCK:
            x = _letters(t)
            if len(t) < k:                                 # lengths differ: so do the hashes
                g = words.mix(words.window_hashes(x, len(t)) ^ _U(len(t)))
            else:
                g = words.window_hashes(x, k)
            lists.append(g)
            rows.append(i)
            size += len(t)
            if size > BLOCK:
                flush()
        else:
            hs, ps, last = [], [], -1
            windows = max(len(t) - k - window + 2, 1)
            for s in range(0, windows, BLOCK):
                h = words.window_hashes(_letters(t[s:s + BLOCK + window + k - 2]), k)
                at, _ = _winnow_block(h, np.array([0, len(h)]), window)
                new = at[at + s > last]                    # the block before may have chosen it
                if len(new):
                    hs.append(h[new])
                    ps.append(new.astype(np.int64) + s)
                    last = int(ps[-1][-1])
            out[i] = (np.concatenate(hs), np.concatenate(ps))
    flush()
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes; two empty ones are alike."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def encoded(hashes: np.ndarray, positions: np.ndarray) -> str:
    """A fingerprint as text: base64 of the positions (32-bit) and then the hashes
    (64-bit), little-endian, in order of position."""
    return base64.b64encode(positions.astype("<u4").tobytes() + hashes.astype("<u8").tobytes()).decode()


def decoded(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw = base64.b64decode(text)
    n = len(raw) // 12
    return np.frombuffer(raw, "<u8", n, 4 * n), np.frombuffer(raw, "<u4", n).astype(np.int64)


def _texts(col: pa.Array) -> list[str]:
    return [t or "" for t in col.to_pylist()]


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                 window: int = WINDOW) -> DataFrame:
    """``doc_id, n_chars, hashes, positions`` of every row (hashes as signed 64-bit).

    Null text: empty, and empty texts have no fingerprint.  Null ids and repeated rows:
    rows like any other.  Other columns of ``docs`` are not read.  No rows: no rows.
    """
    prepare(docs.sparkSession)
    names = ["doc_id", "n_chars", "hashes", "positions"]

    def run(batches):
        for b in batches:
            for i, j in words.slices(words.buffers(b.column(1))[1]):
                texts = _texts(b.column(1).slice(i, j - i))
                made = winnow(texts, k, window)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(i, j - i), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([h.view(np.int64) for h, _ in made], pa.list_(pa.int64())),
                    pa.array([p.astype(np.int32) for _, p in made], pa.list_(pa.int32()))], names)
        words.trim()

    narrow = docs.select(F.col(id_col).cast("long").alias("a"), F.col(text_col).cast("string").alias("t"))
    return narrow.mapInArrow(run, "doc_id long, n_chars long, hashes array<long>, positions array<int>")


def _ranges(keys: DataFrame, n: int):
    """A function from a row's key to its range of ids and, for the first key of a range,
    the range before (cyclically) as well, which needs it as its last document's next.

    Boundaries come from a sample by hash (``SAMPLE_PER_RANGE`` distinct keys for each
    range are expected); they only decide where rows are computed, never the result.
    """
    share = min(1.0, SAMPLE_PER_RANGE * n / max(keys.count(), 1))
    chosen = F.pmod(F.xxhash64("_z", "_o", "_h"), F.lit(1 << 30)) < int(share * (1 << 30))
    drawn = sorted(tuple(r) for r in keys.filter(chosen).distinct().collect())
    bounds = sorted({drawn[len(drawn) * i // n] for i in range(1, n)}) if drawn else []

    def range_of(z, o, h):
        return pa.array([bisect_right(bounds, key) for key in zip(z.to_pylist(), o.to_pylist(), h.to_pylist())],
                        pa.int64())

    place = F.arrow_udf(range_of, "long")
    heads = keys.groupBy(place("_z", "_o", "_h").alias("_r")).agg(F.min(F.struct("_z", "_o", "_h")).alias("_k")) \
        .orderBy("_r").collect()                                   # one row per range
    before = {tuple(x["_k"]): heads[i - 1]["_r"] for i, x in enumerate(heads)}

    def places(z, o, h):
        out = []
        for key in zip(z.to_pylist(), o.to_pylist(), h.to_pylist()):
            own = [2 * bisect_right(bounds, key)]
            if key in before:
                own.append(2 * before[key] + 1)                    # as a guest: odd
            out.append(own)
        return pa.array(out, pa.list_(pa.int64()))

    return F.arrow_udf(places, "array<long>")


def _edited(text: str, following: str) -> str:
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _compare(k: int, window: int):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def finish(held):
        """All rows of ``held`` but the last, which is only a next document."""
        texts = [t for _, _, _, t in held]
        alone = [i for i in range(len(held) - 1) if not held[i][1]]
        for i in alone:
            if held[i][0] != held[i + 1][0]:
                raise RuntimeError("a range of ids does not end with the next range's first document")
        edited = [_edited(texts[i], texts[i + 1]) for i in alone]
        own, other = winnow(texts, k, window), winnow(edited, k, window)
        cols = [[] for _ in names]
        for i, e, fe in zip(alone, edited, other):
            row = (held[i][2], len(texts[i]), hashlib.sha256(e.encode()).hexdigest(), encoded(*own[i]), encoded(*fe),
                   likeness(own[i][0], fe[0]), likeness(own[i][0], own[i + 1][0]))
            for c, v in zip(cols, row):
                c.append(v)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    def run(batches):
        held, size = [], 0                                         # range, guest, id, text
        for b in batches:
            for i, j in words.slices(words.buffers(b.column(3))[1]):
                part = [b.column(c).slice(i, j - i).to_pylist() for c in range(3)]
                for r, g, d, t in zip(*part, _texts(b.column(3).slice(i, j - i))):
                    if held and held[-1][1] and g and held[-1][0] == r:
                        continue                                   # repeats of a guest: the first is the next
                    held.append((r, g, d, t))
                    size += len(t)
                    if size > BLOCK and len(held) > 1:
                        yield finish(held)
                        held, size = held[-1:], len(t)
        if len(held) > 1:
            yield finish(held)
        words.trim()
    return run


def edit_check(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = K,
               window: int = WINDOW) -> DataFrame:
    """Fingerprints of each document and of an edited form of it: the last third of its
    code points replaced by the first as many (or all) of the next document, by descending
    id; after the last comes the first.  ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next`` (``likeness`` to the edited text's and to
    the next document's).

    Texts move once, to ranges of ids, each range streamed in order.  The first document of
    a range also goes to the range before it.

    Null text: empty.  Null ids come after all others, by a hash of the text; rows that
    share an id likewise, so repeated rows are each other's next.  A single row is its own
    next.  Other columns of ``docs`` are not read.  No rows: no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    n = shuffle_partitions(spark)
    doc_id = F.col(id_col).cast("long")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = {"_z": F.when(doc_id.isNull(), 1).otherwise(0), "_o": F.coalesce(F.bitwise_not(doc_id), F.lit(0)),
           "_h": F.xxhash64(text)}
    keys = materialize(docs.select(*[c.alias(name) for name, c in key.items()]))
    places = _ranges(keys, n)
    rows = docs.select(doc_id.alias("_id"), text.alias("_t"), *[c.alias(name) for name, c in key.items()]) \
        .withColumn("_at", F.explode(places("_z", "_o", "_h"))) \
        .withColumns({"_r": F.expr("_at div 2"), "_g": F.col("_at") % 2 == 1})
    ordered = rows.repartitionById(n, F.col("_r").cast("int")).sortWithinPartitions("_r", "_g", "_z", "_o", "_h", "_t")
    return ordered.select("_r", "_g", "_id", "_t").mapInArrow(
        _compare(k, window), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double")


def query(spark, sf_dir):
    return edit_check(table(spark, sf_dir, "documents"))
