"""Numpy kernels over Arrow text: words, word hashes, window hashes.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09``-``\\x0D`` (UTF-8, so
multi-byte characters are never cut).  All hashing is deterministic.  Texts are
handled in slices of a few MB, so the memory of a task is bounded by its longest
single text, never by the number of rows in an Arrow batch.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
NULL_ID = -(1 << 63)          # stands for a null id inside the operators

_U = np.uint64
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32                     # A-Z hash as a-z
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)      # the n lowest bytes of 8
BASE_A, BASE_B = 0x9E3779B97F4A7C17, 0xD1B54A32D192ED07
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = BASE_A) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64, for i in [0, n); grown on demand."""
    got = _powers.get(base)
    if got is None or len(got[0]) < n:
        m = max(n, 1 << 16)
        inv = pow(base, -1, 1 << 64)
        one = np.ones(1, dtype=np.uint64)
        got = tuple(np.concatenate([one, np.cumprod(np.full(m - 1, b, dtype=np.uint64))]) for b in (base, inv))
        _powers[base] = got
    return got


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (murmur3's)."""
    x = x ^ (x >> _U(33))
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


def trim() -> None:
    """Gives freed memory back to the system: workers are reused, and an operator should
    not start with what the one before has left."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):      # another C library
        pass


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a text column; a null text is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    col = col.cast(pa.large_binary())
    off = np.frombuffer(col.buffers()[1], dtype=np.int64, count=len(col) + 1 + col.offset)[col.offset:]
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, off


def slices(off: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges [a, b) whose texts have at most ``limit`` bytes, or one row."""
    a, n = 0, len(off) - 1
    while a < n:
        b = int(np.searchsorted(off, off[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def _scan(c: np.ndarray, cuts: np.ndarray):
    """Word starts and ends in ``c``; no word goes over a position of ``cuts``."""
    sp = _IS_SPACE[c]
    before = np.empty(len(c), dtype=bool)
    before[0] = True
    before[1:] = sp[:-1]
    after = np.empty(len(c), dtype=bool)
    after[-1] = True
    after[:-1] = sp[1:]
    cuts = cuts[(cuts > 0) & (cuts < len(c))]
    before[cuts] = True
    after[cuts - 1] = True
    w = ~sp
    return np.flatnonzero(w & before), np.flatnonzero(w & after) + 1


def _hash_runs(c: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hashes of the byte runs ``[s, e)``: their 8-byte blocks, each mixed with its place,
    are added up and mixed with the length.  Mixing is not linear, so no pattern of bytes
    makes different words meet."""
    if not len(s):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([c, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(c) + 1, "<u8", padded, strides=(1,))          # from each byte on
    n = e - s
    blocks = (n + 7) >> 3
    first = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    if blocks.max() == 1:
        v, place = eight[s] & _KEEP[n], np.zeros(1, np.int64)
    else:
        word = np.repeat(np.arange(len(s)), blocks)
        place = np.arange(len(word)) - first[word]
        v = eight[s[word] + 8 * place] & _KEEP[np.minimum(n[word] - 8 * place, 8)]
    v = mix(v ^ mix((place + 1).astype(np.uint64) * _U(BASE_A)))
    if len(v) > len(s):
        v = np.add.reduceat(v, first)
    return mix(v + n.astype(np.uint64) * _U(BASE_B))


def word_hashes(buf: np.ndarray, off: np.ndarray, fold: bool = False):
    """Hashes of all words of the texts ``off`` bounds, and the words' offsets by
    text (n + 1).  ``fold`` takes A-Z as a-z."""
    lo, hi = int(off[0]), int(off[-1])
    hs, ss = [], []
    at = lo
    while at < hi:
        end = min(at + SLICE_BYTES, hi)
        while end < hi and not _IS_SPACE[buf[end]]:      # a long text is cut between words
            nxt = np.flatnonzero(_IS_SPACE[buf[end:end + SLICE_BYTES]])
            end = end + int(nxt[0]) if len(nxt) else min(end + SLICE_BYTES, hi)
        c = buf[at:end]
        s, e = _scan(c, off - at)
        hs.append(_hash_runs(_FOLDED[c] if fold else c, s, e))
        ss.append(s + at)
        at = end
    h = np.concatenate(hs) if hs else np.zeros(0, np.uint64)
    starts = np.concatenate(ss) if ss else np.zeros(0, np.int64)
    return h, np.searchsorted(starts, off, side="left").astype(np.int64)


def word_counts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    out = []
    for a, b in slices(off):
        o = off[a:b + 1]
        if o[-1] == o[0]:
            out.append(np.zeros(b - a, np.int64))
            continue
        s, _ = _scan(buf[o[0]:o[-1]], o - o[0])
        out.append(np.diff(np.searchsorted(s, o - o[0], side="left")).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def window_hashes(h: np.ndarray, width: int, base: int = BASE_A) -> np.ndarray:
    """Hash of each window of ``width`` words, by its first word."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    p, inv = powers(len(h) + 1, base)
    acc = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * p[:len(h)], out=acc[1:])
    return mix((acc[width:] - acc[:n]) * inv[:n])


def ids_of(col: pa.Array) -> np.ndarray:
    """Integer ids; null becomes ``NULL_ID``."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return pc.fill_null(col.cast(pa.int64()), NULL_ID).to_numpy(zero_copy_only=False)


def within(off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element of the lists ``off`` bounds: its list, its place in it."""
    n = np.diff(off)
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(int(off[-1] - off[0])) - (off[:-1] - off[0])[row]
