"""Arrays in the rows of a shuffle.

A row for each number would cost a shuffle 20 and more bytes apiece; a task's numbers for
one bucket, as arrays in one row, cost little more than their significant bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from lapworks.llm import words

def small(v: np.ndarray) -> tuple[int, bytes]:
    """Integers as their least one and 32-bit (else 64-bit) differences from it."""
    if not len(v):
        return 0, b""
    base = int(v.min())
    d = v.astype(np.uint64) - np.uint64(base % (1 << 64))
    return base, (d.astype("<u4") if d.max() < 1 << 32 else d.astype("<u8")).tobytes()


def large(base: int, data: bytes, n: int) -> np.ndarray:
    d = np.frombuffer(data, "<u8" if len(data) == 8 * n else "<u4").astype(np.uint64)
    return (d + np.uint64(base % (1 << 64))).view(np.int64)


def pos_out(pos: np.ndarray) -> bytes:
    return pos.astype("<u2" if not len(pos) or pos.max() < 1 << 16 else "<u4").tobytes()


def pos_in(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype(np.int64)


def bucket_of(ids: np.ndarray, n: int) -> np.ndarray:
    return (words.mix(ids.astype(np.uint64) ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(n)).astype(np.int64)


def split(by: np.ndarray, n: int):
    """Row numbers of each value of ``by`` that occurs, in their order."""
    order = np.argsort(by, kind="stable")
    at = np.searchsorted(by[order], np.arange(n + 1))
    for v in np.flatnonzero(np.diff(at)):
        yield int(v), order[at[v]:at[v + 1]]


def keys_out(key: np.ndarray, width: int) -> bytes:
    """The ``width`` high bytes of each 64-bit key."""
    return np.ascontiguousarray(key).view(np.uint8).reshape(-1, 8)[:, 8 - width:].tobytes()


def keys_in(data: bytes, n: int, width: int) -> np.ndarray:
    k = np.zeros((n, 8), np.uint8)
    k[:, 8 - width:] = np.frombuffer(data, np.uint8).reshape(n, width)
    return k.view(np.uint64).ravel()


def key_bucket(key: np.ndarray, n: int) -> np.ndarray:
    """By the low bits of the key, which ``keys_out`` leaves out first."""
    return ((key & np.uint64(0xFFFFFF)) % np.uint64(n)).astype(np.int64)


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    cols = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(cols, fields)], [n for n, _ in fields])
