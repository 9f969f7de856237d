"""Small numpy helpers that tasks run on one Arrow batch of texts.

Texts are handled as UTF-8 bytes; ``slices`` cuts a batch into runs of whole
texts of a few MB, so that the scratch arrays of a task stay bounded by the
longest single text and not by the batch.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 19

#: separators of `[^\x20\x09-\x0D]+`
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, all other bytes kept
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BYTE = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) ^ np.uint64(0x2545F4914F6CDD1D)
_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64) on a uint64 array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TABLES = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the base of the hashes and of its inverse modulo
    2^64; kept for the life of the process and grown to the longest slice."""
    if len(_TABLES[0]) < n:
        size = 1 << n.bit_length()
        _TABLES[:] = [powers(_BASE, size), powers(_INVERSE, size)]
    return _TABLES[0], _TABLES[1]


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    k = 1
    while k < n:  # doubling: out[k:2k] = out[:k] * base^k
        m = min(k, n - k)
        out[k:k + m] = out[:m] * (out[k - 1:k] * base)
        k += m
    return out


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(uint8 data, int64 offsets) of a string or binary column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
        col = pc.cast(pc.fill_null(col, ""), pa.large_string())
    else:
        col = pc.cast(pc.fill_null(col, b""), pa.large_binary())
    _, off, data = col.buffers()
    if len(col) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offs = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of whole texts holding at most ``limit`` bytes, or one text."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, side="right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def words(data: np.ndarray, offs: np.ndarray, sep: np.ndarray = SPACE, heads: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """Words of consecutive texts: (text index, start, end, 64-bit hash) arrays,
    and a hash of the first k bytes of each word for every k in ``heads``.

    ``data`` must be lower-cased already; a word never crosses a text end.
    """
    n = len(data)
    z = np.zeros(0, np.int64)
    empty = (z, z, z, *[np.zeros(0, np.uint64)] * (1 + len(heads)))
    if n == 0:
        return empty
    inside = ~sep[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    starts_of_text = offs[:-1][offs[:-1] < n]
    first[starts_of_text] = inside[starts_of_text]
    before = starts_of_text[starts_of_text > 0] - 1
    last[before] = inside[before]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(start):
        return empty
    power, inverse = tables(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:n], out=total[1:])
    back, low = inverse[start], total[start]
    text = np.searchsorted(offs, start, side="right") - 1
    out = []
    for m in (n, *heads):
        stop = np.minimum(end, start + m)
        out.append(mix((total[stop] - low) * back ^ ((stop - start).astype(np.uint64) * _GOLDEN)))
    return text, start, end, *out


def shingles(text: np.ndarray, h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, 64-bit hash) of all runs of ``width`` words; a text with
    fewer words, but not none, gives its whole sequence as one."""
    n = len(h)
    if n == 0:
        return text, h
    out_t, out_h = [], []
    if n >= width:
        acc = h[:n - width + 1].copy()
        for j in range(1, width):
            acc *= _BASE
            acc += h[j:n - width + 1 + j]
        acc = mix(acc)
        ok = text[:n - width + 1] == text[width - 1:]
        out_t.append(text[:n - width + 1][ok])
        out_h.append(acc[ok])
    ids, at, cnt = np.unique(text, return_index=True, return_counts=True)
    for i, a, c in zip(*(x[cnt < width] for x in (ids, at, cnt))):
        acc = h[a:a + 1].copy()
        for j in range(1, c):
            acc = acc * _BASE + h[a + j:a + j + 1]
        out_t.append(np.array([i]))
        out_h.append(mix(acc + np.uint64(c)))
    t, s = np.concatenate(out_t), np.concatenate(out_h)
    o = np.argsort(t, kind="stable")
    return t[o], s[o]


@cache
def _trim():
    """glibc's ``malloc_trim``, where there is one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


#: what tasks keep in their worker for later tasks of their kind
_HELD: dict = {}


def held(key, build: Callable):
    """``build()``, once per worker, until a task begins that doesn't keep ``key``."""
    if key not in _HELD:
        _HELD[key] = build()
    return _HELD[key]


def release(*kept) -> None:
    """Give free memory back to the system, and what is held under keys other than ``kept``.
    A Python worker serves task after task, of all operators of an application, and would
    otherwise keep the most that any of them took, beside the JVM's own peak."""
    other = [k for k in _HELD if k not in kept]
    for k in other:
        del _HELD[k]
    if other:
        gc.collect()
    pa.default_memory_pool().release_unused()
    if _trim():
        _trim()(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], *kept) -> Callable:
    """A task's function that gives free memory back before it begins, and again when all
    that it held is gone: idle workers wait a minute for another task with what they have.
    ``kept``: keys of what it holds for the next task."""
    def task(batches):
        release(*kept)
        try:
            yield from run(batches)
        finally:
            release(*kept)
    return task


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, *kept) -> DataFrame:
    """``mapInArrow`` for a function of one batch; ``kept``: see ``lean``."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                out = fn(b)
                if out is not None:
                    yield out
    return df.mapInArrow(lean(run, *kept), schema)
