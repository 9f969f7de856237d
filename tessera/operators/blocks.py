"""Numeric columns packed into binary row blocks for numpy jobs.

A job over vectors (gradients, k-means, Gram matrices, network passes) packs
its rows once: each Arrow batch becomes one row holding a row-major float64
matrix.  The packed table is cached, so an iteration reads matrices and builds
no Python object per row.  Every width takes the same path, and a vector of
another length raises in the JVM.

A pass emits ONE row per task, the task's sums as a binary array, and the rows
are added in a tree of fan-in ``FAN_IN``, so that neither a reducer nor the
driver ever holds more than ``FAN_IN`` of them at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN_IN = 64
#: rows of one packed matrix
BLOCK_ROWS = 4096


def checked(col: Column, d: int) -> Column:
    """``col`` as ``array<double>``; raises unless it has exactly ``d`` elements."""
    size = F.coalesce(F.size(col), F.lit(-1))
    said = F.concat(F.lit(f"vector of {d} elements expected, found "), size.cast("string"))
    return F.when(size == d, col.cast("array<double>")).otherwise(F.raise_error(said).cast("array<double>"))


def list_matrix(col: pa.Array, d: int) -> np.ndarray:
    """An Arrow list column of ``d`` doubles a row as a matrix, without a copy."""
    flat = col.flatten()
    flat = flat.to_numpy(zero_copy_only=False) if not flat.null_count else flat.fill_null(float("nan")).to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), d)


def squeezed(x: np.ndarray, kind: str) -> bytes:
    """Numbers column by column, in planes of bytes: the first bytes of a column are alike."""
    columns = np.ascontiguousarray(x.T, kind)
    planes = columns.view(np.uint8).reshape(-1, columns.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unsqueezed(data: bytes, kind: str, rows: int, columns: int | None = None) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, size * rows * (columns or 1), codec="zstd", asbytes=True), np.uint8)
    flat = np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel()
    return flat if columns is None else flat.reshape(columns, rows).T


class Blocks:
    """Cached packed columns; ``dims`` gives the width of each, 0 for a scalar."""

    def __init__(self, df: DataFrame, dims: dict[str, int]):
        self.dims = {c: max(d, 1) for c, d in dims.items()}
        cols = [checked(F.col(c), d).alias(c) if d else F.array(F.col(c).cast("double")).alias(c) for c, d in dims.items()]
        widths = list(self.dims.values())

        def pack(batches):
            for b in batches:
                for a in range(0, b.num_rows, BLOCK_ROWS):
                    part = b.slice(a, BLOCK_ROWS)
                    m = np.hstack([list_matrix(part.column(i), d) for i, d in enumerate(widths)])
                    yield pa.RecordBatch.from_arrays([pa.array([m.tobytes()], pa.binary())], ["m"])
        self.df = df.select(*cols).mapInArrow(pack, "m binary").cache()
        self.parts = self.df.rdd.getNumPartitions()

    def unpersist(self) -> None:
        self.df.unpersist()

    def sums(self, fn: Callable[[Iterator[list[np.ndarray]]], np.ndarray]) -> np.ndarray:
        """``fn`` maps a task's blocks (one matrix per column) to an array of
        sums; returns the total over all tasks."""
        return self.merged(fn, np.add)

    def merged(self, fn: Callable[[Iterator[list[np.ndarray]]], np.ndarray], merge: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """One array per task, two at a time merged into one of the same size."""
        widths = list(self.dims.values())
        cut = np.cumsum(widths)[:-1]

        def run(batches):
            def blocks():
                for b in batches:
                    for m in b.column(0):
                        yield np.split(np.frombuffer(m.as_buffer(), np.float64).reshape(-1, sum(widths)), cut, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([np.asarray(fn(blocks()), np.float64).tobytes()], pa.binary())], ["v"])

        def join(batches):
            got = None
            for b in batches:
                for v in b.column(0):
                    x = np.frombuffer(v.as_buffer(), np.float64)
                    got = x.copy() if got is None else merge(got, x)
            if got is not None:
                yield pa.RecordBatch.from_arrays([pa.array([got.tobytes()], pa.binary())], ["v"])
        parts, n = self.df.mapInArrow(run, "v binary"), self.parts
        while n > FAN_IN:
            n = -(-n // FAN_IN)
            parts = parts.repartition(n).mapInArrow(join, "v binary")
        got = None
        for r in parts.collect():  # at most FAN_IN rows
            x = np.frombuffer(r["v"], np.float64)
            got = x if got is None else merge(got, x)
        return got if got is not None else 0.0


def blocks_of(data: DataFrame | Blocks, dims: dict[str, int]) -> tuple[Blocks, bool]:
    """``data`` itself if it is packed, else its packed form; whether it was packed here."""
    return (data, False) if isinstance(data, Blocks) else (Blocks(data, dims), True)


def first_size(df: DataFrame, col: str) -> int | None:
    """Length of the first non-null vector, None for an empty table."""
    r = df.where(F.col(col).isNotNull()).select(F.size(col).alias("n")).first()
    return None if r is None else int(r["n"])
