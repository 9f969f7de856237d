"""A task's disk-backed priority queue of fixed-width tuples.

Tuples are pushed in blocks of arrays and popped in blocks in ascending order of
their first two columns.  Beyond ``limit`` tuples the buffer is sorted and
written as a run to a temporary file of the task; popping merges the runs, of
which one block each is in memory.  Runs go with the queue.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 14


class Spool:
    def __init__(self, kinds: list[type], limit: int = 1 << 20, block: int = BLOCK):
        self.kinds, self.limit, self.block = [np.dtype(k) for k in kinds], limit, block
        self.held: list[list[np.ndarray]] = []
        self.count, self.runs = 0, []

    def push(self, cols: list[np.ndarray]) -> None:
        if len(cols[0]):
            self.held.append(cols)
            self.count += len(cols[0])
            if self.count >= self.limit:
                self._spill()

    def _sorted(self) -> list[np.ndarray]:
        cols = [np.concatenate(c) if self.held else np.zeros(0, k) for c, k in zip(zip(*self.held), self.kinds)] if self.held else [np.zeros(0, k) for k in self.kinds]
        o = np.lexsort((cols[1], cols[0]))
        return [c[o] for c in cols]

    def _spill(self) -> None:
        f = tempfile.TemporaryFile()
        cols = self._sorted()
        for a in range(0, len(cols[0]), self.block):
            part = [c[a:a + self.block].astype(k) for c, k in zip(cols, self.kinds)]
            f.write(np.int64(len(part[0])).tobytes() + b"".join(c.tobytes() for c in part))
        f.seek(0)
        self.runs.append(f)
        self.held, self.count = [], 0

    def _read(self, f) -> list[np.ndarray] | None:
        n = f.read(8)
        if not n:
            f.close()
            return None
        n = int(np.frombuffer(n, np.int64)[0])
        return [np.frombuffer(f.read(n * k.itemsize), k) for k in self.kinds]

    def pop_all(self) -> Iterator[list[np.ndarray]]:
        """Blocks of columns in ascending order; the queue is empty afterwards."""
        if not self.runs:
            cols = self._sorted()
            self.held, self.count = [], 0
            for a in range(0, len(cols[0]), self.block):
                yield [c[a:a + self.block] for c in cols]
            return
        if self.held:
            self._spill()
        heads = [(f, b) for f in self.runs if (b := self._read(f)) is not None]
        self.runs = []
        while heads:
            # all tuples up to the smallest of the blocks' last ones are here
            last = min((int(b[0][-1]), int(b[1][-1])) for _, b in heads)
            out, rest = [], []
            for f, b in heads:
                k = int(np.count_nonzero((b[0] < last[0]) | ((b[0] == last[0]) & (b[1] <= last[1]))))
                out.append([c[:k] for c in b])
                b = [c[k:] for c in b] if k < len(b[0]) else self._read(f)
                if b is not None:
                    rest.append((f, b))
            heads = rest
            cols = [np.concatenate(c) for c in zip(*out)]
            o = np.lexsort((cols[1], cols[0]))
            cols = [c[o] for c in cols]
            for a in range(0, len(o), self.block):
                yield [c[a:a + self.block] for c in cols]
