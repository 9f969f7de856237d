"""Cutting texts for byte-level BPE at places where no pre-token can reach, and
a task's memory of the pieces.

In the public pattern a single space or newline between two other characters
begins a pre-token, and so does a comma or full stop after a letter.  A text is
the concatenation of its segments cut there, each encodes by itself, and equal
segments encode equally.  Segments are found, hashed and looked up as arrays; only
those that a task hasn't met yet are encoded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from .textbatch import _BYTE, mix, slices, tables, text_bytes

#: segments that a worker remembers (about 60 bytes each) before it starts afresh
CACHE_ENTRIES = 1_500_000
#: new segments gathered before they are sorted into the rest
RECENT = 1 << 17
#: segments longer than this aren't remembered
CACHE_LEN = 64

_SPACE = np.zeros(256, bool)
_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
#: first bytes of the characters beyond ASCII that may be white space
_WIDE = np.zeros(256, bool)
_WIDE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_CUT = np.zeros(256, bool)
_CUT[[0x20, 0x0A]] = True
_MARK = np.zeros(256, bool)
_MARK[[0x2C, 0x2E]] = True
_ANY = _CUT | _MARK


def cuts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Starts of the segments of consecutive texts.  A place whose neighbours may
    be white space in any Unicode version isn't cut."""
    n = len(data)
    starts = offs[:-1][offs[:-1] < n]
    at = np.flatnonzero(_ANY[data])
    at = at[(at > 0) & (at < n - 1)]
    b0, b1, after = data[at], data[at - 1], data[at + 1]
    tight = ~(_SPACE[b1] | _SPACE[after] | _WIDE[after])
    tight &= (b1 < 0x80) | ~(_WIDE[data[np.maximum(at - 2, 0)]] | _WIDE[data[np.maximum(at - 3, 0)]])
    ok = np.where(_MARK[b0], _LETTER[b1], tight)
    # the last byte of a text has the next text's first one behind it
    cut = np.zeros(n, bool)
    cut[at[ok]] = True
    ends = starts[1:] - 1
    cut[ends] &= _MARK[data[ends]]
    cut[starts] = True
    return np.flatnonzero(cut)


class Memory:
    """Segments met so far and their ids; ``encode`` maps a list of strings to a
    list of id sequences."""

    def __init__(self, encode: Callable[[list[str]], list]):
        self.encode = encode
        self.start()

    def start(self) -> None:
        self.keys = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]  # sorted, and sorted recent ones
        self.slot = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.used, self.size = 0, 0
        self.head = np.zeros(1024, np.uint64)
        self.width = np.zeros(1024, np.int64)
        self.off = np.zeros(1025, np.int64)
        self.store = np.zeros(4096, np.uint32)

    def _add(self, head: np.ndarray, width: np.ndarray, ids: list) -> np.ndarray:
        """Slots of new segments."""
        k, lens = len(ids), np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.concatenate([np.asarray(x, np.uint32) for x in ids]) if k else np.zeros(0, np.uint32)
        while self.used + k >= len(self.head):
            self.head, self.width, self.off = (np.resize(x, 2 * len(x) - e) for x, e in ((self.head, 0), (self.width, 0), (self.off, 1)))
        while self.size + len(flat) > len(self.store):
            self.store = np.resize(self.store, 2 * len(self.store))
        s = np.arange(self.used, self.used + k)
        self.head[s], self.width[s] = head, width
        self.off[self.used + 1:self.used + k + 1] = self.size + np.cumsum(lens)
        self.store[self.size:self.size + len(flat)] = flat
        self.used, self.size = self.used + k, self.size + len(flat)
        return s

    def ids(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of consecutive texts, offsets of each text's ids)."""
        n = len(data)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        if self.used > CACHE_ENTRIES:
            self.start()
        a = cuts(data, offs)
        width = np.diff(np.append(a, n))
        power, inverse = tables(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * power[:n], out=total[1:])
        h = mix((total[a + width] - total[a]) * inverse[a] ^ width.astype(np.uint64))
        # the first eight bytes tell two segments of one hash apart
        wide = np.zeros(n + 8, np.uint8)
        wide[:n] = data
        first = np.ndarray(n, "<u8", wide, strides=(1,))[a] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * np.maximum(8 - width, 0).astype(np.uint64)))
        key, at, seg = np.unique(h, return_index=True, return_inverse=True)
        slot = np.full(len(key), -1, np.int64)
        for keys, slots in zip(self.keys, self.slot):
            if len(keys):
                i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[i] == key
                slot[hit] = slots[i[hit]]
        known = slot >= 0
        known[known] = (self.head[slot[known]] == first[at[known]]) & (self.width[slot[known]] == width[at[known]])
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            s, w = a[at[new]], width[at[new]]
            got = self.encode([raw[x:y].decode() for x, y in zip(s.tolist(), (s + w).tolist())])
            fresh = (slot[new] < 0) & (w <= CACHE_LEN)
            slot[new] = self._add(first[at[new]], w, got)
            k = np.concatenate([self.keys[1], key[new[fresh]]])
            v = np.concatenate([self.slot[1], slot[new[fresh]]])
            o = np.argsort(k)
            self.keys[1], self.slot[1] = k[o], v[o]
            if len(k) > RECENT:
                k, v = np.concatenate([self.keys[0], self.keys[1]]), np.concatenate([self.slot[0], self.slot[1]])
                o = np.argsort(k, kind="stable")
                self.keys, self.slot = [k[o], np.zeros(0, np.uint64)], [v[o], np.zeros(0, np.int64)]
        of = slot[seg]
        lens = self.off[of + 1] - self.off[of]
        # two different segments of one hash in this very slice: settled apart
        odd = (self.head[of] != first) | (self.width[of] != width)
        ends = np.cumsum(lens)
        out = self.store[np.arange(int(ends[-1])) + np.repeat(self.off[of] - (ends - lens), lens)]
        if odd.any():
            raw = data.tobytes()
            parts = np.split(out, ends[:-1])
            for i in np.flatnonzero(odd):
                parts[i] = np.asarray(self.encode([raw[a[i]:a[i] + width[i]].decode()])[0], np.uint32)
            lens = np.fromiter(map(len, parts), np.int64, len(parts))
            out, ends = np.concatenate(parts), np.cumsum(lens)
        text_ends = np.searchsorted(a, offs[1:])
        return out, np.concatenate([[0], np.append(0, ends)[text_ends]])


def encoded(memory: Memory, col: pa.Array) -> Iterator[np.ndarray]:
    """The ids (little-endian uint32) of each text of a column, null as empty."""
    data, offs = text_bytes(col)
    for a, z in slices(offs):
        o = offs[a:z + 1]
        ids, at = memory.ids(data[o[0]:o[-1]], o - o[0])
        for i in range(z - a):
            yield ids[at[i]:at[i + 1]]
