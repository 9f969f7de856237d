"""Operator 6: byte-level BPE encoding and decoding with a segment tree.

A pre-token is a row of byte positions.  Position i holds the token that
starts there (or nothing) and the leaf i of a segment tree holds the rank of
the pair it forms with the next live token, or "none".  The root is the
smallest rank, leftmost on ties; a merge rewrites three leaves (the merged
token, its left neighbour, the swallowed position) and their paths to the
root, so that a pre-token of n bytes takes O(n log n).  Pre-tokens of up to
``WIDE`` bytes go through the same tree many at a time as numpy rows; longer
ones one by one.

Cases: null or empty text has no ids; a text without a space is one long
pre-token; ids outside the table raise; equal texts give equal ids; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from . import segments
from .textbatch import held, map_batches

WIDE = 64
NONE = np.int64(1 << 60)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class ByteBPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.size = max(ranks.values()) + 1
        by_id: list[bytes] = [b""] * self.size
        for k, v in ranks.items():
            by_id[v] = k
        self.lens = np.array([len(x) for x in by_id], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.lens)])
        self.joined = np.frombuffer(b"".join(by_id), np.uint8)
        self.valid = self.lens > 0
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for k, v in ranks.items():
            for i in range(1, len(k)):
                a, b = ranks.get(k[:i]), ranks.get(k[i:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = v
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.memory = segments.Memory(lambda texts: [np.frombuffer(x, "<u4") for x in self.encode_strings(texts)])

    # -- merging -----------------------------------------------------------
    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the pair (a, b), NONE where there is none or a token is missing (-1)."""
        key = a * self.size + b
        i = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[i] == key) & (a >= 0) & (b >= 0), self.pair_rank[i], NONE)

    def merge_many(self, toks: list[bytes], m: int) -> list[bytes]:
        """ids (uint32 bytes) of pre-tokens of at most ``m`` bytes, m a power of two."""
        n = len(toks)
        lens = np.fromiter(map(len, toks), np.int64, n)
        raw = np.frombuffer(b"".join(t.ljust(m, b"\0") for t in toks), np.uint8).reshape(n, m)
        cols = np.arange(m)
        tok = np.where(cols < lens[:, None], self.byte_id[raw], -1)
        # column m is a sentinel: the neighbour of the last token, never live
        tok = np.concatenate([tok, np.full((n, 1), -1)], axis=1)
        nxt = np.broadcast_to(np.append(np.minimum(cols + 1, m), m), (n, m + 1)).copy()
        prv = np.broadcast_to(np.append(cols - 1, m), (n, m + 1)).copy()
        prv[:, 0] = m
        tree = np.full((n, 2 * m), NONE)
        r = self._rank(tok[:, :m].ravel(), tok[:, 1:].ravel()).reshape(n, m)
        tree[:, m:] = np.where(r < NONE, r * m + cols, NONE)
        for lv in range(m.bit_length() - 2, -1, -1):
            a, b = 1 << lv, 2 << lv
            tree[:, a:b] = np.minimum(tree[:, b:2 * b:2], tree[:, b + 1:2 * b:2])
        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            root = tree[rows, 1]
            p, rank = root % m, root // m
            q = nxt[rows, p]
            s = nxt[rows, q]
            tok[rows, p] = rank
            tok[rows, q] = -1
            nxt[rows, p] = s
            prv[rows, s] = p
            o = prv[rows, p]
            self._set(tree, rows, q, np.full(len(rows), NONE), m)
            self._set(tree, rows, p, self._leaf(tok[rows, p], tok[rows, s], p, m), m)
            left = np.flatnonzero(o < m)
            if len(left):
                rl, ol = rows[left], o[left]
                self._set(tree, rl, ol, self._leaf(tok[rl, ol], tok[rl, p[left]], ol, m), m)
            rows = rows[tree[rows, 1] < NONE]
        live = tok >= 0
        out = tok[live].astype("<u4").tobytes()
        ends = np.cumsum(live.sum(axis=1)) * 4
        return [out[a:b] for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist())]

    def _leaf(self, a, b, pos, m):
        r = self._rank(a, b)
        return np.where(r < NONE, r * m + pos, NONE)

    @staticmethod
    def _set(tree, rows, pos, val, m) -> None:
        """Point update of one leaf in each row and of its path to the root."""
        i = pos + m
        tree[rows, i] = val
        while m > 1:
            i = i >> 1
            tree[rows, i] = np.minimum(tree[rows, 2 * i], tree[rows, 2 * i + 1])
            m >>= 1

    def merge_one(self, data: bytes) -> bytes:
        """The same for one pre-token of any length."""
        n = len(data)
        m = 1 << max(1, (n - 1).bit_length())
        none, pairs, size = int(NONE), self.pairs, self.size
        tok = self.byte_id[np.frombuffer(data, np.uint8)].tolist()
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))

        def leaf(i, j):
            r = pairs.get(tok[i] * size + tok[j]) if i >= 0 and j < n else None
            return none if r is None else r * m + i
        tree = [none] * (2 * m)
        tree[m:m + n] = [leaf(i, i + 1) for i in range(n)]
        for i in range(m - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b

        def put(i, v):
            i += m
            tree[i] = v
            i >>= 1
            while i:
                a, b = tree[2 * i], tree[2 * i + 1]
                v = a if a < b else b
                if tree[i] == v:
                    return
                tree[i] = v
                i >>= 1
        while tree[1] < none:
            rank, p = divmod(tree[1], m)
            q = nxt[p]
            s = nxt[q]
            tok[p], tok[q], nxt[p] = rank, -1, s
            if s < n:
                prv[s] = p
            put(q, none)
            put(p, leaf(p, s))
            if prv[p] >= 0:
                put(prv[p], leaf(prv[p], p))
        return np.array([t for t in tok if t >= 0], "<u4").tobytes()

    # -- texts -------------------------------------------------------------
    def encode_pretokens(self, toks: list[bytes]) -> dict[bytes, bytes]:
        """ids of each distinct pre-token; one in the table is that id."""
        out, by_size = {}, {}
        for t in set(toks):
            r = self.ranks.get(t)
            if r is not None:
                out[t] = r.to_bytes(4, "little")
            elif len(t) > WIDE:
                out[t] = self.merge_one(t)
            else:
                by_size.setdefault(1 << (len(t) - 1).bit_length(), []).append(t)
        for m, ts in by_size.items():
            for a in range(0, len(ts), 8192):
                out.update(zip(ts[a:a + 8192], self.merge_many(ts[a:a + 8192], m)))
        return out

    def encode_strings(self, texts: list[str]) -> list[bytes]:
        """ids of each text, its pre-tokens encoded separately."""
        pre = [[p.encode("utf-8", "replace") for p in self.pattern.findall(t)] for t in texts]
        known = self.encode_pretokens([p for ps in pre for p in ps])
        return [b"".join([known[p] for p in ps]) for ps in pre]

    def decode(self, ids: bytes) -> bytes:
        i = np.frombuffer(ids, "<u4").astype(np.int64)
        if len(i) == 0:
            return b""
        if int(i.max()) >= self.size or not self.valid[i].all():
            raise ValueError("id outside the vocabulary")
        n = self.lens[i]
        ends = np.cumsum(n)
        return self.joined[np.arange(int(ends[-1])) + np.repeat(self.at[i] - (ends - n), n)].tobytes()


def encoder(path: str, pattern: str) -> ByteBPE:
    """The worker's encoder, built once for consecutive tasks."""
    return held((path, pattern), lambda: ByteBPE(read_ranks(path), pattern))


def encode_decode(df: DataFrame, path: str, pattern: str, keep: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for rows (doc_id, text);
    with ``keep`` also the ids (little-endian uint32) and the decoded text.  Texts are
    cut into segments where ``pattern`` is the public one, which these are proven
    for; with another pattern each text is encoded whole."""
    cut = pattern == public_tokenizers.PATTERN

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        e = encoder(path, pattern)
        cols: list[list] = [[], [], [], [], []]
        found = segments.encoded(e.memory, b.column(1)) if cut else (np.frombuffer(e.encode_strings([t or ""])[0], "<u4") for t in b.column(1).to_pylist())
        for x in found:
            ids = x.astype("<u4").tobytes()
            back = e.decode(ids)
            row = (len(x), hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest())
            for c, v in zip(cols, row + ((ids, back.decode("utf-8", "replace")) if keep else ())):
                c.append(v)
        kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()][:5 if keep else 3]
        names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][:len(kinds)]
        return pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["doc_id", *names])
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(df.select(df.doc_id.cast("long"), "text"), run, schema + (", ids binary, decoded string" if keep else ""), (path, pattern))
