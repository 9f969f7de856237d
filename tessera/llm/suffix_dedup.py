"""Operator 2: repeated byte strings by external induced suffix sorting.

Every byte covered by a ``LENGTH``-byte string that also starts elsewhere is
removed.  The work is cut so that a suffix array is only built where it decides:

1.  Anchors.  In each window of LENGTH bytes the smallest hash of a ``GRAM``-byte
    string is the window's anchor, so equal windows have equal anchors at equal
    places, and the window starts of a text fall into runs with a common anchor.
2.  Classes.  Runs whose whole stretch of bytes (first start to last end) is equal
    form a class; a class with two members is repeated throughout.  Tasks settle
    what repeats in their batch and send one entry a class, packed by target.
3.  Suffixes.  Where an anchor string has several classes, one stretch of each goes
    to a shard, sorted (by Spark, on disk) by what follows the anchor.  From that
    order the shard induces the order one byte further left, again and again:
    tuples (preceding byte, rank) with the common prefix to the predecessor pass
    through a disk-backed priority queue, and the prefix of two neighbours one
    level on is the smallest between them plus one.  Neighbours with LENGTH common
    bytes mark their starts.  Memory is a few blocks whatever the shard's size.
4.  Anchor strings with more than ``HOT`` classes in a target would make one large
    shard; their windows are counted by hash over all tasks instead.

Strings are compared by 128 bits of hash in steps 2 and 4, byte by byte in step 3.

Cases: null or empty text has no bytes; texts shorter than LENGTH stay whole;
equal rows are occurrences of each other; matches never cross rows; very long texts
take memory in proportion to the longest one; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
import shutil
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spool import Spool
from .textbatch import _BYTE, map_batches, mix, slices, tables, text_bytes
from .written import written

LENGTH, GRAM = 400, 150
HOT = 2_000
_POS = 28  # bits of a place inside a stretch of windows
SPAN = 1 << 27


def row_id(doc_id: Column, text: Column) -> Column:
    """Rows with equal id and text are occurrences of one string and share their result."""
    return F.xxhash64(doc_id.cast("string"), F.coalesce(text, F.lit("")))


class Hashes:
    """Hashes of any substring of a byte array."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power, self.back = tables(n + 1)
        self.sum = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * power[:n], out=self.sum[1:])

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sum[b] - self.sum[a]) * self.back[a])


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each window of w values."""
    n = len(x) - w + 1
    k = -(-len(x) // w) * w
    y = np.full(k, np.iinfo(np.uint64).max, np.uint64)
    y[:len(x)] = x
    y = y.reshape(-1, w)
    ahead = np.minimum.accumulate(y, axis=1).ravel()
    behind = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def anchors(grams: np.ndarray, w: int, span: int = SPAN) -> np.ndarray:
    """Place of the smallest value of each window of w, the leftmost of equal ones; hash
    and place share 64 bits, so places count from the start of a stretch of ``span``
    windows, and a text may be of any length."""
    out, mask = [], np.uint64((1 << _POS) - 1)
    for a in range(0, len(grams) - w + 1, span):
        g = grams[a:a + span + w - 1]
        mark = (g >> np.uint64(_POS) << np.uint64(_POS)) | np.arange(len(g), dtype=np.uint64)
        out.append((window_min(mark, w) & mask).astype(np.int64) + a)
    return np.concatenate(out)


def runs(data: np.ndarray, offs: np.ndarray, length: int, gram: int, span: int = SPAN):
    """(text, first start, last start, anchor, anchor hash, stretch hash) of the
    runs of window starts with a common anchor; positions within ``data``."""
    n = len(data)
    z = np.zeros(0, np.int64)
    if n < length:
        return z, z, z, z, z.view(np.uint64), z.view(np.uint64)
    h = Hashes(data)
    grams = (h.sum[gram:] - h.sum[:-gram]) * h.back[:n - gram + 1]
    grams = mix(grams)
    low = anchors(grams, length - gram + 1, span)
    ok = np.zeros(len(low), bool)
    for a, b in zip(offs[:-1], offs[1:]):
        if b - a >= length:
            ok[a:b - length + 1] = True
    start = np.flatnonzero(ok)
    if not len(start):
        return z, z, z, z, z.view(np.uint64), z.view(np.uint64)
    anchor = low[start]
    new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)))
    lo, hi, at = start[new], start[np.append(new[1:], len(start)) - 1], anchor[new]
    text = np.searchsorted(offs, lo, side="right") - 1
    # the place of the anchor and the length belong to the stretch
    shape = ((at - lo).astype(np.uint64) << np.uint64(32)) | (hi - lo).astype(np.uint64)
    return text, lo, hi, at, grams[at], mix(h(lo, hi + length) ^ mix(shape + np.uint64(1)))


ENTRY = (("key", np.uint64), ("stretch", np.uint64), ("id", np.int64), ("lo", np.int32), ("at", np.int32), ("hi", np.int32), ("n", np.int32))
ENTRY_BYTES = sum(np.dtype(k).itemsize for _, k in ENTRY)


def classes(docs: DataFrame, length: int, gram: int, hot: int) -> DataFrame:
    """(kind, id, lo, at, hi, key, stretch, n): kind 0 a span of starts lo..hi
    that all repeat, 1 a class to compare with others of its anchor string, 2 the
    same for a hot anchor string; n is 1 or, for a class that repeats, more."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def entries(batches):
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            data, offs = text_bytes(b.column(1))
            got = [[] for _ in range(6)]
            for a, z in slices(offs):
                o = offs[a:z + 1]
                text, lo, hi, at, key, stretch = runs(data[o[0]:o[-1]], o - o[0], length, gram)
                base = (o - o[0])[text] if len(text) else lo
                for c, v in zip(got, (key, stretch, ids[a + text], lo - base, at - base, hi - base)):
                    c.append(v)
            if not got[0]:
                continue
            key, stretch, doc, lo, at, hi = (np.concatenate(c) for c in got)
            if not len(key):
                continue
            o = np.lexsort((stretch, key))
            new = np.append(True, (key[o][1:] != key[o][:-1]) | (stretch[o][1:] != stretch[o][:-1]))
            head = np.flatnonzero(new)
            n = np.diff(np.append(head, len(o)))
            twice = np.repeat(n > 1, n)
            rows = []
            if twice.any():
                k = o[twice]
                rows.append((-1 - int(doc[k[0]] % parts), b"".join(x.tobytes() for x in (doc[k], lo[k].astype(np.int32), hi[k].astype(np.int32)))))
            k = o[head]
            cols = [x.astype(t) for x, (_, t) in zip((key[k], stretch[k], doc[k], lo[k], at[k], hi[k], n), ENTRY)]
            to = (cols[0] % np.uint64(parts)).astype(np.int64)
            o = np.argsort(to, kind="stable")
            cols, to = [c[o] for c in cols], to[o]
            edge = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            rows += [(int(to[s]), b"".join(c[s:e].tobytes() for c in cols)) for s, e in zip(edge, np.append(edge[1:], len(to)))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["part", "block"])

    def out(kind, doc, lo, at, hi, key, stretch, n):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.broadcast_to(np.asarray(kind, np.int32), len(doc))), pa.array(doc), pa.array(lo.astype(np.int32)), pa.array(at.astype(np.int32)),
             pa.array(hi.astype(np.int32)), pa.array(key.view(np.int64)), pa.array(stretch.view(np.int64)), pa.array(n.astype(np.int32))],
            ["kind", "id", "lo", "at", "hi", "key", "stretch", "n"])

    def settle(batches):
        held: dict[int, list[bytes]] = {}
        for b in batches:
            for part, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if part >= 0:
                    held.setdefault(part, []).append(block)
                else:
                    k = len(block) // 16
                    doc = np.frombuffer(block, np.int64, k)
                    lo, hi = np.frombuffer(block, np.int32, k, 8 * k), np.frombuffer(block, np.int32, k, 12 * k)
                    zero = np.zeros(k, np.uint64)
                    yield out(0, doc, lo, lo, hi, zero, zero, lo)
        while held:
            _, blocks = held.popitem()
            cols = [[] for _ in ENTRY]
            for x in blocks:
                k, at = len(x) // ENTRY_BYTES, 0
                for c, (_, t) in zip(cols, ENTRY):
                    c.append(np.frombuffer(x, t, k, at))
                    at += c[-1].nbytes
            key, stretch, doc, lo, at, hi, n = (np.concatenate(c) for c in cols)
            o = np.lexsort((stretch, key))
            key, stretch, doc, lo, at, hi, n = (x[o] for x in (key, stretch, doc, lo, at, hi, n))
            newkey = np.append(True, key[1:] != key[:-1])
            new = newkey | np.append(True, stretch[1:] != stretch[:-1])
            head = np.flatnonzero(new)
            per = np.diff(np.append(head, len(key)))
            total = np.add.reduceat(n, head)
            # entries that were alone in their batch but aren't over all
            k = (np.repeat(total, per) > 1) & (n == 1)
            if k.any():
                yield out(0, doc[k], lo[k], at[k], hi[k], key[k], stretch[k], n[k])
            group = np.cumsum(newkey[head]) - 1
            size = np.bincount(group)[group]
            k = size > 1
            if k.any():
                r = head[k]
                yield out(np.where(size[k] > hot, 2, 1), doc[r], lo[r], at[r], hi[r], key[r], stretch[r], total[k])
    sent = docs.select("id", "text").mapInArrow(entries, "part int, block binary").repartition(parts, "part")
    return sent.mapInArrow(settle, "kind int, id long, lo int, at int, hi int, key long, stretch long, n int")


# -- induced sorting ---------------------------------------------------------
def between(lcp: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of lcp over (a, b] for pairs a < b."""
    table = [lcp]
    while (2 << (len(table) - 1)) <= len(lcp):
        t, w = table[-1], 1 << (len(table) - 1)
        table.append(np.minimum(t[:-w], t[w:]))
    lv = np.frexp((b - a).astype(float))[1] - 1
    res = np.empty(len(a), lcp.dtype)
    for v in np.unique(lv):
        k = lv == v
        res[k] = np.minimum(table[v][a[k] + 1], table[v][b[k] + 1 - (1 << v)])
    return res


def induce(order: Spool, left: np.ndarray, depth: np.ndarray, length: int, flag, limit: int) -> None:
    """Walk from the order of the suffixes at the anchors to those of each byte
    further left.  ``order`` holds (group, rank, common prefix with the
    predecessor, row); ``left[row]`` the bytes before the anchor, nearest first;
    ``depth[row]`` their number.  ``flag(rows, level)`` gets the rows whose suffix
    at that level shares ``length`` bytes with a neighbour."""
    kinds = [np.int64, np.int64, np.int32, np.int64]
    level = 0
    while True:
        nxt = Spool(kinds, limit, order.block)
        carry = np.full(256, -1, np.int64)  # smallest prefix since each byte was last seen, -1 never
        before, rank = None, 0
        for group, _, lcp, row in order.pop_all():
            # marks at this level: common with the predecessor, or the successor's with this
            strong = lcp >= length
            hit = strong.copy()
            hit[:-1] |= strong[1:]
            if before is not None and strong[0]:
                flag(before, level)
            if hit.any():
                flag(row[hit], level)
            before = row[-1:]
            live = np.flatnonzero(depth[row] > level)
            byte = left[row[live], level].astype(np.int64)
            o = np.argsort(byte, kind="stable")
            i, c = live[o], byte[o]
            low = np.zeros(len(i), np.int64)
            first = np.append(True, c[1:] != c[:-1]) if len(c) else np.zeros(0, bool)
            if len(i):
                pair = np.flatnonzero(~first)
                low[pair] = between(lcp, i[pair - 1], i[pair])
                prefix = np.minimum.accumulate(lcp)
                old = carry[c[first]]
                low[first] = np.where(old < 0, -1, np.minimum(old, prefix[i[first]]))
            carry = np.where(carry < 0, -1, np.minimum(carry, lcp.min()))
            if len(i):
                suffix = np.append(np.minimum.accumulate(lcp[::-1])[::-1], np.iinfo(np.int32).max)
                last = np.append(first[1:], True)
                carry[c[last]] = suffix[i[last] + 1]
                # a byte starts a new range of each group; ranges over another group hold a 0
                nxt.push([group[i] * 256 + c, rank + i, (low + 1).astype(np.int32), row[i]])
            rank += len(row)
        if not nxt.count and not nxt.runs:
            return
        # (group, byte) becomes the order; groups stay apart by their number alone
        order, level = Renumber(nxt), level + 1


class Renumber:
    """Pops a queue ordered by (group * 256 + byte, rank) with plain groups."""

    def __init__(self, spool: Spool):
        self.spool, self.block = spool, spool.block

    def pop_all(self):
        for key, rank, lcp, row in self.spool.pop_all():
            yield key >> 8, rank, lcp, row


def repeated_starts(rows, length: int, limit: int = 1 << 20):
    """Spans (id, first start, last start) of single classes that repeat, from an
    iterator of batches (key, right, left, id, at, n) sorted by (key, right)."""
    folder = tempfile.mkdtemp()
    try:
        order = Spool([np.int64, np.int64, np.int32, np.int64], limit)
        meta = [[], [], []]  # id, at, n: 20 bytes a class
        depth, group, rank, wide = [], -1, 0, length
        last_key = last = None
        with open(f"{folder}/left", "wb") as f:
            for key, right, left, ids, at, n in rows:
                k = len(key)
                data, offs = right
                lens = np.diff(offs)
                lcp = np.zeros(k, np.int32)
                grp = np.empty(k, np.int64)
                pad = np.zeros((k + 1, length), np.uint8)
                ln = np.zeros(k + 1, np.int64)
                if last is not None:
                    pad[0, :len(last)] = last
                    ln[0] = len(last)
                ln[1:] = lens
                col = np.arange(length)
                pad[1:][col < lens[:, None]] = data
                for a in range(0, k, 4096):
                    z = min(k, a + 4096)
                    diff = pad[a + 1:z + 1] != pad[a:z]
                    m = np.where(diff.any(axis=1), diff.argmax(axis=1), length)
                    lcp[a:z] = np.minimum(m, np.minimum(ln[a + 1:z + 1], ln[a:z]))
                same = np.append(last_key is not None and key[0] == last_key, key[1:] == key[:-1])
                lcp[~same] = 0
                grp = group + np.cumsum(~same)
                order.push([grp, rank + np.arange(k), lcp, rank + np.arange(k)])
                group, rank, last_key = int(grp[-1]), rank + k, key[-1]
                last = data[offs[-2]:offs[-1]].copy()
                ldata, loffs = left
                dl = np.diff(loffs)
                mat = np.zeros((k, wide), np.uint8)
                mat[np.arange(wide) < dl[:, None]] = ldata  # nearest byte first
                f.write(mat.tobytes())
                depth.append(dl)
                for c, v in zip(meta, (ids, at, n)):
                    c.append(v)
        if not rank:
            return
        left = np.memmap(f"{folder}/left", np.uint8, "r", shape=(rank, wide))
        depth = np.concatenate(depth)
        ids, at, n = (np.concatenate(c) for c in meta)
        found = Spool([np.int64, np.int64], limit)

        def flag(rows, level):
            rows = rows[n[rows] == 1]
            found.push([rows, np.full(len(rows), level, np.int64)])
        induce(order, left, depth, length, flag, limit)
        for row, level in found.pop_all():
            new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (level[1:] > level[:-1] + 1)))
            end = np.append(new[1:], len(row)) - 1
            yield ids[row[new]], at[row[new]] - level[end], at[row[new]] - level[new]
        del left
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def stretches(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(key, stretch, n, id, at, left, right): the bytes before the anchor,
    nearest first, and from it on, of each wanted class."""
    per = wanted.groupBy("id").agg(F.collect_list(F.struct("lo", "at", "hi", "key", "stretch", "n")).alias("w"))

    def run(b: pa.RecordBatch):
        rows = []
        for i, text, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            t = text.encode()
            rows += [(x["key"], x["stretch"], x["n"], i, x["at"], t[x["lo"]:x["at"]][::-1], t[x["at"]:x["hi"] + length]) for x in w]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["key", "stretch", "n", "id", "at", "left", "right"])
    return map_batches(docs.join(per, "id").select("id", "text", "w"), run, "key long, stretch long, n int, id long, at int, left binary, right binary")


def hot_starts(found: DataFrame, length: int) -> DataFrame:
    """The same spans for hot anchor strings: every window's hash is counted
    over all tasks."""
    def run(b: pa.RecordBatch):
        cols = [[], [], [], [], []]
        for left, right, i, at, n in zip(*(b.column(k).to_pylist() for k in range(5))):
            data = np.frombuffer(left[::-1] + right, np.uint8)
            s = np.arange(len(data) - length + 1)
            h = Hashes(data)(s, s + length)
            g = mix(Hashes(data[::-1])(len(data) - s - length, len(data) - s))
            for c, v in zip(cols, (h.view(np.int64), g.view(np.int64), np.full(len(s), i), at - len(left) + s, np.full(len(s), n, np.int32))):
                c.append(v)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], ["h", "g", "id", "start", "n"])
    rows = written(map_batches(found.select("left", "right", "id", "at", "n"), run, "h long, g long, id long, start long, n int"), "hot-windows")
    twice = rows.groupBy("h", "g").agg(F.count("*").alias("c")).filter("c > 1").select("h", "g")
    return rows.filter("n = 1").join(twice, ["h", "g"]).select("id", F.col("start").cast("int").alias("lo"), F.col("start").cast("int").alias("hi"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, limit: int = 1 << 20) -> DataFrame:
    """(id, lo, hi): starts lo..hi of repeated strings, for rows (id, text)."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cls = written(classes(docs, length, gram, hot), "stretch-classes")
    spans = cls.filter("kind = 0").select("id", "lo", "hi")

    def sort(batches):
        def rows():
            for b in batches:
                if b.num_rows:
                    yield (b.column(0).to_numpy(), text_bytes(b.column(1)), text_bytes(b.column(2)),
                           b.column(3).to_numpy(), b.column(4).to_numpy(), b.column(5).to_numpy())
        for i, lo, hi in repeated_starts(rows(), length, limit):
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], ["id", "lo", "hi"])
    shard = (stretches(docs, cls.filter("kind = 1"), length).select("key", "right", "left", "id", "at", "n")
             .repartition(parts, "key").sortWithinPartitions("key", "right"))
    spans = spans.union(shard.mapInArrow(sort, "id long, lo int, hi int"))
    if cls.filter("kind = 2").limit(1).count():
        spans = spans.union(hot_starts(stretches(docs, cls.filter("kind = 2"), length), length))
    return written(spans, "repeated-spans")


def strip_repeats(docs: DataFrame, length: int = LENGTH, keep: bool = False, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for rows (doc_id, text);
    with ``keep`` also the kept bytes."""
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), row_id(F.col("doc_id"), F.col("text")).alias("id"))
    spans = repeated_spans(rows.select("id", "text"), length, **options).groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(b: pa.RecordBatch):
        out = [[], [], [], [], []]
        data, offs = text_bytes(b.column(1))
        for i, w in enumerate(b.column(2).to_pylist()):
            t = data[offs[i]:offs[i + 1]]
            spans = np.zeros(0, np.int64)
            if w:
                edge = np.zeros(len(t) + 1, np.int64)
                np.add.at(edge, [x["lo"] for x in w], 1)
                np.add.at(edge, [x["hi"] + length for x in w], -1)
                gone = np.cumsum(edge[:-1]) > 0
                spans = np.flatnonzero(gone & ~np.append(False, gone[:-1]))
                left = t[~gone].tobytes()
            else:
                left = t.tobytes()
            for c, v in zip(out, (len(t), len(t) - len(left), len(spans), hashlib.sha256(left).hexdigest(), left if keep else None)):
                c.append(v)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())[:5 if keep else 4]
        return pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))],
                                          ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:1 + len(kinds)])
    joined = rows.join(spans, "id", "left").select("doc_id", "text", "spans")
    return map_batches(joined, run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep else ""))
