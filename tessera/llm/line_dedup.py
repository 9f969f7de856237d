"""Operator 4: line dedup by an exact set-similarity join.

A line's tokens are its distinct shingles of ``WIDTH`` lower-cased words (a shorter
line is one token); lines are alike if the Jaccard similarity of their token sets
is at least ``PERCENT`` / 100, and a line that is like any earlier line (by doc_id,
then line number) is removed.

Tokens are ordered by rarity: occurrences in all documents, counted in ``SLOTS``
hashed slots, ties by hash; any common order is right, this one keeps groups
small.  Alike lines share a token of their prefixes, the shorter one's index
prefix and the longer one's probe prefix.  Tasks pack prefix entries into one
binary block for each target partition, so that few large rows are shuffled.  A
target sorts its entries by token and proposes earlier lines that pass the length
and positional filters, earliest first; a 64-bit parity of each set, whose bits
differ in at most as many places as the sets differ in tokens, drops most others.
A line's first ``FIRST`` proposals of each token are verified on full sets, which
settles most lines.  The others go on with their next proposals, of which a token
keeps ``PROPOSE``; where it had more, its group is written too, in chunks of
``CHUNK`` entries, and meets the lines that are still unsettled.  Hot groups thus
make few pairs, and none is dropped.

Cases: null text has no lines; blank lines hold no tokens and stay; the parts
between newlines are the lines, so a last empty one counts; rows that share a
doc_id and line number are the same line and don't remove each other; rows with a
null doc_id are left alone; an empty table gives an empty result; further columns
are ignored by ``removed_lines`` and kept by ``drop_lines``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbatch import LOWER, SPACE, lean, map_batches, shingles, slices, text_bytes, words
from .written import written

WIDTH, PERCENT = 5, 80
SLOTS = 1 << 16
FIRST, PROPOSE = 2, 16
CHUNK = 4096
#: lines that one sort key tells apart
RUN = 1 << 24
SEPARATOR = SPACE


def line_tokens(data: np.ndarray, offs: np.ndarray, width: int):
    """(text of line, first byte of line) and the (line, token) occurrences."""
    ends = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([offs[:-1], ends + 1]))
    starts = starts[starts < len(data)] if len(data) else starts[:0]
    text = np.searchsorted(offs, starts, side="right") - 1
    # shingles stay within a line: lines are the "texts" here
    line, _, _, h = words(LOWER[data], np.append(starts, len(data)), SEPARATOR)
    return text, starts, *shingles(line, h, width)


def line_numbers(text: np.ndarray) -> np.ndarray:
    """Number of each line within its text; line starts are in order, and a text
    with any byte begins with its line 0."""
    first = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else np.zeros(0, np.int64)
    return np.arange(len(text)) - np.repeat(first, np.diff(np.append(first, len(text))))


def rarity(docs: DataFrame, width: int = WIDTH) -> np.ndarray:
    """Rank of each slot, rarest first; SLOTS numbers whatever the corpus."""
    per = 1 << 10

    def run(batches):
        acc = np.zeros(SLOTS, np.int64)
        for b in batches:
            data, offs = text_bytes(b.column(0))
            for a, z in slices(offs):
                o = offs[a:z + 1]
                h = line_tokens(data[o[0]:o[-1]], o - o[0], width)[3]
                acc += np.bincount((h >> np.uint64(48)).astype(np.int64), minlength=SLOTS)
        k = SLOTS // per
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array([acc[i * per:(i + 1) * per].tobytes() for i in range(k)], pa.binary())], ["block", "counts"])

    def total(batches):
        acc: dict[int, np.ndarray] = {}  # SLOTS numbers at most
        for b in batches:
            for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                acc[k] = acc.get(k, 0) + np.frombuffer(x, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(acc), pa.int32()), pa.array([x.tobytes() for x in acc.values()], pa.binary())], ["block", "counts"])
    rows = (docs.select("text").mapInArrow(lean(run), "block int, counts binary").repartition(SLOTS // per, "block")
            .mapInArrow(lean(total), "block int, counts binary").collect())
    counts = np.zeros(SLOTS, np.int64)
    for r in rows:
        counts[r.block * per:(r.block + 1) * per] = np.frombuffer(r.counts, np.int64)
    rank = np.empty(SLOTS, np.uint64)
    rank[np.argsort(counts, kind="stable")] = np.arange(SLOTS, dtype=np.uint64)
    return rank


def need(percent: int, n: np.ndarray) -> np.ndarray:
    """Least overlap with any set for a set of n tokens."""
    return -(-percent * n // 100)


def fits(x: dict, y: dict, percent: int) -> np.ndarray:
    """Whether entries x and y of one token pass the filters: lengths, prefixes,
    positions (common tokens still possible) and parities."""
    n, m = x["n"], y["n"]
    both = n + m
    least = -(-percent * both // (100 + percent))  # tokens that alike sets share
    short = np.minimum(n, m)
    index = short - -(-2 * percent * short // (100 + percent)) + 1
    ok = 100 * short >= percent * np.maximum(n, m)
    ok &= np.where(n <= m, x["pos"], y["pos"]) < index
    ok &= (x["pos"] <= n - need(percent, n)) & (y["pos"] <= m - need(percent, m))
    ok &= np.minimum(x["pos"], y["pos"]) + np.minimum(n - x["pos"], m - y["pos"]) >= least
    # alike sets differ in at most both - 2 * least tokens
    ok &= np.bitwise_count(x["parity"] ^ y["parity"]) <= both - 2 * least
    return ok & ((x["doc"] != y["doc"]) | (x["line"] != y["line"]))


def propose(e: dict, percent: int, limit: int):
    """For entries sorted by (token, doc, line): the entries with proposals, whether
    there were more than ``limit``, and offsets into the proposed earlier entries."""
    tok = e["tok"]
    start = np.flatnonzero(np.append(True, tok[1:] != tok[:-1])[:len(tok)])
    at = np.repeat(start, np.diff(np.append(start, len(tok))))
    rank = np.arange(len(tok)) - at
    live = np.flatnonzero(rank > 0)
    got, cut = np.zeros(len(tok), np.int64), np.zeros(len(tok), bool)
    xs, ys, d = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while len(live):
        y = at[live] + d
        ok = fits({k: v[live] for k, v in e.items()}, {k: v[y] for k, v in e.items()}, percent)
        xs.append(live[ok])
        ys.append(y[ok])
        got[live[ok]] += 1
        d += 1
        on = rank[live] > d
        full = got[live] >= limit
        cut[live[full & on]] = True
        live = live[on & ~full]
    x, y = np.concatenate(xs), np.concatenate(ys)
    o = np.argsort(x, kind="stable")  # an entry's proposals side by side, earliest first
    x, y = x[o], y[o]
    head = np.flatnonzero(np.append(True, x[1:] != x[:-1])[:len(x)])
    return x[head], cut[x[head]], np.append(head, len(x)), y


ENTRY = (("tok", np.uint64), ("doc", np.int64), ("line", np.int32), ("n", np.int32), ("pos", np.int32), ("parity", np.uint64))
ENTRY_BYTES = sum(np.dtype(k).itemsize for _, k in ENTRY)


def pack(e: dict, s: slice) -> bytes:
    return b"".join(e[k][s].astype(t).tobytes() for k, t in ENTRY)


def unpack(blocks: list[bytes]) -> dict:
    """Entries of several blocks; numbers as 64-bit ones, so that sums don't wrap."""
    cols: dict[str, list] = {k: [] for k, _ in ENTRY}
    for x in blocks:
        n, at = len(x) // ENTRY_BYTES, 0
        for k, t in ENTRY:
            cols[k].append(np.frombuffer(x, t, n, at))
            at += cols[k][-1].nbytes
    return {k: np.concatenate(v).astype(np.uint64 if k in ("tok", "parity") else np.int64) for k, v in cols.items()}


FOUND = ("doc_id long, line int, first array<struct<doc0: long, line0: int>>, rest array<struct<doc0: long, line0: int>>, more boolean, "
         "tok long, n int, pos int, parity long, chunk binary")


def proposals(docs: DataFrame, rank: np.ndarray, width: int, percent: int) -> DataFrame:
    """``FOUND`` rows: the proposed earlier lines of a line by one token (null for a
    line that equals an earlier one of its task) with its entry, or, without a
    line, a chunk of the entries of a token that had more to propose."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranks = spark.sparkContext.broadcast(rank)

    def sent(b: pa.RecordBatch) -> pa.RecordBatch | None:
        """The entries of a batch, a block for each target; its arrays are gone when it is sent."""
        rank = ranks.value
        ids = b.column(0).to_numpy(zero_copy_only=False)
        data, offs = text_bytes(b.column(1))
        out = [[] for _ in ENTRY]
        gone_d, gone_l = [], []
        for a, z in slices(offs):
            o = offs[a:z + 1]
            text, _, line, h = line_tokens(data[o[0]:o[-1]], o - o[0], width)
            if not len(h):
                continue
            doc, number = ids[a + text], line_numbers(text)
            r = rank[(h >> np.uint64(48)).astype(np.int64)]
            # one sortable key in each run of 2^24 lines: line, rank of the slot, bits of the hash
            key = (line.astype(np.uint64) << np.uint64(40)) | (r << np.uint64(24)) | (h & np.uint64(0xFFFFFF))
            runs = np.append(np.searchsorted(line, np.arange(0, line[-1] + 1, RUN)), len(line))
            o = np.concatenate([a2 + np.argsort(key[a2:z2]) for a2, z2 in zip(runs[:-1], runs[1:])])
            line, h = line[o], h[o]
            new = np.append(True, (line[1:] != line[:-1]) | (h[1:] != h[:-1]))
            line, h = line[new], h[new]
            head = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
            n = np.diff(np.append(head, len(line)))
            same = np.add.reduceat(h * np.uint64(0x9E3779B97F4A7C15) ^ (h >> np.uint64(29)), head)
            # of equal sets only the earliest line here is compared
            who = line[head]
            order = np.lexsort((number[who], doc[who], n, same))
            s = same[order]
            copy = np.append(False, (s[1:] == s[:-1]) & (n[order][1:] == n[order][:-1]))
            w = who[order]
            prev = np.append(False, (doc[w][1:] == doc[w][:-1]) & (number[w][1:] == number[w][:-1])) & copy
            gone = copy & ~prev
            gone_d.append(doc[w[gone]])
            gone_l.append(number[w[gone]])
            keep = np.zeros(len(head), bool)
            keep[order[~copy]] = True
            pos = np.arange(len(line)) - np.repeat(head, n)
            nn = np.repeat(n, n)
            take = np.repeat(keep, n) & (pos <= nn - need(percent, nn))
            parity = np.repeat(np.bitwise_xor.reduceat(np.uint64(1) << (h & np.uint64(63)), head), n)
            for c, v, (_, t) in zip(out, (h[take], doc[line[take]], number[line[take]], nn[take], pos[take], parity[take]), ENTRY):
                c.append(v.astype(t, copy=False))
        rows = []
        if out[0]:
            to = (np.concatenate(out[0]) % np.uint64(parts)).astype(np.int32)
            o = np.argsort(to, kind="stable")
            to, e = to[o], {}
            for c, (k, _) in zip(out, ENTRY):  # column by column, so that few are there twice
                e[k] = np.concatenate(c)[o]
                c.clear()
            at = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            rows = [(int(to[a]), pack(e, slice(a, z))) for a, z in zip(at, np.append(at[1:], len(to)))]
            g = np.concatenate(gone_d), np.concatenate(gone_l).astype(np.int32)
            if len(g[0]):
                rows.append((-1 - int(g[0][0]) % parts, g[0].tobytes() + g[1].tobytes()))
        if not rows:
            return None
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["part", "block"])

    kinds = [pa.int64(), pa.int32(), *[pa.list_(pa.struct([("doc0", pa.int64()), ("line0", pa.int32())]))] * 2, pa.bool_(),
             pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    names = ["doc_id", "line", "first", "rest", "more", "tok", "n", "pos", "parity", "chunk"]

    def found(size: int, **cols) -> pa.RecordBatch:
        """A batch of ``size`` rows; columns that aren't given are null."""
        return pa.RecordBatch.from_arrays([pa.array(cols[c], k) if c in cols and not isinstance(cols[c], pa.Array) else cols.get(c, pa.nulls(size, k))
                                           for c, k in zip(names, kinds)], names)

    def lists(start, size, y, e):
        ends = np.cumsum(size)
        at = y[np.arange(int(ends[-1])) + np.repeat(start - (ends - size), size)]
        pairs = pa.StructArray.from_arrays([pa.array(e["doc"][at]), pa.array(e["line"][at].astype(np.int32))], ["doc0", "line0"])
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pairs)

    def match(batches):
        held: dict[int, list[bytes]] = {}
        for b in batches:
            for part, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if part >= 0:
                    held.setdefault(part, []).append(block)
                else:
                    k = len(block) // 12
                    yield found(k, doc_id=np.frombuffer(block, np.int64, k), line=np.frombuffer(block, np.int32, k, 8 * k))
        while held:
            e = unpack(held.popitem()[1])
            # entries whose token is alone here can't be alike by it
            o = np.argsort(e["tok"])
            t = e["tok"][o]
            alone = np.append(True, t[1:] != t[:-1]) & np.append(t[1:] != t[:-1], True)
            e = {k: v[o[~alone]] for k, v in e.items()}
            o = np.lexsort((e["line"], e["doc"], e["tok"]))
            e = {k: v[o] for k, v in e.items()}
            x, more, at, y = propose(e, percent, PROPOSE)
            for a in range(0, len(x), 50_000):
                h, start, many = x[a:a + 50_000], at[:-1][a:a + 50_000], np.diff(at)[a:a + 50_000]
                few = np.minimum(many, FIRST)
                yield found(len(h), doc_id=e["doc"][h], line=e["line"][h], first=lists(start, few, y, e), rest=lists(start + few, many - few, y, e),
                            more=more[a:a + 50_000], tok=e["tok"][h].view(np.int64), n=e["n"][h], pos=e["pos"][h], parity=e["parity"][h].view(np.int64))
            for t in np.unique(e["tok"][x[more]]):
                a, z = np.searchsorted(e["tok"], t, side="left"), np.searchsorted(e["tok"], t, side="right")
                chunks = [pack(e, slice(c, min(z, c + CHUNK))) for c in range(a, z, CHUNK)]
                yield found(len(chunks), tok=np.full(len(chunks), t).view(np.int64), chunk=chunks)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL")
    return map_batches(rows, sent, "part int, block binary").repartition(parts, "part").mapInArrow(lean(match), FOUND)


def further(left: DataFrame, chunks: DataFrame, percent: int) -> DataFrame:
    """(doc_id, line, doc0, line0): all proposals for the entries ``left`` from the
    chunks of their tokens."""
    def run(batches):
        for b in batches:
            tok, doc, line, n, pos = (b.column(i).to_numpy().astype(np.int64) for i in range(5))
            parity = b.column(5).to_numpy().view(np.uint64)
            out = [[], [], [], []]
            for i, block in enumerate(b.column(6).to_pylist()):
                y = unpack([block])
                k = len(y["doc"])
                x = {"doc": np.full(k, doc[i]), "line": np.full(k, line[i]), "n": np.full(k, n[i]), "pos": np.full(k, pos[i]), "parity": np.full(k, parity[i])}
                ok = fits(x, y, percent) & ((y["doc"] < doc[i]) | ((y["doc"] == doc[i]) & (y["line"] < line[i])))
                for c, v in zip(out, (x["doc"], x["line"], y["doc"], y["line"])):
                    c.append(v[ok])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), k) for c, k in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int32()))],
                                             ["doc_id", "line", "doc0", "line0"]) if b.num_rows else b
    cols = ["tok", "doc_id", "line", "n", "pos", "parity", "chunk"]
    return left.join(chunks, "tok").select(*cols).mapInArrow(lean(run), "doc_id long, line int, doc0 long, line0 int")


def line_sets(docs: DataFrame, lines: DataFrame, width: int) -> DataFrame:
    """(doc_id, line, set) of the wanted lines (doc_id, line); only these lines
    of a document go to Python."""
    want = lines.groupBy("doc_id").agg(F.collect_set("line").alias("lines"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(want, "doc_id")
    rows = rows.select("doc_id", F.split("text", "\n").alias("t"), "lines")
    rows = rows.select("doc_id", F.explode(F.transform("lines", lambda i: F.struct(i.alias("line"), F.get("t", i).alias("text")))).alias("l")).select("doc_id", "l.line", "l.text")

    def run(batches):
        for b in batches:
            data, offs = text_bytes(b.column(2))
            count, parts = [np.zeros(1, np.int64)], [np.zeros(0, np.int64)]
            for a, z in slices(offs):
                o = offs[a:z + 1]
                t, _, _, h = words(LOWER[data[o[0]:o[-1]]], o - o[0], SEPARATOR)
                t, h = shingles(t, h, width)
                s = np.lexsort((h, t))
                t, h = t[s], h[s]
                new = np.append(True, (t[1:] != t[:-1]) | (h[1:] != h[:-1]))[:len(t)]
                count.append(np.bincount(t[new], minlength=z - a))
                parts.append(h[new].view(np.int64))
            sets = pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(count)), pa.int32()), pa.array(np.concatenate(parts)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), sets], ["doc_id", "line", "set"])
    return rows.mapInArrow(lean(run), "doc_id long, line int, set array<long>").dropDuplicates(["doc_id", "line"])


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(doc_id, line) of the lines of pairs that are alike."""
    both = (pairs.join(sets.select("doc_id", "line", F.col("set").alias("a")), ["doc_id", "line"])
            .join(sets.select(F.col("doc_id").alias("doc0"), F.col("line").alias("line0"), F.col("set").alias("b")), ["doc0", "line0"]))
    common, total = F.size(F.array_intersect("a", "b")), F.size("a") + F.size("b")
    alike = both.select("doc_id", "line", common.alias("i"), total.alias("s")).filter(100 * F.col("i") >= percent * (F.col("s") - F.col("i")))
    return alike.select("doc_id", "line").distinct()


def removed_lines(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, line), lines from 0, of all lines like an earlier one."""
    key = ["doc_id", "line"]
    found = written(proposals(docs, rarity(docs, width), width, percent), "line-proposals")

    def pairs(rows, column):
        return rows.select(*key, F.explode(column).alias("p")).select(*key, "p.doc0", "p.line0")

    def earlier(rows):
        return rows.select(F.col("doc0").alias("doc_id"), F.col("line0").alias("line"))
    # the sets of all lines that have or are a proposal, so that texts are joined once
    lines = found.filter("first IS NOT NULL").select(*key).union(earlier(pairs(found, F.concat("first", "rest")))).distinct()
    sets = written(line_sets(docs, written(lines, "proposed-lines"), width), "line-sets")
    gone = verify(written(pairs(found, "first").distinct(), "line-pairs"), sets, percent)
    gone = written(gone.union(found.filter("first IS NULL AND doc_id IS NOT NULL").select(*key)).distinct(), "removed-lines")
    left = written(found.filter("size(rest) > 0 OR more").join(gone, key, "left_anti"), "unsettled-lines")
    if left.limit(1).count():
        more = written(further(left.filter("more").drop("chunk"), found.filter("chunk IS NOT NULL").select("tok", "chunk"), percent).distinct(), "further-pairs")
        new = written(earlier(more).distinct().join(sets.select(*key), key, "left_anti"), "further-lines")
        if new.limit(1).count():
            sets = sets.union(written(line_sets(docs, new, width), "line-sets"))
        gone = written(gone.union(verify(written(pairs(left, "rest").union(more).distinct(), "line-pairs"), sets, percent)).distinct(), "removed-lines")
    return gone


def dedup_report(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_lines, n_removed, removed_sha256 (of the removed line numbers,
    ascending, comma-joined) for every row of ``docs``."""
    gone = removed_lines(docs, width, percent).groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("lines"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"))
    out = rows.join(gone, "doc_id", "left")
    lines = F.coalesce("lines", F.array().cast("array<int>"))
    return out.select("doc_id", "n_lines", F.size(lines).cast("long").alias("n_removed"),
                      F.sha2(F.concat_ws(",", F.transform(lines, lambda x: x.cast("string"))), 256).alias("removed_sha256"))


def drop_lines(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with the removed lines cut from ``text``; rows and columns stay."""
    gone = removed_lines(docs, width, percent).groupBy("doc_id").agg(F.collect_set("line").alias("__gone")).withColumnRenamed("doc_id", "__id")
    out = docs.join(gone, F.col("doc_id").cast("long") == F.col("__id"), "left")
    left = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.when(~F.array_contains("__gone", i), x)), lambda x: x.isNotNull())
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return out.select(*((text if c == "text" else F.col(c)).alias(c) for c in docs.columns))
