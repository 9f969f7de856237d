"""Operator 8: near-duplicate documents by fast similarity sketching.

A document is the set of its distinct word shingles (64-bit hashes).  Equal
sets form one class, represented by its smallest doc_id; only representatives
go on.  A sketch has ``COORDS`` coordinates: in round i every shingle is hashed
to a bin and a value, an empty bin keeps its smallest value, and rounds go on
until all bins are full; after ``COORDS`` rounds, round COORDS + j fills bin j
from all shingles, so every coordinate fills.  Two coordinates agree with the
sets' similarity, more concentrated than independent hashes.  ``BANDS`` bands of
``ROWS`` coordinates put similar sets in a common bucket (at similarity 0.8 all
bands miss with probability 3e-6), and pairs are confirmed on the full sets.

Only components are asked for, so a bucket's pairs aren't all made: members are
confirmed against its smallest id, then, where a bucket still holds several
components, those of other components against ``HUBS`` members drawn by hash.
What then remains are pairs of different components in a common bucket, compared by
blocks of members inside tasks: sketches first, with all ``COORDS`` coordinates, where
pairs within ``SIGMAS`` standard deviations of the threshold go on (a pair at the
threshold is lost with probability 4e-6); then, for the members of such pairs, the
full sets, once for each pair.  Only links leave a task.

Cases: null, empty or wordless texts have no shingles and link with nothing;
fewer words than a shingle make one shingle; equal texts link through their
class; rows that share a doc_id count as one document; a null doc_id keeps its
row, alone; an empty table gives an empty result; further columns are ignored by
``near_duplicates`` and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbatch import LOWER, SPACE, lean, map_batches, mix, shingles, slices, text_bytes, words
from .written import components, written

COORDS, BANDS, ROWS = 512, 32, 5
HUBS = 4
SIGMAS = 4.5
#: members of a bucket that are compared with each other at once
BLOCK = 2048
_FULL = np.uint64(np.iinfo(np.uint64).max)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(data: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of the distinct shingles of each text, sorted."""
    t, _, _, h = words(LOWER[data], offs, SPACE)
    t, h = shingles(t, h, width)
    o = np.lexsort((h, t))
    t, h = t[o], h[o]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    return t[new], h[new]


def sketch(text: np.ndarray, h: np.ndarray, n: int, coords: int = COORDS) -> np.ndarray:
    """[n, coords] sketch of the sets given by sorted (text, hash); rows of
    texts without elements stay unfilled."""
    table = np.full((n, coords), _FULL, np.uint64)
    flat = table.reshape(-1)
    low = np.uint64((2 * coords - 1).bit_length())
    high = np.uint64(64) - low
    t, x = text, h
    for i in range(2 * coords):
        if not len(t):
            break
        with np.errstate(over="ignore"):
            v = mix(x + np.uint64(i + 1) * _STEP)
        if i < coords:
            where = ((v >> np.uint64(40)) * np.uint64(coords)) >> np.uint64(24)
        else:
            where = np.full(len(v), i - coords, np.uint64)
        # an earlier round has the smaller value, so a full bin stays as it is; the
        # round's number takes the bits of 2 * coords - 1
        np.minimum.at(flat, t * coords + where.astype(np.int64), (np.uint64(i) << high) | (mix(v) >> low))
        live = np.unique(t)
        open_ = np.zeros(n, bool)
        open_[live] = (table[live] == _FULL).any(axis=1)
        more = open_[t]
        t, x = t[more], x[more]
    return table


def band_hashes(table: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """[n, bands] hashes; the band's number is part of its hash."""
    out = np.empty((len(table), bands), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            acc = np.full(len(table), np.uint64(b + 1) * _STEP)
            for r in range(rows):
                acc = mix(acc ^ table[:, b * rows + r]) + _STEP
            out[:, b] = acc
    return out.view(np.int64)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n (set size), s0, s1 (128 bits of the set), bands, and the last byte
    of each coordinate."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        data, offs = text_bytes(b.column(1))
        size, keys = np.zeros(b.num_rows, np.int64), np.zeros((2, b.num_rows), np.uint64)
        bands, last = np.zeros((b.num_rows, BANDS), np.int64), [b""] * b.num_rows
        for a, z in slices(offs):
            o = offs[a:z + 1]
            t, h = shingle_sets(data[o[0]:o[-1]], o - o[0], width)
            size[a:z] = np.bincount(t, minlength=z - a)
            if len(t):
                at = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
                for k in (0, 1):
                    keys[k, a + t[at]] = np.add.reduceat(mix(h + np.uint64(k * 7 + 1)), at)
            table = sketch(t, h, z - a)
            bands[a:z] = band_hashes(table)
            last[a:z] = [x.tobytes() for x in table.astype(np.uint8)]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS), pa.int32()), pa.array(bands.ravel()))
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)), lists, pa.array(last, pa.binary())],
                                          ["doc_id", "n", "s0", "s1", "bands", "sketch"])
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                       "doc_id long, n long, s0 long, s1 long, bands array<long>, sketch binary")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """id and the sorted distinct shingle hashes of each row."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        data, offs = text_bytes(b.column(1))
        count, parts = [np.zeros(1, np.int64)], []
        for a, z in slices(offs):
            o = offs[a:z + 1]
            t, h = shingle_sets(data[o[0]:o[-1]], o - o[0], width)
            count.append(np.bincount(t, minlength=z - a))
            parts.append(h.view(np.int64))
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(count)), pa.int32()), pa.array(np.concatenate(parts)))
        return pa.RecordBatch.from_arrays([b.column(0), lists], ["id", "set"])
    return map_batches(docs.select("doc_id", "text"), run, "id long, set array<long>")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union."""
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b"))
    common = F.size(F.array_intersect("sa", "sb"))
    return (both.select("a", "b", common.alias("i"), (F.size("sa") + F.size("sb")).alias("s"))
            .filter(100 * F.col("i") >= percent * (F.col("s") - F.col("i"))).select("a", "b"))


KEYS = ["bucket", "i", "j"]


def groups(batches):
    """Tables of whole groups from batches sorted by ``KEYS``, with the groups'
    first rows and the end."""
    held: list[pa.RecordBatch] = []

    def cut(t):
        k = np.stack([t.column(x).to_numpy() for x in KEYS], axis=1)
        return k, np.flatnonzero(np.append(True, (k[1:] != k[:-1]).any(axis=1)))
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([*held, b])
        k, at = cut(t)
        last = int(at[-1])
        held = t.slice(last).combine_chunks().to_batches()
        if last:
            yield t.slice(0, last).combine_chunks(), k[:last], at  # the last start is the end
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        k, at = cut(t)
        yield t, k, np.append(at, len(k))


def likely(own, rep, n, c, sk, i, j, percent: int):
    """Index pairs of two components in one group whose sketches make the
    similarity likely, a few thousand at a time."""
    share = percent / 100
    least = COORDS * (share - SIGMAS * (share * (1 - share) / COORDS) ** 0.5)
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    for u in range(0, len(left), 256):
        x = left[u:u + 256]
        fit = (c[x][:, None] != c[right]) & (100 * np.minimum(n[x][:, None], n[right]) >= percent * np.maximum(n[x][:, None], n[right]))
        if i == j:
            fit &= rep[x][:, None] < rep[right]
        p, q = np.nonzero(fit)
        for v in range(0, len(p), 8192):  # 4 MB of coordinates at a time
            l, r = x[p[v:v + 8192]], right[q[v:v + 8192]]
            ok = (sk[l] == sk[r]).sum(axis=1) >= least
            if ok.any():
                yield l[ok], r[ok]


def remaining_links(members: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) linked members (bucket, rep, n, c, size) of one bucket and different
    components.  A bucket's members are dealt into blocks, and each pair of blocks
    is a group."""
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    dealt = (members.withColumn("own", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "n", "c"))
    cols = ["own", "rep", "n", "c"]

    def arrays(t: pa.Table):
        return (*(t.column(x).to_numpy() for x in cols), np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(len(t), COORDS))

    def screen(batches):
        for t, k, at in groups(batches):
            own, rep, n, c, sk = arrays(t)
            keep = np.zeros(len(k), bool)
            for a, z in zip(at[:-1], at[1:]):
                for l, r in likely(own[a:z], rep[a:z], n[a:z], c[a:z], sk[a:z], k[a, 1], k[a, 2], percent):
                    keep[a + l] = keep[a + r] = True
            if keep.any():
                yield from t.select([*KEYS, *cols]).filter(pa.array(keep)).combine_chunks().to_batches()

    def check(batches):
        for t, k, at in groups(batches):
            own, rep, n, c, sk = arrays(t)
            bands = t.column("bands").combine_chunks().flatten().to_numpy().reshape(len(k), BANDS)
            full = t.column("set").combine_chunks()
            off, val = full.offsets.to_numpy(), full.values.to_numpy()
            out = [], []
            for a, z in zip(at[:-1], at[1:]):
                for l, r in likely(own[a:z], rep[a:z], n[a:z], c[a:z], sk[a:z], k[a, 1], k[a, 2], percent):
                    l, r = a + l, a + r
                    # a pair is checked in the first band that it shares
                    first = (bands[l] == bands[r]).argmax(axis=1)
                    once = bands[l, first] == k[a, 0]
                    for x, y in zip(l[once], r[once]):
                        both = len(np.intersect1d(val[off[x]:off[x + 1]], val[off[y]:off[y + 1]], assume_unique=True))
                        if 100 * both >= percent * (n[x] + n[y] - both):
                            out[0].append(min(rep[x], rep[y]))
                            out[1].append(max(rep[x], rep[y]))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], ["a", "b"])

    def sorted_groups(df: DataFrame) -> DataFrame:
        return df.repartition(parts, *KEYS).sortWithinPartitions(*KEYS)
    some = sorted_groups(dealt.join(reps.select("rep", "sketch"), "rep").select(*KEYS, *cols, "sketch"))
    some = written(some.mapInArrow(lean(screen), "bucket long, i int, j int, own int, rep long, n long, c long"), "likely-members")
    full = some.join(reps.select("rep", "sketch", "bands"), "rep").join(sets.withColumnRenamed("id", "rep"), "rep")
    return sorted_groups(full.select(*KEYS, *cols, "sketch", "bands", "set")).mapInArrow(lean(check), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    rows = written(sketches(docs, width), "sketches")
    reps = (rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("s0", "s1")
            .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
    reps = written(reps, "representatives")
    members = reps.filter(100 * F.col("n") >= percent * (F.col("n") + 1)).select("rep", "n", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi").drop("hi")
    members = written(members.join(shared, "bucket"), "buckets")  # only buckets with two classes or more
    ids = members.select("rep").distinct()
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    one = text.join(ids.withColumnRenamed("rep", "doc_id"), "doc_id")
    sets = written(full_sets(one, width).dropDuplicates(["id"]), "shingle-sets")
    comp = ids.select(F.col("rep").alias("id"), F.col("rep").alias("component"))
    links = tested = None

    def fits(n, m):
        return 100 * F.least(n, m) >= percent * F.greatest(n, m)
    for step in ("smallest", "hubs", "rest"):
        own = members.join(comp.select(F.col("id").alias("rep"), F.col("component").alias("c")), "rep")
        drawn = [F.min(F.struct(F.xxhash64("rep", "bucket", F.lit(k)).alias("h"), "rep", "n", "c")).alias(f"h{k}") for k in range(HUBS)]
        many = own.groupBy("bucket").agg(F.count("*").alias("size"), F.min("c").alias("c0"), F.max("c").alias("c9"), *drawn).filter("c0 < c9")
        if step == "smallest":
            size = reps.select(F.col("rep").alias("lo"), F.col("n").alias("hn"))
            pairs = own.filter("rep <> lo").select("rep", "lo", "n").distinct().join(size, "lo").filter(fits(F.col("n"), F.col("hn"))).select(F.col("lo").alias("a"), F.col("rep").alias("b"))
        elif step == "hubs":
            if not HUBS:
                continue
            hubs = many.select("bucket", F.explode(F.array_distinct(F.array(*(F.col(f"h{k}") for k in range(HUBS))))).alias("h"))
            hubs = hubs.select(F.col("bucket").alias("bucket2"), *(F.col(f"h.{x}").alias(f"{x}2") for x in ("rep", "n", "c")))
            met = (F.col("bucket") == F.col("bucket2")) & (F.col("c") != F.col("c2")) & fits(F.col("n"), F.col("n2"))
            pairs = own.join(hubs, met).select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct()
        else:
            pairs = None
            found = written(remaining_links(own.join(many.select("bucket", "size"), "bucket"), reps, sets, percent), "links")
        if pairs is not None:
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            pairs = written(pairs, "pairs")
            if not pairs.limit(1).count():
                continue
            found = written(confirm(pairs, sets, percent), "links")
            tested = pairs if tested is None else tested.union(pairs)
        links = found if links is None else links.union(found)
        if found.limit(1).count():
            lab = components(links, "near-components")
            comp = ids.join(lab.withColumnRenamed("id", "rep"), "rep", "left").select(F.col("rep").alias("id"), F.coalesce("component", "rep").alias("component"))
            comp = written(comp, "labels")
    cls = reps.select("s0", "s1", "rep").join(comp.withColumnRenamed("id", "rep"), "rep", "left").select(
        "s0", "s1", F.coalesce("component", "rep").alias("cls"))
    cls = cls.withColumn("some", F.lit(True))
    out = rows.select("doc_id", "n", "s0", "s1", (F.col("n") > 0).alias("some")).join(cls, ["s0", "s1", "some"], "left")
    comp_id = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("cls", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp_id.alias("component_id"),
                      F.coalesce(comp_id == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group; columns stay.  Documents
    without words and rows without an id all stay."""
    found = near_duplicates(docs, width, percent)
    gone = found.filter("NOT kept").select("doc_id").distinct()
    same = found.filter("kept AND n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    left = docs.join(gone, docs.doc_id.cast("long") == gone.doc_id, "left_anti")
    key = left.doc_id.cast("long")
    twice = left.join(same, key == same.doc_id, "left_semi").dropDuplicates(["doc_id"])
    return left.join(same, key == same.doc_id, "left_anti").unionByName(twice)
