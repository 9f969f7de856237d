"""Operator 9: embedding near-duplicates by spherical-cap filters.

Directions of a random product code: the (rotated) space is cut into two halves
with ``CODES`` random codewords each, and every pair of codewords is a filter.  A
vector belongs to all filters whose direction it exceeds by ``LIFT`` standard
deviations (about 48 of 65,536); they are list-decoded from the scores of the
halves, without the first codewords that no second one can lift over the
threshold.  Vectors that share a filter are compared in double precision.  Pairs
at cosine 0.9 share a filter with probability 0.94 (recall on
the tables: README); more codewords or a lower ``LIFT`` raise it.  In fewer than 64
dimensions scores reach less far, and the lift is chosen so that a vector has 48
filters on average (0.95 or more of pairs at cosine 0.9 then share one); vectors of
fewer than ``SHORT`` components share one filter, so all their pairs are compared.

Equal vectors are one class, compared once.  A filter's members are dealt into
blocks of about ``BLOCK`` vectors and each pair of blocks is a task's group, so no
group grows with the data.  Groups are met twice: first by codes of a byte a
component, whose distance to the vector is known, so that no pair at the asked cosine
is missed; then those members that may have a partner, by their full vectors and
lists of filters.  A pair that shares several filters counts in its smallest.  Groups
return, for each vector, the number of its links and one link towards the smallest
id of its part, never the pairs.

Cases: vectors that are null, empty, zero or hold null or non-finite components
have no links and are their own component; vectors link only with others of the
same length; repeated rows and ids are counted as they stand; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .written import components, written

CODES = 256
LIFT = 3.1
BLOCK = 1024
SEED = 20
#: below so many components, all pairs are compared
SHORT = 16


@lru_cache(maxsize=8)
def code(dim: int):
    """(rotation, codebooks) for vectors of ``dim`` components."""
    rng = np.random.default_rng([SEED, dim])
    rot = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    books = []
    for cols in np.array_split(np.arange(dim), 2):
        b = rng.standard_normal((CODES, len(cols)))
        norm = np.linalg.norm(b, axis=1, keepdims=True)
        # a block's share of a unit direction
        books.append((cols, b / np.where(norm > 0, norm, 1) * np.sqrt(len(cols) / dim)))
    return rot, books


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; no overflow for large components."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@lru_cache(maxsize=64)
def lift_of(dim: int) -> float:
    """The lift that leaves 48 filters a vector on average, found on random
    directions; ``LIFT`` does so from 64 dimensions on."""
    if dim >= 64:
        return LIFT
    rot, books = code(dim)
    x = unit(np.random.default_rng([SEED, dim, 1]).standard_normal((100, dim))) @ rot
    s = [x[:, cols] @ b.T for cols, b in books]
    s = (s[0][:, :, None] + s[1][:, None, :]).ravel()
    k = len(s) - 48 * len(x)
    return min(LIFT, float(np.partition(s, k)[k] * np.sqrt(dim)))


def decode(x: np.ndarray, lift: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of all filters that the unit rows of ``x`` exceed, in order;
    filter 0 for every short row."""
    dim = x.shape[1]
    if dim < SHORT:
        return np.arange(len(x)), np.zeros(len(x), np.int64)
    rot, books = code(dim)
    x, floor = x @ rot, (lift_of(dim) if lift is None else lift) / np.sqrt(dim)
    s = [x[:, cols] @ b.T for cols, b in books]
    row, a = np.nonzero(s[0] >= (floor - s[1].max(axis=1))[:, None])
    k, b = np.nonzero(s[0][row, a][:, None] + s[1][row] >= floor)
    return row[k], a[k] * CODES + b


def encoded(x: np.ndarray) -> np.ndarray:
    """Unit rows as bytes: scale, distance to the row that the code stands for (both
    32-bit), and a byte a component."""
    scale = (np.abs(x).max(axis=1, keepdims=True) / 127).astype(np.float32)
    q = np.clip(np.rint(x / scale), -127, 127).astype(np.int8)
    off = np.linalg.norm(x - q * scale.astype(np.float64), axis=1, keepdims=True).astype(np.float32)
    return np.hstack([scale.view(np.uint8).reshape(len(x), 4), off.view(np.uint8).reshape(len(x), 4), q.view(np.uint8)])


def may_link(codes: np.ndarray, left: np.ndarray, right: np.ndarray, floor: float) -> np.ndarray:
    """Members of a group that have a partner (``left`` against ``right``) whose cosine
    may reach ``floor``: the codes' product is off by e + f + e f at most, for members
    that far from their codes, and by the rounding of 32-bit sums."""
    scale, off = codes[:, :4].copy().view(np.float32), codes[:, 4:8].copy().view(np.float32)
    x, e = codes[:, 8:].view(np.int8) * scale, float(off.max())
    li, ri = np.flatnonzero(left), np.flatnonzero(right)
    hit = x[li] @ x[ri].T >= floor - 2 * e - e * e - 1e-4
    if (left & right).all():
        np.fill_diagonal(hit, False)
    some = np.zeros(len(codes), bool)
    some[li] |= hit.any(axis=1)
    some[ri] |= hit.any(axis=0)
    return some


KEYS = ["filter", "dim", "i", "j"]


def groups(batches):
    """(table, key, start, end) of groups of two rows or more, from batches sorted by ``KEYS``."""
    held: list[pa.RecordBatch] = []

    def cut(t: pa.Table, whole: bool):
        k = np.stack([t.column(c).to_numpy() for c in KEYS], axis=1)
        at = np.flatnonzero(np.append(True, (k[1:] != k[:-1]).any(axis=1)))
        end = len(k) if whole else int(at[-1])
        return end, [(t, k[a], a, z) for a, z in zip(at, np.append(at[1:], len(k))) if z <= end and z - a > 1]
    for b in batches:
        if b.num_rows:
            t = pa.Table.from_batches([*held, b]).combine_chunks()
            end, found = cut(t, False)
            yield found
            held = t.slice(end).combine_chunks().to_batches()
    if held:
        yield cut(pa.Table.from_batches(held).combine_chunks(), True)[1]


def group_links(x, ids, mult, filters, this, left, right, floor):
    """Links between ``left`` and ``right`` (masks; equal masks: within) in one
    group: (ids, sum of partners' multiplicities, smallest id of the part)."""
    same = bool((left & right).all())
    li, ri = np.flatnonzero(left), np.flatnonzero(right)
    hit = x[li] @ x[ri].T >= floor
    if same:
        np.fill_diagonal(hit, False)
    a, b = np.nonzero(hit)
    if not len(a):
        return None
    a, b = li[a], ri[b]
    # the pair counts where no smaller filter is shared
    used = np.unique(np.concatenate([a, b]))
    f, c = np.unique(np.concatenate([filters[i][filters[i] < this] for i in used]), return_counts=True)
    f = f[c > 1]
    if len(f):
        member = np.zeros((len(ids), len(f)), np.float32)
        for i in used:
            w = np.searchsorted(f, filters[i])
            w = w[w < len(f)]
            member[i, w[np.isin(f[w], filters[i])]] = 1
        seen = (member[li] @ member[ri].T > 0)
        keep = ~seen[np.searchsorted(li, a), np.searchsorted(ri, b)]
    else:
        keep = np.ones(len(a), bool)
    links = np.bincount(a[keep], weights=mult[b[keep]], minlength=len(ids)).astype(np.int64)
    if not same:
        links += np.bincount(b[keep], weights=mult[a[keep]], minlength=len(ids)).astype(np.int64)
    lab = ids.copy()
    while True:  # smallest id over the links found here, whichever filter counts them
        new = lab.copy()
        np.minimum.at(new, a, lab[b])
        np.minimum.at(new, b, lab[a])
        if (new == lab).all():
            break
        lab = new
    return ids[used], links[used], lab[used]


def near_vectors(vecs: DataFrame, cosine: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row (vec_id, embedding)."""
    wide = isinstance(vecs.schema["embedding"].dataType.elementType, T.DoubleType)
    raw = np.float64 if wide else np.float32
    v = vecs.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>" if wide else "array<float>").alias("v"))
    fine = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    v = written(v.withColumn("fine", F.coalesce(fine, F.lit(False))), "vectors")
    reps = written(v.filter("fine AND vec_id IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult")), "classes")

    def decoded(b: pa.RecordBatch):
        """(dim, rows of the batch, their components, row, filter) in pieces."""
        col = b.column(b.schema.get_field_index("v"))
        lens = np.diff(col.offsets.to_numpy())
        flat = col.flatten().to_numpy(zero_copy_only=False)
        start = np.concatenate([[0], np.cumsum(lens)])
        for dim in np.unique(lens):
            rows = np.flatnonzero(lens == dim)
            for c in range(0, len(rows), 2048):
                r = rows[c:c + 2048]
                x = flat[start[r][:, None] + np.arange(dim)]
                yield dim, r, x, *decode(unit(x))

    def count(batches):
        for b in batches:
            for dim, _, _, _, f in decoded(b):
                k, n = np.unique(f, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(np.full(len(k), dim, np.int32)), pa.array(n)], ["filter", "dim", "n"])
    # at most one row for each filter and vector length
    sizes = (reps.select("v").mapInArrow(count, "filter int, dim int, n long").groupBy("filter", "dim").agg(F.sum("n").alias("size")).filter("size > 1")
             .select("filter", "dim", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int").alias("blocks")))
    sizes = written(sizes, "filter-sizes")

    def members(batches):
        for b in batches:
            rep = b.column(0).to_numpy(zero_copy_only=False)
            for dim, r, x, who, f in decoded(b):
                codes = [y.tobytes() for y in encoded(unit(x))]
                for a in range(0, len(f), 20_000):
                    w = who[a:a + 20_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(f[a:a + 20_000].astype(np.int32)), pa.array(np.full(len(w), dim, np.int32)), pa.array(rep[r][w]),
                         pa.array([codes[i] for i in w], pa.binary())], ["filter", "dim", "rep", "code"])
    spread = reps.select("rep", "v").mapInArrow(members, "filter int, dim int, rep long, code binary")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    # CODES * CODES rows of 12 bytes for each vector length
    dealt = (spread.join(F.broadcast(sizes), ["filter", "dim"]).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("filter", "dim", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "code"))
    parts = int(vecs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def sorted_groups(df: DataFrame) -> DataFrame:
        return df.repartition(parts, *KEYS).sortWithinPartitions(*KEYS)

    def screen(batches):
        for found in groups(batches):
            for t, (_, dim, i, j), a, z in found:
                o = t.column("own").to_numpy()[a:z]
                if i == j or ((o == i).any() and (o == j).any()):
                    codes = np.frombuffer(b"".join(t.column("code").slice(a, z - a).to_pylist()), np.uint8).reshape(z - a, -1)
                    some = may_link(codes, o == i, o == j, cosine)
                    if some.any():
                        yield from t.select([*KEYS, "own", "rep"]).slice(a, z - a).filter(pa.array(some)).combine_chunks().to_batches()
    likely = written(sorted_groups(dealt).mapInArrow(screen, "filter int, dim int, i int, j int, own int, rep long"), "likely-members")

    def describe(batches):
        """Full vectors and filters of those that may have a partner."""
        for b in batches:
            rep, mult = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            for _, r, x, who, f in decoded(b):
                ends = np.cumsum(np.bincount(who, minlength=len(r)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rep[r]), pa.array(mult[r]), pa.array([y.tobytes() for y in np.ascontiguousarray(x, raw)], pa.binary()),
                     pa.array([f[a:z].astype(np.int32).tobytes() for a, z in zip(np.append(0, ends[:-1]), ends)], pa.binary())], ["rep", "mult", "vec", "filters"])
    whole = reps.join(likely.select("rep").distinct(), "rep").select("rep", "mult", "v").mapInArrow(describe, "rep long, mult long, vec binary, filters binary")

    def compare(batches):
        for found in groups(batches):
            out = [[], [], []]
            for t, (f, _, i, j), a, z in found:
                g = t.slice(a, z - a)
                x = unit(np.frombuffer(b"".join(g.column("vec").to_pylist()), raw).reshape(z - a, -1))
                fs = [np.frombuffer(y, np.int32) for y in g.column("filters").to_pylist()]
                o, ids, mult = (g.column(c).to_numpy() for c in ("own", "rep", "mult"))
                if i == j or ((o == i).any() and (o == j).any()):
                    r = group_links(x, ids, mult, fs, f, o == i, o == j, cosine)
                    if r:
                        for c, y in zip(out, r):
                            c.append(y)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["rep", "links", "low"])
    found = written(sorted_groups(likely.join(whole, "rep")).mapInArrow(compare, "rep long, links long, low long"), "vector-links")
    comp = components(found.filter("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b")), "vector-components")
    total = found.groupBy("rep").agg(F.sum("links").alias("links"))
    cls = (reps.join(total, "rep", "left").join(comp.withColumnRenamed("id", "rep"), "rep", "left")
           .select("v", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n"), F.coalesce("component", "rep").alias("cls"), F.lit(True).alias("fine")))
    out = v.join(cls, ["v", "fine"], "left")
    comp_id = F.when(F.col("vec_id").isNotNull(), F.coalesce("cls", "vec_id"))
    return out.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.coalesce("n", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
                      comp_id.alias("component_id"), F.coalesce(comp_id == F.col("vec_id"), F.lit(True)).alias("kept"))
