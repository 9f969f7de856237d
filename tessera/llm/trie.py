"""Operator 11: prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of first d turns (role, text), its id a 128-bit sum of
hashes of (position, turn), so that a conversation's nodes are running sums over its
turns; ``paths`` holds (conv, pos, id, parent).  Nodes, members and ends are grouped
by id.  Texts never leave the task that reads them.

Subtree totals come from a centroid decomposition of the parent-edge forest.  A
component is a connected part, named by its top.  Its centroid is the deepest node
that carries at least half the component's weight; the weight of a node's subtree is
known from the start (the turns that its members have from there on).  The values in
the component below and at the centroid are summed and added to every node on the way
from the centroid to the top; then the centroid goes, its children become tops, and
the weights on that way shrink.  A node and any of its ancestors are parted by just
one centroid, which lies between them, so each value reaches each ancestor once, and
the number of rounds grows with the logarithm of all turns, however deep the trie.

Rounds of joins split the components heavier than ``SMALL`` or a ``COMPONENTS``-th of
all turns: these are at most ``COMPONENTS``, so their centroids are broadcast.
Whether a node is below the centroid, and under which child, is read from the path of
its smallest member, at the depth after the centroid's.  The other components, of a
bounded size, are decomposed in the same way inside tasks, many at once.

Cases: rows with a null conv_id belong to no conversation; null role or text is empty;
turns ascend, null first, equal ones by the SHA-256 of their content; a conversation
without turns is a member of the root alone; an empty table has no node, not even a
root; long conversations and texts take no more memory than others; further columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .running import lookup, running_sums, whole_groups
from .textbatch import map_batches
from .written import written

#: weight up to which a component is decomposed inside a task
SMALL = 1 << 14
#: components split in one round at most; a heavier share than one of so many counts as large
COMPONENTS = 50_000
#: rebuilding: conversations share the head of the first one of their block
BLOCK, HEAD = 5, 9
_ROOT = bytes(16)


def numbered(df: DataFrame) -> DataFrame:
    """(conv, n, key, bytes): the turns of each conversation numbered from 1; ``key`` is
    the SHA-256 of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = df.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), key.alias("key"),
                                                   F.octet_length(text).cast("long").alias("bytes"), F.lit(1).cast("long").alias("n"))
    return running_sums(written(rows, "trie-turns"), "conv", ["turn", "key"], ["n"], "trie-numbered").drop("turn")


def plain(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (conv, pos, key, bytes, len) and conversations (conv, len) as they are."""
    convs = written(turns.groupBy("conv").agg(F.max("n").alias("len")), "trie-convs")
    return turns.withColumnRenamed("n", "pos").join(convs, "conv"), convs


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same after each conversation c took its first h turns from conversation
    c - c % BLOCK (fewer, if that has fewer), h = crc32(c) % HEAD."""
    convs = turns.groupBy("conv").agg(F.max("n").alias("n_own"))
    convs = convs.withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % HEAD).withColumn("base", F.col("conv") - F.col("conv") % BLOCK)
    convs = written(convs, "trie-own")
    size = convs.select(F.col("conv").alias("b"), F.col("n_own").alias("n_base"))
    used = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = (convs.join(size, F.col("base") == F.col("b"), "left").withColumn("used", used)
             .withColumn("len", F.col("used") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).select("conv", "base", "h", "used", "len"))
    convs = written(convs, "trie-convs")
    head = turns.filter(F.col("n") < HEAD).withColumnRenamed("conv", "base")
    head = head.join(convs, "base").filter("n <= h").select("conv", F.col("n").alias("pos"), "key", "bytes", "len")
    own = turns.join(convs, "conv").filter("n > h").select("conv", (F.col("n") - F.col("h") + F.col("used")).alias("pos"), "key", "bytes", "len")
    return head.union(own), convs.select("conv", "len")


def path_rows(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, pos, id, parent, bytes, len), the root at pos 0 included."""
    rows = rows.select("conv", "pos", "bytes", "len", F.xxhash64(F.lit(1), "pos", "key").alias("a0"), F.xxhash64(F.lit(2), "key", "pos").alias("b0"))
    rows = running_sums(written(rows.select("*", F.col("a0").alias("a"), F.col("b0").alias("b")), "trie-rows"), "conv", ["pos"], ["a", "b"], "trie-sums")

    def binary(*lanes: np.ndarray) -> pa.Array:
        data = np.ascontiguousarray(np.stack(lanes, axis=1))
        return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(np.arange(0, 16 * len(data) + 1, 16, dtype=np.int32)), pa.py_buffer(data)])

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        a0, b0, a, c = (b.column(i).to_numpy() for i in range(4, 8))
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), binary(a, c), binary(a - a0, c - b0), b.column(2), b.column(3)],
                                          ["conv", "pos", "id", "parent", "bytes", "len"])
    schema = "conv long, pos long, id binary, parent binary, bytes long, len long"
    roots = convs.select("conv", F.lit(0).cast("long").alias("pos"), F.lit(_ROOT).alias("id"), F.lit(None).cast("binary").alias("parent"),
                         F.lit(0).cast("long").alias("bytes"), "len")
    return written(map_batches(rows, run, schema).union(roots), "trie-paths")


def ends_hash(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256) of rows (id, conv): the conversations of an id in ascending
    order, comma-joined.  Tasks join the parts of an id; then one streams through its
    parts, few rows even where very many conversations end at one node."""
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches):
        for b in batches:
            if b.num_rows:
                ids, convs = b.column(0).to_pylist(), b.column(1).to_pylist()
                at = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1])]
                yield pa.RecordBatch.from_arrays([pa.array([ids[a] for a in at], pa.binary()), pa.array([convs[a] for a in at], pa.int64()),
                                                  pa.array([",".join(map(str, convs[a:z])) for a, z in zip(at, [*at[1:], len(ids)])])], ["id", "first", "part"])

    def stream(batches):
        last, state = None, None
        for b in batches:
            out: list[tuple] = []
            for i, part in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if i != last:
                    if state is not None:
                        out.append((last, state.hexdigest()))
                    last, state = i, hashlib.sha256(part.encode())
                else:
                    state.update(b"," + part.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())], ["id", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()])], ["id", "ends_sha256"])
    packed = (ends.select("id", "conv").repartitionByRange(parts, "id", "conv").sortWithinPartitions("id", "conv")
              .mapInArrow(pack, "id binary, first long, part string"))
    return packed.repartition(parts, "id").sortWithinPartitions("id", "first").mapInArrow(stream, "id binary, ends_sha256 string")


def balanced_sums(parent: np.ndarray, depth: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree sums of ``values`` [n, k] over a forest of nodes with a parent's index
    (-1: a top) by centroid decomposition, all components at once."""
    n, acc, up, live = len(parent), np.zeros_like(values), parent.copy(), np.ones(len(parent), bool)
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
    while live.any():
        size, total, top = live.astype(np.int64), np.where(live[:, None], values, 0), np.arange(n)
        inner = [r[live[r] & (up[r] >= 0)] for r in levels]
        for r in reversed(inner):
            np.add.at(size, up[r], size[r])
            np.add.at(total, up[r], total[r])
        for r in inner:
            top[r] = top[up[r]]
        half = np.flatnonzero(live & (2 * size >= size[top]))
        half = half[np.lexsort((size[half], top[half]))]
        cent = half[np.append(True, top[half][1:] != top[half][:-1])]
        cur, t = cent, total[cent]
        while len(cur):  # one way in each component
            acc[cur] += t
            on = up[cur] >= 0
            cur, t = up[cur][on], t[on]
        live[cent] = False
        gone = np.zeros(n + 1, bool)
        gone[cent] = True
        up[gone[up]] = -1
    return acc


def sums_in_tasks(pool: DataFrame, values: list[str]) -> DataFrame:
    """Subtree sums of whole components (id, parent, top, depth, values)."""
    parts = int(pool.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        for t in whole_groups(batches, 2):
            ids = t.column(0).to_pylist()
            at = {x: i for i, x in enumerate(ids)}
            parent = np.array([-1 if x == top else at[p] for x, p, top in zip(ids, t.column(1).to_pylist(), t.column(2).to_pylist())])
            got = balanced_sums(parent, t.column(3).to_numpy(), np.stack([t.column(4 + k).to_numpy() for k in range(len(values))], axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), *(pa.array(got[:, k]) for k in range(len(values)))], ["id", *values])
    rows = pool.select("id", "parent", "top", "depth", *values).repartition(parts, "top").sortWithinPartitions("top")
    return rows.mapInArrow(run, "id binary, " + ", ".join(f"{v} long" for v in values))


def rollup(nodes: DataFrame, paths: DataFrame, values: list[str]) -> DataFrame:
    """(id, values): subtree sums over ``nodes`` (id, parent, rep, depth, sub, values), where
    ``rep`` is a member conversation and ``sub`` the subtree's weight, above every child's."""
    cols = ["id", "parent", "rep", "depth", "top", "tdepth", "sub", *values]
    live = written(nodes.withColumn("top", F.lit(_ROOT)).withColumn("tdepth", F.lit(0).cast("long")).select(*cols), "trie-live")
    small = max(SMALL, (live.agg(F.max("sub")).first()[0] or 0) // COMPONENTS)
    step = paths.select(F.col("conv").alias("p_conv"), F.col("pos").alias("p_pos"), F.col("id").alias("p_id"), F.col("parent").alias("p_parent"))
    found, pool = [], []
    while True:
        large = written(live.groupBy("top").agg(F.max("sub").alias("size")).filter(F.col("size") > small), "trie-large")
        pool.append(live.join(F.broadcast(large), "top", "left_anti").select("id", "parent", "top", "depth", *values))
        if not large.limit(1).count():
            break
        heavy = live.join(F.broadcast(large), "top")
        pick = F.min(F.struct("sub", F.col("id").alias("c"), F.col("rep").alias("c_rep"), F.col("depth").alias("c_depth"), F.col("tdepth").alias("c_top")))
        cent = written(heavy.filter("2 * sub >= size").groupBy("top").agg(pick.alias("x")).select("top", F.col("x.sub").alias("c_sub"), "x.c", "x.c_rep", "x.c_depth", "x.c_top"), "trie-centroids")
        near = live.join(F.broadcast(cent), "top")
        # below the centroid: the smallest member's path leads through it; its next node is the new top
        deep = near.filter("depth > c_depth").join(step, (F.col("rep") == F.col("p_conv")) & (F.col("c_depth") + 1 == F.col("p_pos")))
        under = F.col("p_parent") == F.col("c")
        deep = deep.select(*(c for c in cols if c not in ("top", "tdepth")), F.when(under, F.col("p_id")).otherwise(F.col("top")).alias("top"),
                           F.when(under, F.col("p_pos")).otherwise(F.col("tdepth")).alias("tdepth"), "c", under.alias("under"))
        flat = near.filter("depth <= c_depth").withColumn("under", F.col("id") == F.col("c"))
        state = written(deep.select(*cols, "c", "under").union(flat.select(*cols, "c", "under")), "trie-state")
        total = written(state.filter("under").groupBy("c").agg(*(F.sum(v).alias(v) for v in values)), "trie-totals")
        way = cent.filter("c_depth > c_top").withColumn("p_pos", F.explode(F.sequence("c_top", F.col("c_depth") - 1)))
        way = way.join(step.drop("p_parent"), (F.col("c_rep") == F.col("p_conv")) & (way.p_pos == step.p_pos)).select(F.col("p_id").alias("id"), "c", "c_sub")
        way = written(way.join(F.broadcast(total), "c").select("id", "c_sub", *values), "trie-ways")
        found += [way.select("id", *values), total.withColumnRenamed("c", "id")]
        left = state.filter("id <> c").join(way.select("id", "c_sub"), "id", "left").withColumn("sub", F.col("sub") - F.coalesce("c_sub", F.lit(0)))
        live = written(left.select(*cols), "trie-live")
    rest = pool[0]
    for p in pool[1:]:
        rest = rest.union(p)
    out = sums_in_tasks(rest, values)
    for f in found:
        out = out.union(f.select("id", *values))
    return out.groupBy("id").agg(*(F.sum(v).alias(v) for v in values))


def trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    paths = path_rows(rows, convs)
    nodes = paths.groupBy("id").agg(F.min("conv").alias("rep"), F.first("pos").alias("depth"), F.first("parent").alias("parent"), F.count("*").alias("n_convs"),
                                    F.first("bytes").alias("bytes"), F.sum(F.col("len") - F.col("pos") + 1).alias("sub"))
    nodes = written(nodes, "trie-nodes")
    kids = nodes.filter("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "id")
    nodes = nodes.join(kids, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(nodes.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes")), "trie-counted")
    sums = rollup(nodes, paths, ["leaf", "saved"]).select("id", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    ends = paths.filter("pos = len").select("id", "conv")
    out = nodes.join(sums, "id").join(ends_hash(ends), "id", "left")
    share = nodes.count() / parts
    names = nodes.select(F.col("id").alias("up"), F.col("rep").alias("parent_conv_id"), "n_children")
    out = lookup(out, "parent", names, "up", "parent_conv_id", F.col("n_children") > share)
    return out.select(F.col("rep").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, rebuild: bool = False) -> DataFrame:
    """``trie`` of rows (conv_id, turn, role, text), as they are or rebuilt."""
    turns = numbered(conversations)
    return trie(*(rebuilt if rebuild else plain)(turns))


ORACLE_SQL = """
WITH t AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k) AS n, k, bytes
  FROM (SELECT conv_id AS c, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
    strlen(coalesce(text, '')) AS bytes FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (
  SELECT c, c - c % 5 AS b, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda acc, x:
      list_reduce([xor(acc, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)) + z)), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT c FROM t)),
r AS (
  SELECT convs.c, 0 AS part, n, k, bytes FROM convs JOIN t ON t.c = b AND n <= h
  UNION ALL SELECT c, 1, n, k, bytes FROM t JOIN convs USING (c) WHERE n > h),
p AS (
  SELECT c, coalesce(list(k ORDER BY part, n) FILTER (WHERE k IS NOT NULL), []::VARCHAR[]) AS l,
    list(bytes ORDER BY part, n) FILTER (WHERE k IS NOT NULL) AS lens FROM convs LEFT JOIN r USING (c) GROUP BY c),
nodes AS (
  SELECT l[1:d] AS k, d AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(CASE WHEN d > 0 THEN lens[d] ELSE 0 END) AS bytes,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(l) = d), '') AS ends
  FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM p) GROUP BY l[1:d], d),
kids AS (SELECT k[1:depth - 1] AS k, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
full_ AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (k)),
sums AS (
  SELECT k[1:a] AS k, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM full_) GROUP BY 1)
SELECT f.conv_id, f.depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_ f JOIN sums USING (k) LEFT JOIN full_ up ON f.depth > 0 AND up.k = f.k[1:f.depth - 1]
"""
