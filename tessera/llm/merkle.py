"""Operator 12: Merkle manifest of a table, by sibling-shift self-joins.

A row's leaf is the digest of its fields.  The leaves of a group (here a language)
form a tree in the order of their keys, and the groups' roots a tree of their own.
A node is (tree, idx, size of its level, digest).  A level joins its nodes to
themselves on (tree, sibling's idx), the sibling's idx being computed: idx XOR 1 in
a binary tree, else the slot shifted within the run of ``fan``.  The rows of slot
zero then hold their whole run and emit the parent, digest of the run's digests.
Every level is written; it keeps each node's siblings (those before it, those after).

The proof of a leaf is the list of its siblings up to the root.  Levels are joined
to their parents from the top down, so that a node takes its parent's list and puts
its own siblings in front.  Nothing is grouped: (tree, idx) is unique and a large
group is spread like any other rows.  Digests travel as bytes, texts never leave
the task that reads them.

H is the lowercase hex SHA-256 of its inputs, digests as hex text.  A lone leaf is
its tree's root; a last run of one node still becomes its H.

Cases: a null group comes first, as does a null key; a null field is ``-``, another
its UTF-8 length, ``:`` and value; rows with equal keys are ordered by their leaves,
repeated rows have leaves of their own; an empty table gives an empty result;
columns beside ``FIELDS`` are ignored; a long text is hashed where it is read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .running import running_sums
from .written import discard, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 2
#: levels of the way down that make one job
STEP = 6
#: manipulated rows of the report: those where this divides the CRC-32 of the key
TAMPER = 7


def field(c: Column) -> Column:
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def text(digest: Column) -> Column:
    """Digests as lowercase hex text."""
    return F.lower(F.hex(digest))


def digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def with_siblings(level: DataFrame, fan: int) -> DataFrame:
    """Each node with the digests of its run before (l) and after it (r)."""
    slot = F.col("idx") % fan
    out = level
    for s in range(1, fan):
        to = F.col("idx").bitwiseXOR(F.lit(1).cast("long")) if fan == 2 else F.col("idx") - slot + (slot + s) % fan
        other = level.select(F.col("tree").alias("tree_s"), F.col("idx").alias("idx_s"), F.col("digest").alias(f"s{s}"))
        out = out.withColumn("to", to).join(other, (F.col("tree") == F.col("tree_s")) & (F.col("to") == F.col("idx_s")), "left").drop("to", "tree_s", "idx_s")
    none = F.lit(b"")
    before = [F.when(slot + s >= fan, F.coalesce(f"s{s}", none)).otherwise(none) for s in range(1, fan)]
    after = [F.when(slot + s < fan, F.coalesce(f"s{s}", none)).otherwise(none) for s in range(1, fan)]
    return out.select(*level.columns, F.concat(*before).alias("l"), F.concat(*after).alias("r"))


def levels(leaves: DataFrame, fan: int = FAN) -> list[DataFrame]:
    """The levels of all trees, leaves (tree, idx, size, digest, others) first; a tree
    ends at the level where its size is 1."""
    cur, out = leaves, []
    top = cur.agg(F.max("size")).first()[0]
    if top is None:
        return []
    while True:
        lev = written(with_siblings(cur, fan) if top > 1 else cur.select(*cur.columns, F.lit(b"").alias("l"), F.lit(b"").alias("r")), "merkle-level")
        out.append(lev)
        if top == 1:
            return out
        run = lev.filter((F.col("size") > 1) & (F.col("idx") % fan == 0))  # slot zero emits the parent
        cur = run.select("tree", F.floor(F.col("idx") / fan).cast("long").alias("idx"), F.ceil(F.col("size") / fan).cast("long").alias("size"),
                         digest(text(F.col("digest")), text(F.col("r"))).alias("digest"))
        top = math.ceil(top / fan)


def tree_roots(levs: list[DataFrame]) -> DataFrame:
    """(tree, level, digest) of the node at which each tree ends."""
    roots = [lev.filter("size = 1").select("tree", F.lit(k).alias("level"), "digest") for k, lev in enumerate(levs)]
    return written(reduce(DataFrame.union, roots), "merkle-roots")


def paths(levs: list[DataFrame], fan: int, roots: DataFrame, above: DataFrame | None = None) -> DataFrame:
    """The leaves of ``levels`` with ``path``, the siblings from the leaf up to the root,
    and ``subroot``; ``above``, (tree, path), goes on from a tree's root."""
    ends = {r.level for r in roots.select("level").distinct().collect()}  # numbers of levels
    below = kept = None
    for k in range(len(levs) - 1, -1, -1):
        lev, got = levs[k], []
        others = [c for c in lev.columns if c not in ("size", "l", "r")] if k == 0 else ["tree", "idx"]
        if k in ends:
            root = lev.filter("size = 1").withColumn("subroot", F.col("digest"))
            root = root.join(above, "tree") if above is not None else root.withColumn("path", F.expr("CAST(array() AS array<struct<l: binary, r: binary>>)"))
            got.append(root.select(*others, "path", "subroot"))
        if below is not None:
            up = below.select(F.col("tree").alias("tree_p"), F.col("idx").alias("idx_p"), F.col("path").alias("rest"), "subroot")
            kids = lev.filter("size > 1").join(up, (F.col("tree") == F.col("tree_p")) & (F.floor(F.col("idx") / fan) == F.col("idx_p")))
            got.append(kids.select(*others, F.concat(F.array(F.struct("l", "r")), "rest").alias("path"), "subroot"))
        below = reduce(DataFrame.union, got)
        if k and k % STEP == 0:
            below = written(below, "merkle-paths")
            if kept:
                discard(lev.sparkSession, [kept])
            kept = below.written_to
    return below


def ranked(leaves: DataFrame, order: list[str], name: str) -> DataFrame:
    """``leaves`` (tree, ...) with idx, the number of earlier rows of the tree, and size."""
    rows = running_sums(leaves.withColumn("idx", F.lit(1).cast("long")), "tree", order, ["idx"], name)
    sizes = rows.groupBy("tree").agg(F.max("idx").alias("size"))
    return rows.withColumn("idx", F.col("idx") - 1).join(sizes, "tree")


def folded(leaf: Column, path: Column) -> Column:
    """The root recomputed from a leaf (hex text) and its siblings."""
    return F.aggregate(path, leaf, lambda acc, p: F.sha2(F.concat(text(p["l"]), acc, text(p["r"])), 256))


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS, tampered: str = "n_chars",
             fan: int = FAN, every: int = TAMPER) -> DataFrame:
    """For each row: ``key``, leaf, subroot, root, proof_sha256, folded_root, verified;
    the fold starts from the changed leaf where ``every`` divides the key's CRC-32."""
    def leaf(change: bool) -> Column:
        cols = [F.col(c) + 1 if change and c == tampered else F.col(c) for c in fields]
        return digest(*(field(c) for c in cols))
    spark = docs.sparkSession
    hit = F.crc32(F.col(key).cast("string").cast("binary")) % every == 0
    # a null group sorts before any other, bytewise
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = written(docs.select(tree.alias("tree"), F.col(key).alias("key"), leaf(False).alias("digest"),
                                 F.when(hit, leaf(True)).alias("bad")), "merkle-leaves")
    levs = levels(written(ranked(leaves, ["key", "digest"], "merkle-order"), "merkle-ranked"), fan)
    if not levs:
        return spark.createDataFrame([], f"{key} long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    subs = tree_roots(levs)
    names = subs.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    tops = levels(written(ranked(names, ["name"], "merkle-tops"), "merkle-ranked"), fan)
    root = tops[-1].first()["digest"]  # the one node of the last level
    above = written(paths(tops, fan, tree_roots(tops)).select(F.col("name").alias("tree"), "path"), "merkle-above")
    out = paths(levs, fan, subs, above)
    top = bytes(root).hex()
    siblings = F.array_join(F.transform("path", lambda p: F.concat(text(p["l"]), text(p["r"]))), "")
    own = text(F.col("digest"))
    return out.select(F.col("key").alias(key), own.alias("leaf"), text(F.col("subroot")).alias("subroot"), F.lit(top).alias("root"),
                      F.sha2(siblings, 256).alias("proof_sha256"),
                      folded(F.coalesce(text(F.col("bad")), own), F.col("path")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE_SQL = """
WITH RECURSIVE docs AS (
  SELECT *, coalesce('=' || lang, '') AS tree, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') AS head, coalesce(strlen(text) || ':' || text, '-') AS tail,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda acc, x:
      list_reduce([xor(acc, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)) + z)), 4294967295) % 7 = 0 AS hit
  FROM documents),
hashed AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN hit THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) END AS bad
  FROM docs),
src AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n,
    row_number() OVER () AS rid FROM hashed),
nodes(tree, lvl, idx, n, h) AS (
  SELECT tree, 0, idx, n, leaf FROM src
  UNION ALL
  SELECT tree, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY tree, lvl, idx // 2, n),
subs AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(lvl, idx, n, h) AS (
  SELECT 0, idx, n, h FROM subs
  UNION ALL
  SELECT lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY lvl, idx // 2, n),
height AS (SELECT tree, max(lvl) AS top FROM nodes GROUP BY tree),
low AS (
  SELECT rid, list(CASE WHEN o.h IS NULL THEN '-' WHEN o.idx < m.i THEN 'L' || o.h ELSE 'R' || o.h END ORDER BY m.lvl) AS p
  FROM (SELECT rid, tree, lvl, idx // (1::BIGINT << lvl) AS i FROM src JOIN height USING (tree), LATERAL (SELECT unnest(range(0, top)) AS lvl)) m
  LEFT JOIN nodes o ON o.tree = m.tree AND o.lvl = m.lvl AND o.idx = xor(m.i, 1) GROUP BY rid),
upper_ AS (
  SELECT tree, list(CASE WHEN o.h IS NULL THEN '-' WHEN o.idx < m.i THEN 'L' || o.h ELSE 'R' || o.h END ORDER BY m.lvl) AS p
  FROM (SELECT tree, lvl, idx // (1::BIGINT << lvl) AS i FROM subs, LATERAL (SELECT unnest(range(0, (SELECT max(lvl) FROM tops))) AS lvl)) m
  LEFT JOIN tops o ON o.lvl = m.lvl AND o.idx = xor(m.i, 1) GROUP BY tree),
full_ AS (
  SELECT doc_id, leaf, bad, subs.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root,
    list_concat(coalesce(low.p, []::VARCHAR[]), coalesce(upper_.p, []::VARCHAR[])) AS p
  FROM src JOIN subs USING (tree) LEFT JOIN low USING (rid) LEFT JOIN upper_ USING (tree)),
done AS (
  SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(p, lambda x: x[2:]), '')) AS proof_sha256,
    list_reduce(list_prepend(coalesce(bad, leaf), p), lambda acc, x: sha256(CASE WHEN x[1] = 'L' THEN x[2:] || acc ELSE acc || x[2:] END)) AS folded_root
  FROM full_)
SELECT *, folded_root = root AS verified FROM done
"""
