import hashlib
import random
import zlib

import pytest

from tessera.llm import merkle as M
from tessera.llm import running as R


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, fan):
    """(root, proof of each leaf as (before, after) lists)."""
    where, proofs = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, w in enumerate(where):
            a = w - w % fan
            proofs[i].append(("".join(nodes[a:w]), "".join(nodes[w + 1:a + fan])))
        where = [w // fan for w in where]
        nodes = [h(*nodes[a:a + fan]) for a in range(0, len(nodes), fan)]
    return nodes[0], proofs


def brute(rows, fan, every):
    langs, out = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode())), []
    parts = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in langs}
    trees = {g: tree([leaf(r) for r in parts[g]], fan) for g in langs}
    root, above = tree([trees[g][0] for g in langs], fan)
    for g, up in zip(langs, above):
        for r, low in zip(parts[g], trees[g][1]):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % every == 0 and r[3] is not None
            f = leaf((*r[:3], r[3] + 1, r[4])) if bad else leaf(r)
            for a, b in low + up:
                f = h(a, f, b)
            out.append((r[0], leaf(r), trees[g][0], root, h(*(a + b for a, b in low + up)), f, f == root))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "t", b"x") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, idx int, tree string, digest binary").repartition(5)


def corpus(seed, n):
    r = random.Random(seed)
    rows = [(r.randrange(4 * n), r.choice(["a", "bé", None, ""]), r.choice(["en"] * 5 + ["fr", "é", None, "", "="]), r.choice([None, 5, -3, 10**12]),
             r.choice([None, "", "x" * r.randrange(40), "日本 1:2"])) for _ in range(n)]
    return rows + rows[:3] + [rows[0]] * 20 + [(None, "s", "en", 4, "t"), (None, "s", "en", 4, "u"), (7, "s", "one", 1, "w" * 200_000)]


@pytest.mark.parametrize("seed,n,fan,step", [(1, 90, 2, 6), (2, 60, 3, 1), (3, 150, 5, 2), (4, 64, 2, 2)])
def test_matches_brute_force(spark, monkeypatch, seed, n, fan, step):
    monkeypatch.setattr(M, "STEP", step)
    rows = corpus(seed, n)
    got = sorted((tuple(x) for x in M.manifest(frame(spark, rows), fan=fan, every=3).collect()), key=repr)
    want = brute(rows, fan, 3)
    assert got == want
    assert {x[6] for x in want} == {True, False}


def test_one_row_and_empty_table(spark):
    row = (0, None, None, 3, "text")
    got = [tuple(x) for x in M.manifest(frame(spark, [row])).collect()]
    assert got == brute([row], 2, 7)
    none = M.manifest(frame(spark, [row]).limit(0))
    assert none.collect() == [] and none.columns[0] == "doc_id"


def test_running_sums_across_partitions(spark):
    r = random.Random(5)
    rows = [(r.choice("aaaaaab"), r.choice([None, *range(9)]), r.randrange(-2**63, 2**63)) for _ in range(500)] + [("c", 1, 5)] * 40
    got = R.running_sums(spark.createDataFrame(rows, "g string, o int, v long").withColumn("n", M.F.lit(1).cast("long")).withColumn("key", M.F.col("v")).repartition(7),
                         "g", ["o", "key"], ["v", "n"], "sums").collect()
    assert len(got) == len(rows)
    for g in "abc":
        mine = sorted((x for x in got if x.g == g), key=lambda x: x.n)
        assert [x.n for x in mine] == list(range(1, len(mine) + 1))
        want = sorted((x for x in rows if x[0] == g), key=lambda x: (x[1] is not None, x[1] or 0, x[2]))
        assert [x.key for x in mine] == [x[2] for x in want]
        total = 0
        for x, w in zip(mine, want):
            total += w[2]
            assert (x.v - total) % 2**64 == 0
