import numpy as np
import pytest

from tessera.operators import als_sums as A


@pytest.mark.parametrize("implicit", [False, True])
def test_partial_sums_match_dense_numpy(spark, monkeypatch, implicit):
    """Three iterations on small pieces and chunks against the normal equations of Spark ML's
    docs, in numpy; one user and one item with most of the ratings."""
    monkeypatch.setattr(A, "PIECE", 20)
    monkeypatch.setattr(A, "CHUNK", 7)
    monkeypatch.setattr(A, "CUT", 2)
    rng = np.random.default_rng(3)
    R = {(int(u), int(i)): float(rng.integers(1, 6)) - 2.5 * implicit for u, i in [*rng.integers(-4, 12, (90, 2)), *((0, i) for i in range(60)), *((u, 3) for u in range(40))]}
    df = spark.createDataFrame([(u, i, r) for (u, i), r in R.items()], "user int, item int, rating double").repartition(4)
    m = A.fit(A.pack(df, 3), 2, 3, .1, implicit, seed=5, blocks=3)
    us, its = sorted({u for u, _ in R}), sorted({i for _, i in R})
    U, V = A._first(np.array(us), 2, 5), np.zeros((len(its), 2))

    def half(keys, others, O, get):
        out = []
        for k in keys:
            at = [n for n, o in enumerate(others) if get(k, o) is not None]
            r, f = np.array([get(k, others[n]) for n in at]), O[at]
            if implicit:
                c = np.abs(r)
                g, b, n = O.T @ O + (f * c[:, None]).T @ f, f.T @ np.where(r > 0, 1 + c, 0), (r > 0).sum()
            else:
                g, b, n = f.T @ f, f.T @ r, len(r)
            out.append(np.linalg.solve(g + .1 * n * np.eye(2), b) if b.any() else np.zeros(2))
        return np.array(out)
    for _ in range(3):
        V = half(its, us, U, lambda i, u: R.get((u, i)))
        U = half(us, its, V, lambda u, i: R.get((u, i)))
    for got, ids, want in ((m.users, us, U), (m.items, its, V)):
        rows = sorted(got.collect())
        assert [r.id for r in rows] == ids and np.allclose([r.f for r in rows], want, rtol=1e-3, atol=1e-4)
    p = m.transform(spark.createDataFrame([(0, 3, "a"), (0, 999, "b"), (None, 3, "c")], "user int, item int, x string")).collect()
    assert [(r.user, r.item, r.x) for r in p] == [(0, 3, "a")]
    assert p[0].prediction == pytest.approx(U[us.index(0)] @ V[its.index(3)], rel=1e-3)


def test_items_send_nothing_of_their_own(spark):
    """What a block sends grows with its users, not with its items and ratings."""
    def sent(n):
        df = spark.range(n * 4).selectExpr("CAST(id % 4 AS int) AS user", "CAST(id DIV 4 AS int) AS item", "1D + id % 5 AS rating")
        seen, cut = [], A.cut_lineage
        try:
            A.cut_lineage = lambda d, **kw: seen.append(cut(d, **kw)) or seen[-1]
            A.fit(A.pack(df, 2), 2, 1, .1, blocks=2)
        finally:
            A.cut_lineage = cut
        return seen[1].filter("block >= 0").selectExpr("sum(length(ids) + length(n) + length(f))").first()[0]
    assert sent(1000) < 1.5 * sent(10)


def test_entities_with_equally_many_ratings_are_one_stack(spark, monkeypatch):
    """Products are taken a stack at a time, not a rating or an entity at a time; sums equal
    brute force for entities with one rating, with many and with more than a chunk."""
    assert len([*A._stacks(np.arange(0, 3001, 3))]) == 1
    monkeypatch.setattr(A, "CHUNK", 16)
    rng = np.random.default_rng(8)
    n = np.sort([*rng.integers(1, 9, 40), 50, 33, 17])
    start, f = np.append(0, np.cumsum(n)), rng.normal(size=(30, 3))
    col, r = rng.integers(0, 30, start[-1]), rng.normal(size=start[-1])
    got = A._sums(f, start, col, r, lambda r: (abs(r), 2 * r, (r > 0).astype(float)))
    for e, (a, z) in enumerate(zip(start, start[1:])):
        x, y = f[col[a:z]], r[a:z]
        want = [*((x.T * abs(y)) @ x)[np.triu_indices(3)], *(2 * y @ x), (y > 0).sum()]
        assert np.allclose(got[e], want)
    w = rng.normal(size=(len(n), 3))
    assert A._squares(f, w, start, col, r) == pytest.approx(sum((r[k] - f[col[k]] @ w[np.searchsorted(start, k, side="right") - 1]) ** 2 for k in range(start[-1])))


def test_no_task_gets_two_blocks(spark):
    df = spark.createDataFrame([(i % 9, i, 1.0 + i % 5) for i in range(400)], "user int, item int, rating double")
    packed = A.pack(df, 4).collect()
    labels = packed[0].labels
    parts = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    at = spark.createDataFrame([(x,) for x in labels], "block int").selectExpr(f"pmod(hash(block), {parts}) AS p").distinct()
    assert len(labels) == at.count() == 4 and {r.block for r in packed} <= set(labels)
    # every rating lies once with its item, once with its user, all of a block's ratings of a user together
    assert sum(r.n for r in packed if r["items"]) == sum(r.n for r in packed if not r["items"]) == 400
    users = [(r.block, u) for r in packed if not r["items"] for u in A.Part.of(r, False).ids]
    assert len(users) == len(set(users))


def test_als_dense_sends_sums_of_users_not_factors_of_items(spark, monkeypatch):
    """What blocks send each other in ``als_dense`` doesn't grow with the items."""
    from tessera.operators import models as M

    def sent(n):
        df = spark.range(n * 4).selectExpr("id DIV 4 AS i", "id % 4 AS j", "1D + id % 5 AS r")
        seen, cut = [], A.cut_lineage
        with monkeypatch.context() as m:
            m.setattr(A, "cut_lineage", lambda d, **kw: seen.append(cut(d, **kw)) or seen[-1])
            M.als_dense(df, rank=2, iterations=1, blocks=2)
        return seen[1].filter("block >= 0 AND src >= 0").selectExpr("sum(length(ids) + length(n) + length(f))").first()[0]
    assert sent(1000) < 1.5 * sent(10)


def test_als_dense_matches_numpy(spark, monkeypatch):
    """Factors, numbers of ratings and the RMSE of each iteration, with null and repeated ids, an
    item and a user with most ratings, over more iterations than there are between checkpoints."""
    from tessera.operators import models as M
    for name, x in (("PIECE", 20), ("CHUNK", 7), ("CUT", 2)):
        monkeypatch.setattr(A, name, x)
    rng = np.random.default_rng(4)
    rows = [(int(i) if i < 40 else None, int(j) * 2**40 if j < 25 else None, float(r)) for i, j, r in np.stack([rng.integers(0, 41, 200), rng.integers(0, 26, 200), rng.integers(1, 6, 200)], 1)]
    rows += [(3, j, 4.0) for j in range(90)] + [(i, 7, 2.0) for i in range(50)] + [(3, 7, 1.0)]
    df = spark.createDataFrame(rows, "i long, j long, r double").repartition(3)
    items, users, hist = M.als_dense(df, rank=3, iterations=3, lam=.1, blocks=3)
    begin = {r.id: r.f for r in M.init_factors(df.select("j").distinct(), "j", 3, 42).collect()}
    its, us = ([*dict.fromkeys(r[k] for r in rows)] for k in (0, 1))
    at = [(its.index(i), us.index(j)) for i, j, _ in rows]
    y, U, V, want = np.array([r for *_, r in rows]), np.array([begin[j] for j in us]), np.zeros((len(its), 3)), []

    def half(side, O, n):
        out = np.zeros((n, 3))
        for k in range(n):
            mine = [e for e, p in enumerate(at) if p[side] == k]
            f = O[[at[e][1 - side] for e in mine]]
            out[k] = np.linalg.solve(f.T @ f + .1 * len(mine) * np.eye(3), f.T @ y[mine])
        return out
    for _ in range(3):
        V = half(0, U, len(its))
        U = half(1, V, len(us))
        want.append(np.sqrt(np.mean([(y[e] - V[a] @ U[b]) ** 2 for e, (a, b) in enumerate(at)])))
    assert hist == pytest.approx(want)
    for got, ids, f, side in ((items, its, V, 0), (users, us, U, 1)):
        got = {r.id: r for r in got.collect()}
        assert len(got) == len(ids)
        for k, x in enumerate(ids):
            r = got[-1 << 63 if x is None else x]
            assert np.allclose(r.f, f[k]) and r.n == sum(p[side] == k for p in at)


def test_als_dense_with_a_null_rating(spark):
    """It spreads to all factors as before, and errors that aren't numbers add nothing."""
    from tessera.operators import models as M
    df = spark.createDataFrame([(i, j, None if i == j == 0 else 1.0 + i) for i in range(6) for j in range(4)], "i long, j long, r double")
    items, users, hist = M.als_dense(df, rank=2, iterations=2, lam=.1, blocks=2)
    assert items.count() == 6 and users.count() == 4 and len(hist) == 2 and all(x >= 0 for x in hist)
