import numpy as np

from tessera.llm import cap_filters as C


def brute(ids, vecs, cosine=0.9):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vecs]
    unit = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, (v, k) in enumerate(zip(vecs, ok)) if k}
    links = {i: [j for j in unit if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in unit}
    out, seen = {}, {}
    for i in sorted(unit, key=lambda k: ids[k]):
        if i not in seen:
            todo = [i]
            while todo:
                k = todo.pop()
                if k not in seen:
                    seen[k] = ids[i]
                    todo += links[k]
    for i, d in enumerate(ids):
        out[d] = (len(links.get(i, [])), seen.get(i, d))
    return out, links


def vectors(seed, n=700, dim=64):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    for k in range(200):  # chains and clusters of near copies
        j = rng.integers(0, n // 2)
        x[n // 2 + k] = x[j] / np.linalg.norm(x[j]) + rng.standard_normal(dim) * rng.uniform(.005, .05)
    x[1:60] = x[0] + rng.standard_normal((59, dim)) * .05
    x[300:310] = x[299]
    return x.astype(np.float32)


def frame(spark, ids, vecs):
    return spark.createDataFrame([(i, v, 1, "f") for i, v in zip(ids, vecs)], "vec_id long, embedding array<float>, label int, filter string")


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 16)  # several blocks a filter
    x = vectors(1)
    vecs = [list(map(float, v)) for v in x] + [None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [None] + [1.0] * 63, [1.0, 2.0], [2.0, 4.0], [float("inf")] * 64]
    ids = list(range(len(vecs)))[::-1]
    want, links = brute(ids, vecs)
    got = {r.vec_id: r for r in C.near_vectors(frame(spark, ids, vecs).repartition(3)).collect()}
    assert set(got) == set(ids)
    found, true = sum(r.n_links for r in got.values()), sum(len(v) for v in links.values())
    assert .95 * true <= found and all(got[i].n_links <= want[i][0] for i in ids)
    assert sum(got[i].component_id == want[i][1] for i in ids) >= .97 * len(ids)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert all(got[ids[k]].n_links == 0 and got[ids[k]].kept for k in (700, 701, 702, 703, 704, 707))


def test_recall_at_the_threshold():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2000, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = .9 * a + np.sqrt(1 - .81) * b / np.linalg.norm(b, axis=1, keepdims=True)
    (ra, fa), (rb, fb) = C.decode(a), C.decode(b)
    sa, sb = set(zip(ra.tolist(), fa.tolist())), set(zip(rb.tolist(), fb.tolist()))
    assert len({r for r, _ in sa & sb}) >= .9 * 2000


def test_decoding_is_complete():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((50, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rot, books = C.code(64)
    s = [(x @ rot)[:, c] @ b.T for c, b in books]
    full = (s[0][:, :, None] + s[1][:, None, :]).reshape(50, -1)
    want = set(zip(*map(lambda a: a.tolist(), np.nonzero(full >= C.LIFT / 8))))
    assert set(zip(*map(lambda a: a.tolist(), C.decode(x)))) == want


def test_empty_table(spark):
    assert C.near_vectors(frame(spark, [], [])).collect() == []


def test_short_vectors_link_exactly(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 16)
    rng = np.random.default_rng(7)
    vecs = [[1.0, 2.0], [2.0, 4.0], [3.0], [5.0], [-1.0]]
    vecs += [list(map(float, v.astype(np.float32))) for dim in (3, 9, 15) for v in rng.standard_normal((60, dim)).repeat(2, axis=0) + rng.standard_normal((120, dim)) * .2]
    ids = list(range(len(vecs)))
    want, _ = brute(ids, vecs)
    got = {r.vec_id: r for r in C.near_vectors(frame(spark, ids, vecs).repartition(3)).collect()}
    assert (got[0].n_links, got[1].n_links, got[1].component_id) == (1, 1, 0)
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == want


def test_recall_in_few_dimensions():
    rng = np.random.default_rng(8)
    for dim in (16, 24, 32, 48):
        a = C.unit(rng.standard_normal((1000, dim)))
        b = rng.standard_normal((1000, dim))
        b -= (a * b).sum(axis=1, keepdims=True) * a
        b = .9 * a + np.sqrt(1 - .81) * b / np.linalg.norm(b, axis=1, keepdims=True)
        (ra, fa), (rb, fb) = C.decode(a), C.decode(b)
        sa, sb = set(zip(ra.tolist(), fa.tolist())), set(zip(rb.tolist(), fb.tolist()))
        assert len({r for r, _ in sa & sb}) >= .92 * 1000 and len(ra) < 100 * 1000


def test_codes_lose_no_pair():
    rng = np.random.default_rng(8)
    for dim in (3, 16, 64, 300):
        x = rng.standard_normal((150, dim))
        x[75:] = x[:75] + rng.standard_normal((75, dim)) * rng.uniform(.1, 1.2, (75, 1))
        x[0] = np.eye(dim)[0] + 1e-3  # one large component
        x = C.unit(x)
        left = rng.random(150) < .5
        for l, r in ((left, ~left), (np.ones(150, bool), np.ones(150, bool))):
            exact = (x @ x.T >= .9) & l[:, None] & r[None, :]
            if (l & r).all():
                np.fill_diagonal(exact, False)
            some = C.may_link(C.encoded(x), l, r, .9)
            assert some[exact.any(axis=1) | exact.any(axis=0)].all()
            # and few others
            near = (x @ x.T >= .86) & (l[:, None] & r[None, :])
            if (l & r).all():
                np.fill_diagonal(near, False)
            assert not some[~(near.any(axis=1) | near.any(axis=0))].any()
