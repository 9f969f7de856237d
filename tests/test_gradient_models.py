import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import gradient as Gd
from tessera.operators import models as M
from tessera.sources.generators import labeled_gaussian, low_rank_ratings


def sig(z):
    return 1 / (1 + np.exp(-z))


def to_np(df):
    rows = df.collect()
    return np.array([r.x for r in rows]), np.array([r.y for r in rows])


def test_logistic_sum_gd_matches_numpy(spark):
    df = labeled_gaussian(spark, n=400, dims=3, seed=1)
    X, y = to_np(df)
    w0 = np.random.default_rng(42).uniform(-1, 1, 3)
    w = w0.copy()
    for _ in range(5):
        w = w - (X * ((sig(y * (X @ w)) - 1) * y)[:, None]).sum(0)
    got = Gd.logistic_sum_gd(df, w0, iterations=5, step=1.0)
    assert np.allclose(got, w, atol=1e-9)


@pytest.mark.parametrize("updater", ["none", "l1", "l2"])
def test_train_sgd_updaters_match_numpy(spark, updater):
    df = labeled_gaussian(spark, n=300, dims=3, seed=2).withColumn("y", (F.col("y") > 0).cast("double"))
    X, y = to_np(df)
    for kind in ("squared", "hinge", "logistic"):
        w = np.zeros(3)
        for i in range(1, 11):
            m = X @ w
            if kind == "squared":
                g = ((m - y)[:, None] * X).mean(0)
            elif kind == "hinge":
                s = 2 * y - 1
                g = ((np.where(s * m < 1, -s, 0.0))[:, None] * X).mean(0)
            else:
                g = ((sig(m) - y)[:, None] * X).mean(0)
            w = Gd.update(w, g, 1.0 / np.sqrt(i), 0.1, updater)
        got, losses = Gd.train_sgd(df, kind, 3, iterations=10, step=1.0, reg=0.1, updater=updater)
        assert np.allclose(got, w, atol=1e-9), kind
        assert len(losses) == 10


def test_lbfgs_quadratic():
    A = np.diag([1.0, 10.0, 100.0])
    b = np.array([1.0, -2.0, 3.0])
    w, hist = Gd.lbfgs(lambda w: (0.5 * w @ A @ w - b @ w, A @ w - b), np.zeros(3), max_iter=100, tol=1e-14)
    assert np.allclose(w, np.linalg.solve(A, b), atol=1e-5)
    assert all(h2 <= h1 + 1e-12 for h1, h2 in zip(hist, hist[1:]))


def test_als_dense_low_rank(spark):
    r = low_rank_ratings(spark, m=30, u=40, rank=3, seed=3).select(
        F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), "r")
    items, users, hist = M.als_dense(r, rank=3, iterations=8, lam=0.0001)
    assert hist[-1] < 0.05 and hist[-1] <= hist[0]
    # the RMSE from the normal-equation sums equals the join-based one
    assert abs(hist[-1] - M.als_rmse(r, items, users).first()["rmse"]) < 1e-9


@pytest.mark.parametrize("blocks", [1, 3, 40])
def test_routed_blocks_match_numpy(spark, monkeypatch, blocks):
    """Half-steps and the RMSE against dense numpy, with entities that hold more than a block's share."""
    from tessera.operators import als_blocks as B
    monkeypatch.setattr(B, "CHUNK", 7)
    rng = np.random.default_rng(blocks)
    pairs = {(int(i), int(j)) for i, j in rng.integers(-5, 25, (200, 2))} | {(3, j) for j in range(100, 260)} | {(i, 7) for i in range(100, 200)}
    rows = [(i, j, float(rng.integers(1, 6))) for i, j in sorted(pairs)]
    r = spark.createDataFrame(rows, "i int, j long, r double").repartition(3)
    of_i, of_j = B.sides(r, blocks)
    assert of_i.any_hot == (blocks > 1) and of_j.any_hot == (blocks > 3)
    fixed = {j: rng.normal(size=3) for j in {j for _, j, _ in rows}}
    users = B.pack_factors(spark.createDataFrame([(j, f.tolist()) for j, f in fixed.items()], "id long, f array<double>"), 3, blocks)
    packed = B.half_step(of_i, users, 3, .2)
    got = {x.id: (np.array(x.f), x.n) for x in B.unpack_factors(packed, 3).collect()}
    sse = 0.0
    for i in {i for i, _, _ in rows}:
        f = np.array([fixed[j] for a, j, _ in rows if a == i])
        y = np.array([v for a, _, v in rows if a == i])
        w = np.linalg.solve(f.T @ f + .2 * len(y) * np.eye(3), f.T @ y)
        assert np.allclose(got[i][0], w) and got[i][1] == len(y)
        sse += ((y - f @ w) ** 2).sum()
    assert len(got) == len({i for i, _, _ in rows})
    assert B.rmse(packed) == pytest.approx(np.sqrt(sse / len(rows)))
    # the next half-step takes these rows as they are
    back = {x.id: np.array(x.f) for x in B.unpack_factors(B.half_step(of_j, packed, 3, .2), 3).collect()}
    f = np.array([got[i][0] for i, j, _ in rows if j == 7])
    y = np.array([v for _, j, v in rows if j == 7])
    assert np.allclose(back[7], np.linalg.solve(f.T @ f + .2 * len(y) * np.eye(3), f.T @ y))


def test_als_half_step_matches_numpy(spark):
    rng = np.random.default_rng(0)
    R = [(i, j, float(rng.integers(1, 6))) for i in range(6) for j in range(8) if rng.random() < 0.7]
    ratings = spark.createDataFrame(R, "i long, j long, r double")
    U = rng.uniform(size=(8, 2))
    users = spark.createDataFrame([(j, U[j].tolist()) for j in range(8)], "id long, f array<double>")
    got = {r.id: np.array(r.f) for r in M.als_half_step(ratings, users, "i", "j", 2, 0.1).collect()}
    for i in range(6):
        js = [(j, r) for (ii, j, r) in R if ii == i]
        X = U[[j for j, _ in js]]
        b = X.T @ np.array([r for _, r in js])
        want = np.linalg.solve(X.T @ X + 0.1 * len(js) * np.eye(2), b)
        assert np.allclose(got[i], want, atol=1e-9)


def test_gram_and_singular_values(spark):
    rng = np.random.default_rng(4)
    X = rng.normal(size=(500, 5))
    df = spark.createDataFrame([(x.tolist(),) for x in X], "x array<double>").repartition(3)
    assert np.allclose(M.gram_matrix(df), X.T @ X, atol=1e-8)
    assert np.allclose(M.singular_values(df), np.linalg.svd(X, compute_uv=False), atol=1e-8)


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(400, 3)) @ np.array([[2, 0, 0], [1, 1, 0], [0, 0, 0.2]])
    df = spark.createDataFrame([(x.tolist(),) for x in X], "x array<double>")
    pc = M.sign_normalise(M.fit_pca(df).pc.toArray())
    ev, vec = np.linalg.eigh(np.cov(X.T))
    want = M.sign_normalise(vec[:, ::-1])
    assert np.allclose(pc, want, atol=1e-6)


def test_tree_validation_and_fit(spark):
    df = spark.createDataFrame([([float(i)], float(i > 5)) for i in range(12)], "x array<double>, label double")
    with pytest.raises(ValueError):
        M.fit_decision_tree(df, "classification", "variance")
    with pytest.raises(ValueError):
        M.fit_decision_tree(df, "regression", "gini")
    m = M.fit_decision_tree(df, "classification", "gini", max_depth=2)
    assert "feature 0 <= 5.5" in m.toDebugString


def test_naive_bayes_closed_form(spark):
    rows = [([1.0, 0.0, 2.0], 0.0), ([0.0, 3.0, 1.0], 1.0), ([2.0, 1.0, 0.0], 0.0)]
    df = spark.createDataFrame(rows, "x array<double>, label double")
    m = M.fit_naive_bayes(df, smoothing=1.0)
    pi = np.log(np.array([2 + 1, 1 + 1]) / (3 + 2))
    s0 = np.array([3.0, 1.0, 2.0])
    s1 = np.array([0.0, 3.0, 1.0])
    theta = np.log(np.vstack([(s0 + 1) / (s0.sum() + 3), (s1 + 1) / (s1.sum() + 3)]))
    assert np.allclose(m.pi.toArray(), pi) and np.allclose(m.theta.toArray(), theta)


def test_binary_models_learn(spark):
    df = labeled_gaussian(spark, n=2000, dims=10, seed=3).withColumn("label", (F.col("y") > 0).cast("double"))
    for pen in ("l1", "l2"):
        m = M.fit_logistic(df, reg=0.01, penalty=pen)
        s = Gd.predict_linear(df, m.coefficients.toArray().tolist(), "x", "score")
        assert M.binary_metrics(s, "score")["auc_roc"] > 0.9
    svc = M.fit_linear_svc(df, reg=0.01)
    s = Gd.predict_linear(df, svc.coefficients.toArray().tolist(), "x", "score")
    met = M.binary_metrics(s, "score")
    assert met["auc_roc"] > 0.9 and met["auc_pr"] > 0.9
    lr = M.fit_linear_regression(df.withColumn("label", F.col("y")), reg=0.0)
    assert len(lr.coefficients) == 10


def test_als_ml(spark):
    r = low_rank_ratings(spark, m=30, u=40, rank=2, seed=3).select(
        F.col("i").alias("user"), F.col("j").alias("item"), F.col("r").alias("rating"))
    m = M.fit_als(r, rank=4, max_iter=10, reg=0.01)
    p = m.transform(r)
    rmse = p.agg(F.sqrt(F.avg((F.col("prediction") - F.col("rating")) ** 2))).first()[0]
    assert rmse < 0.1


def test_singular_values_of_a_graded_matrix(spark):
    """Nine orders of magnitude below the largest, where the Gram matrix knows nothing."""
    rng = np.random.default_rng(4)
    u, _ = np.linalg.qr(rng.normal(size=(500, 4)))
    v, _ = np.linalg.qr(rng.normal(size=(4, 4)))
    want = np.array([10.0, 1.0, 1e-5, 1e-8])
    X = u * want @ v.T
    df = spark.createDataFrame([(x.tolist(),) for x in X], "x array<double>").repartition(7)
    assert np.allclose(M.singular_values(df), want, rtol=1e-6)
    few = spark.createDataFrame([([1.0, 2.0, 3.0],), ([0.0, 1.0, 0.0],)], "x array<double>").repartition(4)  # fewer rows than columns
    assert np.allclose(M.singular_values(few), [*np.linalg.svd(np.array([[1, 2, 3], [0, 1, 0.]]), compute_uv=False), 0.0])


def test_triangles_are_merged_in_a_tree(spark, monkeypatch):
    from tessera.operators import blocks
    monkeypatch.setattr(blocks, "FAN_IN", 3)
    X = np.random.default_rng(5).normal(size=(200, 3))
    df = spark.createDataFrame([(x.tolist(),) for x in X], "x array<double>").repartition(20)
    assert np.allclose(M.singular_values(df), np.linalg.svd(X, compute_uv=False))
    assert np.allclose(M.gram_matrix(df), X.T @ X)


def test_factor_messages_carry_no_ids(spark, monkeypatch):
    """What the routes already say doesn't travel with the factors of every half-step."""
    from tessera.operators import als_blocks as B
    plans, cut = [], B.cut_lineage

    def watched(df, keep_partitioning=False):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, keep_partitioning)
    r = spark.createDataFrame([(i, j, float(i + j)) for i in range(12) for j in range(9) if (i + j) % 3], "i long, j long, r double")
    of_i, _ = B.sides(r, 4)
    users = B.pack_factors(spark.createDataFrame([(j, [1.0 + j, 2.0]) for j in range(9)], "id long, f array<double>"), 2, 4)
    monkeypatch.setattr(B, "cut_lineage", watched)
    B.half_step(of_i, users, 2, .1)
    sent = [x for x in plans[0].splitlines() if "FlatMapCoGroupsInPandas" in x and "send(" in x]
    assert sent and all(x.rstrip().split("[")[-1].count("#") == 3 and "ids#" not in x.rstrip().split("[")[-1] for x in sent), plans[0]
