import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import mlp as N

FOUR = [((0.0, 0.0), 1.0), ((0.0, 1.0), 2.0), ((1.0, 0.0), 3.0), ((1.0, 1.0), 4.0)]
XOR = [((0.0, 0.0), 0.0), ((0.0, 1.0), 1.0), ((1.0, 0.0), 1.0), ((1.0, 1.0), 0.0)]


def labeled(spark, rows):
    return spark.createDataFrame([(list(x), y) for x, y in rows], "features array<double>, label double")


def numeric_grad(f, w, eps=1e-6):
    g = np.zeros_like(w)
    for i in range(len(w)):
        e = np.zeros_like(w)
        e[i] = eps
        g[i] = (f(w + e) - f(w - e)) / (2 * eps)
    return g


@pytest.mark.parametrize("layout", ["A", "B"])
def test_pack_unpack_roundtrip(layout):
    topo = [3, 4, 2]
    w = np.arange(N.n_weights(topo), dtype=float)
    assert N.n_weights(topo) == 4 * 4 + 2 * 5
    assert np.array_equal(N.pack(N.unpack(w, topo, layout), layout), w)
    if layout == "A":
        W, b = N.unpack(w, topo, "A")[0]
        assert W[:, 0].tolist() == [0, 1, 2, 3]          # column-major
        assert b.tolist() == [12, 13, 14, 15]
        assert N.weights_by_layer(w, topo, 1).shape == (4, 4)


def test_random_weight_bounds():
    topo = [64, 33, 10]
    w = N.random_weights(topo, 1)
    for li in (1, 2):
        m = N.weights_by_layer(w, topo, li)
        assert np.abs(m).max() <= 2.4 / (topo[li - 1] + 1)
    b = N.random_weights(topo, 1, scale_by_fan_in=False)
    assert np.abs(b).max() <= 2.4 and np.abs(b).max() > 1.0


def test_gradient_job_matches_numeric(spark):
    rng = np.random.default_rng(0)
    X, T = rng.normal(size=(37, 3)), rng.uniform(size=(37, 2))
    df = spark.createDataFrame([(X[i].tolist(), T[i].tolist()) for i in range(37)],
                               "input array<double>, output array<double>").repartition(3)
    topo = [3, 4, 2]
    w = N.random_weights(topo, 3)
    for layout, scale in (("A", 0.5), ("B", 1.0)):
        def f(v):
            acts = N.forward(N.unpack(v, topo, layout), X)
            return scale * ((acts[-1] - T) ** 2).sum() / len(X)
        loss, g, n = N.gradient_job(df, w, topo, layout, scale)
        assert n == 37 and abs(loss - f(w)) < 1e-10
        assert np.allclose(g, numeric_grad(f, w), atol=1e-6)


def test_batch_size_weighting(spark):
    rng = np.random.default_rng(1)
    X, T = rng.normal(size=(10, 2)), rng.uniform(size=(10, 1))
    df = spark.createDataFrame([(X[i].tolist(), T[i].tolist()) for i in range(10)],
                               "input array<double>, output array<double>").coalesce(1)
    topo = [2, 3, 1]
    w = N.random_weights(topo, 2)
    loss, g, _ = N.gradient_job(df, w, topo, batch_size=4)
    layers = N.unpack(w, topo)
    want_l, want_g = 0.0, np.zeros_like(w)
    for s in (slice(0, 4), slice(4, 8), slice(8, 10)):       # the last group is short
        gg, ll = N.batch_gradient(layers, X[s], T[s], 0.5)
        want_g += N.pack(gg) / len(X[s])
        want_l += ll / len(X[s])
    assert abs(loss - want_l / 3) < 1e-12 and np.allclose(g, want_g / 3)


def test_classifier_a_learns_four_points(spark):
    df = labeled(spark, FOUR)
    m = N.mlp_classifier_fit(df, hidden=[5], max_iter=2000, tol=1e-4)    # the original settings
    pred = {tuple(r.features): r.prediction for r in N.classify(m, df).collect()}
    assert pred == {x: y for x, y in FOUR}
    # continue training never raises the loss
    m2 = N.mlp_classifier_fit(df, hidden=[5], max_iter=5, tol=1e-12, init=m)
    assert m2.history[-1] <= m.history[-1] + 1e-12
    with pytest.raises(Exception):       # a label the model has not seen
        N.mlp_classifier_fit(labeled(spark, [((0.0, 0.0), 9.0)]), hidden=[5], max_iter=1, init=m)


def test_unseen_label_raises(spark):
    df = labeled(spark, FOUR)
    with pytest.raises(Exception):
        N.encode_labels(labeled(spark, [((0.0, 0.0), 9.0)]), "label", [1.0, 2.0], 0.9, 0.1).collect()
    assert df.count() == 4


def test_classifier_b_four_points_and_two_labels(spark):
    m = N.mlp_gd_fit(labeled(spark, FOUR), hidden=[5], iterations=100, lr=10.0, seed=1)
    assert m.topology == [2, 5, 4]
    pred = {tuple(r.features): r.prediction for r in N.classify(m, labeled(spark, FOUR)).collect()}
    assert pred == {x: y for x, y in FOUR}
    assert m.history[-1] < m.history[0]
    two = N.mlp_gd_fit(labeled(spark, XOR), hidden=[4], iterations=100, lr=10.0, seed=3)
    assert two.topology[-1] == 1                      # single-output path
    pred = {tuple(r.features): r.prediction for r in N.classify(two, labeled(spark, XOR)).collect()}
    assert pred == {x: y for x, y in XOR}
    quirk = N.mlp_gd_fit(labeled(spark, FOUR), hidden=[3], iterations=5, double_sigmoid=True)
    assert len(quirk.history) == 5


def test_regression_fit_and_layers(spark):
    from tessera.sources.generators import function_samples
    data = function_samples(spark, 100)
    m = N.mlp_fit(data, [5, 3], max_iter=30, tol=1e-12)
    assert m.history[-1] < m.history[0] * 0.5
    p = m.predict(data, "input", "acts", layer="all").first()
    assert [len(a) for a in p.acts] == [1, 5, 3, 1]
    one = m.predict(data, "input", "h", layer=1).select(F.size("h")).first()[0]
    assert one == 5


@pytest.mark.parametrize("double", [False, True])
def test_network_b_steps_along_error_times_slope(spark, double):
    """One example at a time: delta = (o - t) * o', hidden delta = (delta W) * h',
    without the factor 2 of the reported squared loss."""
    rng = np.random.default_rng(5)
    X, T = rng.normal(size=(9, 3)), rng.uniform(size=(9, 2))
    df = spark.createDataFrame([(x.tolist(), t.tolist()) for x, t in zip(X, T)], "input array<double>, output array<double>")
    topo = [3, 4, 2]
    w = N.random_weights(topo, 11, scale_by_fan_in=False)
    (W1, b1), (W2, b2) = N.unpack(w, topo, "B")
    sig = lambda z: 1 / (1 + np.exp(-z))
    slope = (lambda a: sig(a) * (1 - sig(a))) if double else (lambda a: a * (1 - a))
    g1, c1, g2, c2, loss = np.zeros_like(W1), np.zeros_like(b1), np.zeros_like(W2), np.zeros_like(b2), 0.0
    for x, t in zip(X, T):
        h = sig(W1 @ x + b1)
        o = sig(W2 @ h + b2)
        d2 = (o - t) * slope(o)
        d1 = (W2.T @ d2) * slope(h)
        g2 += np.outer(d2, h)
        c2 += d2
        g1 += np.outer(d1, x)
        c1 += d1
        loss += ((o - t) ** 2).sum()
    got_loss, g, n = N.gradient_job(df, w, topo, "B", 1.0, None, double, grad_scale=1.0)
    assert n == 9 and abs(got_loss - loss / 9) < 1e-12
    assert np.allclose(g, N.pack([(g1, c1), (g2, c2)], "B") / 9, atol=1e-12)


def test_network_b_on_four_points(spark):
    m = N.mlp_gd_fit(labeled(spark, FOUR), hidden=[5], iterations=100, lr=0.3)
    assert len(m.history) == 100 and all(b <= a for a, b in zip(m.history, m.history[1:])) and m.topology == [2, 5, 4]


def test_rows_of_another_length_raise(spark):
    from tessera.operators.gradient import gradient_sum
    for d in (2, 64):
        for wrong in (d - 1, d + 1):
            df = spark.createDataFrame([([1.0] * d, 1.0), ([1.0] * wrong, 0.0)], "x array<double>, y double")
            with pytest.raises(Exception, match=f"vector of {d} elements expected, found {wrong}"):
                gradient_sum(df, [0.0] * d, "logistic")


def test_labels_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(N, "MAX_LABELS", 5)
    assert N.distinct_labels(spark.range(5).withColumnRenamed("id", "y"), "y") == [0.0, 1.0, 2.0, 3.0, 4.0]
    with pytest.raises(ValueError, match="distinct labels"):
        N.distinct_labels(spark.range(6).withColumnRenamed("id", "y"), "y")
