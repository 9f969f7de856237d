import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import sparse as SP
from tessera.sources import text as T


def random_rows(seed, n, d, density, low=-3):
    rng = np.random.default_rng(seed)
    x = np.where(rng.random((n, d)) < density, rng.integers(low, 9, (n, d)) / 2, 0.0)
    return x, rng.integers(0, 3, n).astype(float)


def sparse_frame(spark, x, y, explicit=()):
    rows = []
    for i, (r, l) in enumerate(zip(x, y)):
        at = [int(j) for j in np.flatnonzero(r)]
        at = sorted({*at, *(j for k, j in explicit if k == i)})  # stored zeros
        rows.append((i, float(l), x.shape[1], at, [float(r[j]) for j in at]))
    return spark.createDataFrame(rows, "id long, label double, size int, indices array<int>, values array<double>").repartition(5)


def test_libsvm_text_round_trip_and_inference(spark, tmp_path):
    x, y = random_rows(1, 60, 40, .2)
    x[:, 37:] = 0
    x[3, 36] = 1.5
    x[7] = 0  # a row without entries
    lines = T.to_libsvm(sparse_frame(spark, x, y)).union(spark.createDataFrame([("# a comment",), ("",), ("  2.0   3:1e-3  ",)], "value string"))
    lines.write.text(str(tmp_path / "l"))
    got = T.read_libsvm(spark, str(tmp_path / "l"), min_partitions=9)
    assert got.rdd.getNumPartitions() == 9
    rows = got.collect()
    assert {r["size"] for r in rows} == {37}
    dense = sorted((r.label, *np.bincount(r.indices, r["values"], 37)) if r.indices else (r.label, *np.zeros(37)) for r in rows)
    want = sorted([(l, *v[:37]) for l, v in zip(y, x)] + [(2.0, *np.eye(37)[2] * 1e-3)])
    assert np.array_equal(np.array(dense), np.array(want))
    assert {r["size"] for r in T.read_libsvm(spark, str(tmp_path / "l"), num_features=50).collect()} == {50}
    # Spark's own reader sees the same vectors
    from pyspark.ml.functions import vector_to_array
    lib = spark.read.format("libsvm").option("numFeatures", 37).load(str(tmp_path / "l")).select("label", vector_to_array("features").alias("v"))
    assert sorted((r.label, *r.v) for r in lib.collect()) == [tuple(map(float, r)) for r in want]


@pytest.mark.parametrize("line", ["1 3:1 2:1", "1 2:1 2:1", "1 0:1", "1 9:1", "x 1:1", "1 2", "1 a:1"])
def test_malformed_lines_throw(spark, line):
    with pytest.raises(Exception):
        T.parse_libsvm(spark.createDataFrame([(line,)], "value string"), 8).collect()


def test_empty_scan_has_no_dimension(spark):
    assert T.parse_libsvm(spark.createDataFrame([("",)], "value string")).collect() == []
    assert T.parse_libsvm(spark.createDataFrame([("1",)], "value string")).first()["size"] == 0


@pytest.mark.parametrize("n,shift", [(200, 0.0), (1, 0.0), (50, 1e8)])
def test_summary_counts_implicit_zeros(spark, n, shift):
    x, y = random_rows(2, n, 12, .4)
    x[:, 5] = 0
    x[:, 6] = np.arange(1, n + 1) + shift  # dense, far from zero
    df = sparse_frame(spark, x, y, explicit=[(0, 5), (0, 3)])
    got = {r.dim: r for r in SP.summary(df).collect()}
    assert sorted(got) == list(range(12))
    for d in range(12):
        c, r = x[:, d], got[d]
        assert r.mean == pytest.approx(c.mean(), rel=1e-12, abs=1e-12)
        assert r.variance == pytest.approx(c.var(ddof=1) if n > 1 else 0, rel=1e-6, abs=1e-9)
        assert (r.nnz, r.max, r.min) == (np.count_nonzero(c), c.max(), c.min())


def test_naive_bayes_equals_the_dense_form(spark):
    x, y = random_rows(3, 120, 30, .2, low=0)
    x[4] = 0
    x[:, 11] = np.where(y == 2, 0, x[:, 11])
    df = sparse_frame(spark, x, y)
    model = SP.fit_naive_bayes(df, smoothing=.5)
    classes = np.unique(y)
    s = np.array([x[y == c].sum(axis=0) for c in classes])
    theta = np.log(s + .5) - np.log(s.sum(axis=1, keepdims=True) + .5 * 30)
    prior = np.log([(y == c).sum() + .5 for c in classes]) - np.log(len(y) + .5 * 3)
    for r in model.terms.collect():
        assert r.theta == pytest.approx(theta[int(r.label), r.dim], rel=1e-12)
    assert model.terms.count() == np.count_nonzero(s)
    want = prior + x @ theta.T
    got = np.zeros_like(want)
    for r in model.scores(df, ["id"]).collect():
        got[r.id, int(r.label)] = r.score
    assert np.allclose(got, want, rtol=1e-10)
    best = {r.id: r.prediction for r in model.predict(df, ["id"]).collect()}
    assert all(best[i] == classes[want[i].argmax()] for i in range(len(y)))


def test_naive_bayes_checks_its_input(spark, monkeypatch):
    x, y = random_rows(4, 20, 5, .5, low=0)
    with pytest.raises(ValueError):
        SP.fit_naive_bayes(sparse_frame(spark, x, y), smoothing=0)
    with pytest.raises(ValueError):
        SP.fit_naive_bayes(sparse_frame(spark, x, y).limit(0))
    with pytest.raises(Exception, match="negative"):
        SP.fit_naive_bayes(sparse_frame(spark, x - 1, y))
    monkeypatch.setattr(SP, "MAX_CLASSES", 2)
    with pytest.raises(ValueError, match="classes"):
        SP.fit_naive_bayes(sparse_frame(spark, x, y))


def test_rows_from_counts(spark):
    long_ = spark.createDataFrame([(1, 5, 2.0), (1, 0, 1.0), (2, 3, 4.0)], "k long, d int, v double")
    got = {r.k: (r["size"], r.indices, r["values"]) for r in SP.from_counts(long_, ["k"], "d", "v", 6).collect()}
    assert got == {1: (6, [0, 5], [1.0, 2.0]), 2: (6, [3], [4.0])}
