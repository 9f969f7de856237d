import math

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import clustering as C
from tessera.sources import generators as G


def test_kv_ramp_counts(spark):
    got = {r.mapper: r.n for r in G.ramp_counts(spark, 4, 1000).collect()}
    assert got == {p: int((p + 1) / 4 * 1000) for p in range(4)}
    kv = G.kv_ramp(spark, 4, 1000, val_size=10)
    c = {r.mapper: r["count"] for r in kv.groupBy("mapper").count().collect()}
    assert c == got
    assert kv.select(F.length("payload")).distinct().collect()[0][0] == 10


def test_kv_hotkey_share(spark):
    base = spark.range(40000)
    r, ratio = 4, 5.0
    kv = G.kv_hotkey(base, reducers=r, ratio=ratio)
    share = kv.where(F.pmod("key", F.lit(r)) == 0).count() / 40000
    assert abs(share - ratio / (r + ratio - 1)) < 0.02
    one = G.kv_hotkey(base, reducers=1)
    assert one.where(F.pmod("key", F.lit(1)) != 0).count() == 0


def test_kv_uniform_and_normals(spark):
    kv = G.kv_uniform(spark.range(1000), val_size=50)
    assert kv.count() == 1000
    assert kv.agg(F.min("key"), F.max("key")).first()[0] >= 0
    x = G.normal(spark.range(20000)).agg(F.avg("x"), F.var_samp("x")).first()
    assert abs(x[0]) < 0.05 and abs(x[1] - 1) < 0.05
    v = G.normal_vectors(spark.range(20000), dims=2).select(F.col("v")[0].alias("a"), F.col("v")[1].alias("b"))
    assert abs(v.agg(F.corr("a", "b")).first()[0]) < 0.05


def test_labeled_gaussian_and_function_samples(spark):
    g = G.labeled_gaussian(spark, n=1000, dims=10)
    rows = g.orderBy("id").limit(4).collect()
    assert [r.y for r in rows] == [-1.0, 1.0, -1.0, 1.0]
    assert len(rows[0].x) == 10
    f = G.function_samples(spark, 100).collect()
    assert len(f) == 100 and all(r.output[0] <= 1.0 for r in f)
    for r in f:
        x = r.input[0]
        assert abs(r.output[0] - (0.5 + 0.15 * int(abs(x / 5)) + 0.1 * math.sin(math.pi * x / 10))) < 1e-12


def test_low_rank_ratings(spark):
    r = G.low_rank_ratings(spark, m=20, u=30, rank=3)
    assert r.count() == 600
    assert r.select("i", "j").distinct().count() == 600


def lloyd_numpy(X, centers, converge, max_iter):
    c = np.array(centers, dtype=float)
    delta, it = 1.0, 0
    while delta > converge and it < max_iter:
        d = ((X[:, None, :] - c[None]) ** 2).sum(-1)
        a = d.argmin(1)
        new = c.copy()
        for k in range(len(c)):
            if (a == k).any():
                new[k] = X[a == k].mean(0)
        delta = ((new - c) ** 2).sum()
        c, it = new, it + 1
    return c, it


def test_lloyd_matches_numpy(spark):
    rng = np.random.default_rng(0)
    X = rng.uniform(0, 1000, size=(1000, 10))
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(len(X))], "id long, features array<double>")
    init = X[:10].tolist()
    got, it = C.kmeans_lloyd(df, 10, converge_dist=0.001, initial_centers=init, max_iter=100)
    want, it2 = lloyd_numpy(X, init, 0.001, 100)
    assert it == it2
    assert np.allclose(np.array(got), want, atol=1e-7)
    cost = C.kmeans_cost(df, got).first()["cost"]
    assert abs(cost - ((X[:, None, :] - want[None]) ** 2).sum(-1).min(1).sum()) < 1e-3


def test_lloyd_edge_cases(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([0.0, 1.0],), ([1.0, 0.0],)], "features array<double>")
    far = [[0.0, 0.5], [100.0, 100.0]]          # the second centre gets no point: it keeps its place
    got, _ = C.kmeans_lloyd(df, 2, converge_dist=1e-9, initial_centers=far)
    assert got[1] == [100.0, 100.0]
    same, it = C.kmeans_lloyd(df, 2, converge_dist=1.0, initial_centers=far)
    assert it == 0 and same == far
    seeded, _ = C.kmeans_lloyd(df.withColumn("id", F.monotonically_increasing_id()), 2, id_cols=["id"], seed=1)
    assert len(seeded) == 2


def test_pi(spark):
    pts = G.unit_square_points(spark, slices=4, per_slice=50000)
    pi = C.pi_estimate(pts).first()["pi"]
    assert abs(pi - math.pi) < 0.02


def test_kmeans_ml(spark):
    rng = np.random.default_rng(1)
    X = np.vstack([rng.normal(c, 0.1, size=(100, 2)) for c in ([0, 0], [5, 5], [0, 5])])
    df = spark.createDataFrame([(x.tolist(),) for x in X], "features array<double>")
    for mode in ("k-means||", "random"):
        m = C.kmeans_ml(df, 3, max_iter=20, init_mode=mode)
        assert m.summary.trainingCost < 300 * 0.05
