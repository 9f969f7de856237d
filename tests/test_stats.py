import numpy as np
from pyspark.sql import functions as F

from tessera.operators import stats as S
from tessera.operators.relational import (class_fractions, count_distinct_keys, group_sizes,
                                          group_sizes_salted, lookup_join, reindex_labels)


def brute_auc(scores, labels):
    pos = [s for s, l in zip(scores, labels) if l > 0]
    neg = [s for s, l in zip(scores, labels) if l <= 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_with_ties_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    scores = rng.integers(0, 30, size=400).astype(float)      # many ties
    labels = (rng.random(400) < 0.3 + scores / 60).astype(int)
    df = spark.createDataFrame([(float(s), int(l)) for s, l in zip(scores, labels)], "score double, label int")
    got = S.auc_roc(df.repartition(5)).first()["auc"]
    assert abs(got - brute_auc(scores, labels)) < 1e-12


def test_prefix_sums(spark):
    df = spark.createDataFrame([(i, i % 7) for i in range(1000)], "k long, v long")
    got = {r.k: r.v_before for r in S.prefix_sums(df, "k", ["v"], partitions=6).collect()}
    run = 0
    for i in range(1000):
        assert got[i] == run
        run += i % 7


def test_column_summary_and_corr(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(300, 2))
    X[::5, 1] = 0.0
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], "a double, b double")
    s = {r.column: r for r in S.column_summary(df, ["a", "b"]).collect()}
    assert abs(s["b"].variance - X[:, 1].var(ddof=1)) < 1e-9
    assert s["b"].nnz == int((X[:, 1] != 0).sum()) and s["a"].max == X[:, 0].max()
    c = {r.feature: r.corr for r in S.label_correlations(df, "a", ["b"]).collect()}
    assert abs(c["b"] - np.corrcoef(X[:, 0], X[:, 1])[0, 1]) < 1e-9
    v = {r.dim: r for r in S.vector_summary(df.select(F.array("a", "b").alias("x")), "x").collect()}
    assert abs(v[0].mean - X[:, 0].mean()) < 1e-12


def test_grouping_helpers(spark):
    # one key holds a third of the rows
    rows = [(0 if i % 3 == 0 else i % 50, f"p{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, payload string")
    plain = {r.k: r.n for r in group_sizes(df, "k").collect()}
    salted = {r.k: r.n for r in group_sizes_salted(df, "k", salt_buckets=8).collect()}
    assert plain == salted and plain[0] >= 1000
    assert count_distinct_keys(df, "k").first()["n_keys"] == len(plain)
    fr = {r.k: r.fraction for r in class_fractions(df, "k").collect()}
    assert abs(sum(fr.values()) - 1) < 1e-12


def test_lookup_and_reindex(spark):
    fact = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "id int, c string")
    dim = spark.createDataFrame([("x", 10), ("y", 20)], "c string, v int")
    assert sorted(tuple(r) for r in lookup_join(fact, dim, "c").select("id", "v").collect()) == [(1, 10), (2, 20), (3, 10)]
    assert reindex_labels(fact, "c").columns == ["id", "c", "label_idx"]
    idx = {r.c: r.label_idx for r in reindex_labels(fact, "c").collect()}
    assert idx == {"x": 0, "y": 1}


def test_auc_with_many_scores_and_pruned_columns(spark):
    # totals and local sums must read one range partitioning, whatever is pruned
    df = spark.range(200_000).select(F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("score"),
                                     (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(3)) == 0).cast("int").alias("label"), F.lit("x").alias("extra"))
    pdf = df.select("score", "label").toPandas().sort_values("score")
    y = pdf["label"].to_numpy()
    rank = np.arange(1, len(y) + 1)
    want = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    for _ in range(2):
        assert abs(S.auc_roc(df).first()["auc"] - want) < 1e-9
    tp, fp = np.cumsum(y[::-1]), np.cumsum(1 - y[::-1])
    prec = tp / (tp + fp)
    area = ((prec + np.append(prec[0], prec[:-1])) / 2 * y[::-1]).sum() / y.sum()
    assert abs(S.pr_area(df).first()["auc_pr"] - area) < 1e-9
