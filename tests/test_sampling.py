import math
from collections import Counter

from pyspark.sql import functions as F

import pytest

from tessera.operators import sampling as A


def part(spark, n=2000, strata=5, hot=True):
    # stratum 0 holds about a third of all rows (a hot stratum)
    rows = []
    for i in range(n):
        k = 0 if (hot and i % 3 == 0) else 1 + i % (strata - 1)
        rows.append((i, f"s{k}"))
    return spark.createDataFrame(rows, "id long, k string")


FR = {"s0": 0.125, "s1": 0.5, "s2": 0.3, "s3": 1.0, "s4": 0.0}


def test_exact_stratified_counts_and_identity(spark):
    df = part(spark)
    sizes = Counter(r.k for r in df.collect())
    # thresholds at the expected cut itself force several scans
    got = A.sample_by_key_exact(df, "k", FR, ["id"], seed=3, sigmas=0.0)
    rows = got.collect()
    cnt = Counter(r.k for r in rows)
    for k, f in FR.items():
        assert cnt.get(k, 0) == math.ceil(f * sizes[k])
    assert len({r.id for r in rows}) == len(rows)          # no duplicates
    # identical to brute force: the ceil(f n) smallest hashes per stratum
    h = df.withColumn("h", F.pmod(F.xxhash64(F.lit(3), F.col("id")), F.lit(2 ** 53))).collect()
    want = set()
    for k, f in FR.items():
        members = sorted((r.h, r.id) for r in h if r.k == k)
        want |= {i for _, i in members[:math.ceil(f * sizes[k])]}
    assert {r.id for r in rows} == want
    # defaults (one round) agree
    assert {r.id for r in A.sample_by_key_exact(df, "k", FR, ["id"], seed=3).collect()} == want


def test_exact_stratified_with_replacement(spark):
    df = part(spark)
    sizes = Counter(r.k for r in df.collect())
    got = A.sample_by_key_exact(df, "k", FR, ["id"], with_replacement=True, seed=5).collect()
    cnt = Counter(r.k for r in got)
    for k, f in FR.items():
        assert cnt.get(k, 0) == math.ceil(f * sizes[k])
    ids = {r.id: r.k for r in df.collect()}
    assert all(ids[r.id] == r.k for r in got)


def test_one_scan_and_a_short_waiting_list(spark):
    df = spark.range(200_000).withColumn("k", F.lit("a"))
    rows, scans = A._smallest_hashes(df, "k", [("a", 200_000, 10_000)], ["id"], 1)
    assert scans == 1 and rows.count() == 10_000
    _, scans = A._smallest_hashes(df, "k", [("a", 200_000, 10_000)], ["id"], 1, sigmas=0.0)
    assert scans > 1
    edge = {m: A._smallest_hashes(df.limit(50), "k", [("a", 50, m)], ["id"], 1)[0].count() for m in (1, 2, 49, 50)}
    assert edge == {1: 1, 2: 2, 49: 49, 50: 50}


def test_draws_with_replacement_are_uniform(spark):
    """How often a row is drawn: mean 1 and variance near 1 - 1/n, as for independent draws."""
    df = spark.range(3000)
    times = Counter(r.id for r in A.take_sample(df, 3000, ["id"], with_replacement=True, seed=4).collect())
    c = [times.get(i, 0) for i in range(3000)]
    mean, var = sum(c) / 3000, sum(x * x for x in c) / 3000 - 1
    assert mean == 1 and abs(var - 1) < 5 * math.sqrt(2 / 3000)
    assert max(c) > 3 and abs(c.count(0) / 3000 - math.exp(-1)) < .05
    first = sum(i * x for i, x in enumerate(c)) / 3000
    assert abs(first - 1499.5) < 5 * 866 / math.sqrt(3000)


def test_take_sample(spark):
    df = part(spark)
    a = A.take_sample(df, 100, ["id"], seed=1).collect()
    b = A.take_sample(df, 100, ["id"], seed=1).collect()
    assert len(a) == 100 and {r.id for r in a} == {r.id for r in b} and len({r.id for r in a}) == 100
    w = A.take_sample(df, 500, ["id"], with_replacement=True, seed=1).collect()
    assert len(w) == 500
    assert len(A.take_sample(df, 5000, ["id"]).collect()) == 2000


def test_row_index_dense(spark):
    df = part(spark).repartition(7)
    idx = sorted(r._idx for r in A.with_row_index(df).collect())
    assert idx == list(range(2000))


def test_approx_stratified(spark):
    df = part(spark, n=20000)
    sizes = Counter(r.k for r in df.collect())
    for wr in (False, True):
        got = Counter(r.k for r in A.sample_by_key(df, "k", FR, wr, ["id"], seed=9).collect())
        for k, f in FR.items():
            exp = f * sizes[k]
            assert abs(got.get(k, 0) - exp) <= 5 * math.sqrt(max(exp, 1)) + 1


def test_poisson_mean(spark):
    def uniform(i):
        return F.pmod(F.xxhash64(F.col("id"), i), F.lit(1 << 53)).cast("double") / float(1 << 53)
    for mean in (0.7, 60.0):
        df = spark.range(20000).select(A.poisson_count(F.lit(mean), uniform).alias("k"))
        r = df.agg(F.avg("k").alias("m"), F.variance("k").alias("v"), F.max("k").alias("x")).first()
        assert abs(r.m - mean) < 5 * math.sqrt(mean / 20000) and abs(r.v - mean) < 0.06 * mean
        assert mean < 1 or r.x > 80


def test_fractions_outside_the_unit_interval_raise(spark):
    df = part(spark, n=100)
    for f in (1.5, -0.1):
        with pytest.raises(ValueError):
            A.sample_by_key_exact(df, "k", {"a": f}, ["id"])
    assert A.sample_by_key_exact(df, "k", {}, ["id"]).count() == 0


def test_null_stratum_is_sampled(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(400)], "id long, k string")
    for wr in (False, True):
        got = Counter(r.k for r in A.sample_by_key_exact(df, "k", {None: 0.25, "a": 0.5}, ["id"], with_replacement=wr).collect())
        assert got == {None: 50, "a": 100}
    assert Counter(r.k for r in A.sample_by_key_exact(df, "k", {None: 1.0}, ["id"]).collect()) == {None: 200}


def test_hash_split_disjoint_complete(spark):
    df = part(spark)
    s = A.hash_split(df, [0.8, 0.2], ["id"])
    rows = s.collect()
    assert len(rows) == 2000 and {r.split for r in rows} <= {0, 1}
    share = sum(r.split == 0 for r in rows) / 2000
    assert 0.75 < share < 0.85
    again = {r.id: r.split for r in A.hash_split(df, [0.8, 0.2], ["id"]).collect()}
    assert again == {r.id: r.split for r in rows}
    parts = A.random_split(df, [0.8, 0.2], seed=1)
    ids = [r.id for p in parts for r in p.collect()]
    assert sorted(ids) == list(range(2000))


def test_sample_report_zero_when_empty(spark):
    df = part(spark)
    empty = df.where("false")
    rep = {r.k: r for r in A.sample_report(df, df, empty, "k").collect()}
    assert all(r.exact == 0.0 for r in rep.values())
    assert abs(sum(r.original for r in rep.values()) - 1.0) < 1e-12
