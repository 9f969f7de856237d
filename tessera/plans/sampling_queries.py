"""Sampling and splitting queries (A1-A6) on whole tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sampling as A
from ..sources.tables import table
from .registry import register

LINE_ID = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def brand_fractions(spark: SparkSession, sf: str) -> dict[str, float]:
    """Stratum fractions for ``part`` by brand: (1 + brand number mod 4) / 8,
    i.e. 1/8 .. 4/8 (exact binary fractions).  One entry per brand."""
    brands = [r[0] for r in table(spark, sf, "part").select("p_brand").distinct().collect()]
    return {b: (1 + int(b.split("#")[1]) % 4) / 8.0 for b in brands}


@register("sample_replace", sql="SELECT TRUE AS near_size, TRUE AS known FROM lineitem LIMIT 1")
def q_sample_replace(spark: SparkSession, sf: str) -> DataFrame:
    """A tenth with replacement: within five standard deviations of its size, all
    of it rows of the table."""
    li = table(spark, sf, "lineitem").select(*LINE_ID)
    s = A.sample(li, True, 0.1, seed=42)
    n = li.agg(F.count(F.lit(1)).alias("all"))                                          # one-row sides
    strange = s.join(li, LINE_ID, "left_anti").agg(F.count(F.lit(1)).alias("strange"))
    facts = s.agg(F.count(F.lit(1)).alias("n")).crossJoin(n).crossJoin(strange)
    return facts.select((F.abs(F.col("n") - 0.1 * F.col("all")) <= 5 * F.sqrt(0.1 * F.col("all"))).alias("near_size"), (F.col("strange") == 0).alias("known"))


_SAMPLE_N = 1000


def _sample_facts(s: DataFrame, li: DataFrame) -> DataFrame:
    """Size of a sample, its distinct rows, and whether all are rows of the table."""
    known = s.join(li.distinct(), LINE_ID, "left_semi")
    return (s.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(*LINE_ID).alias("n_distinct"))
            .crossJoin(known.agg(F.count(F.lit(1)).alias("n_known"))))          # one-row sides


@register("sample_exact", sql=f"""
SELECT CAST(least({_SAMPLE_N}, count(*)) AS BIGINT) AS n, CAST(least({_SAMPLE_N}, count(*)) AS BIGINT) AS n_distinct,
       CAST(least({_SAMPLE_N}, count(*)) AS BIGINT) AS n_known
FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem)
""")
def q_sample_exact(spark: SparkSession, sf: str) -> DataFrame:
    """An exact sample without replacement of the distinct line keys."""
    li = table(spark, sf, "lineitem").select(*LINE_ID).distinct()
    return _sample_facts(A.take_sample(li, _SAMPLE_N, LINE_ID, False, seed=42), li)


@register("sample_exact_replace", sql="""
SELECT 2 * count(*) AS n, 2 * count(*) AS n_known, TRUE AS distinct_near, TRUE AS none_often FROM part
""")
def q_sample_exact_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Twice as many draws with replacement as there are parts: their number, the draws
    known to the table, whether the distinct ones are near 1 - 1/e^2 of all (five
    standard deviations), and whether no part came up very often."""
    part = table(spark, sf, "part").select("p_partkey")
    n = part.count()
    times = A.take_sample(part, 2 * n, ["p_partkey"], True, seed=42).groupBy("p_partkey").agg(F.count(F.lit(1)).alias("t"))
    known = times.join(part, "p_partkey", "left_semi")
    share = 1 - math.exp(-2)
    near = F.abs(F.count(F.lit(1)) - share * n) <= 5 * math.sqrt(share * (1 - share) * n)
    return times.agg(F.sum("t").alias("n"), near.alias("distinct_near"), (F.max("t") < 30).alias("none_often")).crossJoin(known.agg(F.sum("t").alias("n_known")))  # one-row sides


@register("stratified_approx", sql="SELECT p_brand, TRUE AS near_size FROM part GROUP BY p_brand")
def q_stratified_approx(spark: SparkSession, sf: str) -> DataFrame:
    """Poisson samples by brand: each stratum within five standard deviations
    (and one row) of its expected size."""
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    fr = brand_fractions(spark, sf)
    got = A.sample_by_key(part, "p_brand", fr, True, ["p_partkey"], seed=42).groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    want = part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("size")).withColumn("mean", A.fraction_column("p_brand", fr) * F.col("size"))
    near = F.abs(F.coalesce("n", F.lit(0)) - F.col("mean")) <= 5 * F.sqrt("mean") + 1
    return want.join(got, "p_brand", "left").select("p_brand", near.alias("near_size"))


_EXACT_SQL = """
SELECT p_brand,
       CAST(ceil(((1 + CAST(split_part(p_brand, '#', 2) AS INTEGER) % 4) / 8.0) * count(*)) AS BIGINT) AS n_exact,
       CAST(ceil(((1 + CAST(split_part(p_brand, '#', 2) AS INTEGER) % 4) / 8.0) * count(*)) AS BIGINT) AS n_exact_replace
FROM part GROUP BY p_brand
"""


@register("stratified_exact_counts", sql=_EXACT_SQL)
def q_stratified_exact_counts(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    fr = brand_fractions(spark, sf)
    a = A.sample_by_key_exact(part, "p_brand", fr, ["p_partkey"], False, seed=42)
    b = A.sample_by_key_exact(part, "p_brand", fr, ["p_partkey"], True, seed=42)
    ca = a.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_exact"))
    cb = b.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_exact_replace"))
    return ca.join(cb, "p_brand", "full").select(
        "p_brand", F.coalesce("n_exact", F.lit(0)).cast("bigint").alias("n_exact"),
        F.coalesce("n_exact_replace", F.lit(0)).cast("bigint").alias("n_exact_replace"))


@register("sample_report", sql="""
WITH p AS (SELECT p_brand, count(*) AS n, (1 + CAST(split_part(p_brand, '#', 2) AS INTEGER) % 4) / 8.0 AS f FROM part GROUP BY 1),
m AS (SELECT *, ceil(f * n) AS m FROM p)
SELECT p_brand, round(n / sum(n) OVER (), 9) AS original, round(m / sum(m) OVER (), 9) AS exact, TRUE AS near FROM m
""")
def q_sample_report(spark: SparkSession, sf: str) -> DataFrame:
    """Each stratum's share of the original and of the exact sample, and whether
    its share of the approximate sample lies within five standard deviations."""
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    fr = brand_fractions(spark, sf)
    approx = A.sample_by_key(part, "p_brand", fr, True, ["p_partkey"], seed=42)
    exact = A.sample_by_key_exact(part, "p_brand", fr, ["p_partkey"], True, seed=42)
    r = A.sample_report(part, approx, exact, "p_brand")
    n = approx.agg(F.count(F.lit(1)).alias("n"))
    near = F.abs(F.col("approx") - F.col("exact")) <= 5 * F.sqrt(F.col("exact") / F.col("n")) + 5 / F.col("n")
    return r.crossJoin(F.broadcast(n)).select("p_brand", F.round("original", 9).alias("original"), F.round("exact", 9).alias("exact"), near.alias("near"))


@register("split_hash", sql="""
SELECT count(*) AS n, TRUE AS two_parts, TRUE AS near_share, CAST(0 AS BIGINT) AS moved FROM lineitem
""")
def q_split_hash(spark: SparkSession, sf: str) -> DataFrame:
    """An 80/20 split by row hash: all rows fall into two parts, the first near
    its share, and rows with equal keys into the same part."""
    li = table(spark, sf, "lineitem").select(*LINE_ID)
    s = A.hash_split(li, [0.8, 0.2], LINE_ID, seed=42)
    keys = s.groupBy(*LINE_ID).agg(F.count_distinct("split").alias("parts"))
    share = F.avg((F.col("split") == 0).cast("double"))
    facts = s.agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("split").isin(0, 1)).alias("two_parts"),
                  (F.abs(share - 0.8) <= 5 * F.sqrt(F.lit(0.16) / F.count(F.lit(1)))).alias("near_share"))
    return facts.crossJoin(keys.agg(F.sum((F.col("parts") > 1).cast("long")).alias("moved")))     # one-row sides


@register("split_mod", sql="""
SELECT CASE WHEN l_orderkey % 10 < 8 THEN 'train' ELSE 'test' END AS split,
       CAST(count(*) AS BIGINT) AS n, round(sum(l_extendedprice), 2) AS revenue
FROM lineitem GROUP BY 1
""")
def q_split_mod(spark: SparkSession, sf: str) -> DataFrame:
    """Deterministic 80/20 split by order key: every row lands in one part."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice")
    part = F.when(F.pmod("l_orderkey", F.lit(10)) < 8, "train").otherwise("test")
    return li.groupBy(part.alias("split")).agg(F.count(F.lit(1)).alias("n"),
                                                F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
