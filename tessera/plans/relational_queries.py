"""Grouping, joins, lookups, label handling and vector functions
(D6, D7, D9, D10, J3, J5, P7, F6, F8, F9, T3, T4) on the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import relational as R
from ..operators.stats import group_mean_vectors
from ..sources import text as T
from ..sources.tables import table
from .session import cut_lineage
from .registry import register
from .text_queries import ratings_lines


# ---------------------------------------------------------------- D6
@register("group_count_distinct", sql="""
SELECT CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_keys FROM orders
""")
def q_group_count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return R.count_distinct_keys(table(spark, sf, "orders"), "o_custkey")


@register("group_collect", sql="""
SELECT user_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(length(props)) AS BIGINT) AS payload_bytes
FROM events GROUP BY user_id
""", note="groupByKey re-aimed: per-key value count and payload size as mergeable aggregates")
def q_group_collect(spark: SparkSession, sf: str) -> DataFrame:
    return R.group_payload_stats(table(spark, sf, "events"), "user_id", "props")


# ---------------------------------------------------------------- D7
@register("group_sizes_salted", sql="""
SELECT l_suppkey, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY l_suppkey
""")
def q_group_sizes_salted(spark: SparkSession, sf: str) -> DataFrame:
    return R.group_sizes_salted(table(spark, sf, "lineitem"), "l_suppkey", salt_buckets=16,
                                salt_col="l_orderkey")


# ---------------------------------------------------------------- D9
@register("class_fractions", sql="""
SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n,
       round(count(*) / (SELECT count(*) FROM lineitem), 6) AS fraction
FROM lineitem GROUP BY l_returnflag
""")
def q_class_fractions(spark: SparkSession, sf: str) -> DataFrame:
    r = R.class_fractions(table(spark, sf, "lineitem"), "l_returnflag")
    return r.select("l_returnflag", "n", F.round("fraction", 6).alias("fraction"))


# ---------------------------------------------------------------- D10
@register("rating_cardinalities", sql="""
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT l_suppkey) AS BIGINT) AS n_user,
       CAST(count(DISTINCT l_partkey) AS BIGINT) AS n_item
FROM lineitem
""")
def q_rating_cardinalities(spark: SparkSession, sf: str) -> DataFrame:
    ratings = T.parse_ratings(ratings_lines(table(spark, sf, "lineitem")))
    return R.cardinalities(ratings, ["user", "item"])


# ---------------------------------------------------------------- J5
@register("broadcast_lookup", sql="""
SELECT c.c_custkey, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def q_broadcast_lookup(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return R.lookup_join(c, n, "c_nationkey").select("c_custkey", "n_name")


@register("broadcast_lookup_two", sql="""
SELECT n.n_name, CAST(count(*) AS BIGINT) AS n_lines, round(sum(l.l_extendedprice), 2) AS revenue
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY n.n_name
""")
def q_broadcast_lookup_two(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_extendedprice")
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    j = R.lookup_join(R.lookup_join(li, s, "l_suppkey"), n, "s_nationkey")
    return j.groupBy("n_name").agg(F.count(F.lit(1)).alias("n_lines"),
                                   F.round(F.sum("l_extendedprice"), 2).alias("revenue"))


# ---------------------------------------------------------------- P7
@register("reindex_labels", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag,
       CAST(dense_rank() OVER (ORDER BY l_returnflag) - 1 AS INTEGER) AS label_idx
FROM lineitem
""")
def q_reindex_labels(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    return R.reindex_labels(li, "l_returnflag")


# ---------------------------------------------------------------- J3 / M2 / M3
def rating_counts(ratings: DataFrame) -> DataFrame:
    """The parsed ratings reduced once to ``(user, item, rating, n)``, and
    checkpointed: everything below is derived from this table."""
    return cut_lineage(ratings.groupBy("user", "item", "rating").agg(F.count(F.lit(1)).alias("n")))


def baseline_predictions(counts: DataFrame) -> DataFrame:
    """A fixed predictor keyed by (user, item): user mean + item mean - global
    mean, for every observed pair.  The global mean is a one-row table."""
    mean = F.sum(F.col("rating") * F.col("n")) / F.sum("n")
    g = counts.agg(mean.alias("g"))
    u = counts.groupBy("user").agg(mean.alias("bu"))
    i = counts.groupBy("item").agg(mean.alias("bi"))
    pairs = counts.select("user", "item").distinct()
    return (pairs.join(u, "user").join(i, "item").crossJoin(F.broadcast(g))
            .select("user", "item", (F.col("bu") + F.col("bi") - F.col("g")).alias("prediction")))


def weighted_rmse(rows: DataFrame, err: Column) -> DataFrame:
    """RMSE of rows that stand for ``n`` ratings each."""
    return rows.agg(F.sum("n").alias("n"), F.round(F.sqrt(F.sum(F.col("n") * err * err) / F.sum("n")), 6).alias("rmse"))


_BASELINE_SQL = """
WITH r AS (
  SELECT CAST(l_suppkey AS INTEGER) AS u, CAST(l_partkey AS INTEGER) AS i, CAST(ceil(l_quantity / 10) AS DOUBLE) AS rating
  FROM lineitem
), g AS (SELECT avg(rating) AS g FROM r),
bu AS (SELECT u, avg(rating) AS bu FROM r GROUP BY u),
bi AS (SELECT i, avg(rating) AS bi FROM r GROUP BY i),
p AS (SELECT DISTINCT r.u, r.i, bu.bu + bi.bi - g.g AS prediction
      FROM r JOIN bu USING (u) JOIN bi USING (i) CROSS JOIN g)
"""


@register("rmse_join", sql=_BASELINE_SQL + """
SELECT CAST(count(*) AS BIGINT) AS n, round(sqrt(avg((p.prediction - r.rating) ^ 2)), 6) AS rmse
FROM r JOIN p ON r.u = p.u AND r.i = p.i
""")
def q_rmse_join(spark: SparkSession, sf: str) -> DataFrame:
    counts = rating_counts(T.parse_ratings(ratings_lines(table(spark, sf, "lineitem"))))
    j = counts.join(baseline_predictions(counts), ["user", "item"])          # composite-key join
    return weighted_rmse(j, F.col("prediction") - F.col("rating"))


@register("rmse_implicit", sql=_BASELINE_SQL + """
SELECT CAST(count(*) AS BIGINT) AS n,
       round(sqrt(avg((greatest(least(p.prediction / 5.0, 1.0), 0.0)
                       - CASE WHEN r.rating - 2.5 > 0 THEN 1.0 ELSE 0.0 END) ^ 2)), 6) AS rmse
FROM r JOIN p ON r.u = p.u AND r.i = p.i
""")
def q_rmse_implicit(spark: SparkSession, sf: str) -> DataFrame:
    """Implicit-feedback evaluation: ratings are parsed shifted, test labels are
    1 when the shifted rating is positive, predictions are clamped to [0, 1]."""
    counts = rating_counts(T.parse_ratings(ratings_lines(table(spark, sf, "lineitem")), implicit=True))
    j = counts.join(baseline_predictions(counts), ["user", "item"])
    p = F.greatest(F.least((F.col("prediction") + 2.5) / 5.0, F.lit(1.0)), F.lit(0.0))
    return weighted_rmse(j, p - F.when(F.col("rating") > 0, 1.0).otherwise(0.0))


# ---------------------------------------------------------------- F6 / F8 / F9 / T3 / T4
_MEANS_SQL = """
WITH ex AS (
  SELECT label, unnest(generate_series(0, len(embedding) - 1)) AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings
), m AS (SELECT label, pos, avg(v) AS m FROM ex GROUP BY label, pos),
mv AS (SELECT label, list(m ORDER BY pos) AS mean FROM m GROUP BY label)
"""


def _with_label_means(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    means = group_mean_vectors(e, "label", "embedding")
    return R.lookup_join(e, means, "label")


@register("vector_dot", sql=_MEANS_SQL + """
SELECT e.vec_id, round(list_dot_product(CAST(e.embedding AS DOUBLE[]), mv.mean), 5) AS dot
FROM embeddings e JOIN mv USING (label)
""")
def q_vector_dot(spark: SparkSession, sf: str) -> DataFrame:
    j = _with_label_means(spark, sf)
    return j.select("vec_id", F.round(V.dot(V.to_double_array("embedding"), "mean"), 5).alias("dot"))


@register("vector_sqdist", sql=_MEANS_SQL + """
SELECT e.vec_id, round(list_distance(CAST(e.embedding AS DOUBLE[]), mv.mean) ^ 2, 5) AS sqdist
FROM embeddings e JOIN mv USING (label)
""")
def q_vector_sqdist(spark: SparkSession, sf: str) -> DataFrame:
    j = _with_label_means(spark, sf)
    return j.select("vec_id", F.round(V.sqdist(V.to_double_array("embedding"), "mean"), 5).alias("sqdist"))


@register("vector_concat", sql="""
SELECT vec_id, CAST(len(embedding) + 1 AS INTEGER) AS n,
       CAST(label AS DOUBLE) AS last, round(list_sum(CAST(embedding AS DOUBLE[])) + label, 6) AS total
FROM embeddings
""")
def q_vector_concat(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    c = V.concat(V.to_double_array("embedding"), F.array(F.col("label").cast("double")))
    return e.select("vec_id", F.size(c).alias("n"), F.element_at(c, -1).alias("last"),
                    F.round(V.vsum(c), 6).alias("total"))


@register("vector_arithmetic", sql="""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings)
SELECT vec_id, round(list_sum(list_transform(x, lambda a: 0.5 * a + (a + 2.0 * a))), 6) AS linear,
       round(list_sum(list_transform(x, lambda a: 1.0 / (1.0 + exp(-a)))), 6) AS squashed
FROM v
""")
def q_vector_arithmetic(spark: SparkSession, sf: str) -> DataFrame:
    """Sums of ``0.5 x + (x + 2 x)`` and of the logistic function of x."""
    x = V.to_double_array("embedding")
    return table(spark, sf, "embeddings").select(
        "vec_id", F.round(V.vsum(V.axpy(0.5, x, V.vadd(x, V.vscale(x, 2.0)))), 6).alias("linear"),
        F.round(V.vsum(F.transform(x, V.sigmoid)), 6).alias("squashed"))


@register("label_encode", sql="""
WITH l AS (SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS idx FROM (SELECT DISTINCT label FROM embeddings)),
k AS (SELECT count(*) AS k FROM l),
x AS (SELECT e.vec_id, l.idx, unnest(range(k.k)) AS pos FROM embeddings e JOIN l USING (label) CROSS JOIN k)
SELECT vec_id, CAST(pos AS INTEGER) AS pos, CASE WHEN pos = idx THEN 0.9 ELSE 0.1 END::DOUBLE AS value FROM x
""")
def q_label_encode(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select("vec_id", "label")
    idx = R.reindex_labels(e, "label")
    k = idx.select("label_idx").distinct().count()          # number of classes (model-sized)
    enc = idx.select("vec_id", V.one_hot("label_idx", k, 0.9, 0.1).alias("target"))
    return enc.select("vec_id", F.posexplode("target").alias("pos", "value"))


@register("argmax_label", sql="""
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax FROM embeddings
""")
def q_argmax_label(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", V.argmax("embedding").alias("argmax"))


def label_centres(spark: SparkSession, sf: str) -> list[list[float]]:
    """Per-label mean embeddings ordered by label (K x D numbers, model-sized)."""
    e = table(spark, sf, "embeddings")
    rows = group_mean_vectors(e, "label", "embedding").orderBy("label").collect()
    return [list(r["mean"]) for r in rows]


_NEAREST_SQL = _MEANS_SQL + """,
ranked AS (SELECT mv.label AS k, dense_rank() OVER (ORDER BY mv.label) - 1 AS ki, mean FROM mv),
d AS (SELECT e.vec_id, r.ki, list_distance(CAST(e.embedding AS DOUBLE[]), r.mean) ^ 2 AS d2
      FROM embeddings e CROSS JOIN ranked r),
best AS (SELECT vec_id, ki, d2, row_number() OVER (PARTITION BY vec_id ORDER BY d2, ki) AS rn FROM d)
"""


@register("nearest_center", sql=_NEAREST_SQL + """
SELECT vec_id, CAST(ki AS INTEGER) AS cluster FROM best WHERE rn = 1
""")
def q_nearest_center(spark: SparkSession, sf: str) -> DataFrame:
    centres = label_centres(spark, sf)
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", V.nearest_center(V.to_double_array("embedding"), centres).alias("cluster"))


@register("kmeans_cost", sql=_NEAREST_SQL + """
SELECT round(sum(d2), 4) AS cost FROM best WHERE rn = 1
""")
def q_kmeans_cost(spark: SparkSession, sf: str) -> DataFrame:
    centres = label_centres(spark, sf)
    e = table(spark, sf, "embeddings")
    return e.agg(F.round(F.sum(V.nearest_center_dist(V.to_double_array("embedding"), centres)), 4).alias("cost"))
