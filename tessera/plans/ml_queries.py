"""Generators, clustering, gradient and model queries
on whole driver tables."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import als_blocks as AB
from ..operators import clustering as C
from ..operators import gradient as G
from ..operators import models as M
from ..operators.relational import reindex_labels
from ..sources import generators as GEN
from ..sources import text as T
from ..sources.tables import table
from .registry import register
from .session import cut_lineage, stored

LINE_ID = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def _rows(spark: SparkSession, data: list[tuple], schema: str) -> DataFrame:
    """Model-sized driver results (coefficients, metrics) as a DataFrame."""
    return spark.createDataFrame(data, schema)


# ================================================================ generators
def _moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows of a normal sample, and whether each column's mean and variance lie
    within five standard errors of 0 and 1."""
    n = F.count(F.lit(1))
    near = [(F.abs(F.avg(c)) <= 5 / F.sqrt(n)) & (F.abs(F.var_samp(c) - 1) <= 5 * F.sqrt(F.lit(2.0) / n)) for c in cols]
    return df.agg(n.alias("n"), *[x.alias(f"{c}_standard") for x, c in zip(near, cols)])


@register("random_normal", sql="SELECT count(*) AS n, TRUE AS x_standard FROM lineitem")
def q_random_normal(spark: SparkSession, sf: str) -> DataFrame:
    return _moments(GEN.normal(table(spark, sf, "lineitem").select(*LINE_ID), seed=42), ["x"])


@register("random_normal_vectors", sql="SELECT count(*) AS n, TRUE AS v0_standard, TRUE AS v1_standard FROM lineitem")
def q_random_normal_vectors(spark: SparkSession, sf: str) -> DataFrame:
    v = GEN.normal_vectors(table(spark, sf, "lineitem").select(*LINE_ID), dims=2, seed=42)
    return _moments(v.select(F.col("v")[0].alias("v0"), F.col("v")[1].alias("v1")), ["v0", "v1"])


@register("kv_uniform", sql="""
SELECT count(*) AS n, CAST(100 * count(*) AS BIGINT) AS payload_bytes, TRUE AS in_range, TRUE AS centred FROM lineitem
""")
def q_kv_uniform(spark: SparkSession, sf: str) -> DataFrame:
    """One uniform key and a 100-byte payload per lineitem row: the sizes, the
    range of the keys, and whether their mean is within five standard errors."""
    kv = GEN.kv_uniform(table(spark, sf, "lineitem").select(*LINE_ID), val_size=100, seed=42)
    n, top = F.count(F.lit(1)), float(GEN.INT_MAX)
    return kv.agg(n.alias("n"), F.sum(F.octet_length("payload")).cast("bigint").alias("payload_bytes"),
                  F.bool_and((F.col("key") >= 0) & (F.col("key") < GEN.INT_MAX)).alias("in_range"),
                  (F.abs(F.avg("key") / top - 0.5) <= 5 / F.sqrt(12 * n)).alias("centred"))


MAPPERS = 8


@register("kv_ramp_counts", sql=f"""
WITH t AS (SELECT count(*) // {MAPPERS} AS pairs FROM lineitem)
SELECT CAST(p AS INTEGER) AS mapper, CAST(floor((p + 1) / {float(MAPPERS)} * pairs) AS BIGINT) AS n
FROM generate_series(0, {MAPPERS - 1}) g(p), t
""")
def q_kv_ramp_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Linearly skewed generator sized by the table: pairs = |lineitem| / 8."""
    pairs = table(spark, sf, "lineitem").count() // MAPPERS
    kv = GEN.kv_ramp(spark, MAPPERS, pairs, val_size=16, seed=42)
    return kv.groupBy("mapper").agg(F.count(F.lit(1)).alias("n"))


@register("kv_hotkey", sql="""
SELECT CAST(r AS INTEGER) AS reducer, TRUE AS near_share, (SELECT count(*) FROM lineitem) AS total FROM range(8) t(r)
""")
def q_kv_hotkey(spark: SparkSession, sf: str) -> DataFrame:
    """Ratio-skewed keys for every lineitem row: whether each reducer (key mod 8)
    gets its share (5 / 12 for the hot one, 1 / 12 else) within five standard
    deviations, and the rows of all reducers."""
    kv = GEN.kv_hotkey(table(spark, sf, "lineitem").select(*LINE_ID), reducers=8, ratio=5.0, seed=42)
    n = kv.groupBy(F.pmod("key", F.lit(8)).alias("reducer")).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("total"))                                            # one row
    share = F.when(F.col("reducer") == 0, 5 / 12).otherwise(1 / 12)
    near = F.abs(F.col("n") - share * F.col("total")) <= 5 * F.sqrt(F.col("total") * share * (1 - share))
    return n.crossJoin(F.broadcast(total)).select(F.col("reducer").cast("int").alias("reducer"), near.alias("near_share"), "total")


# ================================================================ K3
@register("pi_random", sql="SELECT count(*) AS n, TRUE AS near_pi FROM lineitem")
def q_pi_random(spark: SparkSession, sf: str) -> DataFrame:
    """A random point for every lineitem row: the estimate lies within five
    standard errors of pi."""
    pts = table(spark, sf, "lineitem").select((F.rand(42) * 2 - 1).alias("x"), (F.rand(43) * 2 - 1).alias("y"))
    return C.pi_estimate(pts).select("n", (F.abs(F.col("pi") - np.pi) <= 5 * 1.65 / F.sqrt("n")).alias("near_pi"))


@register("pi_grid", sql="""
WITH p AS (
  SELECT ((l_orderkey * 31 + l_linenumber * 17 + l_partkey) % 2001) / 1000.0 - 1 AS x,
         ((l_partkey * 13 + l_suppkey * 7 + l_orderkey) % 2001) / 1000.0 - 1 AS y
  FROM lineitem)
SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN x * x + y * y < 1 THEN 1 ELSE 0 END) AS BIGINT) AS inside,
       round(4.0 * sum(CASE WHEN x * x + y * y < 1 THEN 1 ELSE 0 END) / count(*), 6) AS pi
FROM p
""")
def q_pi_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Deterministic points from row keys (a fixed grid of 2001 x 2001)."""
    li = table(spark, sf, "lineitem")
    x = F.pmod(F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17 + F.col("l_partkey"), F.lit(2001)) / 1000.0 - 1
    y = F.pmod(F.col("l_partkey") * 13 + F.col("l_suppkey") * 7 + F.col("l_orderkey"), F.lit(2001)) / 1000.0 - 1
    r = C.pi_estimate(li.select(x.alias("x"), y.alias("y")))
    return r.select("n", "inside", F.round("pi", 6).alias("pi"))


# ================================================================ K4 / L8
KM_K = 3
KM_ITERS = 3


def _kmeans_sql() -> str:
    # pid: a per-row id (the 4-column line key is not unique in every table)
    parts = ["""pts AS MATERIALIZED (
  SELECT row_number() OVER () AS pid, l_orderkey, l_partkey, l_suppkey, l_linenumber,
         l_quantity AS x, l_extendedprice / 1000.0 AS y FROM lineitem
)""", f"""c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, x, y) - 1 AS INTEGER) AS k,
         x AS cx, y AS cy
  FROM (SELECT * FROM pts ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, x, y LIMIT {KM_K})
)"""]
    for i in range(1, KM_ITERS + 1):
        parts.append(f"""a{i} AS (
  SELECT x, y, k FROM (
    SELECT p.x, p.y, c.k, row_number() OVER (PARTITION BY p.pid
                                               ORDER BY (p.x - c.cx) * (p.x - c.cx) + (p.y - c.cy) * (p.y - c.cy), c.k) AS rn
    FROM pts p CROSS JOIN c{i-1} c) WHERE rn = 1
), m{i} AS (SELECT k, avg(x) AS cx, avg(y) AS cy FROM a{i} GROUP BY k),
c{i} AS (SELECT c.k, coalesce(m.cx, c.cx) AS cx, coalesce(m.cy, c.cy) AS cy FROM c{i-1} c LEFT JOIN m{i} m USING (k))""")
    return "WITH " + ",\n".join(parts) + f"\nSELECT k, round(cx, 6) AS cx, round(cy, 6) AS cy FROM c{KM_ITERS}"


@register("kmeans_lloyd", sql=_kmeans_sql())
def q_kmeans_lloyd(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    pts = li.select(*LINE_ID, F.array("l_quantity", (F.col("l_extendedprice") / 1000.0)).alias("features"))
    # seeds: the first K rows in key order (a top-K: choosing K seeds is the feature)
    seeds = [list(r["features"]) for r in
             pts.orderBy(*LINE_ID, F.col("features")[0], F.col("features")[1]).limit(KM_K).collect()]
    centers, _ = C.kmeans_lloyd(pts, KM_K, converge_dist=0.0, initial_centers=seeds, max_iter=KM_ITERS)
    return _rows(spark, [(i, round(c[0], 6), round(c[1], 6)) for i, c in enumerate(centers)],
                 "k int, cx double, cy double")


def _class_cost(e: DataFrame) -> float:
    """Cost of the classes' own means: a partition that a good clustering beats."""
    from ..operators.stats import group_mean_vectors
    means = group_mean_vectors(e, "label", "features")
    d = e.join(means, "label").select(V.sqdist(V.to_double_array("features"), F.col("mean")).alias("c"))
    return float(d.agg(F.sum("c")).first()[0])


def _replayed_cost(e: DataFrame, centers: list) -> float:
    """Squared distances to the nearest of the returned centres, without the library."""
    x = V.to_double_array("features")
    per = [F.aggregate(F.zip_with(x, V.lit_vector([float(v) for v in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, v: t + v) for c in centers]
    return float(e.agg(F.sum(F.least(*per))).first()[0])


#: ten centres that cost less than the classes' own means, and a cost that follows from them
_CLUSTER_FACTS = "CAST(10 AS INTEGER) AS k, TRUE AS below_classes, TRUE AS cost_replayed"


@register("kmeans_embeddings", sql=f"SELECT {_CLUSTER_FACTS}")
def q_kmeans_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """Lloyd k-means on the 64-d embeddings, K = 10, seeds sampled exactly (10
    rows by hash), until the centres move less than 0.001: its cost, replayed
    from the centres, is below that of the ten classes' means."""
    e = cut_lineage(table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").alias("features")))
    centers, _ = C.kmeans_lloyd(e.select("vec_id", "features"), 10, converge_dist=0.001, id_cols=["vec_id"], seed=42, max_iter=50)
    cost, again = float(C.kmeans_cost(e, centers).first()["cost"]), _replayed_cost(e, centers)
    return _rows(spark, [(len(centers), again < _class_cost(e), abs(cost - again) <= 1e-6 * again)], "k int, below_classes boolean, cost_replayed boolean")


@register("kmeans_fit", sql=f"SELECT m AS init_mode, {_CLUSTER_FACTS} FROM (VALUES ('k-means||'), ('random')) v(m)")
def q_kmeans_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Spark ML k-means with both initialisations, held against the classes' means."""
    e = cut_lineage(table(spark, sf, "embeddings").select("label", F.col("embedding").alias("features")))
    classes, out = _class_cost(e), []
    for mode in ("k-means||", "random"):
        m = C.kmeans_ml(e.select("features"), 10, max_iter=10, init_mode=mode)
        again = _replayed_cost(e, [c.tolist() for c in m.clusterCenters()])
        before = float(m.summary.trainingCost)  # under the centres of the step before the last update
        out.append((mode, int(m.summary.k), again < classes, 0.5 * before < again <= before * (1 + 1e-9)))
    return _rows(spark, out, "init_mode string, k int, below_classes boolean, cost_replayed boolean")


# ================================================================ L1 / L2
LR_W0 = [0.2, -0.5, 0.8]   # fixed start weights (bias, discount*10, tax*10)
LR_STEP = 1e-5
LR_ITERS = 5


def _logreg_sql() -> str:
    parts = ["""d AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE -1.0 END::DOUBLE AS y,
         1.0::DOUBLE AS x0, l_discount * 10 AS x1, l_tax * 10 AS x2 FROM lineitem
)""", f"w0 AS (SELECT {LR_W0[0]}::DOUBLE AS w0, {LR_W0[1]}::DOUBLE AS w1, {LR_W0[2]}::DOUBLE AS w2)"]
    for i in range(1, LR_ITERS + 1):
        m = f"(1.0 / (1.0 + exp(-(d.y * (w.w0 * d.x0 + w.w1 * d.x1 + w.w2 * d.x2)))) - 1.0) * d.y"
        parts.append(f"""w{i} AS (
  SELECT any_value(w.w0) - {LR_STEP} * sum(d.x0 * {m}) AS w0,
         any_value(w.w1) - {LR_STEP} * sum(d.x1 * {m}) AS w1,
         any_value(w.w2) - {LR_STEP} * sum(d.x2 * {m}) AS w2
  FROM d CROSS JOIN w{i-1} w)""")
    return ("WITH " + ",\n".join(parts) +
            f"\nSELECT round(w0, 6) AS w0, round(w1, 6) AS w1, round(w2, 6) AS w2 FROM w{LR_ITERS}")


def _lr_points(li: DataFrame) -> DataFrame:
    y = F.when(F.col("l_returnflag") == "R", 1.0).otherwise(-1.0)
    return li.select(y.alias("y"), F.array(F.lit(1.0), F.col("l_discount") * 10, F.col("l_tax") * 10).alias("x"))


def _weights_row(spark, w) -> DataFrame:
    return _rows(spark, [tuple(round(float(v), 6) for v in w)], "w0 double, w1 double, w2 double")


@register("logreg_gd", sql=_logreg_sql())
def q_logreg_gd(spark: SparkSession, sf: str) -> DataFrame:
    w = G.logistic_sum_gd(_lr_points(table(spark, sf, "lineitem")), LR_W0, iterations=LR_ITERS, step=LR_STEP)
    return _weights_row(spark, w)


@register("logreg_gd_text", sql=_logreg_sql())
def q_logreg_gd_text(spark: SparkSession, sf: str) -> DataFrame:
    """Same job from text lines ``"y 1.0 d t"`` through the labeled-point parser."""
    pts = _lr_points(table(spark, sf, "lineitem"))
    lines = pts.select(F.concat_ws(" ", F.col("y").cast("string"),
                                   *[F.col("x")[i].cast("string") for i in range(3)]).alias("value"))
    parsed = T.parse_labeled_points(lines, dims=3)
    w = G.logistic_sum_gd(parsed, LR_W0, iterations=LR_ITERS, step=LR_STEP)
    return _weights_row(spark, w)


# ================================================================ L3 / L4
#: a linear rule over the first components, times 16 so that a penalty of 0.1 leaves room
_RULE = (2.0, -1.5, 1.0, -0.5, 0.25)
_AREA = 0.8


def _binary_embeddings(spark, sf):
    e = table(spark, sf, "embeddings")
    x = V.to_double_array("embedding")
    side = sum(c * x[k] for k, c in enumerate(_RULE))
    return cut_lineage(e.select("vec_id", (side > 0).cast("double").alias("label"), F.transform(x, lambda v: v * 16.0).alias("x")))


#: every fifth id is held out; zeros as weights have areas of a half and of the share of positives
_BINARY_SQL = f"""
WITH e AS (SELECT vec_id % 5 = 4 AS held, {" + ".join(f"({c}) * CAST(embedding[{k + 1}] AS DOUBLE)" for k, c in enumerate(_RULE))} > 0 AS y FROM embeddings)
SELECT p AS penalty, count(*) AS n_test, count_if(y) AS n_positive, TRUE AS roc_above, TRUE AS pr_above
FROM e, (VALUES ('l1'), ('l2')) v(p) WHERE held GROUP BY p
"""


def _binary_rows(spark: SparkSession, test: DataFrame, weights: dict[str, list[float]]) -> DataFrame:
    """Per penalty: test rows, and whether both areas are above their floors: 0.8, and
    half way from the share of positives (what chance gives) to 1."""
    out = []
    n, pos = test.agg(F.count(F.lit(1)), F.sum("label").cast("long")).first()
    for pen, w in weights.items():
        met = M.binary_metrics(G.predict_linear(test, w, "x", "score"), "score")
        out.append((pen, n, pos, met["auc_roc"] > _AREA, met["auc_pr"] > (1 + pos / n) / 2))
    return _rows(spark, out, "penalty string, n_test long, n_positive long, roc_above boolean, pr_above boolean")


@register("binary_lr", sql=_BINARY_SQL)
def q_binary_lr(spark: SparkSession, sf: str) -> DataFrame:
    """L-BFGS logistic regression with L1 and L2 (reg 0.1, 100 iterations),
    scored on every fifth id by raw margins."""
    d = _binary_embeddings(spark, sf)
    train, test = d.where("vec_id % 5 <> 4"), d.where("vec_id % 5 = 4")
    return _binary_rows(spark, test, {pen: M.fit_logistic(train, reg=0.1, penalty=pen, max_iter=100).coefficients.toArray().tolist()
                                      for pen in ("l1", "l2")})


@register("binary_svm", sql=_BINARY_SQL)
def q_binary_svm(spark: SparkSession, sf: str) -> DataFrame:
    """Linear SVM (reg 0.1): L2 via Spark ML LinearSVC, L1 via the shared gradient
    trainer (hinge loss, soft-threshold updater, step 1.0, 100 iterations)."""
    d = _binary_embeddings(spark, sf)
    train, test = d.where("vec_id % 5 <> 4"), d.where("vec_id % 5 = 4")
    w, _ = G.train_sgd(train, "hinge", 64, iterations=100, step=1.0, reg=0.1, updater="l1", x="x", y="label")
    return _binary_rows(spark, test, {"l2": M.fit_linear_svc(train, reg=0.1, max_iter=100).coefficients.toArray().tolist(), "l1": w.tolist()})


# ================================================================ L5
@register("linreg_ols", sql="""
SELECT round(sum(l_quantity * l_extendedprice / 1000.0) / sum(l_quantity * l_quantity), 6) AS coefficient
FROM lineitem
""")
def q_linreg_ols(spark: SparkSession, sf: str) -> DataFrame:
    """Least squares without intercept or regularisation, one feature."""
    li = table(spark, sf, "lineitem").select(F.array("l_quantity").alias("x"),
                                             (F.col("l_extendedprice") / 1000.0).alias("label"))
    m = M.fit_linear_regression(li, reg=0.0)
    return _rows(spark, [(round(float(m.coefficients[0]), 6),)], "coefficient double")


def _sgd_sql(iterations: int, step: float, reg: float) -> str:
    """The three updaters replayed from the training rows' sums."""
    terms = [(a, b) for a in range(3) for b in range(a, 3)]
    sums = ", ".join([f"sum(x{a} * x{b}) / count(*) AS s{a}{b}" for a, b in terms] + [f"sum(x{a} * y) / count(*) AS t{a}" for a in range(3)])
    size = f"({step} / sqrt(k + 1))"

    def moved(a):
        g = " + ".join(f"s{min(a, b)}{max(a, b)} * w{b}" for b in range(3)) + f" - t{a}"
        plain, soft = f"(w{a} - {size} * ({g}))", f"{reg} * {size}"
        return (f"CASE u WHEN 'none' THEN {plain} WHEN 'l2' THEN w{a} * (1 - {size} * {reg}) - {size} * ({g}) "
                f"ELSE sign({plain}) * greatest(0.0, abs({plain}) - {soft}) END AS w{a}")
    return f"""
WITH RECURSIVE d AS (
  SELECT (l_orderkey * 7 + l_linenumber) % 5 < 4 AS train, l_quantity / 50.0 AS y, 1.0::DOUBLE AS x0, l_discount * 10 AS x1, l_tax * 10 AS x2 FROM lineitem
), s AS MATERIALIZED (SELECT {sums} FROM d WHERE train),
w(u, k, w0, w1, w2) AS (
  SELECT u, 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM (VALUES ('none'), ('l1'), ('l2')) v(u)
  UNION ALL
  SELECT u, k + 1, {", ".join(moved(a) for a in range(3))} FROM w, s WHERE k < {iterations}
)
SELECT u AS updater, round(any_value(w0), 6) AS w0, round(any_value(w1), 6) AS w1, round(any_value(w2), 6) AS w2,
       round(sqrt(avg((w0 * x0 + w1 * x1 + w2 * x2 - y) ^ 2)), 6) AS rmse
FROM w, d WHERE k = {iterations} AND NOT train GROUP BY u
"""


@register("linreg_sgd", sql=_sgd_sql(100, 1.0, 0.1))
def q_linreg_sgd(spark: SparkSession, sf: str) -> DataFrame:
    """Full-batch SGD least squares with none / L1 / L2 updaters (100
    iterations, step 1.0, reg 0.1); RMSE on the fifth of the rows that the key
    arithmetic holds out."""
    li = table(spark, sf, "lineitem")
    held = F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.lit(5)) >= 4
    d = li.select(F.array(F.lit(1.0), F.col("l_discount") * 10, F.col("l_tax") * 10).alias("x"),
                  (F.col("l_quantity") / 50.0).alias("label"), held.alias("held"))
    train, test = d.where("NOT held"), d.where("held")
    blocks = G.Blocks(train.select("x", F.col("label").alias("y")), {"x": 3, "y": 0})
    try:
        stats = G.normal_statistics(blocks, 3)           # one pass serves the three updaters
    finally:
        blocks.unpersist()
    out = []
    for upd in ("none", "l1", "l2"):
        w, _ = G.descend(stats, np.zeros(3), 100, 1.0, 0.1, upd)
        r = G.predict_linear(test, w.tolist(), "x").agg(
            F.sqrt(F.avg((F.col("prediction") - F.col("label")) ** 2)).alias("rmse")).first()["rmse"]
        out.append((upd, *[round(float(v), 6) for v in w], round(float(r), 6)))
    return _rows(spark, out, "updater string, w0 double, w1 double, w2 double, rmse double")


# ================================================================ L6 / L7
def pair_ratings(li: DataFrame) -> DataFrame:
    """(supplier, part) ratings, stars = ceil(quantity/10), averaged per pair."""
    return li.groupBy(F.col("l_suppkey").cast("int").alias("user"), F.col("l_partkey").cast("int").alias("item")).agg(
        F.avg(F.ceil(F.col("l_quantity") / 10)).alias("rating"))


@register("als_fit", sql="""
WITH r AS (SELECT DISTINCT l_suppkey AS u, l_partkey AS i FROM lineitem),
t AS (SELECT * FROM r WHERE (u + i) % 5 <> 4)
SELECT m AS mode, count(*) AS n_test, TRUE AS learnt
FROM r, (VALUES ('explicit'), ('implicit')) v(m)
WHERE (r.u + r.i) % 5 = 4 AND r.u IN (SELECT u FROM t) AND r.i IN (SELECT i FROM t) GROUP BY m
""")
def q_als_fit(spark: SparkSession, sf: str) -> DataFrame:
    """ALS (rank 10, 20 iterations, lambda 0.05) explicit and implicit on four
    fifths of the pairs, rated 1 or 5 by a rule of low rank: test pairs with known user
    and item, and whether the RMSE is below half that of the mean (implicit: whether
    the area under ROC of likes against dislikes is above 0.75)."""
    held = F.pmod(F.col("user") + F.col("item"), F.lit(5)) == 4
    rule = F.when(F.pmod(F.col("user") + F.floor(F.col("item") / 5), F.lit(3)) == 0, 1.0).otherwise(5.0)
    r = stored(pair_ratings(table(spark, sf, "lineitem")).withColumn("rating", rule), "ratings")
    train, test = M.pack_als(r.where(~held)), r.where(held)
    out = []
    for implicit in (False, True):
        p = M.fit_als(train, rank=10, max_iter=20, reg=0.05, implicit=implicit, less=2.5 if implicit else 0.0).transform(test)
        if implicit:
            liked = stored(p.select("prediction", (F.col("rating") > 2.5).cast("double").alias("liked")), "predictions")  # read several times
            out.append(("implicit", liked.count(), M.binary_metrics(liked, "prediction", "liked")["auc_roc"] > 0.75))
        else:
            row = p.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg((F.col("prediction") - F.col("rating")) ** 2)).alias("rmse"), F.stddev_pop("rating").alias("spread")).first()
            out.append(("explicit", int(row["n"]), float(row["rmse"]) < float(row["spread"]) / 2))
    return _rows(spark, out, "mode string, n_test long, learnt boolean")


def _dense_ratings(li: DataFrame) -> DataFrame:
    r = pair_ratings(li)
    return r.select(F.col("item").cast("long").alias("i"), F.col("user").cast("long").alias("j"), F.col("rating").alias("r"))


@register("als_dense", sql="""
WITH r AS (SELECT l_partkey AS i, l_suppkey AS j, avg(ceil(l_quantity / 10)) AS r FROM lineitem GROUP BY 1, 2)
SELECT CAST(5 AS INTEGER) AS iterations, count(DISTINCT i) AS n_items, count(DISTINCT j) AS n_users, TRUE AS falling, TRUE AS below_spread FROM r
""")
def q_als_dense(spark: SparkSession, sf: str) -> DataFrame:
    """Hand-written ALS by normal equations (rank 10, 5 iterations, lambda 0.01):
    the RMSE falls and ends below the ratings' standard deviation."""
    ratings = stored(_dense_ratings(table(spark, sf, "lineitem")), "ratings")
    items, users, hist = M.als_dense(ratings, rank=10, iterations=5, lam=0.01)
    spread = ratings.agg(F.stddev_pop("r")).first()[0]
    falling = all(b <= a + 1e-3 for a, b in zip(hist, hist[1:]))
    return _rows(spark, [(len(hist), items.count(), users.count(), falling, hist[-1] < spread)],
                 "iterations int, n_items long, n_users long, falling boolean, below_spread boolean")


ALS_LAMBDA = 0.01
# keeps exact halves off the rounding ties, where the last bit of a sum decides
TIE_OFFSET = 3.7e-7


@register("als_step_f1", sql=f"""
WITH r AS (
  SELECT l_partkey AS i, l_suppkey AS j, avg(ceil(l_quantity / 10)) AS r FROM lineitem GROUP BY 1, 2
), u AS (SELECT j, 0.5 + (j % 10) / 20.0 AS u FROM (SELECT DISTINCT j FROM r))
SELECT r.i AS id, round(sum(r.r * u.u) / (sum(u.u * u.u) + {ALS_LAMBDA} * count(*)) + {TIE_OFFSET}, 4) AS factor
FROM r JOIN u USING (j) GROUP BY r.i
""")
def q_als_step_f1(spark: SparkSession, sf: str) -> DataFrame:
    """One item half-step with rank 1: ``m_i = sum r u / (sum u^2 + lambda n_i)``."""
    ratings = _dense_ratings(table(spark, sf, "lineitem"))
    users = ratings.select("j").distinct().select(
        F.col("j").alias("id"), F.array(F.lit(0.5) + F.pmod("j", F.lit(10)) / 20.0).alias("f"))
    items = M.als_half_step(ratings, users, "i", "j", 1, ALS_LAMBDA)
    return items.select("id", F.round(F.col("f")[0] + TIE_OFFSET, 4).alias("factor"))


@register("als_step_f2", sql=f"""
WITH r AS (
  SELECT l_partkey AS i, l_suppkey AS j, avg(ceil(l_quantity / 10)) AS r FROM lineitem GROUP BY 1, 2
), u AS (SELECT j, 0.5 + (j % 10) / 20.0 AS a, 0.3 + (j % 7) / 14.0 AS b FROM (SELECT DISTINCT j FROM r)),
s AS (
  SELECT i, count(*) AS n, sum(a * a) + {ALS_LAMBDA} * count(*) AS aa, sum(a * b) AS ab, sum(b * b) + {ALS_LAMBDA} * count(*) AS bb,
         sum(r * a) AS ra, sum(r * b) AS rb FROM r JOIN u USING (j) GROUP BY i)
SELECT i AS id, n, round((bb * ra - ab * rb) / (aa * bb - ab * ab) + {TIE_OFFSET}, 4) AS f0, round((aa * rb - ab * ra) / (aa * bb - ab * ab) + {TIE_OFFSET}, 4) AS f1
FROM s
""")
def q_als_step_f2(spark: SparkSession, sf: str) -> DataFrame:
    """One item half-step with rank 2 on routed blocks."""
    ratings = cut_lineage(_dense_ratings(table(spark, sf, "lineitem")))
    j = F.col("j")
    users = ratings.select("j").distinct().select(j.alias("id"), F.array(F.lit(0.5) + F.pmod(j, F.lit(10)) / 20.0, F.lit(0.3) + F.pmod(j, F.lit(7)) / 14.0).alias("f"))
    side, _ = AB.sides(ratings)
    items = AB.unpack_factors(AB.half_step(side, AB.pack_factors(users, 2, side.n_blocks), 2, ALS_LAMBDA), 2)
    return items.select("id", "n", *[F.round(F.col("f")[k] + TIE_OFFSET, 4).alias(f"f{k}") for k in range(2)])


# ================================================================ L9
@register("tree_classify", sql="""
SELECT i AS impurity, TRUE AS shaped, count(*) AS n_test, TRUE AS above_majority
FROM embeddings, (VALUES ('gini'), ('entropy')) v(i) WHERE vec_id % 5 = 4 GROUP BY i
""")
def q_tree_classify(spark: SparkSession, sf: str) -> DataFrame:
    """Gini and entropy trees (depth 4, 100 bins) on four classes, the quadrants of the
    embeddings' first two components: shape, test rows, and whether at least half of
    what the majority class gets wrong is right."""
    x = V.to_double_array("embedding")
    label = (x[0] > 0).cast("double") * 2 + (x[1] > 0).cast("double")
    e = cut_lineage(table(spark, sf, "embeddings").select("vec_id", x.alias("x"), label.alias("label")))
    train, test = e.where("vec_id % 5 <> 4"), e.where("vec_id % 5 = 4")
    n = test.count()
    majority = test.groupBy("label").count().agg(F.max("count")).first()[0] / n
    out = []
    for imp in ("gini", "entropy"):
        m = M.fit_decision_tree(train, "classification", imp)
        hit = m.transform(M._vec(test, "x")).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
        out.append((imp, m.depth <= 4 and m.numNodes <= 31, n, hit >= (1 + majority) / 2))
    return _rows(spark, out, "impurity string, shaped boolean, n_test long, above_majority boolean")


@register("tree_regress", sql="""
SELECT TRUE AS shaped, count(*) AS n_test, TRUE AS below_spread FROM lineitem WHERE (l_orderkey + l_linenumber) % 5 = 4
""")
def q_tree_regress(spark: SparkSession, sf: str) -> DataFrame:
    """Depth-4 regression tree of what a line would cost at a price of 10 less its
    discount: shape, test rows, and whether its RMSE is below a third of the labels'
    standard deviation."""
    li = table(spark, sf, "lineitem").select(F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(5)).alias("part"),
                                             F.array("l_quantity", "l_discount", "l_tax").alias("x"), (F.col("l_quantity") * 10 * (1 - F.col("l_discount"))).alias("label"))
    m = M.fit_decision_tree(li.where("part <> 4"), "regression", "variance")
    r = m.transform(M._vec(li.where("part = 4"), "x")).agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg((F.col("prediction") - F.col("label")) ** 2)).alias("rmse"), F.stddev_pop("label").alias("spread")).first()
    return _rows(spark, [(m.depth <= 4 and m.numNodes <= 31, int(r["n"]), r["rmse"] < r["spread"] / 3)], "shaped boolean, n_test long, below_spread boolean")


@register("tree_stump", sql="""
WITH d AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem),
v AS (SELECT x, count(*) AS n, sum(y) AS s, sum(y * y) AS ss FROM d GROUP BY x),
c AS (SELECT x, lead(x) OVER (ORDER BY x) AS nx,
             sum(n) OVER (ORDER BY x) AS nl, sum(s) OVER (ORDER BY x) AS sl, sum(ss) OVER (ORDER BY x) AS ssl,
             sum(n) OVER () AS nt, sum(s) OVER () AS st, sum(ss) OVER () AS sst FROM v),
g AS (SELECT (x + nx) / 2 AS threshold, sl / nl AS lp, (st - sl) / (nt - nl) AS rp,
             (ssl - sl * sl / nl) + ((sst - ssl) - (st - sl) * (st - sl) / (nt - nl)) AS impurity
      FROM c WHERE nx IS NOT NULL)
SELECT round(threshold, 4) AS threshold, round(lp, 4) AS left_prediction, round(rp, 4) AS right_prediction
FROM g ORDER BY impurity, threshold LIMIT 1
""")
def q_tree_stump(spark: SparkSession, sf: str) -> DataFrame:
    """Depth-1 regression tree of price on quantity: the chosen threshold and
    the two leaf predictions, read from the model's debug dump."""
    li = table(spark, sf, "lineitem").select(F.array("l_quantity").alias("x"), F.col("l_extendedprice").alias("label"))
    m = M.fit_decision_tree(li, "regression", "variance", max_depth=1, max_bins=100)
    dump = m.toDebugString
    thr = float(re.search(r"feature 0 <= ([-0-9.Ee]+)", dump).group(1))
    preds = [float(v) for v in re.findall(r"Predict: ([-0-9.Ee]+)", dump)]
    return _rows(spark, [(round(thr, 4), round(preds[0], 4), round(preds[1], 4))],
                 "threshold double, left_prediction double, right_prediction double")


# ================================================================ L10
@register("naive_bayes_params", sql="""
WITH d AS (SELECT dense_rank() OVER (ORDER BY l_returnflag) - 1 AS c, l_quantity AS x0, l_discount AS x1, l_tax AS x2 FROM lineitem),
k AS (SELECT count(DISTINCT c) AS k, count(*) AS n FROM d),
s AS (SELECT c, count(*) AS nc, sum(x0) AS s0, sum(x1) AS s1, sum(x2) AS s2 FROM d GROUP BY c)
SELECT CAST(c AS DOUBLE) AS label,
       round(ln((nc + 1.0) / (k.n + k.k * 1.0)), 6) AS pi,
       round(ln((s0 + 1.0) / (s0 + s1 + s2 + 3.0)), 6) AS theta0,
       round(ln((s1 + 1.0) / (s0 + s1 + s2 + 3.0)), 6) AS theta1,
       round(ln((s2 + 1.0) / (s0 + s1 + s2 + 3.0)), 6) AS theta2
FROM s CROSS JOIN k
""")
def q_naive_bayes_params(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_returnflag", F.array("l_quantity", "l_discount", "l_tax").alias("x"))
    d = reindex_labels(li, "l_returnflag").select("x", F.col("label_idx").cast("double").alias("label"))
    m = M.fit_naive_bayes(d, smoothing=1.0)
    pi = m.pi.toArray()
    th = m.theta.toArray()
    return _rows(spark, [(float(c), round(float(pi[c]), 6), *[round(float(v), 6) for v in th[c]]) for c in range(len(pi))],
                 "label double, pi double, theta0 double, theta1 double, theta2 double")


@register("naive_bayes_accuracy", sql="""
WITH d AS (SELECT dense_rank() OVER (ORDER BY l_returnflag) - 1 AS c, (l_orderkey + l_linenumber) % 5 = 4 AS test,
                  l_quantity AS x0, l_discount AS x1, l_tax AS x2 FROM lineitem),
s AS (SELECT c, count(*) AS nc, sum(x0) AS s0, sum(x1) AS s1, sum(x2) AS s2 FROM d WHERE NOT test GROUP BY c),
m AS (SELECT c, ln((nc + 1.0) / (sum(nc) OVER () + count(*) OVER ())) AS pi, ln((s0 + 1.0) / (s0 + s1 + s2 + 3.0)) AS t0,
             ln((s1 + 1.0) / (s0 + s1 + s2 + 3.0)) AS t1, ln((s2 + 1.0) / (s0 + s1 + s2 + 3.0)) AS t2 FROM s),
p AS (SELECT d.c, (SELECT arg_max(m.c, pi + t0 * d.x0 + t1 * d.x1 + t2 * d.x2) FROM m) AS guess FROM d WHERE test)
SELECT count(*) AS n_test, round(avg(CASE WHEN c = guess THEN 1.0 ELSE 0.0 END), 4) AS accuracy FROM p
""")
def q_naive_bayes_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """Multinomial naive Bayes trained on four fifths of the lines."""
    li = table(spark, sf, "lineitem").select(F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(5)).alias("part"), "l_returnflag",
                                             F.array("l_quantity", "l_discount", "l_tax").alias("x"))
    d = reindex_labels(li, "l_returnflag").withColumn("label", F.col("label_idx").cast("double"))
    m = M.fit_naive_bayes(d.where("part <> 4"))
    hit = (F.col("prediction") == F.col("label")).cast("double")
    return m.transform(M._vec(d.where("part = 4"), "x")).agg(F.count(F.lit(1)).alias("n_test"), F.round(F.avg(hit), 4).alias("accuracy"))


# ================================================================ L11 / L12
_PCA_SQL = """
WITH s AS (
  SELECT var_samp(l_quantity) AS a, covar_samp(l_quantity, l_extendedprice / 1000.0) AS b,
         var_samp(l_extendedprice / 1000.0) AS c FROM lineitem),
e AS (SELECT a, b, c, (a + c) / 2 + sqrt(((a - c) / 2) ^ 2 + b * b) AS l1, (a + c) / 2 - sqrt(((a - c) / 2) ^ 2 + b * b) AS l2 FROM s),
v AS (
  SELECT 0 AS component, b AS v0, l1 - a AS v1, l1 / (l1 + l2) AS explained FROM e
  UNION ALL SELECT 1, b, l2 - a, l2 / (l1 + l2) FROM e),
n AS (SELECT component, v0 / sqrt(v0 * v0 + v1 * v1) AS v0, v1 / sqrt(v0 * v0 + v1 * v1) AS v1, explained FROM v)
SELECT CAST(component AS INTEGER) AS component,
       round(CASE WHEN (CASE WHEN abs(v0) >= abs(v1) THEN v0 ELSE v1 END) < 0 THEN -v0 ELSE v0 END, 6) AS v0,
       round(CASE WHEN (CASE WHEN abs(v0) >= abs(v1) THEN v0 ELSE v1 END) < 0 THEN -v1 ELSE v1 END, 6) AS v1,
       round(explained, 6) AS explained
FROM n
"""


@register("pca_2d", sql=_PCA_SQL)
def q_pca_2d(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select(F.array("l_quantity", F.col("l_extendedprice") / 1000.0).alias("x"))
    m = M.fit_pca(li, 2)
    pc = M.sign_normalise(m.pc.toArray())
    ev = m.explainedVariance.toArray()
    return _rows(spark, [(c, round(float(pc[0, c]), 6), round(float(pc[1, c]), 6), round(float(ev[c]), 6)) for c in range(2)],
                 "component int, v0 double, v1 double, explained double")


@register("pca_embeddings", sql="""
WITH v AS (SELECT k, var_samp(CAST(embedding[k] AS DOUBLE)) AS v FROM embeddings, (SELECT unnest(range(1, 65)) AS k) GROUP BY k)
SELECT CAST(count(*) AS INTEGER) AS components, round(sum(v), 6) AS variance, TRUE AS uncorrelated, TRUE AS descending, TRUE AS first_beats_axes FROM v
""")
def q_pca_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """All components of the embeddings, judged by the projections: their variances add
    up to the columns' own, descend as the explained shares do, no two are correlated,
    and the first is larger than that of any column."""
    e = cut_lineage(table(spark, sf, "embeddings").select(V.to_double_array("embedding").alias("x")))
    m = M.fit_pca(e)
    from pyspark.ml.functions import vector_to_array
    got = cut_lineage(m.transform(M._vec(e, "x")).select(vector_to_array("pca").alias("x"), F.col("x").alias("raw")))
    n = got.count()
    mean = np.array(got.agg(*[F.avg(F.col("x")[k]) for k in range(64)]).first())
    cov = (M.gram_matrix(got.select("x")) - n * np.outer(mean, mean)) / (n - 1)
    axes = max(got.agg(*[F.var_samp(F.col("raw")[k]) for k in range(64)]).first())
    var, off = np.diag(cov), cov - np.diag(np.diag(cov))
    shares = m.explainedVariance.toArray()
    return _rows(spark, [(len(var), round(float(var.sum()), 6), bool(np.abs(off).max() < 1e-9), bool((np.diff(var) <= 1e-12).all()) and np.allclose(var / var.sum(), shares),
                          bool(var[0] > axes))], "components int, variance double, uncorrelated boolean, descending boolean, first_beats_axes boolean")


@register("svd_2d", sql="""
WITH s AS (SELECT sum(l_quantity * l_quantity) AS a, sum(l_quantity * l_extendedprice / 1000.0) AS b,
                  sum((l_extendedprice / 1000.0) * (l_extendedprice / 1000.0)) AS c FROM lineitem)
SELECT 0 AS idx, round(sqrt((a + c) / 2 + sqrt(((a - c) / 2) ^ 2 + b * b)), 4) AS sigma FROM s
UNION ALL SELECT 1, round(sqrt((a + c) / 2 - sqrt(((a - c) / 2) ^ 2 + b * b)), 4) FROM s
""")
def q_svd_2d(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select(F.array("l_quantity", F.col("l_extendedprice") / 1000.0).alias("x"))
    sv = M.singular_values(li)
    return _rows(spark, [(i, round(float(s), 4)) for i, s in enumerate(sv)], "idx int, sigma double")


@register("svd_graded", sql="""
WITH s AS (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb FROM (SELECT CAST(l_quantity AS DOUBLE) AS a, CAST(l_linenumber AS DOUBLE) AS b FROM lineitem)),
t AS (SELECT 2 * aa + ab / 536870912.0 + bb / 1152921504606846976.0 AS trace, (aa * bb - ab * ab) AS det FROM s)
SELECT round(sqrt(trace / 2 + sqrt(trace * trace / 4 - det / 1152921504606846976.0)), 3) AS largest,
       round(sqrt(det / (trace / 2 + sqrt(trace * trace / 4 - det / 1152921504606846976.0))), 1) AS smallest_scaled FROM t
""")
def q_svd_graded(spark: SparkSession, sf: str) -> DataFrame:
    """Two almost parallel columns, q and q + 2^-30 l: the singular values lie nine
    orders of magnitude apart (the smaller one times 2^30)."""
    q, line = F.col("l_quantity").cast("double"), F.col("l_linenumber").cast("double")
    sv = M.singular_values(table(spark, sf, "lineitem").select(F.array(q, q + line * 2.0 ** -30).alias("x")))
    return _rows(spark, [(round(float(sv[0]), 3), round(float(sv[1]) * 2.0 ** 30, 1))], "largest double, smallest_scaled double")


@register("svd_embeddings", sql="""
SELECT CAST(max(len(embedding)) AS INTEGER) AS n, round(sum(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 4) AS energy
FROM embeddings
""")
def q_svd_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """All singular values of the embeddings: their number and the sum of their
    squares, which is the sum of all squared components."""
    e = table(spark, sf, "embeddings").select(V.to_double_array("embedding").alias("x"))
    sv = M.singular_values(e)
    return _rows(spark, [(len(sv), round(float((sv ** 2).sum()), 4))], "n int, energy double")
