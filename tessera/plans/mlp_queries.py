"""Neural-network queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import mlp as N
from ..sources.tables import table
from .registry import register
from .session import cut_lineage

LINE_ID = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
# fixed weights of the 2-1-1 check network, layout A: w11, w12, b1, w2, b2
TINY_W = np.array([0.3, -0.2, 0.1, 0.7, -0.4])
TINY_TOPOLOGY = [2, 1, 1]

_TINY_SQL_BASE = """
WITH d AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_discount * 10 AS x1, l_tax * 10 AS x2,
                  l_quantity / 50.0 AS t FROM lineitem),
h AS (SELECT *, 1.0 / (1.0 + exp(-(0.3 * x1 - 0.2 * x2 + 0.1))) AS h FROM d),
o AS (SELECT *, 1.0 / (1.0 + exp(-(0.7 * h - 0.4))) AS o FROM h)
"""


def _tiny_inputs(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(*LINE_ID, F.array(F.col("l_discount") * 10, F.col("l_tax") * 10).alias("input"),
                     F.array(F.col("l_quantity") / 50.0).alias("output"))


@register("mlp_forward", sql=_TINY_SQL_BASE + """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(o, 6) AS o FROM o
""")
def q_mlp_forward(spark: SparkSession, sf: str) -> DataFrame:
    model = N.MLPModel(TINY_TOPOLOGY, TINY_W)
    p = model.predict(_tiny_inputs(spark, sf), "input", "pred")
    return p.select(*LINE_ID, F.round(F.col("pred")[0], 6).alias("o"))


@register("mlp_gradient", sql=_TINY_SQL_BASE + """,
g AS (SELECT *, (o - t) * o * (1 - o) AS d2 FROM o),
g1 AS (SELECT *, d2 * 0.7 * h * (1 - h) AS d1 FROM g)
SELECT round(avg(d1 * x1), 8) AS g0, round(avg(d1 * x2), 8) AS g1, round(avg(d1), 8) AS g2,
       round(avg(d2 * h), 8) AS g3, round(avg(d2), 8) AS g4, round(avg(0.5 * (t - o) * (t - o)), 8) AS loss
FROM g1
""")
def q_mlp_gradient(spark: SparkSession, sf: str) -> DataFrame:
    """Mean loss and gradient of the fixed 2-1-1 network over all lineitem rows."""
    loss, g, _ = N.gradient_job(_tiny_inputs(spark, sf).select("input", "output"), TINY_W, TINY_TOPOLOGY)
    vals = [round(float(v), 8) for v in g] + [round(float(loss), 8)]
    return spark.createDataFrame([tuple(vals)], "g0 double, g1 double, g2 double, g3 double, g4 double, loss double")


def _embeddings(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("double").alias("label"),
                                                 V.to_double_array("embedding").alias("features"))


@register("mlp_fit", sql="SELECT count(*) AS n, TRUE AS falling, TRUE AS lower FROM embeddings")
def q_mlp_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Network A regression from the 64-d embedding to its 0.9/0.1 class code
    (hidden 5), 20 L-BFGS iterations: the loss falls with every iteration."""
    e = _embeddings(spark, sf)
    labels = N.distinct_labels(e, "label")
    data = N.encode_labels(e.withColumnRenamed("features", "input"), "label", labels, 0.9, 0.1)
    h = N.mlp_fit(data, [5], max_iter=20, tol=1e-6).history
    return data.agg(F.count(F.lit(1)).alias("n"), F.lit(all(b <= a for a, b in zip(h, h[1:]))).alias("falling"), F.lit(h[-1] < h[0]).alias("lower"))


@register("mlp_classifier", sql="""
SELECT count(*) FILTER (vec_id % 5 <> 4) AS n_train, count(*) FILTER (vec_id % 5 = 4) AS n_test, TRUE AS falling FROM embeddings
""")
def q_mlp_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Classifier A on the embeddings' 10 classes (default hidden layer, 30
    iterations): predicted rows, and whether the loss falls with every iteration."""
    e = _embeddings(spark, sf)
    train, test = e.where("vec_id % 5 <> 4"), e.where("vec_id % 5 = 4")
    m = N.mlp_classifier_fit(train, max_iter=30)
    n = [N.classify(m, d).where("prediction IS NOT NULL").count() for d in (train, test)]
    falling = all(b <= a for a, b in zip(m.history, m.history[1:])) and m.history[-1] < m.history[0]
    return spark.createDataFrame([(*n, falling)], "n_train long, n_test long, falling boolean")


@register("mlp_gd", sql="SELECT count(*) AS n, TRUE AS lower FROM embeddings")
def q_mlp_gd(spark: SparkSession, sf: str) -> DataFrame:
    """Classifier B (gradient descent, lr 0.3, 100 iterations) on the binary
    target label >= 5: single output, rounded to one of the two labels."""
    e = _embeddings(spark, sf).withColumn("label", (F.col("label") >= 5).cast("double"))
    m = N.mlp_gd_fit(e, iterations=100, lr=0.3)
    n = N.classify(m, e).where(F.col("prediction").isin(0.0, 1.0)).count()
    return spark.createDataFrame([(n, m.history[-1] < m.history[0])], "n long, lower boolean")


@register("mlp_weights_bounds", sql="""
WITH t AS (SELECT max(len(embedding)) AS a, count(DISTINCT label) AS c FROM embeddings)
SELECT CAST(1 AS INTEGER) AS layer, CAST((a + 1) * (a // 2 + 1) AS BIGINT) AS n, TRUE AS bounded FROM t
UNION ALL SELECT 2, CAST((a // 2 + 2) * c AS BIGINT), TRUE FROM t
""")
def q_mlp_weights_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Random initial weights of classifier A's topology for the embeddings: per
    layer their number, and whether they lie within 2.4 / (fan_in + 1)."""
    e = table(spark, sf, "embeddings")
    n_in, n_out = e.agg(F.max(F.size("embedding")), F.count_distinct("label")).first()
    topo = [n_in, n_in // 2 + 1, n_out]
    w = N.random_weights(topo, 42)
    rows = []
    for li in range(1, len(topo)):
        m = N.weights_by_layer(w, topo, li)
        rows.append((li, int(m.size), bool(np.abs(m).max() <= N.INIT_RANGE / (topo[li - 1] + 1))))
    return spark.createDataFrame(rows, "layer int, n long, bounded boolean")


LAYER_TOPOLOGY = [64, 8, 10]


def rule_weight(p: int) -> float:
    """Weight at position p of the fixed check network: in [-0.25, 0.25)."""
    return p * 7919 % 1009 / 2018.0 - 0.25


def _layers_sql() -> str:
    w = "((({}) * 7919) % 1009 / 2018.0 - 0.25)"
    return f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings),
l0 AS (SELECT vec_id, unnest(x) AS a, unnest(range(0, 64)) AS j FROM e),
l1 AS (SELECT vec_id, i, 1 / (1 + exp(-(sum({w.format("j * 8 + i")} * a) + {w.format("512 + i")}))) AS a FROM l0, (SELECT unnest(range(0, 8)) AS i) GROUP BY vec_id, i),
l2 AS (SELECT vec_id, k, 1 / (1 + exp(-(sum({w.format("520 + i * 10 + k")} * a) + {w.format("600 + k")}))) AS a FROM l1, (SELECT unnest(range(0, 10)) AS k) GROUP BY vec_id, k)
SELECT vec_id, CAST(0 AS INTEGER) AS layer, CAST(64 AS INTEGER) AS n, round(list_sum(x), 6) AS total FROM e
UNION ALL SELECT vec_id, 1, CAST(count(*) AS INTEGER), round(sum(a * (i + 1)), 6) FROM l1 GROUP BY vec_id
UNION ALL SELECT vec_id, 2, CAST(count(*) AS INTEGER), round(sum(a * (k + 1)), 6) FROM l2 GROUP BY vec_id
"""


@register("mlp_layers", sql=_layers_sql())
def q_mlp_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Activations of every layer (propagate) for every embedding under fixed weights:
    the width of each layer, the sum of the input, and the sums of the others weighted
    by the unit's number."""
    e = _embeddings(spark, sf)
    model = N.MLPModel(LAYER_TOPOLOGY, np.array([rule_weight(p) for p in range(N.n_weights(LAYER_TOPOLOGY))]))
    p = model.predict(e.select("vec_id", "features"), "features", "acts", layer="all")
    rows = p.select("vec_id", F.posexplode("acts").alias("layer", "a"))
    weighted = F.aggregate(F.arrays_zip("a", F.sequence(F.lit(1), F.size("a")).alias("k")), F.lit(0.0), lambda t, x: t + x["a"] * x["k"])
    return rows.select("vec_id", "layer", F.size("a").alias("n"), F.round(F.when(F.col("layer") == 0, V.vsum("a")).otherwise(weighted), 6).alias("total"))


GROUP, PLACES = 64, 8
_ORDER = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_discount, l_tax, l_quantity"


@register("mlp_minibatch", sql=_TINY_SQL_BASE.replace("l_quantity / 50.0 AS t FROM", "l_quantity / 50.0 AS t, l_discount, l_tax, l_quantity FROM") + f""",
g AS (SELECT *, (o - t) * o * (1 - o) AS d2, (row_number() OVER (PARTITION BY l_orderkey % {PLACES} ORDER BY {_ORDER}) - 1) // {GROUP} AS grp FROM o),
g1 AS (SELECT *, d2 * 0.7 * h * (1 - h) AS d1 FROM g),
m AS (SELECT avg(d1 * x1) AS a, avg(d1 * x2) AS b, avg(d1) AS c, avg(d2 * h) AS d, avg(d2) AS e, avg(0.5 * (t - o) * (t - o)) AS loss
      FROM g1 GROUP BY l_orderkey % {PLACES}, grp)
SELECT count(*) AS n_groups, round(0.3 - 0.5 * avg(a), 8) AS w0, round(-0.2 - 0.5 * avg(b), 8) AS w1, round(0.1 - 0.5 * avg(c), 8) AS w2,
       round(0.7 - 0.5 * avg(d), 8) AS w3, round(-0.4 - 0.5 * avg(e), 8) AS w4, round(avg(loss), 8) AS loss FROM m
""")
def q_mlp_minibatch(spark: SparkSession, sf: str) -> DataFrame:
    """One step (rate 0.5) of network A from the fixed weights with the rows of each
    partition in groups of 64: every group weighs the same, also a partition's short
    last one.  Rows are dealt by the order key and sorted, so the groups are known."""
    rows = _tiny_inputs(spark, sf)
    placed = rows.repartitionById(PLACES, F.pmod("l_orderkey", F.lit(PLACES)).cast("int"))
    placed = placed.sortWithinPartitions(*LINE_ID, F.col("input")[0], F.col("input")[1], F.col("output")[0])
    loss, g, n = N.gradient_job(placed.select("input", "output"), TINY_W, TINY_TOPOLOGY, batch_size=GROUP)
    sizes = rows.groupBy(F.pmod("l_orderkey", F.lit(PLACES))).agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("g")).agg(F.sum("g")).first()[0]
    return spark.createDataFrame([(int(sizes), *[round(float(v), 8) for v in TINY_W - 0.5 * g], round(float(loss), 8))],
                                 "n_groups long, w0 double, w1 double, w2 double, w3 double, w4 double, loss double")


@register("mlp_continue", sql=_TINY_SQL_BASE + """
SELECT round(avg(0.5 * (t - o) * (t - o)), 8) AS first_loss, count(*) AS n, TRUE AS falling, TRUE AS resumed, TRUE AS gained FROM o
""")
def q_mlp_continue(spark: SparkSession, sf: str) -> DataFrame:
    """Network A from the fixed weights, stopped after 3 iterations and continued from
    the model for 5 more, in groups of 64 rows: the loss before the first iteration,
    whether it falls throughout, goes on from where it stopped, and ends lower."""
    data = cut_lineage(_tiny_inputs(spark, sf).select("input", "output"))
    start, _, n = N.gradient_job(data, TINY_W, TINY_TOPOLOGY)
    a = N.mlp_fit(data, [1], max_iter=3, tol=0.0, batch_size=GROUP, init=TINY_W)
    b = N.mlp_fit(data, [1], max_iter=5, tol=0.0, batch_size=GROUP, init=a)
    h = a.history + b.history
    return spark.createDataFrame([(round(float(start), 8), n, all(bool(y <= x + 1e-12) for x, y in zip(h, h[1:])), bool(abs(a.history[-1] - b.history[0]) < 1e-9), bool(b.history[-1] < a.history[0]))],
                                 "first_loss double, n long, falling boolean, resumed boolean, gained boolean")


@register("mlp_gd_step", sql=_TINY_SQL_BASE + """,
g AS (SELECT *, (o - t) * o * (1 - o) AS d2 FROM o),
g1 AS (SELECT *, d2 * 0.7 * h * (1 - h) AS d1 FROM g)
SELECT round(0.3 - 0.3 * avg(d1 * x1), 8) AS w11, round(-0.2 - 0.3 * avg(d1 * x2), 8) AS w12, round(0.7 - 0.3 * avg(d2 * h), 8) AS w2,
       round(0.1 - 0.3 * avg(d1), 8) AS b1, round(-0.4 - 0.3 * avg(d2), 8) AS b2, round(avg((t - o) * (t - o)), 8) AS loss
FROM g1
""")
def q_mlp_gd_step(spark: SparkSession, sf: str) -> DataFrame:
    """One step of network B (lr 0.3) from the fixed 2-1-1 weights: the step
    follows ``(o - t) * o'``, the reported loss is the unhalved square."""
    w = N.pack(N.unpack(TINY_W, TINY_TOPOLOGY, "A"), "B")
    loss, g, _ = N.gradient_job(_tiny_inputs(spark, sf).select("input", "output"), w, TINY_TOPOLOGY, "B", 1.0, grad_scale=1.0)
    vals = [round(float(v), 8) for v in w - 0.3 * g] + [round(float(loss), 8)]
    return spark.createDataFrame([tuple(vals)], "w11 double, w12 double, w2 double, b1 double, b2 double, loss double")
