"""Streaming regression queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.session import shared_path
from ..sources.tables import table
from ..streaming.linreg import StreamingLinearRegression, point_stream, print_batches
from .registry import register

STREAM_BATCHES = 3
STREAM_ITERATIONS, STREAM_STEP = 50, 0.1
ROWS_PER_FILE = 1_000_000
#: rows of each batch that a print shows
PRINTED = 10
INTERVAL = "500 milliseconds"
#: files of an arrival, and of a micro-batch, of the timed query
FILES = 4


def points(li: DataFrame) -> DataFrame:
    """The number of the arrival, key modulo ``STREAM_BATCHES``, and a labeled point
    ``(q/50,[10*discount,10*tax,1.0])`` of every lineitem row."""
    s = lambda c: c.cast("string")
    b = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(STREAM_BATCHES))
    return li.select(b.alias("b"), F.concat(F.lit("("), s(F.col("l_quantity") / 50.0), F.lit(",["), s(F.col("l_discount") * 10), F.lit(","),
                                            s(F.col("l_tax") * 10), F.lit(",1.0])")).alias("value"))


def folder(spark: SparkSession, name: str) -> str:
    """A new folder that a stream can watch before anything arrives."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_path(spark, name))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    return path.toString()


def move(spark: SparkSession, b: int, source: str, to: str) -> None:
    """The files of the b-th arrival go from one folder to another."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(f"{x}/b={b}") for x in (source, to))
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(old) and not fs.rename(old, new):
        raise OSError(f"{old} can't be moved to {new}")


def run_live(spark: SparkSession, sf: str, ask_first: bool, also=None) -> tuple[StreamingLinearRegression, str]:
    """A training and a prediction query that stay up while arrivals come.  All of them
    are written once; the files of each go through the two watched folders, first to
    the one that is asked first."""
    staged, train, test = shared_path(spark, "stream-staged"), folder(spark, "stream-train"), folder(spark, "stream-test")
    out = shared_path(spark, "stream-predictions")
    points(table(spark, sf, "lineitem")).write.partitionBy("b").option("maxRecordsPerFile", ROWS_PER_FILE).text(staged)
    model = StreamingLinearRegression(spark, num_features=3, step=STREAM_STEP, iterations=STREAM_ITERATIONS)
    with model.live(point_stream(spark, train), point_stream(spark, test), out, INTERVAL, also) as (training, prediction):
        for b in range(STREAM_BATCHES):
            at = staged
            for to, query in ((test, prediction), (train, training)) if ask_first else ((train, training), (test, prediction)):
                move(spark, b, at, to)
                query.processAllAvailable()
                at = to
    return model, out


def _weights_sql() -> str:
    """Replays the updates from each arrival's sums, one recursive step per iteration:
    ``d`` the points, ``e`` the weights after each version (-1: the initial ones)."""
    terms = [(a, b) for a in range(3) for b in range(a, 3)]
    sums = ", ".join([f"sum(x{a} * x{b}) / count(*) AS s{a}{b}" for a, b in terms] + [f"sum(x{a} * y) / count(*) AS t{a}" for a in range(3)])

    def grad(a):
        return " + ".join(f"s.s{min(a, b)}{max(a, b)} * w{b}" for b in range(3)) + f" - s.t{a}"
    steps = ", ".join(f"w{a} - {STREAM_STEP} / sqrt(k % {STREAM_ITERATIONS} + 1) * ({grad(a)}) AS w{a}" for a in range(3))
    return f"""
WITH RECURSIVE d AS (
  SELECT (l_orderkey + l_linenumber) % {STREAM_BATCHES} AS b, l_quantity / 50.0 AS y,
         l_discount * 10 AS x0, l_tax * 10 AS x1, 1.0::DOUBLE AS x2 FROM lineitem
), s AS MATERIALIZED (SELECT b, count(*) AS n, {sums} FROM d GROUP BY b),
w(k, w0, w1, w2) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT k + 1, {steps} FROM w JOIN s ON s.b = k // {STREAM_ITERATIONS}
), e AS (SELECT k // {STREAM_ITERATIONS} - 1 AS b, w0, w1, w2 FROM w WHERE k % {STREAM_ITERATIONS} = 0)"""


def _errors(predictions: DataFrame) -> DataFrame:
    err = F.col("prediction") - F.col("label")
    return predictions.groupBy("batch_id", "version").agg(F.count(F.lit(1)).alias("n"), F.round(F.sqrt(F.avg(err * err)), 6).alias("rmse"))


def _w() -> list:
    return [F.round(F.col("w")[i], 6).alias(f"w{i}") for i in range(3)]


_W_SQL = ", ".join(f"round(any_value(w{i}), 6) AS w{i}" for i in range(3))


@register("stream_linreg", sql=f"""{_weights_sql()}
SELECT CAST(e.b AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS n, {_W_SQL},
       round(sqrt(avg((w0 * x0 + w1 * x1 + w2 * x2 - y) ^ 2)), 6) AS rmse
FROM e JOIN d USING (b) GROUP BY e.b
""")
def q_stream_linreg(spark: SparkSession, sf: str) -> DataFrame:
    """Three arrivals, each trained on and then predicted, by two running queries.  One
    row per arrival: its rows, the weights after it and the RMSE of its predictions."""
    model, out = run_live(spark, sf, ask_first=False)
    rmse = _errors(spark.read.parquet(out)).select("batch_id", "rmse")
    return model.history().join(rmse, "batch_id").select("batch_id", "n", *_w(), "rmse")


@register("stream_predict_versions", sql=f"""{_weights_sql()}
SELECT CAST(d.b AS BIGINT) AS batch_id, CAST(d.b - 1 AS BIGINT) AS version, count(*) AS n,
       round(sqrt(avg((w0 * x0 + w1 * x1 + w2 * x2 - y) ^ 2)), 6) AS rmse
FROM d JOIN e ON e.b = d.b - 1 GROUP BY d.b
""")
def q_stream_predict_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Predict, then train: each arrival is asked of the model of the arrivals before it.
    One row per prediction batch: the version of the weights it used and its RMSE."""
    return _errors(spark.read.parquet(run_live(spark, sf, ask_first=True)[1]))


@register("stream_print", sql=f"""
SELECT CAST(b AS BIGINT) AS batch_id, CAST(b - 1 AS BIGINT) AS version, least(count(*), {PRINTED}) AS printed, least(count(*), {PRINTED}) AS exact
FROM (SELECT (l_orderkey + l_linenumber) % {STREAM_BATCHES} AS b FROM lineitem) GROUP BY b
""")
def q_stream_print(spark: SparkSession, sf: str) -> DataFrame:
    """The memory table of a print sink: the rows it shows of each prediction batch, and
    how many of them follow from the weights of their version."""
    name = f"stream_print_{uuid.uuid4().hex[:8]}"
    model, _ = run_live(spark, sf, ask_first=True, also=print_batches(spark, name, PRINTED, out=lambda text: None))
    w = model.history().select(F.col("batch_id").alias("v"), "w")
    shown = spark.table(name).join(w, F.col("version") == F.col("v"), "left")
    weights = F.coalesce("w", F.array(*[F.lit(0.0)] * 3))
    want = sum(weights[i] * F.col("features")[i] for i in range(3))
    return shown.groupBy("batch_id", "version").agg(F.count(F.lit(1)).alias("printed"), F.count_if(F.abs(want - F.col("prediction")) < 1e-9).alias("exact"))


@register("stream_timed", sql=f"""{_weights_sql()}
SELECT CAST(e.b AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS n, {_W_SQL}, {FILES} AS files FROM e JOIN d USING (b) GROUP BY e.b
""")
def q_stream_timed(spark: SparkSession, sf: str) -> DataFrame:
    """One training query over files that are all there from the start: a timed trigger,
    and so many files a micro-batch, the oldest first.  One row per micro-batch."""
    src = folder(spark, "stream-points")
    rows = points(table(spark, sf, "lineitem"))
    for b in range(STREAM_BATCHES):
        rows.where(F.col("b") == b).select("value").repartition(FILES).write.mode("append").text(src)
    model = StreamingLinearRegression(spark, num_features=3, step=STREAM_STEP, iterations=STREAM_ITERATIONS)
    query = model.train_on(point_stream(spark, src, max_files_per_trigger=FILES), processing_time=INTERVAL)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return model.history().select("batch_id", "n", *_w(), F.lit(FILES).alias("files"))
