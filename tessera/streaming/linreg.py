"""Streaming linear regression: train on one stream, predict on another.

``train_on`` runs a Structured Streaming query over a text directory of
labeled points ``(y,[x1,...,xn])``.  Each micro-batch is a DataFrame; the
update is the shared full-batch gradient trainer (least squares, step
0.1 / sqrt(i), 50 iterations by default) started from the latest weights.
Weights are written once per batch id into a table in shared storage (one
folder per batch id), so a batch that is replayed after a failure finds its
weights already written and changes nothing: the update is idempotent and
the model survives driver and executor restarts together with the
streaming checkpoint.  An empty batch leaves the weights unchanged.

``predict_on_values`` runs a second query beside the training one; its
``foreachBatch`` reads the newest weights once and writes ``(batch_id, version,
label, features, prediction)`` rows into one folder per batch id, so that a
replayed batch replaces its rows.  ``version`` is the training batch that the
weights came from (-1: the initial ones), the prediction a pure column expression
``w . x``.  ``live`` runs both until the caller is done and stops them cleanly.

``print_batches`` prints the first rows of every micro-batch, as a console does,
and keeps them in a memory table of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from ..functions import vectors as V
from ..operators.blocks import Blocks
from ..operators.gradient import descend, normal_statistics
from ..plans.session import shared_path
from ..sources.text import parse_bracket_points


def point_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``readStream.text(dir)`` parsed into ``label double, features array<double>``; files
    may also arrive in folders of their own."""
    r = spark.readStream.format("text").option("recursiveFileLookup", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_bracket_points(r.load(directory).select("value"))


class StreamingLinearRegression:
    """Online least-squares model; weights start at zeros(num_features)."""

    def __init__(self, spark: SparkSession, num_features: int, step: float = 0.1, iterations: int = 50,
                 weights_path: str | None = None, initial: Sequence[float] | None = None):
        self.spark = spark
        self.num_features = num_features
        self.step = step
        self.iterations = iterations
        self.weights_path = weights_path or shared_path(spark, "stream-weights")
        self.initial = np.zeros(num_features) if initial is None else np.asarray(initial, dtype=float)

    # ------------------------------------------------------------ weight table
    def _table(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.weights_path)
        except AnalysisException:
            return None

    def current(self, before_batch: int | None = None) -> tuple[int, np.ndarray]:
        """The newest version (the training batch it came from; -1: none) and its weights."""
        t = self._table()
        if t is None:
            return -1, self.initial.copy()
        if before_batch is not None:
            t = t.where(F.col("batch_id") < before_batch)
        row = t.orderBy(F.col("batch_id").desc()).select("batch_id", "w").first()
        return (-1, self.initial.copy()) if row is None else (row["batch_id"], np.asarray(row["w"], dtype=float))

    def latest_weights(self, before_batch: int | None = None) -> np.ndarray:
        return self.current(before_batch)[1]

    def history(self) -> DataFrame:
        t = self._table()
        if t is None:
            return self.spark.createDataFrame([], "batch_id long, n long, w array<double>")
        return t.select("batch_id", "n", "w").orderBy("batch_id")

    def _written(self, batch_id: int) -> bool:
        t = self._table()
        return t is not None and t.where(F.col("batch_id") == batch_id).limit(1).count() > 0

    # ------------------------------------------------------------ training
    def update(self, batch: DataFrame, batch_id: int) -> None:
        """foreachBatch body: idempotent per batch id."""
        if self._written(batch_id):
            return
        blocks = Blocks(batch.select(F.col("features").alias("x"), F.col("label").alias("y")), {"x": self.num_features, "y": 0})
        try:
            stats = normal_statistics(blocks, self.num_features)      # one pass serves all iterations
        finally:
            blocks.unpersist()
        n = stats[3]
        if n == 0:
            return
        w, _ = descend(stats, self.latest_weights(before_batch=batch_id), self.iterations, self.step)
        rec = self.spark.createDataFrame([(int(batch_id), int(n), [float(v) for v in w])],
                                         "batch_id long, n long, w array<double>")
        # one folder per batch id: a replayed batch overwrites the same rows
        rec.write.mode("overwrite").parquet(f"{self.weights_path}/batch={int(batch_id)}")

    def train_on(self, stream: DataFrame, checkpoint: str | None = None, processing_time: str | None = None,
                 available_now: bool = False) -> StreamingQuery:
        return start(self.spark, stream, self.update, checkpoint or shared_path(self.spark, "stream-train-ckpt"), processing_time, available_now)

    # ------------------------------------------------------------ prediction
    def predict(self, df: DataFrame, features: str = "features", out: str = "prediction") -> DataFrame:
        w = self.latest_weights()
        return df.withColumn(out, V.dot(features, V.lit_vector(w.tolist())))

    def predict_on_values(self, stream: DataFrame, output_path: str, checkpoint: str | None = None, processing_time: str | None = None,
                          available_now: bool = False, also: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
        """``also`` gets what was written of each batch, for instance ``print_batches``."""
        def fn(df: DataFrame, batch_id: int) -> None:
            version, w = self.current()
            folder = f"{output_path}/batch={int(batch_id)}"
            df.select(F.lit(int(batch_id)).cast("long").alias("batch_id"), F.lit(int(version)).cast("long").alias("version"), "label", "features",
                      V.dot("features", V.lit_vector(w.tolist())).alias("prediction")).write.mode("overwrite").parquet(folder)
            if also is not None:
                also(self.spark.read.parquet(folder), batch_id)
        return start(self.spark, stream, fn, checkpoint or shared_path(self.spark, "stream-predict-ckpt"), processing_time, available_now)

    @contextmanager
    def live(self, training: DataFrame, test: DataFrame, output_path: str, interval: str = "1 second",
             also: Callable[[DataFrame, int], None] | None = None) -> Iterator[tuple[StreamingQuery, StreamingQuery]]:
        """Training and prediction running together, a micro-batch every ``interval``; both
        finish the batch they are in and stop when the block ends."""
        queries = self.train_on(training, processing_time=interval), self.predict_on_values(test, output_path, processing_time=interval, also=also)
        try:
            yield queries
        finally:
            for q in queries:
                q.stop()


def start(spark: SparkSession, stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, processing_time: str | None = None,
          available_now: bool = False) -> StreamingQuery:
    """``fn`` for every micro-batch: all that is there and then an end (``available_now``),
    one every ``processing_time``, or one after another."""
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def print_batches(spark: SparkSession, table: str, rows: int = 10, keep: int = 100, out: Callable[[str], None] = print) -> Callable[[DataFrame, int], None]:
    """A sink that prints the first ``rows`` rows of each micro-batch under its number and
    keeps those of the last ``keep`` batches in the temporary view ``table`` (batch_id,
    then the batch's columns): at most ``rows * keep`` rows, whatever the stream holds.
    A replayed batch replaces its rows; an empty one prints its number alone."""
    held: dict[int, DataFrame] = {}

    def fn(batch: DataFrame, batch_id: int) -> None:
        first = batch.limit(rows)
        got = first.collect()  # ``rows`` rows at most
        out("\n".join([f"--- batch {batch_id}", *map(str, got)]) + (" ..." if len(got) == rows else ""))
        mine = spark.createDataFrame(got, batch.schema).withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
        held[batch_id] = mine.select("batch_id", *(c for c in batch.columns if c != "batch_id"))
        for old in sorted(held)[:-keep]:
            del held[old]
        view = None
        for b in sorted(held):
            view = held[b] if view is None else view.unionByName(held[b])
        view.createOrReplaceTempView(table)
    return fn
