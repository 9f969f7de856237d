"""Column statistics, correlation and evaluation metrics.

Each statistic is one aggregation job with partial aggregation; nothing is
collected except model-sized results (one row, or one row per class).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.session import cut_lineage


def column_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """mean, sample variance, number of non-zeros, max and min of every
    column, computed in ONE pass, returned long: one row per column."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.var_samp(x).alias(f"{c}__variance"),
                 F.sum(F.when(x != 0, 1).otherwise(0)).cast("bigint").alias(f"{c}__nnz"),
                 F.max(x).alias(f"{c}__max"), F.min(x).alias(f"{c}__min")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__mean`, `{c}__variance`, `{c}__nnz`, `{c}__max`, `{c}__min`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (`column`, mean, variance, nnz, max, min)")


def vector_summary(df: DataFrame, vec: str) -> DataFrame:
    """Per-dimension summary of an ``array<double>`` column (implicit zeros
    of sparse data count as values), long format ``(dim, mean, variance,
    nnz, max, min)``; posexplode + one grouped aggregation."""
    ex = df.select(F.posexplode(vec).alias("dim", "x"))
    return ex.groupBy("dim").agg(F.avg("x").alias("mean"), F.var_samp("x").alias("variance"),
                                 F.sum(F.when(F.col("x") != 0, 1).otherwise(0)).cast("bigint").alias("nnz"),
                                 F.max("x").alias("max"), F.min("x").alias("min"))


def label_correlations(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Pearson correlation of the label with every feature in one pass."""
    wide = df.agg(*[F.corr(F.col(label).cast("double"), F.col(f).cast("double")).alias(f) for f in features])
    stack = ", ".join(f"'{f}', `{f}`" for f in features)
    return wide.selectExpr(f"stack({len(features)}, {stack}) AS (feature, corr)")


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """correct / total."""
    hit = (F.col(prediction) == F.col(label)).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(hit).cast("bigint").alias("correct"),
                  F.avg(hit).alias("accuracy"))


def rmse(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    err = F.col(prediction) - F.col(label)
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(err * err).alias("mse"),
                  F.sqrt(F.avg(err * err)).alias("rmse"))


def prefix_sums(df: DataFrame, order_col: str, value_cols: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Exclusive running sums of ``value_cols`` in ``order_col`` order
    (``order_col`` unique), computed without a single-task global window:
    range-partition, sum each partition (one row per partition), turn those
    few rows into offsets, then a window per range partition.

    The range-partitioned rows are checkpointed with their partition number:
    range bounds are sampled anew each time a plan is evaluated, so totals and
    local sums must both read the one partitioning that was written."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(n, order_col).withColumn("_pid", F.spark_partition_id()))
    per_part = ranged.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in value_cols])
    # one row per range partition: a bounded table, so a global window is fine
    wo = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_pid", *[F.coalesce(F.sum(f"_t_{c}").over(wo), F.lit(0)).alias(f"_o_{c}")
                                        for c in value_cols])
    wl = Window.partitionBy("_pid").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select("*", *[F.coalesce(F.sum(c).over(wl), F.lit(0)).alias(f"_l_{c}") for c in value_cols])
    out = local.join(F.broadcast(offsets), "_pid")
    return out.select(*df.columns, *[(F.col(f"_o_{c}") + F.col(f"_l_{c}")).alias(f"{c}_before")
                                     for c in value_cols])


def auc_roc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Exact area under the ROC curve (ties count one half):
    ``sum over positives of (#negatives scored lower + 0.5 #negatives tied)
    / (P * N)``.  Scores are first reduced to one row per distinct score
    (partial aggregation, skew-safe), then a distributed prefix sum gives
    the negatives below each score."""
    pos = (F.col(label) > 0).cast("bigint")
    g = df.groupBy(F.col(score).alias("s")).agg(F.sum(pos).alias("p"),
                                                 F.sum(F.lit(1) - pos).alias("q"))
    ps = prefix_sums(g, "s", ["q"])
    return ps.agg((F.sum(F.col("p") * (F.col("q_before") + F.col("q") * 0.5))
                   / (F.sum("p") * F.sum("q"))).alias("auc"),
                  F.sum("p").alias("n_pos"), F.sum("q").alias("n_neg"))


def group_mean_vectors(df: DataFrame, key: str, vec: str, out: str = "mean") -> DataFrame:
    """Element-wise mean vector per key: one pass with a vector accumulator per
    key and task, merged after the shuffle; rows are never multiplied by D."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    v = df.select(key, array_to_vector(F.col(vec).cast("array<double>")).alias("_v"))
    return v.groupBy(key).agg(Summarizer.mean(F.col("_v")).alias("_m")).select(key, vector_to_array("_m").alias(out))


def pr_area(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Exact area under the precision-recall curve: every distinct score is a
    threshold, trapezoids between neighbouring points, and the curve starts at
    recall 0 with the first point's precision.  Same plan as ``auc_roc``; a
    point's predecessor follows from the running sums of its own row."""
    pos = (F.col(label) > 0).cast("bigint")
    g = df.groupBy((-F.col(score)).alias("s")).agg(F.sum(pos).alias("p"), F.sum(F.lit(1) - pos).alias("q"))
    ps = prefix_sums(g, "s", ["p", "q"])
    tp0, fp0, tp, fp = F.col("p_before"), F.col("q_before"), F.col("p_before") + F.col("p"), F.col("q_before") + F.col("q")
    now = tp / (tp + fp)
    before = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(now)
    return ps.agg((F.sum(F.col("p") * (now + before) / 2) / F.sum("p")).alias("auc_pr"),
                  F.sum("p").alias("n_pos"), F.sum("q").alias("n_neg"))
