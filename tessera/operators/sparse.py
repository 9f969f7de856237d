"""Jobs on sparse vectors: columns ``size int, indices array<int>, values array<double>``
(indices ascending, from 0), as ``sources.text.parse_libsvm`` returns them.

Only entries are ever touched: a row of ten entries in a space of ten million
dimensions costs ten.  What the absent entries stand for is corrected in the merged
sums, one row a dimension.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.session import cut_lineage

#: classes of a model that is sent to all tasks
MAX_CLASSES = 1000


def entries(df: DataFrame, *keep: str) -> DataFrame:
    """One row per entry: the columns ``keep``, ``dim`` and ``x``."""
    e = F.explode(F.arrays_zip("indices", "values")).alias("e")
    return df.select(*keep, e).select(*keep, F.col("e.indices").alias("dim"), F.col("e.values").alias("x"))


def from_counts(df: DataFrame, key: Sequence[str], dim: str, value: str, size: int) -> DataFrame:
    """Sparse rows of long-form entries (``key``, ``dim``, ``value``), one per key."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(dim).cast("int").alias("i"), F.col(value).cast("double").alias("x"))))
    return df.groupBy(*key).agg(pairs.alias("p")).select(*key, F.lit(size).alias("size"), F.col("p.i").alias("indices"), F.col("p.x").alias("values"))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def summary(df: DataFrame) -> DataFrame:
    """mean, sample variance, number of non-zeros, max and min of every dimension, in one
    pass over the entries; one row per dimension, those without entries included.

    The accumulator of a dimension holds what its entries add up to: their number, mean
    and squared deviations, which Spark merges across tasks without cancellation.  With
    k entries of n rows the n - k implicit zeros shift the mean to k m / n and add
    k (n - k) / n * m^2 to the squared deviations.  One row alone has variance 0."""
    n_rows, size = df.agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("d")).first()
    per = entries(df).groupBy("dim").agg(F.count(F.lit(1)).alias("k"), F.avg("x").alias("m"), F.var_pop("x").alias("v"),
                                          F.sum(F.when(F.col("x") != 0, 1).otherwise(0)).alias("nz"), F.max("x").alias("hi"), F.min("x").alias("lo"))
    dims = df.sparkSession.range(size or 0).select(F.col("id").cast("int").alias("dim"))
    n, k, m = F.lit(float(n_rows)), F.coalesce("k", F.lit(0)).cast("double"), F.coalesce("m", F.lit(0.0))
    squares = k * F.coalesce("v", F.lit(0.0)) + m * m * k * (n - k) / n
    with_zero = lambda f, c: F.when(F.col("k") == n, F.col(c)).otherwise(f(F.coalesce(c, F.lit(0.0)), F.lit(0.0)))
    return dims.join(per, "dim", "left").select(
        "dim", (m * k / n).alias("mean"), (squares / F.greatest(n - 1, F.lit(1.0))).alias("variance"), F.coalesce("nz", F.lit(0)).cast("long").alias("nnz"),
        with_zero(F.greatest, "hi").alias("max"), with_zero(F.least, "lo").alias("min"))


@dataclass
class SparseNaiveBayes:
    """Multinomial model: ``classes`` (label, prior, absent), one row per class, where
    ``absent`` is the log probability of a term that the class never showed; ``terms``
    (label, dim, theta) of the terms that it did."""
    classes: DataFrame
    terms: DataFrame
    size: int

    def scores(self, df: DataFrame, key: Sequence[str]) -> DataFrame:
        """(key, label, score): joint log likelihood of each row in every class.  A row's
        entries meet only the terms that a class has; the others are a multiple of
        ``absent``."""
        rare = F.broadcast(self.classes)  # at most MAX_CLASSES rows, checked by the fit
        base = df.select(*key, total(F.col("values")).alias("mass")).crossJoin(rare)
        base = base.select(*key, "label", (F.col("prior") + F.col("mass") * F.col("absent")).alias("base"))
        gain = self.terms.join(rare, "label").select("label", "dim", (F.col("theta") - F.col("absent")).alias("gain"))
        met = entries(df, *key).join(gain, "dim").groupBy(*key, "label").agg(F.sum(F.col("x") * F.col("gain")).alias("more"))
        return base.join(met, [*key, "label"], "left").select(*key, "label", (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("score"))

    def predict(self, df: DataFrame, key: Sequence[str]) -> DataFrame:
        """(key, prediction): the likeliest class; of equal ones the smallest label."""
        best = F.max(F.struct("score", (-F.col("label")).alias("low"))).alias("b")
        return self.scores(df, key).groupBy(*key).agg(best).select(*key, (-F.col("b.low")).alias("prediction"))


def fit_naive_bayes(df: DataFrame, smoothing: float = 1.0, label: str = "label") -> SparseNaiveBayes:
    """Class-term sums over the entries alone; nothing of size classes x dimensions is
    built.  Labels are numbers, values must not be negative, ``smoothing`` is positive."""
    if smoothing <= 0:
        raise ValueError("smoothing must be positive")
    rows = df.select(F.col(label).cast("double").alias("label"), "size", "indices", "values")
    bad = F.when(F.exists("values", lambda x: x < 0), F.raise_error(F.lit("negative value in a multinomial model"))).otherwise(F.lit(0))
    per = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(total(F.col("values"))).alias("mass"), F.max("size").alias("d"), F.max(bad).alias("bad"))
    per = cut_lineage(per)
    k, n, d = per.agg(F.count(F.lit(1)), F.sum("n"), F.max("d")).first()
    if k > MAX_CLASSES:
        raise ValueError(f"{k} classes; at most {MAX_CLASSES} are supported")
    if not k:
        raise ValueError("no rows to learn from")
    below = F.log(F.col("mass") + F.lit(smoothing * d))
    classes = per.select("label", (F.log(F.col("n") + F.lit(smoothing)) - F.log(F.lit(n + smoothing * k))).alias("prior"),
                         (F.log(F.lit(smoothing)) - below).alias("absent"), below.alias("below"))
    sums = entries(rows, "label").groupBy("label", "dim").agg(F.sum("x").alias("s"))
    terms = sums.join(F.broadcast(classes), "label").select("label", "dim", (F.log(F.col("s") + F.lit(smoothing)) - F.col("below")).alias("theta"))
    return SparseNaiveBayes(classes.drop("below"), cut_lineage(terms), d)
