"""Model-fitting jobs: Spark ML estimators where Spark has the algorithm,
own distributed jobs where it does not (dense ALS by normal equations,
Gram-matrix SVD, closed-form checks).

Everything that comes back to the driver is model-sized (coefficients,
K x D centres, a D x D Gram matrix), never data-sized.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from .blocks import Blocks


def _vec(df: DataFrame, features: str, out: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(V.to_double_array(features)))


# ------------------------------------------------------------------ L3 / L4 / L5
def fit_logistic(df: DataFrame, reg: float = 0.1, penalty: str = "l2", max_iter: int = 100,
                 features: str = "x", label: str = "label"):
    """L-BFGS/OWL-QN logistic regression, L1 or L2, no intercept (labels 0/1)."""
    from pyspark.ml.classification import LogisticRegression
    lr = LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=1.0 if penalty == "l1" else 0.0,
                            fitIntercept=False, standardization=False, featuresCol="features", labelCol=label)
    return lr.fit(_vec(df, features))


def fit_linear_svc(df: DataFrame, reg: float = 0.1, max_iter: int = 100, features: str = "x", label: str = "label"):
    """Linear SVM with L2 regularisation (hinge loss), no intercept."""
    from pyspark.ml.classification import LinearSVC
    svc = LinearSVC(maxIter=max_iter, regParam=reg, fitIntercept=False, standardization=False,
                    featuresCol="features", labelCol=label)
    return svc.fit(_vec(df, features))


def fit_linear_regression(df: DataFrame, reg: float = 0.0, penalty: str = "l2", features: str = "x",
                          label: str = "label", intercept: bool = False):
    from pyspark.ml.regression import LinearRegression
    lr = LinearRegression(regParam=reg, elasticNetParam=1.0 if penalty == "l1" else 0.0,
                          fitIntercept=intercept, standardization=False, featuresCol="features", labelCol=label,
                          solver="normal" if (reg == 0.0 or penalty == "l2") else "auto")
    return lr.fit(_vec(df, features))


def binary_metrics(scored: DataFrame, score: str, label: str = "label") -> dict[str, float]:
    """Areas under ROC and PR from raw scores (exact: every distinct score
    is a threshold)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    d = scored.select(F.col(score).cast("double").alias("s"), F.col(label).cast("double").alias("l"))
    ev = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="l", numBins=0)
    return {"auc_roc": ev.evaluate(d, {ev.metricName: "areaUnderROC"}),
            "auc_pr": ev.evaluate(d, {ev.metricName: "areaUnderPR"})}


# ------------------------------------------------------------------ L6
def pack_als(ratings: DataFrame) -> DataFrame:
    """(user, item, rating) rows packed for one or more ``fit_als``."""
    from . import als_sums
    return als_sums.pack(ratings)


def fit_als(ratings: DataFrame, rank: int = 10, max_iter: int = 20, reg: float = 1.0, implicit: bool = False,
            seed: int = 42, less: float = 0.0):
    """ALS of (user, item, rating) rows, or of ``pack_als``, each rating lowered by
    ``less``; unknown users or items are dropped at prediction time."""
    from . import als_sums
    packed = ratings if "items" in ratings.columns else pack_als(ratings)
    return als_sums.fit(packed, rank, max_iter, reg, implicit, seed=seed, less=less)


# ------------------------------------------------------------------ L7
def _normal_equation_sums(ratings: DataFrame, factors: DataFrame, key: str, other: str, rank: int) -> DataFrame:
    """Per ``key``: upper triangle of sum f f^T, sum r f and the count, from
    ratings joined with the opposite factors on ``other``.  A hot key is
    handled by partial aggregation; only (rank^2 + rank)/2 + rank sums per
    key and partition cross the shuffle."""
    j = ratings.join(factors.select(F.col("id").alias(other), "f"), other)
    f = F.col("f")
    tri = [(a, b) for a in range(rank) for b in range(a, rank)]
    return j.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(f[a] * f[b]) for a, b in tri]).alias("ata"),
        F.array(*[F.sum(F.col("r") * f[a]) for a in range(rank)]).alias("atb"))


def _solve_batches(rank: int, lam: float):
    tri = [(a, b) for a in range(rank) for b in range(a, rank)]
    ia = np.array([t[0] for t in tri])
    ib = np.array([t[1] for t in tri])

    def solve(it):
        for pdf in it:
            if pdf.empty:
                continue
            ata = np.stack(pdf["ata"].to_numpy())
            atb = np.stack(pdf["atb"].to_numpy())
            n = pdf["n"].to_numpy().astype(float)
            G = np.zeros((len(pdf), rank, rank))
            G[:, ia, ib] = ata
            G[:, ib, ia] = ata
            A = G + (lam * n)[:, None, None] * np.eye(rank)[None]
            x = np.linalg.solve(A, atb[..., None])[..., 0]
            yield pd.DataFrame({"id": pdf["id"].to_numpy(), "f": list(x), "n": n.astype("int64")})
    return solve


def als_half_step(ratings: DataFrame, fixed: DataFrame, key: str, other: str, rank: int, lam: float) -> DataFrame:
    """Solve ``(F^T F + lam * n * I) x = F^T r`` for every ``key`` entity with
    the opposite factors ``fixed`` held constant.  The normal equations are
    built by aggregation; the K-sized solves run vectorised in numpy over
    Arrow batches of the (one row per entity) sums.  Output ``(id, f, n)``:
    ``n`` ratings of the entity."""
    sums = _normal_equation_sums(ratings, fixed, key, other, rank).withColumnRenamed(key, "id")
    return sums.mapInPandas(_solve_batches(rank, lam), schema="id long, f array<double>, n long")


def init_factors(ids: DataFrame, id_col: str, rank: int, seed: int) -> DataFrame:
    """Uniform [0, 1) factors from a hash of (seed, id, k): reproducible."""
    return ids.select(F.col(id_col).cast("long").alias("id"), F.array(*[
        F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.lit(k)), F.lit(1 << 30)).cast("double") / float(1 << 30)
        for k in range(rank)]).alias("f"))


def als_rmse(ratings: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    j = (ratings.join(items.select(F.col("id").alias("i"), F.col("f").alias("fi")), "i")
         .join(users.select(F.col("id").alias("j"), F.col("f").alias("fj")), "j"))
    err = V.dot("fi", "fj") - F.col("r")
    return j.agg(F.sqrt(F.avg(err * err)).alias("rmse"))


def als_dense(ratings: DataFrame, rank: int = 10, iterations: int = 5, lam: float = 0.01, seed: int = 42, blocks: int | None = None):
    """Alternating least squares on ``(i, j, r)``: items first, then users with
    the NEW item factors; RMSE after every iteration, from direct residuals.
    Ratings are packed into blocks of items once and stay there; the users' factors
    and the sums of their normal equations travel, never through the driver.
    Returns ``(items, users, [rmse per iteration])``."""
    from . import als_sums
    users = init_factors(ratings.select("j").distinct(), "j", rank, seed)
    rows = ratings.select(F.col("j").alias("user"), F.col("i").alias("item"), F.col("r").alias("rating"))
    users, items, hist = als_sums.fit_exact(rows, users, rank, iterations, lam, blocks or als_sums.BLOCKS)
    return items, users, hist


# ------------------------------------------------------------------ L9
_ALGOS = {"classification": {"gini", "entropy"}, "regression": {"variance"}}


def fit_decision_tree(df: DataFrame, algo: str, impurity: str, max_depth: int = 4, max_bins: int = 100,
                      features: str = "x", label: str = "label", seed: int = 42):
    """Decision tree with continuous features; an impurity that does not fit
    the algorithm is rejected up front."""
    if algo not in _ALGOS:
        raise ValueError(f"unknown algorithm {algo!r}")
    if impurity not in _ALGOS[algo]:
        raise ValueError(f"impurity {impurity!r} does not fit {algo}")
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.regression import DecisionTreeRegressor
    cls = DecisionTreeClassifier if algo == "classification" else DecisionTreeRegressor
    est = cls(maxDepth=max_depth, maxBins=max_bins, impurity=impurity, featuresCol="features", labelCol=label, seed=seed)
    return est.fit(_vec(df, features))


# ------------------------------------------------------------------ L10
def fit_naive_bayes(df: DataFrame, smoothing: float = 1.0, features: str = "x", label: str = "label"):
    """Multinomial naive Bayes (features must be non-negative)."""
    from pyspark.ml.classification import NaiveBayes
    return NaiveBayes(smoothing=smoothing, modelType="multinomial", featuresCol="features",
                      labelCol=label).fit(_vec(df, features))


# ------------------------------------------------------------------ L11 / L12
def fit_pca(df: DataFrame, k: int | None = None, features: str = "x"):
    """All (or ``k``) principal components of a tall matrix (Spark ML PCA)."""
    from pyspark.ml.feature import PCA
    from .clustering import vector_dims
    k = k or vector_dims(df, features)
    return PCA(k=k, inputCol="features", outputCol="pca").fit(_vec(df, features))


def gram_matrix(df: DataFrame, features: str = "x") -> np.ndarray:
    """X^T X of a tall matrix: one pass over the packed rows, one D x D partial
    per task, added in a tree; only D x D numbers reach the driver."""
    from .clustering import vector_dims
    d = vector_dims(df, features)
    blocks = Blocks(df, {features: d})

    def task(ms):
        out = np.zeros((d, d))
        for (x,) in ms:
            out += x.T @ x
        return out.ravel()
    try:
        return blocks.sums(task).reshape(d, d)
    finally:
        blocks.unpersist()


def tall_r(df: DataFrame, features: str = "x") -> np.ndarray:
    """R of a QR factorisation of a tall matrix: a task factors its rows block by block,
    keeping one D x D triangle, and the triangles of all tasks are stacked and factored
    in a tree.  Unlike the Gram matrix, R keeps the condition number of the data."""
    from .clustering import vector_dims
    d = vector_dims(df, features)
    blocks = Blocks(df, {features: d})

    def factor(upper: np.ndarray, rows: np.ndarray) -> np.ndarray:
        r = np.linalg.qr(np.vstack([upper, rows]), mode="r")
        return np.vstack([r, np.zeros((d - len(r), d))])

    def task(ms):
        r = np.zeros((d, d))
        for (x,) in ms:
            r = factor(r, x)
        return r.ravel()
    try:
        r = blocks.merged(task, lambda a, b: factor(a.reshape(d, d), b.reshape(d, d)).ravel())
        return np.asarray(r).reshape(d, d)
    finally:
        blocks.unpersist()


def singular_values(df: DataFrame, features: str = "x") -> np.ndarray:
    """All singular values of the tall matrix, descending (U not computed): those of
    its triangle, correct relative to the largest to about rounding."""
    return np.linalg.svd(tall_r(df, features), compute_uv=False)


def sign_normalise(vectors: np.ndarray) -> np.ndarray:
    """Flip each column so its largest-magnitude entry is positive."""
    v = np.array(vectors, dtype=float)
    for c in range(v.shape[1]):
        i = int(np.argmax(np.abs(v[:, c])))
        if v[i, c] < 0:
            v[:, c] = -v[:, c]
    return v
