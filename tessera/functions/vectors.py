"""Vector expressions on ``array<double>`` columns.

All are Catalyst higher-order functions (``zip_with``, ``aggregate``,
``transform``) evaluated in the JVM; no Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lit_vector(values: Sequence[float]) -> Column:
    """A driver-side vector (model-sized, e.g. a centre or weights) as a literal."""
    return F.array(*[F.lit(float(v)) for v in values])


def vsum(a) -> Column:
    return F.aggregate(_c(a), F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    """Sum of element products (arrays of equal length)."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def sqdist(a, b) -> Column:
    """Squared Euclidean distance."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                       lambda acc, x: acc + x)


def vadd(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x + y)


def vscale(a, s) -> Column:
    s = s if isinstance(s, Column) else F.lit(float(s))
    return F.transform(_c(a), lambda x: x * s)


def axpy(alpha, x, y) -> Column:
    """alpha * x + y."""
    alpha = alpha if isinstance(alpha, Column) else F.lit(float(alpha))
    return F.zip_with(_c(x), _c(y), lambda u, v: alpha * u + v)


def concat(a, b) -> Column:
    """Input ++ output vector concatenation."""
    return F.concat(_c(a), _c(b))


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))


def argmax(a) -> Column:
    """0-based index of the largest element, lowest index on ties."""
    a = _c(a)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def one_hot(idx, k: int, hi: float = 1.0, lo: float = 0.0) -> Column:
    """``k``-vector with ``hi`` at ``idx`` and ``lo`` elsewhere."""
    idx = _c(idx)
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                       lambda i: F.when(i == idx, F.lit(float(hi))).otherwise(F.lit(float(lo))))


def nearest_center(features, centers: Sequence[Sequence[float]]) -> Column:
    """Index of the closest centre (squared distance, strict ``<``: lowest
    index on ties).  Centres are literals (K x D, bounded by the model), so
    the assignment is a row-local expression: no join, no shuffle."""
    f = _c(features)
    cands = [F.struct(sqdist(f, lit_vector(c)).alias("d"), F.lit(i).alias("k"))
             for i, c in enumerate(centers)]
    return F.array_min(F.array(*cands))["k"]


def nearest_center_dist(features, centers: Sequence[Sequence[float]]) -> Column:
    f = _c(features)
    return F.array_min(F.array(*[sqdist(f, lit_vector(c)) for c in centers]))


def to_double_array(a) -> Column:
    return _c(a).cast("array<double>")
