"""Seeded data generators.

Generators that decorate an existing table (``df`` argument) draw one value
per input row, so their size follows the table; the rest build fixtures
from ``spark.range`` with an explicit partition count (the "slices" /
"mappers" of the original jobs).  All randomness is seeded.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INT_MAX = 2147483647  # fixed value: upper bound (exclusive) of generated int keys


def normal(df: DataFrame, seed: int = 42, out: str = "x") -> DataFrame:
    """G1: one N(0, 1) draw per row."""
    return df.withColumn(out, F.randn(seed))


def normal_vectors(df: DataFrame, dims: int = 2, seed: int = 42, out: str = "v") -> DataFrame:
    """One vector of ``dims`` independent N(0, 1) draws per row."""
    return df.withColumn(out, F.array(*[F.randn(seed + 7919 * i) for i in range(dims)]))


def random_bytes(seed_cols: list[Column], size: int) -> Column:
    """``size`` pseudo-random bytes derived from row content (re-executions
    give the same payload)."""
    blocks = max(1, math.ceil(size / 32))
    hexes = [F.sha2(F.concat_ws("|", F.lit(i), *[c.cast("string") for c in seed_cols]), 256) for i in range(blocks)]
    return F.unhex(F.substring(F.concat(*hexes), 1, 2 * size))


def kv_uniform(df: DataFrame, val_size: int = 100, seed: int = 42) -> DataFrame:
    """Per row a key uniform in [0, INT_MAX) and a ``val_size``-byte payload."""
    key = F.floor(F.rand(seed) * INT_MAX).cast("int")
    return df.select(key.alias("key"), random_bytes([F.monotonically_increasing_id(), F.lit(seed)], val_size).alias("payload"))


def ramp_counts(spark: SparkSession, mappers: int, pairs: int) -> DataFrame:
    """Rows per mapper of the linearly skewed generator:
    ``int((p + 1) / mappers * pairs)`` for mapper p."""
    p = F.col("id")
    return spark.range(mappers).select(p.cast("int").alias("mapper"),
                                       F.floor((p + 1) / F.lit(float(mappers)) * F.lit(pairs)).cast("long").alias("n"))


# rows one generating task produces at most
RAMP_CHUNK_ROWS = 1_000_000


def kv_ramp(spark: SparkSession, mappers: int, pairs: int, val_size: int = 100, seed: int = 42) -> DataFrame:
    """Mapper p emits ``int((p+1)/mappers * pairs)`` uniform pairs.

    The skew is in the ``mapper`` label, not in the tasks: each mapper's rows
    are cut into chunks of at most ``RAMP_CHUNK_ROWS`` that are generated by
    separate tasks.  Key and payload are hashes of ``(seed, mapper, i)``, so
    a re-executed task produces the same rows."""
    counts = ramp_counts(spark, mappers, pairs).where(F.col("n") > 0)
    chunks = counts.select("mapper", "n", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("n") - 1) / RAMP_CHUNK_ROWS).cast("long"))).alias("chunk"))
    n_tasks = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), mappers * (pairs // RAMP_CHUNK_ROWS + 1)))
    rows = chunks.repartition(n_tasks, "mapper", "chunk").select("mapper", F.explode(F.sequence(
        F.col("chunk") * RAMP_CHUNK_ROWS + 1, F.least(F.col("n"), (F.col("chunk") + 1) * RAMP_CHUNK_ROWS))).alias("i"))
    key = F.pmod(F.xxhash64(F.lit(seed), F.col("mapper"), F.col("i"), F.lit("key")), F.lit(INT_MAX)).cast("int")
    return rows.select("mapper", key.alias("key"), random_bytes([F.col("mapper"), F.col("i"), F.lit(seed)], val_size).alias("payload"))


def kv_hotkey(df: DataFrame, reducers: int, ratio: float = 5.0, seed: int = 42) -> DataFrame:
    """Per row a key whose reducer (key mod R) is 0 with probability
    ``ratio / (R + ratio - 1)``; other reducers uniformly.  R = 1 puts every
    key on reducer 0."""
    offset = F.floor(F.rand(seed) * 1000).cast("int") * F.lit(reducers)
    if reducers <= 1:
        key = offset
    else:
        hot = F.rand(seed + 1) < F.lit(ratio / (reducers + ratio - 1))
        key = F.when(hot, offset).otherwise(offset + 1 + F.floor(F.rand(seed + 2) * (reducers - 1)).cast("int"))
    return df.withColumn("key", key.cast("int"))


def labeled_gaussian(spark: SparkSession, n: int = 10000, dims: int = 10, shift: float = 0.7,
                     seed: int = 42, slices: int = 2) -> DataFrame:
    """Row i has y = -1 (i even) or +1 (i odd), x_d = N(0,1) + shift*y."""
    y = F.when(F.col("id") % 2 == 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    base = spark.range(0, n, numPartitions=slices).withColumn("y", y)
    return base.select("id", "y", F.array(*[F.randn(seed + i) + F.lit(shift) * F.col("y") for i in range(dims)]).alias("x"))


def random_graph(spark: SparkSession, edges: int = 200, vertices: int = 100, seed: int = 42) -> DataFrame:
    """``edges`` distinct directed edges on ``vertices`` vertices, no
    self-loops (candidates from hashes; the first ``edges`` distinct ones by
    hash order are kept, so the count is exact)."""
    cand = spark.range(0, edges * 8).select(
        F.pmod(F.xxhash64(F.lit(seed), F.col("id"), F.lit(1)), F.lit(vertices)).cast("int").alias("src"),
        F.pmod(F.xxhash64(F.lit(seed), F.col("id"), F.lit(2)), F.lit(vertices)).cast("int").alias("dst"))
    d = cand.where(F.col("src") != F.col("dst")).distinct()
    return d.orderBy(F.xxhash64(F.lit(seed), "src", "dst"), "src", "dst").limit(edges)


def uniform_factors(spark: SparkSession, n: int, rank: int, seed: int, name: str = "i") -> DataFrame:
    return spark.range(n).select(F.col("id").cast("int").alias(name),
                                 F.array(*[F.rand(seed + 31 * k) for k in range(rank)]).alias("f"))


def low_rank_ratings(spark: SparkSession, m: int = 100, u: int = 500, rank: int = 10, seed: int = 42) -> DataFrame:
    """Dense M x U matrix R = A B^T with uniform factors, long format
    ``(i, j, r)``.  Cells come from ``range(M*U)`` joined to the factor
    tables on their ids (equi-joins, no cartesian product)."""
    a = uniform_factors(spark, m, rank, seed, "i").withColumnRenamed("f", "a")
    b = uniform_factors(spark, u, rank, seed + 1, "j").withColumnRenamed("f", "b")
    cells = spark.range(m * u).select((F.col("id") / u).cast("int").alias("i"), (F.col("id") % u).cast("int").alias("j"))
    dot = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return cells.join(a, "i").join(b, "j").select("i", "j", dot.alias("r"))


def target_function(x: Column) -> Column:
    """G9 target: 0.5 + 0.15 * int(|x/5|) + 0.1 * sin(pi x / 10)."""
    return F.lit(0.5) + F.lit(0.15) * F.floor(F.abs(x / 5)) + F.lit(0.1) * F.sin(F.lit(math.pi) * x / 10)


def function_samples(spark: SparkSession, n: int = 100, xmin: float = -10.0, xmax: float = 10.0,
                     seed: int = 42) -> DataFrame:
    """``(input array<double>(1), output array<double>(1))`` samples of
    the target on [xmin, xmax]; raises if an output exceeds 1."""
    x = F.lit(xmin) + F.rand(seed) * F.lit(xmax - xmin)
    df = spark.range(n).select(x.alias("x"))
    y = target_function(F.col("x"))
    checked = F.when(y <= 1.0, y).otherwise(F.raise_error(F.lit("target above 1")))
    return df.select(F.array("x").alias("input"), F.array(checked).alias("output"))


def unit_square_points(spark: SparkSession, slices: int, per_slice: int = 100000, seed: int = 42) -> DataFrame:
    """K3 input: ``slices * per_slice`` uniform points in [-1, 1]^2."""
    return spark.range(0, slices * per_slice, numPartitions=slices).select(
        (F.rand(seed) * 2 - 1).alias("x"), (F.rand(seed + 1) * 2 - 1).alias("y"))
