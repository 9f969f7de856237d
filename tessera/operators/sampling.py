"""Sampling and splitting.

Design rules: stratified and exact samples are functions of row content and a
seed (``xxhash64``), so a re-executed task draws the same rows (``sample`` and
``random_split`` are Spark's own seeded samplers); no stratum is ever gathered
into one task; only the caller's strata and per-partition offsets (one row per
partition) are small tables.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.session import cut_lineage

_TWO53 = float(2 ** 53)
#: standard deviations between an exact sample's thresholds and its expected cut
SIGMAS = 5.0


def uniform_hash(cols: Sequence[str], seed: int) -> Column:
    """Deterministic pseudo-uniform value in [0, 1) from row content."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), F.lit(2 ** 53)).cast("double") / F.lit(_TWO53)


#: a Poisson variable of this mean or less stays below POISSON_TERMS with
#: probability 1 - 1e-30, beyond the resolution of a 53-bit uniform value
POISSON_MEAN, POISSON_TERMS = 8.0, 64


def poisson_count(mean: Column, uniform: Callable[[Column], Column]) -> Column:
    """Poisson(mean) draw for any mean: the sum of ``ceil(mean / 8)`` draws of
    mean 8 or less, each by inverse CDF (smallest k with ``u <= CDF(k)``).
    ``uniform(i)`` gives the i-th deterministic uniform value of the row."""
    parts = F.greatest(F.lit(1), F.ceil(mean / POISSON_MEAN).cast("int"))
    m = mean / parts

    def draw(i):
        init = F.struct(F.lit(0).alias("k"), F.exp(-m).alias("p"), F.exp(-m).alias("c"), uniform(i).alias("u"))

        def step(a, j):
            p = a["p"] * m / j.cast("double")
            return F.when(a["u"] > a["c"], F.struct(j.alias("k"), p.alias("p"), (a["c"] + p).alias("c"), a["u"].alias("u"))).otherwise(a)
        return F.aggregate(F.sequence(F.lit(1), F.lit(POISSON_TERMS)), init, step)["k"]
    return F.aggregate(F.sequence(F.lit(1), parts), F.lit(0), lambda acc, i: acc + draw(i))


# ---------------------------------------------------------------- A1
def sample(df: DataFrame, with_replacement: bool, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli (without) or Poisson (with replacement) sample."""
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)


# ---------------------------------------------------------------- row index
def with_row_index(df: DataFrame, out: str = "_idx") -> DataFrame:
    """Dense 0-based row index without a single-task sort: per-partition row
    counts (one row per partition) give offsets that are added to the
    partition-local position of ``monotonically_increasing_id``.  The numbered
    rows are checkpointed, so counts and positions read the same partitions."""
    m = cut_lineage(df.withColumn("_mid", F.monotonically_increasing_id()))
    m = m.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_local", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = m.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    wo = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition
    offsets = counts.select("_pid", F.coalesce(F.sum("_c").over(wo), F.lit(0)).alias("_off"))
    return (m.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + F.col("_local")).drop("_mid", "_pid", "_local", "_off"))


# ---------------------------------------------------------------- A2
def take_sample(df: DataFrame, n: int, id_cols: Sequence[str], with_replacement: bool = False,
                seed: int = 42) -> DataFrame:
    """Exactly ``min(n, N)`` rows without replacement (the ``n`` smallest row
    hashes), or exactly ``n`` draws with replacement.  ``id_cols`` identify a row."""
    one = df.withColumn("_all", F.lit(0))
    total = df.count()
    return _exact(one, "_all", [(0, total, int(n) if with_replacement else min(int(n), total))], id_cols, seed, with_replacement).select(*df.columns)


# ---------------------------------------------------------------- A3
def fraction_column(key: str, fractions: Mapping) -> Column:
    """Per-stratum fraction as a literal lookup (one entry per stratum that the
    caller names; a null stratum has the fraction of ``None``)."""
    pairs = [x for k, f in fractions.items() if k is not None for x in (F.lit(k), F.lit(float(f)))]
    named = F.coalesce(F.create_map(*pairs)[F.col(key)], F.lit(0.0)) if pairs else F.lit(0.0)
    return F.when(F.col(key).isNull(), F.lit(float(fractions.get(None, 0.0)))).otherwise(named)


def check_fractions(fractions: Mapping, with_replacement: bool) -> None:
    for k, f in fractions.items():
        if not 0 <= f or not with_replacement and f > 1:
            raise ValueError(f"fraction {f} of stratum {k!r}: must be 0 or more" + ("" if with_replacement else ", and at most 1 without replacement"))


def sample_by_key(df: DataFrame, key: str, fractions: Mapping, with_replacement: bool,
                  id_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """Approximate stratified sample: each row is kept with its stratum's
    fraction (Bernoulli), or repeated Poisson(fraction) times."""
    check_fractions(fractions, with_replacement)
    f = fraction_column(key, fractions)
    if not with_replacement:
        return df.where(uniform_hash(id_cols, seed) < f)
    k = poisson_count(f, lambda i: F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in id_cols], i), F.lit(2 ** 53)).cast("double") / F.lit(_TWO53))
    return (df.withColumn("_k", k).where(F.col("_k") > 0)
            .withColumn("_rep", F.explode(F.array_repeat(F.lit(1), F.col("_k")))).drop("_k", "_rep"))


# ---------------------------------------------------------------- A4
def stratum_targets(df: DataFrame, key: str, fractions: Mapping) -> DataFrame:
    """One row per sampled stratum (at most as many as ``fractions`` names):
    size and exact target ``ceil(f * n)``."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_f", fraction_column(key, fractions))
            .withColumn("_m", F.ceil(F.col("_f") * F.col("_n")).cast("long")).where("_m > 0"))


def sample_by_key_exact(df: DataFrame, key: str, fractions: Mapping, id_cols: Sequence[str],
                        with_replacement: bool = False, seed: int = 42, sigmas: float = SIGMAS) -> DataFrame:
    """Exact stratified sample: exactly ``ceil(f_k * n_k)`` rows of stratum k.

    Without replacement: the rows with the smallest hashes of each stratum.
    With replacement: ``m_k`` uniform draws from the stratum."""
    check_fractions(fractions, with_replacement)
    targets = stratum_targets(df, key, fractions).collect()          # one row per named stratum
    return _exact(df, key, [(r[key], int(r["_n"]), int(r["_m"])) for r in targets], id_cols, seed, with_replacement, sigmas)


def _lookup(df: DataFrame, key: str, side: DataFrame, how: str = "inner") -> DataFrame:
    """Join on ``key`` where a null matches a null; ``side`` holds ``_key``."""
    return df.join(side, df[key].eqNullSafe(side["_key"]), how).drop("_key")


def _exact(df: DataFrame, key: str, targets: Sequence[tuple[object, int, int]], id_cols: Sequence[str], seed: int,
           with_replacement: bool, sigmas: float = SIGMAS) -> DataFrame:
    """``m`` of the ``n`` rows of each stratum (key, n, m) of ``targets``, which is
    the caller's list, so what is broadcast of it is as small."""
    spark, ktype = df.sparkSession, df.schema[key].dataType.simpleString()
    if not with_replacement:
        return _smallest_hashes(df, key, targets, id_cols, seed, sigmas)[0].select(*df.columns)
    # m draws of n rows hit d distinct ones, some more than once: draw the numbers
    # first, then d rows without replacement and give them these multiplicities
    strata = spark.createDataFrame([(k, n, m) for k, n, m in targets if m and n], f"_key {ktype}, _n long, _m long")
    chunk = 100_000
    at = F.floor(F.pmod(F.xxhash64(F.lit(seed), F.col("_key"), F.col("_j"), F.lit("draw")), F.lit(2 ** 53)).cast("double") / F.lit(_TWO53) * F.col("_n")).cast("long")
    draws = (strata.withColumn("_ch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_m") - 1) / chunk).cast("long"))))
             .repartition("_key", "_ch")
             .withColumn("_j", F.explode(F.sequence(F.col("_ch") * chunk, F.least(F.col("_m"), (F.col("_ch") + 1) * chunk) - 1)))
             .groupBy("_key", at.alias("_at")).agg(F.count(F.lit(1)).alias("_times")))
    draws = cut_lineage(draws)
    distinct = {r["_key"]: r["d"] for r in draws.groupBy("_key").agg(F.count(F.lit(1)).alias("d")).collect()}
    rows, _ = _smallest_hashes(df, key, [(k, n, distinct[k]) for k, n, m in targets if k in distinct], id_cols, seed, sigmas)
    numbered = _number(rows, key).alias("r")
    often = _number(draws, "_key").select(F.col("_key"), F.col("_rank").alias("_nth"), "_times")
    hit = numbered.join(often, numbered[key].eqNullSafe(often["_key"]) & (numbered["_rank"] == often["_nth"]))
    return hit.withColumn("_rep", F.explode(F.array_repeat(F.lit(1), F.col("_times").cast("int")))).select(*df.columns)


def _number(df: DataFrame, key: str) -> DataFrame:
    """``df`` (a sample) with a dense number ``_rank`` within its stratum: the number
    within the stratum's rows of one task, after those of the tasks before."""
    m = cut_lineage(df.withColumn("_mid", F.monotonically_increasing_id())).withColumn("_pid", F.shiftright("_mid", 33))
    m = m.withColumn("_local", F.row_number().over(Window.partitionBy(key, "_pid").orderBy("_mid")) - 1)
    per = m.groupBy(key, "_pid").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)   # one row per task
    off = per.select(F.col(key).alias("_k"), F.col("_pid").alias("_p"), F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    out = m.join(off, m[key].eqNullSafe(off["_k"]) & (m["_pid"] == off["_p"]))
    return out.withColumn("_rank", F.col("_off") + F.col("_local")).select(*df.columns, "_rank")


def _smallest_hashes(df: DataFrame, key: str, targets: Sequence[tuple[object, int, int]], id_cols: Sequence[str], seed: int,
                     sigmas: float = SIGMAS) -> tuple[DataFrame, int]:
    """The ``m`` rows with the smallest hashes of each stratum, and the number of scans.

    The m-th smallest of n uniform hashes lies near m / n.  A scan accepts the rows
    ``sigmas`` standard deviations below that at once, puts those up to as far above
    on a waiting list and writes both, a sample's worth of rows.  Only the waiting
    lists, about sqrt(m) rows a stratum, are ranked for the places that are left.  Should
    a stratum have accepted too many rows or too few wait, the next scan is wider."""
    spark, ktype, full = df.sparkSession, df.schema[key].dataType.simpleString(), 2 ** 53
    base = df.withColumn("_h", F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in id_cols]), F.lit(full)))
    wanted, scans = [(k, n, m) for k, n, m in targets if m > 0], 0
    if not wanted:
        return base.limit(0), 0
    while True:
        scans += 1
        state = []
        for k, n, m in wanted:
            slack = sigmas * (math.sqrt(m) + 1)
            state.append((k, 0 if m < n and m <= slack else full if m >= n else int((m - slack) / n * full), full if m + slack >= n else int((m + slack) / n * full)))
        side = F.broadcast(spark.createDataFrame(state, f"_key {ktype}, _lo long, _hi long"))
        cand = cut_lineage(_lookup(base, key, side).where(F.col("_h") < F.col("_hi")).withColumn("_sure", F.col("_h") < F.col("_lo")).drop("_lo", "_hi"))
        got = {r[key]: (r["_a"], r["_b"]) for r in cand.groupBy(key).agg(F.count_if("_sure").alias("_a"), F.count(F.lit(1)).alias("_b")).collect()}
        left = [(k, m - got.get(k, (0, 0))[0], got.get(k, (0, 0))[1] - m) for k, n, m in wanted]
        if all(a >= 0 and b >= 0 for _, a, b in left):
            break
        sigmas = 2 * sigmas + 1
    places = F.broadcast(spark.createDataFrame([(k, a) for k, a, _ in left], f"_key {ktype}, _left long"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy("_h", *id_cols))
    waiting = _lookup(cand.where(~F.col("_sure")), key, places).withColumn("_r", rank).where(F.col("_r") <= F.col("_left"))
    return cand.where("_sure").select(*df.columns, "_h").unionByName(waiting.select(*df.columns, "_h")), scans


# ---------------------------------------------------------------- A5
def sample_report(df: DataFrame, approx: DataFrame, exact: DataFrame, key: str) -> DataFrame:
    """Per stratum: fraction of all rows in the original, the approximate and
    the exact sample (0 when a sample has no row of that stratum)."""
    def frac(d, name):
        c = d.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
        t = d.agg(F.count(F.lit(1)).alias("_t"))
        return c.crossJoin(F.broadcast(t)).select(key, (F.col("_c") / F.col("_t")).alias(name))
    return (frac(df, "original").join(frac(approx, "approx"), key, "left")
            .join(frac(exact, "exact"), key, "left")
            .select(key, "original", F.coalesce("approx", F.lit(0.0)).alias("approx"),
                    F.coalesce("exact", F.lit(0.0)).alias("exact")))


# ---------------------------------------------------------------- A6
def random_split(df: DataFrame, weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)


def hash_split(df: DataFrame, weights: Sequence[float], id_cols: Sequence[str], seed: int = 42,
               out: str = "split") -> DataFrame:
    """Reproducible split: a row's part depends only on its id columns, so
    parts are disjoint, their union is the input, and reruns agree."""
    total = float(sum(weights))
    bounds = []
    acc = 0.0
    for w in weights:
        acc += w / total
        bounds.append(acc)
    u = uniform_hash(id_cols, seed)
    expr = F.lit(len(weights) - 1)
    for i in range(len(weights) - 2, -1, -1):
        expr = F.when(u < F.lit(bounds[i]), F.lit(i)).otherwise(expr)
    return df.withColumn(out, expr.cast("int"))
