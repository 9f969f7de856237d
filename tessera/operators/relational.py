"""Relational building blocks: roll-ups, skew-aware grouping, lookups, label re-indexing, class fractions.

All of them are declarative DataFrame plans: Catalyst pushes filters and
column pruning into the scans and every aggregate gets a map-side partial
aggregation before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.text import parse_access_log
from .stats import prefix_sums


def log_rollup(lines: DataFrame, col: str = "value") -> DataFrame:
    """Access-log roll-up: per (ip, user, query) the number of requests and
    the bytes served.  One group-by with partial aggregation (the mergeable
    ``(count, bytes)`` accumulator is ``count(*)``/``sum``)."""
    parsed = parse_access_log(lines, col)
    return parsed.groupBy("ip", "user", "query").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").cast("bigint").alias("bytes"))


def count_distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """``groupByKey().count()``: number of distinct keys (one row).

    Written as an aggregate, not as materialised groups: two hash aggregates
    (distinct keys, then a global count), so a hot key costs one row per
    partition, never a whole group in one task."""
    return df.select(key).distinct().agg(F.count(F.lit(1)).alias("n_keys"))


def group_sizes(df: DataFrame, key: str) -> DataFrame:
    """``(k, size of group k)`` with partial aggregation before the shuffle."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def group_sizes_salted(df: DataFrame, key: str, salt_buckets: int = 32,
                       salt_col: str | None = None) -> DataFrame:
    """Two-phase (salted) group sizes for skewed keys.

    Phase 1 groups by ``(key, salt)`` so one hot key is spread over
    ``salt_buckets`` reducers; phase 2 adds the at most ``salt_buckets``
    partial counts per key.  The salt is derived from a row column (or a
    per-row hash) so a re-executed task produces the same split."""
    salt_src = F.col(salt_col) if salt_col else F.monotonically_increasing_id()
    salted = df.select(key, F.pmod(F.xxhash64(salt_src), F.lit(salt_buckets)).alias("_salt"))
    partial = salted.groupBy(key, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    return partial.groupBy(key).agg(F.sum("_n").cast("bigint").alias("n"))


def group_payload_stats(df: DataFrame, key: str, payload: str) -> DataFrame:
    """What a ``groupByKey`` materialises per key, as mergeable aggregates:
    number of values and their total size, without building the group."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"),
                               F.sum(F.length(payload)).cast("bigint").alias("payload_bytes"))


def class_fractions(df: DataFrame, label: str) -> DataFrame:
    """``countByValue`` on a label plus each label's fraction of all rows.
    The total comes from a one-row aggregate cross-joined in (broadcast of
    a single row, size fixed at 1)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
            .select(label, "n", (F.col("n") / F.col("_total")).alias("fraction")))


def lookup_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Lookup of ``fact`` rows in ``dim``.  No hint: Spark broadcasts a side whose
    size in bytes is below its threshold, from the statistics of the plan or,
    with adaptive execution, of the finished stage, and shuffles otherwise."""
    return fact.join(dim, on, how)


def reindex_labels(df: DataFrame, label: str, out: str = "label_idx") -> DataFrame:
    """Map labels to dense 0-based indices in sorted label order, as a last
    column; the others keep their order."""
    labels = df.select(label).distinct().withColumn("_one", F.lit(1))
    # the rank of a distinct label = number of labels before it: a range-
    # partitioned prefix sum, so even a huge label set is never sorted in
    # one task
    idx = prefix_sums(labels, label, ["_one"]).select(label, F.col("_one_before").cast("int").alias(out))
    return lookup_join(df, idx, label).select(*df.columns, out)


def cardinalities(df: DataFrame, cols: list[str]) -> DataFrame:
    """Row count plus exact distinct count per column, in one job
    (``count(distinct)`` of several columns is planned as an Expand + two
    aggregates, all partial-aggregated)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.countDistinct(c).alias(f"n_{c}") for c in cols])
