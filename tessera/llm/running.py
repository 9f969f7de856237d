"""Running sums within groups over one range partitioning, and joins with large keys.

Rows are range-partitioned by (group, order), so a group of any size is spread over
tasks in order; each task sums its own part, and what a group's earlier parts hold
is added afterwards.  Only groups that cross a partition's end need that: at most
one for each partition, so their sums (two rows a partition) pass through the driver.

Sums are 64-bit and wrap.  Rows with equal (group, order) stay in any order, so they
should be interchangeable; ``spread`` deals very many of them over several tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textbatch import map_batches
from .written import written


def _changes(col: pa.Array) -> np.ndarray:
    """Where a row's group differs from that of the row before; the first counts."""
    out = np.ones(len(col), bool)
    if len(col) > 1:
        out[1:] = pc.not_equal(col.slice(1), col.slice(0, len(col) - 1)).to_numpy(zero_copy_only=False)
    return out


def running_sums(df: DataFrame, group: str, order: list[str], values: list[str], name: str) -> DataFrame:
    """``df``, kept in a written table, with each column of ``values`` (long, not null) replaced by its sum over the
    rows of the same ``group`` (never null) up to this one; nulls in ``order`` come first."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = F.xxhash64(F.monotonically_increasing_id())
    ranged = (df.withColumn("_spread", spread).repartitionByRange(parts, group, *order, "_spread").drop("_spread")
              .sortWithinPartitions(group, *order))
    names, at = df.columns, [df.columns.index(v) for v in values]
    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_row", T.LongType())])

    def local(batches):
        from pyspark import TaskContext
        part, row, last, carry = TaskContext.get().partitionId(), 0, None, np.zeros(len(at), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            key = b.column(names.index(group))
            new = _changes(key)
            new[0] = last is None or key[0].as_py() != last
            start = np.flatnonzero(np.append(True, new[1:]))
            size = np.diff(np.append(start, b.num_rows))
            cols = list(b.columns)
            for k, i in enumerate(at):
                x = b.column(i).to_numpy(zero_copy_only=False)
                total = np.cumsum(x)
                before = np.append(0, total)[start]
                if not new[0]:
                    before[0] -= carry[k]
                total = total - np.repeat(before, size)
                carry[k] = total[-1]
                cols[i] = pa.array(total)
            last = key[-1].as_py()
            yield pa.RecordBatch.from_arrays([*cols, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(np.arange(row, row + b.num_rows))],
                                             [*names, "_part", "_row"])
            row += b.num_rows
    rows = written(ranged.mapInArrow(local, schema), name)
    # one row a partition: its first and last group
    ends = sorted(rows.groupBy("_part").agg(F.min(group).alias("lo"), F.max(group).alias("hi")).collect(), key=lambda r: r._part)
    across = sorted({a.hi for a, b in zip(ends, ends[1:]) if a.hi == b.lo})
    if not across:
        return rows.drop("_part", "_row")
    few = spark.createDataFrame([(x,) for x in across], T.StructType([T.StructField(group, df.schema[group].dataType)]))
    sums = (rows.join(F.broadcast(few), group).groupBy("_part", group)
            .agg(F.max(F.struct("_row", *values)).alias("s")).select("_part", group, "s.*").collect())
    # what a group's earlier parts hold; at most two groups a partition
    carry: dict[int, dict] = {}
    for r in sorted(sums, key=lambda r: (r[group], r._part)):
        so_far = carry.setdefault("sum", {}).setdefault(r[group], np.zeros(len(at), np.uint64))
        carry.setdefault(r._part, {})[r[group]] = so_far.copy()
        with np.errstate(over="ignore"):
            so_far += np.array([r[v] for v in values], np.int64).view(np.uint64)
    carry.pop("sum")

    def add(b: pa.RecordBatch) -> pa.RecordBatch:
        cols, part = list(b.columns), b.column(len(names)).to_numpy()
        for p in np.unique(part).tolist():
            for g, before in carry.get(p, {}).items():
                here = (part == p) & pc.equal(b.column(names.index(group)), pa.scalar(g, b.column(names.index(group)).type)).to_numpy(zero_copy_only=False)
                for k, i in enumerate(at):
                    x = cols[i].to_numpy(zero_copy_only=False).copy()
                    x[here] += before.view(np.int64)[k]
                    cols[i] = pa.array(x)
        return pa.RecordBatch.from_arrays(cols[:len(names)], names)
    return map_batches(rows, add, df.schema)


def whole_groups(batches, key: int):
    """Tables of whole groups, one after another, from batches sorted by column ``key``."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        new = np.flatnonzero(_changes(b.column(key)))
        joins = bool(held) and held[-1].column(key)[-1].as_py() == b.column(key)[0].as_py()
        if held and not joins:
            yield pa.Table.from_batches(held)
            held = []
        cut = int(new[-1])  # the last group may go on
        if cut:
            yield pa.Table.from_batches([*held, b.slice(0, cut)])
            held = []
        held.append(b.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def lookup(left: DataFrame, on: str, right: DataFrame, key: str, value: str, large: Column) -> DataFrame:
    """``left`` with ``value`` of the row of ``right`` whose ``key`` (binary, unique) equals
    ``on``, else null.  ``large`` picks the rows of ``right`` that so many rows of ``left``
    ask for that there are fewer of them than partitions: they are broadcast, and their
    rows of ``left`` are spread over the other join under keys of their own."""
    large = F.coalesce(large, F.lit(False))
    near = right.filter(large).select(F.col(key).alias("_near"), F.col(value).alias("_value"))
    far = right.filter(~large).select(F.col(key).alias("_far"), F.col(value))
    spread = F.encode(F.xxhash64(F.monotonically_increasing_id()).cast("string"), "UTF-8")
    out = left.join(F.broadcast(near), F.col(on) == F.col("_near"), "left")
    out = out.withColumn("_key", F.when(F.col("_near").isNull(), F.col(on)).otherwise(spread))
    return out.join(far, F.col("_key") == F.col("_far"), "left").select(*left.columns, F.coalesce("_value", value).alias(value))
