"""Tables written to the shared folder, and components of a graph of links."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.session import shared_path


#: folders written by the running pipeline stage (None outside one) and by those before
_NOTES: list[str] | None = None
_LAST: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back, so that
    later jobs start from files and survive lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    if _NOTES is not None:
        _NOTES.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete written folders through the file system that holds them."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(hadoop).delete(path, True)


def _modified(spark: SparkSession, path) -> int:
    """When a folder changed last, by the file system that holds it; 0 if it's gone."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(path))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(path).getModificationTime() if fs.exists(path) else 0


def _follows(docs: DataFrame, paths: list[str]) -> bool:
    """Whether ``docs`` is a table whose files are younger than all of ``paths``: what
    was made with these has then been written."""
    plan = docs._jdf.queryExecution().analyzed()
    if not paths or plan.getClass().getSimpleName() != "LogicalRelation":
        return False
    roots = plan.relation().location().rootPaths()
    young = min(_modified(docs.sparkSession, roots.apply(i).toString()) for i in range(roots.size()))
    return young >= max(_modified(docs.sparkSession, p) for p in paths)


@contextmanager
def stage_tables(docs: DataFrame):
    """Around the body of a pipeline stage: notes what it writes.  Where the input is a
    table written after the tables of the stages before, these go first; a stage that
    is called on an older table leaves them alone."""
    global _NOTES, _LAST
    if _follows(docs, _LAST):
        discard(docs.sparkSession, _LAST)
        _LAST = []
    _NOTES = []
    try:
        yield
    finally:
        _LAST, _NOTES = _LAST + _NOTES, None


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) for the ids of ``edges`` (a, b): the smallest id
    reachable.  Smallest neighbour labels and pointer jumping, each round
    written; the number of rounds grows with the logarithm of the diameter."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), name + "-edges")
    lab = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component")), name)
    old = lab.written_to
    while True:
        # the label of each neighbour, then the label's own label
        near = (both.join(lab, both.b == lab.id).groupBy("a").agg(F.min("component").alias("m")))
        new = lab.join(near, lab.id == near.a).select("id", F.least("component", "m").alias("c"), F.col("component").alias("old"))
        jump = lab.select(F.col("id").alias("c"), F.col("component").alias("cc"))
        new = written(new.join(jump, "c").select("id", F.least("c", "cc").alias("component"), (F.least("c", "cc") != F.col("old")).alias("moved")), name)
        discard(new.sparkSession, [old])
        lab, old = new.select("id", "component"), new.written_to
        if not new.filter("moved").limit(1).count():
            return lab
