"""Session construction and lineage cutting.

Iterative jobs (PageRank, transitive closure, k-means, gradient training)
cut their plan with ``DataFrame.checkpoint()`` into the reliable folder that
the cluster names in ``spark.checkpoint.dir``.  Only a single-JVM session
(unit tests, a laptop) without one gets a folder of its own; on a cluster a
missing setting is an error, because executors don't share local disks.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it if needed.

    Order: the SparkContext's folder, then ``spark.checkpoint.dir`` from the
    session conf, and only when both are unset a fresh local folder (tests).
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables, below the checkpoint dir
    (shared storage on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, keep_partitioning: bool = False) -> DataFrame:
    """Materialise ``df`` into the reliable checkpoint folder and return a
    DataFrame whose plan starts there.

    ``keep_partitioning``: the checkpointed scan reports the hash
    partitioning ``df`` was written with, so later joins / aggregations on
    those keys skip their exchange.  An adaptive plan reports no
    partitioning to the checkpoint, so this one materialisation is planned
    with AQE off (it is a plain repartition or aggregation; nothing for AQE
    to re-plan)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if not keep_partitioning:
        return df.checkpoint(eager=True)
    key = "spark.sql.adaptive.enabled"
    prev = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return df.checkpoint(eager=True)
    finally:
        spark.conf.set(key, prev)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the checkpoint folder: columns are packed
    and read one by one, at a fraction of a checkpoint's bytes."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application; workers
    on other machines, or started in another folder, import it from there."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="tessera-ship-"), "tessera.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
