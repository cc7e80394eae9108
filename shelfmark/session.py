"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    # Python-like reading of repeated JSON keys: the later one wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A union of two joins on one key would count as partitioned by it, and a grouping above have no
    # exchange: that gave wrong rows under the adaptive plan (q_lookup_index). So unions are dealt out anew.
    "spark.sql.unionOutputPartitioning": "false",
    # A base has many small folders: a listing task takes some of them, not one (by default 10,000 tasks).
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options the operators rely on."""
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="shelfmark-"))
    return context.getCheckpointDir()


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: one computation, many readers."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` through the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def spread(df: DataFrame) -> DataFrame:
    """Rebalance a scan that has fewer partitions than the session has cores.

    Unsplittable inputs (one gzip, one row group) would leave most cores idle in front of
    the CPU-heavy JSON work. Scans that already fill the cores are returned unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df
