"""Session settings every job relies on.

All time arithmetic is done in UTC (the reference bills by UTC day), ANSI mode is kept
on so bad casts fail loudly, and AQE is enabled so join strategies and skew splits are
decided from runtime statistics instead of guesses.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the semantics depend on. They are set on the session by
# ``ensure_conf`` so queries behave the same under a session someone else built.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# On a cluster: size post-shuffle partitions by bytes, not by core count. Start from a
# generous spark.sql.shuffle.partitions (e.g. input bytes / 128 MB) and let AQE merge
# small partitions up to ~128 MB. On one machine Spark's parallelism-first default keeps
# all cores busy instead.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
}

# The codec of tables that a job writes for itself or keeps
STORED = "zstd"

# Performance settings: applied when we build the session ourselves.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def build_session(master: str | None = None, app: str = "ledgerlight",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {**DEFAULT_CONF, **SEMANTIC_CONF}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("LEDGERLIGHT_DRIVER_MEMORY", "16g"))
    else:
        conf.update(CLUSTER_CONF)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> SparkSession:
    for k, v in SEMANTIC_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared file
    system). Only when nothing is configured (local tests) do we pick a fresh folder
    under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) "
                           "before running on a cluster")
    local = tempfile.mkdtemp(prefix="ledgerlight-ckpt-")
    sc.setCheckpointDir(local)
    return local


def hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path as that system knows it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def is_file(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def path_bytes(spark: SparkSession, path: str) -> int:
    """The size of a file, or of all files of a folder."""
    fs, p = hadoop(spark, path)
    return fs.getContentSummary(p).getLength()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files."""
    fs, p = hadoop(spark, path)
    fs.delete(p, True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """Write a catalog table bucketed and sorted by ``key``, one file a bucket, its files under the
    shared checkpoint folder. Tables of equal bucket counts join on the key without a shuffle."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("compression", STORED)
     .option("path", shared_folder(spark, table)).saveAsTable(table))
    return spark.table(table)


def default_parallelism(spark: SparkSession) -> int:
    return int(os.environ.get("LEDGERLIGHT_PARTITIONS", spark.sparkContext.defaultParallelism))


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a small, reused intermediate as parquet under the shared checkpoint folder
    and read it back: one job, lineage cut (survives executor loss), and later reads
    get column pruning, filter pushdown and file statistics. The reference
    materializes these as tables."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", STORED).parquet(path)
    return spark.read.parquet(path)
