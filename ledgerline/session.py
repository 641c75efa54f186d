"""SparkSession settings and the shared work folder.

Everything here is plain Spark configuration. The settings that change
results are pinned: ANSI mode on, UTC session time zone, NTZ timestamps
kept as they are read from Parquet. AQE is on so that shuffle partition
counts, join strategies and skewed partitions are re-planned at run time.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of the library should carry. Sizes are for a
# large cluster; local runs override the partition count.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Extra settings for a large cluster: many initial shuffle partitions that
# AQE coalesces to ~128 MB each, and skew splitting even when it costs an
# extra shuffle.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(master: str | None = None, app: str = "ledgerline",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, cluster: bool = False) -> SparkSession:
    """Create (or fetch) a session with the library's settings
    (``cluster=True`` adds the large-cluster profile)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (HDFS / object store path)
    and is read, never replaced. If only the context has a checkpoint folder
    (``setCheckpointDir``), that one is used. Without either, a session whose
    tasks all run in this process (master ``local``) gets a temporary folder;
    anywhere else that is an error, since executors would not share it.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared folder (one per call, never reused)."""
    base = shared_dir(spark)
    return "/".join([base, "ledgerline", *parts, uuid.uuid4().hex])


# Hadoop's names of a store that pyarrow knows by another one.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def arrow_file_system(uri: str):
    """(pyarrow file system, path) of a folder that Spark names by ``uri``, for tasks that write
    files of their own."""
    import pyarrow.fs

    scheme, sep, rest = uri.partition("://")
    return pyarrow.fs.FileSystem.from_uri(f"{ARROW_SCHEMES.get(scheme, scheme)}{sep}{rest}")


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python helpers can list local test dirs."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return path
