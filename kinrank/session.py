"""Session helpers: a tuned SparkSession for local runs and written
intermediates in the cluster's ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings the operators rely on. AQE re-plans joins with runtime
# sizes (a broadcast only after the build side is measured) and splits skewed
# shuffle partitions; nothing here is specific to local mode.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # readers rely on casts that fail on bad input
    "spark.sql.ansi.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "kinrank", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster's ``spark.checkpoint.dir`` is used as is. Only a session whose
    executors share the driver's machine (a ``local`` master, as in tests) may
    leave it unset; then a folder under the system's temporary one is made. On
    any other master an unset folder is an error: executors would write to
    disks that nobody else can read.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        require_local_master(sc.master)
        configured = tempfile.mkdtemp(prefix="kinrank-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def require_local_master(master: str) -> None:
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for written intermediates, inside the
    checkpoint folder. It is deleted when the application ends, and its
    contents whenever ``clear_scratch`` is called."""
    root = os.path.join(ensure_checkpoint_dir(spark), f"kinrank-{spark.sparkContext.applicationId}")
    path, fs = _hadoop(spark, root)
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate (shared storage on a cluster)."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def clear_scratch(spark: SparkSession) -> None:
    """Delete what queries have written so far. Call it once their results
    have been used: frames that still read an intermediate fail afterwards."""
    path, fs = _hadoop(spark, scratch_root(spark))
    for entry in fs.listStatus(path):
        fs.delete(entry.getPath(), True)


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df`` where one intermediate feeds several
    branches of a plan (otherwise every branch recomputes it up to the shared
    shuffle): write it as parquet into the shared checkpoint folder and read
    it back. The files survive executor loss (never a local checkpoint), later
    branches read only the columns that they use, and the folder goes with the
    application or with ``clear_scratch``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
