"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults for a batch job. Everything here can be overridden by spark-submit;
# the cluster's own spark.checkpoint.dir is never touched.
BATCH_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even when a later operator then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "lumenrec", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the batch settings above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BATCH_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates and streaming checkpoints.

    A cluster names it in ``spark.checkpoint.dir``. Only a local-mode session may
    fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="lumenrec-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


# Folders made by this process, so that a caller can give their space back.
_MADE: list[str] = []


def new_scratch(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder path of the shared folder (not created yet)."""
    path = os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")
    _MADE.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove all scratch folders of this process, once their results have been used; their number.

    Frames that still read from them fail afterwards.
    """
    hadoop = spark._jsc.hadoopConfiguration()
    gone = 0
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        gone += bool(path.getFileSystem(hadoop).delete(path, True))
    return gone


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several later steps read, and read it back.

    The table lies in the shared folder, so a lost executor costs no recomputation.
    """
    path = new_scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Shuffle a scan that has fewer splits than the session has cores.

    For CPU-heavy work on small inputs; only for a plain scan, whose splits are known
    without running anything. A scan with enough splits, as any large table has, is
    returned unchanged.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)
