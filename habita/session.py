"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings every session of ours wants; a cluster session keeps whatever the
# deployment already set for these keys.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # HotSpot does not JIT methods above 8000 bytes of bytecode; larger fused
    # stages run faster split up (documented setting for HotSpot JVMs)
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "habita", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. ``master`` is only for local runs and tests."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    asked = dict(extra or {})
    if shuffle_partitions:
        asked["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    # defaults give way to what the deployment has set (submit options, a running session)
    deployed = SparkContext._active_spark_context.getConf() if SparkContext._active_spark_context else SparkConf()
    for k, v in {**{k: v for k, v in DEFAULT_CONF.items() if not deployed.contains(k)}, **asked}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage (HDFS, S3, ...).
    Only a local master (tests) may leave it unset; a folder is then created.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="habita-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    # keep Dataset.checkpoint() pointed at the same shared folder
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext of a classic session (None for remote sessions)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001
        return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared folder (for sinks and checkpoints)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))
