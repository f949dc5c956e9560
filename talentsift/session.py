"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Times in stored rows are UTC, so every session that runs the library must be. HotSpot never
# compiles methods above 8000 bytes, which fused JSON projections exceed; below that limit Spark splits them.
RUNTIME_CONF = {"spark.sql.session.timeZone": "UTC", "spark.sql.codegen.hugeMethodLimit": "8000"}

# Sizes stay under adaptive control: the planned partition count is only the
# upper bound that AQE coalesces from, and skewed join partitions are split.
ENGINE_CONF = {
    **RUNTIME_CONF,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def prepare(spark: SparkSession) -> None:
    """Give a session built elsewhere the time zone and the method size that the library requires."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)


def build_session(app_name: str = "talentsift", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared checkpoint directory.

    Streaming checkpoints and intermediate tables go here because any executor
    may be lost and another must still reach the files. A local session without
    the setting gets a temporary directory; a cluster without it is an error.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="talentsift-")
        spark.conf.set(CHECKPOINT_DIR, base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
