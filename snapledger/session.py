"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings the operators rely on.  ANSI and AQE are on by default in Spark 4;
#: they are spelled out so that an older default cannot change a result or a plan.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Building a plan is thousands of small calls; do not record a Python stack for each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Streaming dedup state lives on local disk with changelog upload, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

#: Added unless the session is local: start with many shuffle partitions and let AQE merge
#: them to the advisory size; larger scan splits keep the number of tasks at 100 TB in bounds.
CLUSTER = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
}


def build_session(app: str = "snapledger", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the defaults above; ``extra`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    scale = {} if (master or "").startswith("local") else CLUSTER
    for key, value in {**DEFAULTS, **scale, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Hour-of-day and epoch results depend on the session zone; keep it at UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, for staged tables and checkpoints.

    It lives under ``spark.checkpoint.dir``.  Only a local-mode session, where all tasks
    share one machine, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
