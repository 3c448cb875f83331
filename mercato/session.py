"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine relies on; a cluster's own values for sizes are left alone.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffles begin in many small parts, which are joined up by size: a task then holds no more for six times the input.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Python tasks take rows of long texts in small batches; the defaults hold tens of MB on either side.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16777216",
    # Window, session and duplicate state may outgrow executor memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Sessions of one key are joined up inside each task before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("mercato")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_engine_conf(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings results depend on (UTC days, ANSI casts, AQE)."""
    for key, value in ENGINE_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a session in local mode that names none, as in tests, gets a temporary folder, the same
    one for as long as it lives.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.master.startswith("local") and not context.master.startswith("local-cluster"):
        if not context.getCheckpointDir():
            context.setCheckpointDir(tempfile.mkdtemp(prefix="mercato-"))
        return context.getCheckpointDir().rstrip("/")
    raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/mercato/{label}-{uuid.uuid4().hex}"
