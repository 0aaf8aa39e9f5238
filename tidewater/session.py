"""Session defaults, table loading and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tidewater

# Settings that change results or the shape of plans. Sizes (shuffle
# partitions, memory) stay with whoever starts the session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # JSON objects with a repeated name are JSON; the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Rows of whole texts: a Python worker holds a few MB of them at once.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # Row groups of whole texts wait in memory until they are written, one per task.
    "parquet.block.size": str(32 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the operators rely on."""
    # Functions travel with their code, so executors need no copy of the package.
    cloudpickle.register_pickle_by_value(tidewater)
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", app: str = "tidewater", memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        # No call-site capture per Column call; it slows building large plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; columns and filters are pruned by the parquet scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``ts`` as an instant, the only type watermarks accept."""
    return load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for streaming checkpoints and sinks.

    A cluster names its shared folder in ``spark.checkpoint.dir``. Where it is
    unset only a local session may fall back to a machine-local folder, since
    executors elsewhere could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex[:12]}")


