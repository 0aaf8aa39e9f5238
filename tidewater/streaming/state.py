"""Streaming state as tables, and state from tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence as Seq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import work_dir


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Stateful operators of a checkpoint: ids, names, partitions, batch range."""
    return spark.read.format("state-metadata").load(checkpoint)


def read_state(
    spark: SparkSession, checkpoint: str, operator_id: int = 0, store: str | None = None, batch_id: int | None = None,
    variable: str | None = None, timers: bool = False, changes_from: int | None = None, join_side: str | None = None,
) -> DataFrame:
    """State rows (``key``, ``value``, ``partition_id``) of one operator.

    ``batch_id`` reads an earlier version, ``changes_from`` the change feed since
    a batch, ``variable`` one state variable (list, map, value) of a custom
    operator, ``timers`` its registered timers, ``join_side`` one side of a
    stream-stream join.
    """
    r = spark.read.format("statestore").option("operatorId", operator_id)
    options = {
        "storeName": store, "batchId": batch_id, "stateVarName": variable, "joinSide": join_side,
        "readRegisteredTimers": "true" if timers else None,
        "readChangeFeed": "true" if changes_from is not None else None, "changeStartBatchId": changes_from,
    }
    for k, v in options.items():
        if v is not None:
            r = r.option(k, v)
    return r.load(checkpoint)


def keyed_state(spark: SparkSession, checkpoint: str, operator_id: int = 0) -> DataFrame:
    """Key fields and value fields side by side."""
    s = read_state(spark, checkpoint, operator_id)
    taken = set(s.schema["key"].dataType.fieldNames())
    values = [F.col("value")[f].alias(f if f not in taken else f"value_{f}") for f in s.schema["value"].dataType.fieldNames()]
    return s.select("key.*", *values, "partition_id")


def timeouts(spark: SparkSession, checkpoint: str, operator_id: int = 0) -> DataFrame:
    """Timers of a groups-with-state operator: when each key times out."""
    s = read_state(spark, checkpoint, operator_id)
    return s.select("key.*", F.timestamp_millis(F.col("value.timeoutTimestamp")).alias("fires_at")).where("value.timeoutTimestamp >= 0")


def window_state(spark: SparkSession, checkpoint: str, operator_id: int = 0) -> DataFrame:
    """Contents of open windows: bounds, keys and partial aggregates."""
    s = read_state(spark, checkpoint, operator_id)
    keys = s.schema["key"].dataType.fieldNames()
    w = next(k for k in keys if k == "window" or k.startswith("session_window") or k == "w")
    rest = [F.col("key")[k].alias(k) for k in keys if k != w]
    return s.select(F.col("key")[w]["start"].alias("window_start"), F.col("key")[w]["end"].alias("window_end"), *rest, "value.*")


def bootstrap(
    rows: DataFrame, build: Callable[[DataFrame], DataFrame], mode: str = "update", sink: Callable | None = None,
) -> str:
    """Start a checkpoint whose state is that of ``build`` after ``rows``.

    The rows are fed as the first micro-batch; a query with the same ``build``
    over the returned source folder continues from it. Returns the folder that
    holds ``source`` and ``checkpoint``.
    """
    spark = rows.sparkSession
    home = work_dir(spark, "bootstrap")
    rows.write.parquet(f"{home}/source")
    feed(spark, home, build, mode, sink)
    return home


def feed(spark: SparkSession, home: str, build, mode: str = "update", sink: Callable | None = None) -> None:
    """Process what arrived in a bootstrapped query's source folder."""
    schema = spark.read.parquet(f"{home}/source").schema
    src = spark.readStream.schema(schema).parquet(f"{home}/source")
    w = build(src).writeStream.outputMode(mode).option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True)
    w = w.foreachBatch(sink) if sink else w.format("noop")
    w.start().awaitTermination()


def rewrite(
    state: DataFrame, keep: Column, to_rows: Seq[Column], build: Callable[[DataFrame], DataFrame], mode: str = "update",
) -> str:
    """New checkpoint from selected state rows: filter, turn into input rows, feed."""
    return bootstrap(state.where(keep).select(*to_rows), build, mode)


def source_positions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Source offsets per batch, from the JSON lines of the offset log."""
    lines = spark.read.option("wholetext", "true").text(f"{checkpoint}/offsets").select(
        F.regexp_extract(F.input_file_name(), r"(\d+)$", 1).cast("bigint").alias("batch"), "value")
    parts = F.split("value", "\n")
    return lines.select(
        "batch", F.get_json_object(F.element_at(parts, 2), "$.batchWatermarkMs").cast("bigint").alias("watermark_ms"),
        F.slice(parts, 3, F.size(parts)).alias("offsets"))


def shard_report(shards: DataFrame, bound: float, tasks: int, lo: str, hi: str, end: str) -> DataFrame:
    """Open shards per task: hash-range middle scaled to the task count."""
    from tidewater.operators.aggregates import hash_range_bucket

    task = hash_range_bucket(F.col(lo), F.col(hi), bound, tasks)
    return shards.where(F.col(end).isNull()).groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("shards"))
