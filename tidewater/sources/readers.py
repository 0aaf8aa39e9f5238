"""Sources: literals, text, delimited lines, generated rows, message queues."""

from __future__ import annotations

from collections.abc import Sequence as Seq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.json import from_lenient


def collection(spark: SparkSession, rows: Seq, schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def text_lines(spark: SparkSession, paths: Seq[str] | str) -> DataFrame:
    """One row per line, of one path or of several."""
    return spark.read.text([paths] if isinstance(paths, str) else list(paths))


def stream_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of files as they arrive; stands in for a line socket."""
    return spark.readStream.text(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Line socket of the user's own; for trying out, it cannot be replayed."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def delimited(lines: DataFrame, schema: T.StructType, sep: str = ",", seconds: Seq[str] = ()) -> DataFrame:
    """Typed fields of delimited lines; fields that do not parse, or are not
    there, are NULL. ``seconds`` columns hold epoch seconds and become instants."""
    # The separator is literal text, not a pattern.
    parts = F.split("value", "\\Q" + sep + "\\E")
    out = []
    for i, f in enumerate(schema.fields):
        raw = F.trim(F.try_element_at(parts, F.lit(i + 1)))
        if f.name in seconds:
            out.append(F.timestamp_seconds(raw.try_cast("bigint")).alias(f.name))
        else:
            out.append(raw.try_cast(f.dataType).alias(f.name))
    return lines.select(*out)


def ticker(spark: SparkSession, rows_per_second: int = 2, subject: str = "Subject 1") -> DataFrame:
    """An endless stream of (subject, now)."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return rate.select(F.lit(subject).alias("subject"), F.col("timestamp").alias("sent"))


def datagen(spark: SparkSession, rows_per_second: int = 5, limit: int = 1000, seed: int = 1) -> DataFrame:
    """Sequence, random number, random text, time; watermarked without delay."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return rate.select(
        F.col("value").cast("int").alias("f_sequence"), F.floor(F.rand(seed) * limit).cast("int").alias("f_random"),
        F.randstr(10, seed).alias("f_random_str"), F.col("timestamp").alias("ts")).withWatermark("ts", "0 seconds")


def messages(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Message queue values as text. Needs the Kafka connector jar on the cluster."""
    r = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return r.options(**options).load().select(F.col("value").cast("string").alias("value"))


def good_and_broken(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """``data`` parsed from JSON text and ``broken``; NULL text counts as broken."""
    d = df.withColumn("data", from_lenient(F.col(text), schema))
    return d.withColumn("broken", F.col("data").isNull())


def batches(df: DataFrame, order: Seq[str], size: int = 25, limit: int | None = None) -> DataFrame:
    """Number rows 0, 1, ... in order and put them into batches of ``size``.

    The order is numbered per range partition, so no task sees all rows. With
    ``limit`` only the first rows are kept (a top-k, not a sample).
    """
    rows = df.orderBy(*order).limit(limit) if limit else df
    from tidewater.operators import sequence as S

    seq = S.sequence(rows, (), order[0], order[1:], unit=65536.0)
    pos = S.positions(rows, seq, "__n")
    return S.unchunked(pos).withColumn("batch", F.floor((F.col("__n") - 1) / size)).drop("__n")


def column_as(df: DataFrame, name: str, value: Column, delay: str = "0 seconds") -> DataFrame:
    """Computed time column with a watermark, as a table definition declares it."""
    return df.withColumn(name, value).withWatermark(name, delay)
