"""Sinks and table statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import work_dir

BUCKETS = ("year", "month", "day", "hour")


def write_text(df: DataFrame, column: str, path: str, gzip: bool = False) -> None:
    w = df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite")
    (w.option("compression", "gzip") if gzip else w).text(path)


def bucketed(df: DataFrame, ts: str | None = None) -> DataFrame:
    """Add ``year``, ``month``, ``day``, ``hour`` folders' columns, from a time
    column or from the clock."""
    t = F.col(ts) if ts else F.current_timestamp()
    parts = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return df.withColumns({n: F.date_format(t, p) for n, p in parts.items()})


def stream_to_buckets(df: DataFrame, path: str, ts: str | None = None, fmt: str = "parquet", rows_per_file: int = 1_000_000):
    """Date-bucketed file sink; part files roll at ``rows_per_file``."""
    spark = df.sparkSession
    q = (
        bucketed(df, ts).writeStream.format(fmt).partitionBy(*BUCKETS).option("path", path)
        .option("maxRecordsPerFile", rows_per_file).option("checkpointLocation", work_dir(spark, "buckets-ckpt"))
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return q


def console(df: DataFrame, mode: str = "append"):
    return df.writeStream.format("console").outputMode(mode).start()


def create_like(spark: SparkSession, new: str, old: str) -> None:
    """Empty table with the columns of another."""
    spark.sql(f"CREATE TABLE {new} LIKE {old}")


def insert_columns(df: DataFrame, table: str, columns: list[str]) -> None:
    """INSERT INTO t(columns) SELECT; the other columns become NULL."""
    spark = df.sparkSession
    spark.sql(f"INSERT INTO {table} ({', '.join(columns)}) SELECT * FROM {{src}}", src=df)
