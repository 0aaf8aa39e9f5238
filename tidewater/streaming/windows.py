"""Group windows: tumbling, hopping, session; evictors; late rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidewater.session import work_dir


def tumble(ts: str, size: str, align: str | None = None) -> Column:
    """TUMBLE(ts, size[, align]); bounds are ``.start`` and ``.end``."""
    return F.window(ts, size, size, align) if align else F.window(ts, size)


def hop(ts: str, slide: str, size: str, align: str | None = None) -> Column:
    """HOP(ts, slide, size[, align]), slide first."""
    return F.window(ts, size, slide, align) if align else F.window(ts, size, slide)


def session(ts: str, gap: str) -> Column:
    return F.session_window(ts, gap)


def window_agg(df: DataFrame, window: Column, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Aggregate per window and key, with the window's bounds as columns."""
    out = df.groupBy(window.alias("w"), *keys).agg(*aggs)
    names = [c for c in out.columns if c not in ("w", *keys)]
    return out.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *names)


def evict_count(df: DataFrame, window: Column, keys: list[str], ts: str, tie: list[str], keep: int) -> DataFrame:
    """Evictor that keeps a window's last ``keep`` rows before it is evaluated.

    Spark keeps that many rows per task before the shuffle already.
    """
    rows = df.withColumn("w", window)
    order = [F.col(ts).desc(), *[F.col(c).desc() for c in tie]]
    rn = F.row_number().over(Window.partitionBy("w", *keys).orderBy(*order))
    return rows.withColumn("__rn", rn).where(F.col("__rn") <= keep).drop("__rn")


def evict_time(df: DataFrame, window: Column, keys: list[str], ts: str, keep: timedelta) -> DataFrame:
    """Evictor that keeps rows within ``keep`` of the window's newest row."""
    rows = df.withColumn("w", window)
    newest = rows.groupBy("w", *keys).agg(F.max(ts).alias("__top"))
    span = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(keep.total_seconds()))
    return rows.join(newest, ["w", *keys]).where(F.col(ts) >= F.col("__top") - span).drop("__top")


class LateSplit:
    """Route each micro-batch: rows at or before the watermark are late.

    The watermark is the greatest time of the earlier batches minus ``delay``.
    It is kept as one marker row per batch beside the sinks, so a restarted
    query continues from the same value; a retried batch overwrites its output.
    """

    def __init__(self, spark, ts: str, delay: timedelta, path: str | None = None):
        self.ts, self.delay = ts, delay
        self.path = path or work_dir(spark, "late")
        self.spark = spark

    def watermark(self, before_batch: int):
        if before_batch == 0:
            return None
        marks = self.spark.read.schema("top timestamp, batch bigint").parquet(f"{self.path}/marks")
        top = marks.where(F.col("batch") < before_batch).agg(F.max("top")).first()[0]
        return None if top is None else top - self.delay

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        mark = self.watermark(batch_id)
        late = F.lit(False) if mark is None else F.coalesce(F.col(self.ts) <= F.lit(mark), F.lit(False))
        # One write of the batch, split by folder.
        batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(f"{self.path}/rows/batch={batch_id}")
        batch.agg(F.max(self.ts).alias("top")).where("top IS NOT NULL").write.mode("overwrite").parquet(
            f"{self.path}/marks/batch={batch_id}")

    def rows(self, late: bool) -> DataFrame:
        got = self.spark.read.option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows")
        return got.where(F.col("late") == late).drop("late")

    def late_counts(self) -> DataFrame:
        """Counter of late rows: ``batch`` and ``n`` of each batch that had any."""
        return self.rows(True).groupBy(F.col("batch").cast("long").alias("batch")).agg(F.count(F.lit(1)).alias("n"))


class SideOutputs:
    """foreachBatch sink with several outputs from one pass.

    ``outputs`` maps a tag to the condition under which a row goes there; a row
    may go to several outputs or to none. Each batch writes its own folder,
    split by tag, and a retry overwrites it.
    """

    def __init__(self, spark, outputs: dict[str, Column], path: str | None = None):
        self.spark, self.outputs = spark, outputs
        self.path = path or work_dir(spark, "outputs")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        tags = F.array_compact(F.array(*[F.when(cond, F.lit(tag)) for tag, cond in self.outputs.items()]))
        batch.withColumn("output", F.explode(tags)).write.mode("overwrite").partitionBy("output").parquet(f"{self.path}/batch={batch_id}")

    def rows(self, tag: str) -> DataFrame:
        got = self.spark.read.option("basePath", self.path).parquet(self.path)
        return got.where(F.col("output") == tag).drop("output", "batch")


def processing_time(df: DataFrame, name: str = "pt") -> DataFrame:
    """Processing-time column; all rows of a micro-batch share it."""
    return df.withColumn(name, F.current_timestamp())


class QualitySplit:
    """foreachBatch sink for parsed rows, with counters of good and broken ones.

    ``data`` is NULL where the text is broken. Each batch writes its rows and one
    row of counts, taken as the rows are written; a retry overwrites both.
    """

    def __init__(self, spark, text: str, parsed: Callable[[Column], Column], path: str | None = None):
        self.spark, self.text, self.parsed = spark, text, parsed
        self.path = path or work_dir(spark, "quality")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        data = F.col("data")
        out = batch.withColumn("data", self.parsed(F.col(self.text))).observe(
            seen, F.count(F.when(data.isNotNull(), 1)).alias("normalDataNum"), F.count(F.when(data.isNull(), 1)).alias("dirtyDataNum"))
        out.write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch_id}")
        counts = [(seen.get["normalDataNum"], seen.get["dirtyDataNum"])]
        self.spark.createDataFrame(counts, "normalDataNum bigint, dirtyDataNum bigint").coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/counts/batch={batch_id}")

    def rows(self) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows").drop("batch")

    def counts(self) -> DataFrame:
        got = self.spark.read.option("basePath", f"{self.path}/counts").parquet(f"{self.path}/counts")
        return got.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("normalDataNum", "dirtyDataNum")])
