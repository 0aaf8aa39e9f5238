"""Run streaming queries over tables and bounded slices."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import work_dir


def stream_table(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A parquet table as a stream of its files, in one micro-batch.

    ``max_files`` bounds the files of a micro-batch. Files come in order of their
    modification, not of event time: with a bound, and a watermark, rows of later
    files may be late, as on any stream that is out of order by more than its delay.
    """
    schema = spark.read.parquet(path).schema
    # A glob matches a table kept as one file as well as one kept as a folder;
    # the plain path of a single file is refused as a stream.
    glob = f"{path[:-1]}[{path[-1]}]"
    stream = spark.readStream.schema(schema)
    return (stream.option("maxFilesPerTrigger", max_files) if max_files else stream).parquet(glob)


def stream_events(spark: SparkSession, path: str, delay: str | None = None) -> DataFrame:
    """Events with an event-time column watermarks accept, and a watermark."""
    ev = stream_table(spark, path).withColumn("ts", F.col("ts").cast("timestamp"))
    return ev.withWatermark("ts", delay) if delay else ev


def write_all(df: DataFrame, mode: str = "append", name: str = "out", checkpoint: str | None = None, path: str | None = None):
    """Process what is available into a parquet sink. Returns (path, query)."""
    spark = df.sparkSession
    path = path or work_dir(spark, name)
    q = (
        df.writeStream.format("parquet").outputMode(mode).option("path", path)
        .option("checkpointLocation", checkpoint or work_dir(spark, f"{name}-ckpt")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return path, q


def collect_table(df: DataFrame, name: str = "out") -> DataFrame:
    """Result of an append-mode stream as a table."""
    path, _ = write_all(df, name=name)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def each_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None):
    """Run ``fn`` on every micro-batch of what is available."""
    q = (
        df.writeStream.foreachBatch(fn).outputMode(mode)
        .option("checkpointLocation", checkpoint or work_dir(df.sparkSession, "ckpt")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return q


def latest_table(df: DataFrame, key: list[str], mode: str = "update", name: str = "upsert") -> DataFrame:
    """Result of an update-mode stream: the last row written per key.

    Each batch lands in its own folder, which a retry overwrites.
    """
    path = work_dir(df.sparkSession, name)

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    each_batch(df, put, mode)
    rest = [c for c in df.columns if c not in key]
    got = df.sparkSession.read.option("basePath", path).parquet(path)
    return got.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*key, "r.*")


#: Rows of a replayed batch, and batches at least, so that a watermark acts between them.
REPLAY_ROWS, REPLAY_BATCHES = 1 << 24, 2


def event_time_slices(df: DataFrame, ts: str, batches: int | None = None) -> list[DataFrame]:
    """Slices of a table in the order of event time, of about equal numbers of rows.

    Rows of one time stay together. Without ``batches`` a slice has about ``REPLAY_ROWS`` rows.
    """
    if batches is None:
        batches = max(REPLAY_BATCHES, -(-df.count() // REPLAY_ROWS))
    t = F.col(ts).cast("timestamp")
    cuts = df.agg(F.percentile_approx(F.unix_micros(t), [k / batches for k in range(1, batches)], 100 * batches)).first()[0] if batches > 1 else None
    edges = sorted(set(cuts or []))
    lo, out = None, []
    for hi in [*edges, None]:
        after = F.coalesce(t > F.timestamp_micros(F.lit(lo)), F.lit(False)) if lo is not None else F.lit(True)
        # Rows without a time come first.
        before = F.coalesce(t <= F.timestamp_micros(F.lit(hi)), F.lit(True)) if hi is not None else F.lit(True)
        out.append(df.where(after & before))
        lo = hi
    return out


def replay(df: DataFrame, ts: str, build: Callable[[DataFrame], DataFrame], batches: int | None = None, checkpoint: str | None = None) -> DataFrame:
    """Result of an append-mode stream over a table, fed in event-time order, one run per slice.

    ``build`` turns the stream into its result. The watermark closes windows and drops state
    between the slices, so state is bounded by the delay, not by the table.
    """
    spark = df.sparkSession
    path = work_dir(spark, "replay")
    schema = []

    def start(stream: DataFrame, ckpt: str) -> None:
        out = build(stream)
        schema[:] = [out.schema]
        write_all(out, checkpoint=ckpt, path=path)

    run_slices(spark, event_time_slices(df, ts, batches), start, checkpoint)
    return spark.read.schema(schema[0]).parquet(path)


def run_slices(spark: SparkSession, slices: Iterable[DataFrame], start: Callable[[DataFrame, str], None], checkpoint: str | None = None) -> str:
    """Feed slices one after the other, each as one run over the same checkpoint.

    ``start(stream, checkpoint)`` must process what is available. Returns the
    checkpoint folder.
    """
    source, ckpt = work_dir(spark, "slices"), checkpoint or work_dir(spark, "ckpt")
    for s in slices:
        s.write.mode("append").parquet(source)
        start(spark.readStream.schema(s.schema).parquet(source), ckpt)
    return ckpt
