"""Updating results as changelogs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.changelog import retract_diff
from tidewater.session import work_dir

#: Runs of one level that are merged into one of the next.
FANOUT = 4


class RetractSink:
    """foreachBatch sink for an update-mode aggregate: writes -U/+U/+I rows.

    The snapshot is kept in levelled runs: each batch adds a run with the values it wrote,
    and ``fanout`` runs of a level become one of the next level, with the last value per key. So there are
    a few runs per level, each key stands at most once in a run, and however many batches have passed a
    value is rewritten once per level. Which runs stand is one small table per batch; a retried batch
    starts from that of the batch before and overwrites its own folders.
    """

    def __init__(self, spark, key: list[str], path: str | None = None, fanout: int = FANOUT):
        self.spark, self.key, self.fanout = spark, key, fanout
        self.path = path or work_dir(spark, "retract")

    def runs(self, batch_id: int) -> list[tuple[int, int]]:
        """Level and last batch of the runs that stand after a batch, newest first."""
        if batch_id < 0:
            return []
        rows = self.spark.read.schema("level int, last bigint").parquet(f"{self.path}/runs/batch={batch_id}").collect()
        return sorted(((r.level, r.last) for r in rows), key=lambda r: -r[1])

    def _folder(self, level: int, last: int) -> str:
        return f"{self.path}/run/level={level}-last={last}"

    def _latest(self, runs: list[tuple[int, int]], schema) -> DataFrame:
        """The last value of each key in some runs."""
        rest = [f.name for f in schema if f.name not in self.key]
        each = [self.spark.read.schema(schema).parquet(self._folder(*r)).withColumn("__last", F.lit(r[1])) for r in runs]
        if len(each) == 1:
            return each[0].drop("__last")
        both = reduce(DataFrame.unionByName, each)
        return both.groupBy(*self.key).agg(F.max_by(F.struct(*rest), "__last").alias("r")).select(*self.key, "r.*")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = self.runs(batch_id - 1)
        if before:
            # Only keys of this batch are looked up, before versions are compared.
            keys = batch.select(*self.key)
            each = [self.spark.read.schema(batch.schema).parquet(self._folder(*r)).withColumn("__last", F.lit(r[1])).join(keys, self.key, "left_semi") for r in before]
            rest = [c for c in batch.columns if c not in self.key]
            old = reduce(DataFrame.unionByName, each).groupBy(*self.key).agg(F.max_by(F.struct(*rest), "__last").alias("r")).select(*self.key, "r.*")
        else:
            old = batch.limit(0)
        retract_diff(old, batch, self.key).write.mode("overwrite").parquet(f"{self.path}/changes/batch={batch_id}")
        batch.write.mode("overwrite").parquet(self._folder(0, batch_id))
        now, level = [(0, batch_id), *before], 0
        while len(full := [r for r in now if r[0] == level]) >= self.fanout:
            self._latest(full, batch.schema).write.mode("overwrite").parquet(self._folder(level + 1, batch_id))
            now = [(level + 1, batch_id), *[r for r in now if r[0] != level]]
            level += 1
        self.spark.createDataFrame(now, "level int, last bigint").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/runs/batch={batch_id}")

    def snapshot(self, batch_id: int, schema) -> DataFrame:
        """The value of every key after a batch."""
        return self._latest(self.runs(batch_id), schema)

    def changes(self) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.path}/changes").parquet(f"{self.path}/changes")
