"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import work_dir

#: Rows of a one-column id table that may be broadcast (8 MB of ids).
BROADCAST_IDS = 1_000_000


def cut(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read again: a lost executor replays nothing before it."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Tables:
    """Work tables of one operator: written like ``cut``, and deleted once their successors are written."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def cut(self, df: DataFrame, purpose: str) -> DataFrame:
        path = work_dir(self.spark, purpose)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = out, path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later step reads."""
        for t in tables:
            _, path = self.paths.pop(id(t))
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def only(df: DataFrame, ids: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose ``on`` is in ``ids``. ``ids`` is broadcast when its count
    allows it, so that texts need no shuffle; beyond that a shuffled join does it."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, on, how)
