"""User-written aggregates and window functions, kept bounded per task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def salted_agg(df: DataFrame, keys: list[str], partial: list[Column], final: list[Column], rows: int = 1 << 16) -> DataFrame:
    """A user aggregate in two stages, so that no group is held whole.

    ``partial`` runs per (key, block), where a block is ``rows`` rows that follow
    each other in one input partition, so the blocks grow in number and not in
    size; ``final`` combines the partial results in the JVM. For Python
    aggregates Spark does not combine before the shuffle by itself.
    """
    salt = F.floor(F.monotonically_increasing_id() / rows)
    blocks = df.withColumn("__salt", salt).groupBy(*keys, "__salt").agg(*partial)
    return blocks.groupBy(*keys).agg(*final)


def process_window(
    df: DataFrame, window: Column, keys: list[str], fn: Callable[[tuple, Iterator[pd.DataFrame]], Iterator[tuple]], schema: str,
) -> DataFrame:
    """Full-window function: ``fn`` gets the key (window start, window end,
    *keys) and the window's rows batch by batch, so a large window streams
    through instead of being loaded, and yields result rows."""
    rows = df.withColumn("w", window).withColumns({"__ws": F.col("w.start"), "__we": F.col("w.end")}).drop("w")
    group = ["__ws", "__we", *keys]
    # The window sorts each partition by group and flags where one starts.
    head = F.lag(F.lit(1)).over(Window.partitionBy(*group).orderBy("__ws")).isNull()
    rows = rows.withColumn("__head", head)
    names = T.StructType.fromDDL(schema).names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source, out = _Pieces(batches), []
        while source.piece is not None:
            first = source.piece
            key = tuple(first[c].iat[0] for c in group)
            pieces = source.group()
            for row in fn(key, pieces):
                out.append(row)
                if len(out) >= 10_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            for _ in pieces:
                pass
        if out:
            yield pd.DataFrame(out, columns=names)

    return rows.mapInPandas(run, schema)


class _Pieces:
    """Batches cut at group starts; ``piece`` is the next one to read."""

    def __init__(self, batches: Iterator[pd.DataFrame]):
        self.cuts = self._cut(batches)
        self.piece = next(self.cuts, None)

    @staticmethod
    def _cut(batches):
        for pdf in batches:
            heads = pdf["__head"].to_numpy().nonzero()[0].tolist()
            bounds = sorted({0, *heads, len(pdf)})
            for a, b in zip(bounds, bounds[1:]):
                yield pdf.iloc[a:b]

    def group(self) -> Iterator[pd.DataFrame]:
        """Pieces of the current group, read as they are asked for."""
        first = True
        while self.piece is not None and (first or not self.piece["__head"].iat[0]):
            first = False
            piece, self.piece = self.piece, next(self.cuts, None)
            yield piece
