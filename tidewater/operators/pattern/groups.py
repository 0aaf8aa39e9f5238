"""Run a function over (key, chunk) groups inside sorted partitions.

A window over (key, chunk) partitions and sorts the rows and flags where a group
starts; one Python pass then reads the partition in order and holds the current
group only. Small groups so cost a function call, not a data exchange each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import sequence as S


def match_groups(d: DataFrame, order: list[str], cols: list[str], handle: Callable) -> DataFrame:
    """Matches found by ``handle`` in each group of ``d`` (KEY, CHUNK, ``__ev``
    and plain ``cols``): it gets the columns as lists, in order, and returns
    (kind, slots, row numbers) per match."""
    head = f"lag(1) OVER (PARTITION BY {S.KEY}, {S.CHUNK} ORDER BY {', '.join(order)}) IS NULL AS __head"
    rows = d.selectExpr(S.KEY, S.CHUNK, *cols, "__ev", head)
    item = T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("e", d.schema["__ev"].dataType)])
    out = T.StructType([
        d.schema[S.KEY], T.StructField(S.CHUNK, T.LongType()), T.StructField("kind", T.StringType()),
        T.StructField("__no", T.IntegerType()), T.StructField("items", T.ArrayType(item))])
    key, chunk = S.KEY, S.CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: dict[str, list] = {c: [] for c in cols}
        slices: list[pa.RecordBatch] = []

        def flush():
            if not slices:
                return None
            found = handle(lists)
            if not found:
                return None
            ev = pa.concat_arrays([s.column("__ev") for s in slices])
            offsets, slots, refs = [0], [], []
            for _, ids, at in found:
                slots.extend(ids)
                refs.extend(at)
                offsets.append(len(slots))
            picked = pa.StructArray.from_arrays(
                [pa.array(slots, pa.int32()), ev.take(pa.array(refs, pa.int64()))], names=["slot", "e"])
            first = pa.array([0] * len(found), pa.int64())
            return pa.RecordBatch.from_arrays([
                slices[0].column(key).take(first), slices[0].column(chunk).take(first),
                pa.array([k for k, _, _ in found], pa.string()), pa.array(range(len(found)), pa.int32()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), picked),
            ], names=[key, chunk, "kind", "__no", "items"])

        for batch in batches:
            values = {c: batch.column(c).to_pylist() for c in cols}
            heads = [i for i, h in enumerate(batch.column("__head").to_pylist()) if h]
            bounds = [0, *[h for h in heads if h > 0], batch.num_rows]
            starts = set(heads)
            done = []
            for a, b in zip(bounds, bounds[1:]):
                if a in starts:
                    done.append(flush())
                    lists, slices = {c: [] for c in cols}, []
                for c in cols:
                    lists[c].extend(values[c][a:b])
                slices.append(batch.slice(a, b - a))
            done = [x for x in done if x is not None]
            if done:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
        last = flush()
        if last is not None:
            yield last

    return rows.mapInArrow(run, out)
