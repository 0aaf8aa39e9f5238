"""Line deduplication against levelled sorted runs of line hashes.

Documents come in batches. A batch's line keys are merge-anti-joined with the runs that
are already stored: keys that are new are recorded with the document that owns them,
known keys add to their document counts. Each batch writes one sorted run at level 0; when
a level holds ``fanout`` runs they are merged into one run of the next level.

A key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z in lower case; keys
are compared by two 64-bit hashes. Keys of at least ``min_chars`` code points found in at
least ``min_docs`` documents lose all their lines except in the document with the largest
id, so batches are taken from the largest ids down and the first batch that holds a key
owns it. Null and empty texts have one empty line. Rows with one id are one document
(equal rows give equal results); rows of a null id never own or count but lose lines.
An empty table gives an empty result. Further columns are dropped.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import cut
from tidewater.session import work_dir

BLANK = " \t\n\x0b\x0c\r"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]
BATCHES = 4
FANOUT = 2


class LineRuns:
    """Sorted runs of (h1, h2, docs, owner) in a shared folder; ``owner`` is null where a
    key was already known when its run was made."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT) -> None:
        self.spark, self.fanout = spark, fanout
        self.folder = work_dir(spark, "line-runs")
        self.levels: list[list[str]] = []
        self.made = 0

    def _write(self, rows: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        path = f"{self.folder}/level-{level}-run-{self.made}"
        self.made += 1
        rows.repartition(*KEY).sortWithinPartitions(*KEY).write.parquet(path)
        self.levels[level].append(path)

    def stored(self) -> DataFrame | None:
        paths = [p for level in self.levels for p in level]
        return self.spark.read.parquet(*paths) if paths else None

    def fresh(self, keys: DataFrame) -> DataFrame:
        """Rows whose key no run holds."""
        runs = self.stored()
        return keys if runs is None else keys.join(runs.select(*KEY).hint("merge"), KEY, "left_anti")

    def add(self, keys: DataFrame) -> None:
        """Store a batch: one row per key with ``docs`` and ``owner``."""
        new = self.fresh(keys.select(*KEY)).withColumn("_new", F.lit(True))
        owner = F.when(F.col("_new"), F.col("owner")).alias("owner")
        rows = keys if self.stored() is None else keys.join(new, KEY, "left").select(*KEY, "docs", owner)
        self._write(rows, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(merged(self.spark.read.parquet(*full)), level + 1)
            level += 1

    def totals(self) -> DataFrame:
        return merged(self.stored())


def merged(runs: DataFrame) -> DataFrame:
    # One run at most names the owner of a key.
    return runs.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.max("owner").alias("owner"))


def line_key(line: Column) -> Column:
    # lower() equals the ASCII rule where every character is one byte.
    small = F.when(F.octet_length(line) == F.length(line), F.lower(line)).otherwise(F.translate(line, UPPER, SMALL))
    return F.btrim(small, F.lit(BLANK))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = BATCHES, fanout: int = FANOUT,
                text: str = "text", id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_lines, n_dropped, n_full (lines with a word that stay, -1 where none was dropped), kept_text
    and the ``keep`` columns (as a struct ``more``) of every row."""
    spark = docs.sparkSession
    more = F.struct(*[F.col(c) for c in keep]) if keep else F.struct(F.lit(0).alias("none"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), more.alias("more"))
    tag = F.xxhash64("text")
    lines = rows.select("doc_id", tag.alias("tag"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    # A key is never longer than its line.
    lines = lines.where(F.length("line") >= min_chars).withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
    lines = lines.select("doc_id", "tag", "line_no", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))
    ends = rows.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    lo, hi = (ends.lo, ends.hi) if ends.lo is not None else (0, 0)
    step = (hi - lo) // batches + 1
    # Batch 0 has the largest ids.
    wide = lambda x: f"CAST({x} AS DECIMAL(20, 0))"
    number = F.coalesce(F.expr(f"({wide(f"'{hi}'")} - {wide('doc_id')}) div {wide(f"'{step}'")}"), F.lit(batches - 1)).cast("int")
    path = work_dir(spark, "lines")
    lines.withColumn("batch", number).write.partitionBy("batch").parquet(path)
    schema = "doc_id long, tag long, line_no int, h1 long, h2 long, batch int"
    stored = spark.read.schema(schema).parquet(path)
    runs = LineRuns(spark, fanout)
    for k in range(batches):
        part = stored.where(F.col("batch") == k)
        # Twice in a document counts once.
        once = part.groupBy(*KEY, "doc_id").agg(F.lit(1).alias("one"))
        runs.add(once.groupBy(*KEY).agg(F.count("doc_id").alias("docs"), F.max("doc_id").alias("owner")))
    heavy = cut(runs.totals().where(F.col("docs") >= min_docs).select(*KEY, "owner"), "heavy-lines")
    lost = stored.join(heavy, KEY).where(~F.col("doc_id").eqNullSafe(F.col("owner")))
    lost = lost.groupBy("doc_id", "tag").agg(F.collect_set("line_no").alias("lost")).select(
        F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"), "lost")
    whole = rows.withColumn("tag", tag).join(lost, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tag") == F.col("_tag")), "left")

    def rebuild(found):
        for batch in found:
            ids, texts, gone, others = batch.columns
            n_lines, n_dropped, n_full, kept = [], [], [], []
            for t, g in zip(texts.to_pylist(), gone.to_pylist(), strict=True):
                parts = t.split("\n")
                g = set(g or ())
                rest = [x for i, x in enumerate(parts) if i not in g] if g else parts
                n_lines.append(len(parts))
                n_dropped.append(len(parts) - len(rest))
                n_full.append(sum(1 for x in rest if x.strip(BLANK)) if g else -1)
                kept.append("\n".join(rest) if g else t)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(n_full, pa.int64()), pa.array(kept, pa.string()), others],
                names=schema.names)

    schema = T.StructType([*[T.StructField(c, T.LongType()) for c in ("doc_id", "n_lines", "n_dropped", "n_full")],
                           T.StructField("kept_text", T.StringType()), T.StructField("more", rows.schema["more"].dataType)])
    out = whole.select("doc_id", "text", "lost", "more").mapInArrow(rebuild, schema)
    return out if keep else out.drop("more")
