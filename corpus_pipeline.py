"""A training corpus from ``documents``: quality, lines, near copies, benchmark leaks, token ids.

Each stage takes and returns ``documents`` (the last returns token ids) and is written to
the shared folder before the next one reads it. Stages only remove what their operator
decides against; rows of a null id are never removed as copies or leaks. No SQL
expresses the resampling, the alignment and the encoder, so the whole has no oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, importance, jaccard_join, line_runs, sentencepiece_bpe
from tidewater.llm.common import cut, only
from tidewater.llm.queries import model_path
from tidewater.session import configure, load, work_dir

ORACLE_SQL = None


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return only(docs, cut(ids.select("doc_id").distinct(), "removed"), "doc_id", "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling towards the labelled good documents; documents not drawn go."""
    configure(spark)
    good = load(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    return without(docs, importance.resample(docs, good).where("NOT kept"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one; documents of which no word is left go."""
    configure(spark)
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    d = line_runs.dedup_lines(docs, keep=tuple(_quoted(c) for c in (*rest, "text")))
    d = d.where("n_full <> 0")
    # A text that lost nothing stays as it was, also a null one.
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("more.text"))
    d = d.select("doc_id", text.alias("text"), *[F.col(f"more.{_quoted(c)}").alias(c) for c in rest])
    return d.withColumn("n_chars", F.length("text").cast("long")).select(*[_quoted(c) for c in docs.columns])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents that with the smallest id stays."""
    configure(spark)
    return without(docs, jaccard_join.link(docs, n=5, percent=80).where("doc_id <> component_id"))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    configure(spark)
    return without(docs, decontaminate.leaks(docs, load(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian 32-bit numbers) and the hashes of ids and decoded text."""
    configure(spark)
    d = sentencepiece_bpe.encode(docs, model_path())
    return d.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("leaks", leaks), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
