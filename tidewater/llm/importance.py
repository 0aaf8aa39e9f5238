"""Quality selection by importance resampling.

Two generative models over hashed n-grams, one of target text and one of all raw text,
give each document the log ratio of its probability under the two. Documents are drawn
without replacement in proportion to (a power of) that ratio: a Gumbel variate is added to
the log ratio and the k largest sums stay.

N-grams: words, words without marks, their first four bytes, and pairs of words (a word
``RUN`` times in a row is one n-gram whatever the word), all in lower case; each counts once
per document, so a text cannot repeat its way up or down. An n-gram is hashed into two
tables of ``buckets`` counters and takes the weaker of the two ratios, so that a rare
n-gram is not judged by a frequent one in its bucket. The target model is fitted on at most ``TARGET_ROWS`` labelled documents
(those with the smallest hash of their id); the raw model counts every n-gram of every
document. Ratios are taken against the middle ratio over all n-grams, so length alone
does not count, and an n-gram whose counts could be chance (``sure`` standard deviations)
or differ by less than a factor ``least`` counts nothing.

k is the number of documents that the ratios say are like the target: the sum of
min(1, ratio) over all documents, unless it is given.

Null and empty texts have ratio 1. Equal sums at the border all stay. Repeated ids draw the
same variate. An empty table gives an empty result; without target rows every document
has ratio 1. Further columns are dropped.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import cut
from tidewater.llm.text import LOWER, MARKS, Sums, mix, parts, words

BUCKETS = 1 << 17
#: Labelled documents used for the target model at most.
TARGET_ROWS = 100_000
TEMPERATURE = 0.1
RUN = 6
#: Steps of a key: keys nearer than this are equal.
GRAIN = 1 << 20
#: Key ranges counted at once when the border is sought.
RANGES = 1024


def features(data: np.ndarray, off: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket in either table and row of every n-gram; one that a row repeats counts once."""
    data = LOWER[data]
    sums = Sums(data)
    start, end, row = words(data, off)
    raw = sums.of(start, end)
    bare_start, bare_end, bare_row = words(data, off, MARKS)
    bare = sums.of(bare_start, bare_end)
    long = bare_end - bare_start >= 6
    stem = sums.of(bare_start[long], bare_start[long] + 4)
    pair = mix(raw[:-1] * np.uint64(3) + raw[1:])
    runs = np.flatnonzero(np.lib.stride_tricks.sliding_window_view(raw[1:] == raw[:-1], RUN - 1).all(1)) if len(raw) >= RUN else []
    pair[runs] = np.uint64(1)
    same = row[:-1] == row[1:]
    kinds = [(raw, row), (bare, bare_row), (stem, bare_row[long]), (pair[same], row[:-1][same])]
    h = np.concatenate([mix(x ^ np.uint64(k)) for k, (x, _) in enumerate(kinds)]) >> np.uint64(22)
    found = np.concatenate([r for _, r in kinds]).astype(np.uint64) << np.uint64(42) | h
    found.sort()
    found = found[np.r_[True, found[1:] != found[:-1]]] if len(found) else found
    first, second = found % np.uint64(buckets), (found >> np.uint64(20)) % np.uint64(buckets)
    return first.astype(np.int64), second.astype(np.int64) + buckets, (found >> np.uint64(42)).astype(np.int64)


def count_grams(docs: DataFrame, target: DataFrame, text: str, id_col: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams per bucket in all documents and in the target documents."""
    # TARGET_ROWS ids at most, so this side may be broadcast.
    own_ids = target.select(F.col(id_col).alias("_t")).distinct()
    marked = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(own_ids), F.col("_id") == F.col("_t"), "left")

    def run(batches):
        raw, good = np.zeros(2 * buckets, np.int64), np.zeros(2 * buckets, np.int64)
        for batch in batches:
            own = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, data, off in parts(batch.column(0)):
                first, second, row = features(data, off, buckets)
                for b in (first, second):
                    raw += np.bincount(b, minlength=2 * buckets)
                    good += np.bincount(b[own[lo:hi][row]], minlength=2 * buckets)
        at = np.flatnonzero(raw)
        for k in range(0, len(at), 1 << 16):
            x = at[k:k + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"bucket": x.astype(np.int32), "raw": raw[x], "good": good[x]})

    found = marked.select("_text", F.col("_t").isNotNull().alias("own")).mapInArrow(run, "bucket int, raw long, good long")
    raw, good = np.zeros(2 * buckets), np.zeros(2 * buckets)
    # One row per bucket, whatever the size of the corpus.
    table = found.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).toPandas()
    raw[table.bucket], good[table.bucket] = table.raw, table.good
    return raw, good


def log_ratios(raw: np.ndarray, good: np.ndarray, sure: float = 4.0, least: float = 2.0) -> np.ndarray:
    """Log of the target's over the raw probability per bucket; 0 where that may be chance."""
    if not good.sum():
        return np.zeros(len(raw))
    expected = raw * (good.sum() / raw.sum())
    # The middle ratio over all n-grams stands for text that is like the target.
    seen = np.flatnonzero(raw)
    order = seen[np.argsort(good[seen] / expected[seen])]
    mass = np.cumsum(raw[order])
    middle = order[np.searchsorted(mass, mass[-1] / 2)]
    expected *= max(good[middle] / expected[middle], 1e-9)
    ratio = np.log((good + 0.5) / (expected + 0.5))
    chance = np.abs(good - expected) <= sure * np.sqrt(expected + 1)
    return np.where(chance | (np.abs(ratio) < math.log(least)), 0.0, ratio)


def score(docs: DataFrame, ratios: np.ndarray, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id and log_ratio of every document."""
    buckets = len(ratios) // 2

    def run(batches):
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for lo, hi, data, off in parts(batch.column(1)):
                first, second, row = features(data, off, buckets)
                a, b = ratios[first], ratios[second]
                weaker = np.where(a * b > 0, np.where(np.abs(a) < np.abs(b), a, b), 0.0)
                out[lo:hi] = np.bincount(row, weaker, hi - lo)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], names=["doc_id", "log_ratio"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text).mapInArrow(run, "doc_id long, log_ratio double")


def resample(docs: DataFrame, target: DataFrame, k: int | None = None, seed: int = 17, temperature: float = TEMPERATURE,
             buckets: int = BUCKETS, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, log_ratio, sample_key and kept of every document. ``target``: ids of target documents."""
    some = target.select(id_col).where(F.col(id_col).isNotNull()).orderBy(F.xxhash64(id_col), id_col).limit(TARGET_ROWS)
    ratios = log_ratios(*count_grams(docs, cut(some, "target"), text, id_col, buckets))
    odds = F.col("log_ratio") / temperature
    even = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    key = F.floor((odds - F.log(-F.log(even))) * GRAIN).cast("long")
    scored = cut(score(docs, ratios, text, id_col).withColumn("sample_key", key), "scored")
    if k is None:
        k = round(scored.agg(F.sum(F.exp(F.least(odds, F.lit(0.0))))).first()[0] or 0)
    return scored.withColumn("kept", F.col("sample_key") >= border(scored, k))


def border(scored: DataFrame, k: int) -> int:
    """The k-th largest key: counts of ``RANGES`` key ranges at most, then of the ranges of the one that holds it."""
    ends = scored.agg(F.min("sample_key").alias("lo"), F.max("sample_key").alias("hi")).first()
    if k <= 0:
        return 1 << 62
    left, lo, hi = k, ends.lo, ends.hi
    while lo is not None:
        step = (hi - lo) // RANGES + 1
        rows = scored.where(F.col("sample_key").between(lo, hi))
        bins = rows.groupBy(F.expr(f"(sample_key - ({lo})) div {step}").alias("b")).count().orderBy(F.desc("b"))
        found = None
        for r in bins.collect():
            if left <= r["count"]:
                found = r.b
                break
            left -= r["count"]
        if found is None:
            break
        lo, hi = lo + found * step, min(hi, lo + (found + 1) * step - 1)
        if step == 1:
            return lo
    return -(1 << 62)
