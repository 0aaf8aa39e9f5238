"""Resampling towards a target distribution, ranked by a distributed radix sort.

Weights. Words of the lower-cased text (ASCII letters, digits and all longer characters)
give runs of 1 to ``run`` words; each run counts in the bucket of its CRC. The counts of
the raw corpus and of the target make one gain per bucket, an array of ``buckets`` numbers
that every task holds, and a text is scored by looking its buckets up as arrays. The
weight is the floored mean of the gains, the score adds a Gumbel variate drawn from the id.

Ranks. Rows get their place in the order by score (greatest first) and id in passes of a
least-significant-digit radix sort. A key is the concatenation of its components' bits, a
digit any ``DIGIT`` bits of it. Each pass is a stable counting sort:

1. rows lie in blocks of ``BLOCK`` places; digits are counted per block,
2. prefix sums over (digit, block) give the first destination of each pair,
3. within a pair rows keep their order, so destination = first + running number.

No task sees more than one block of rows of one digit or the counts of one digit over all
blocks, whatever the distribution of the keys, and nothing is sampled. Bits that all keys
share take no pass. Every pass is a table in the shared folder.

A null or empty text has no words: weight 0 and no rank. A null id draws as the id '' and
comes after all others among equal scores. Rows that agree in score and id are ordered by
their number of features; equal rows share their ranks in any order. Long texts are read in
slices. An empty table gives an empty result, an empty target the gains of no target text.
Further columns are dropped.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import Tables
from tidewater.llm.text import LOWER, MARKS, parts, words

BUCKETS = 10_000
#: Words of a drawn document at least; percent of these documents that are drawn.
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
#: Bits of a digit, and places of a block.
DIGIT = 11
BLOCK = 1 << 13
#: Longer words are hashed one by one.
LONG = 64

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, _CRC >> 1 ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)


def crc32(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte range, one byte of all ranges at a time."""
    size = end - start
    order = np.argsort(-size, kind="stable")
    at, size = start[order], size[order]
    out = np.zeros(len(at), np.uint32)
    many = int(np.count_nonzero(size > LONG))
    for k in range(many):
        out[order[k]] = zlib.crc32(data[at[k]:at[k] + size[k]].tobytes())
    order, at, size = order[many:], at[many:], size[many:]
    crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
    for k in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -k, "left"))
        crc[:n] = _CRC[(crc[:n] ^ data[at[:n] + k]) & 255] ^ (crc[:n] >> np.uint32(8))
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def features(data: np.ndarray, off: np.ndarray, run: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of every run of words, and the words of each row."""
    data = LOWER[data]
    start, end, row = words(data, off, MARKS)
    n = np.bincount(row, minlength=len(off) - 1)
    if run > 1:
        # One space between any two words, whatever stood there.
        size = end - start
        to = np.cumsum(size + 1) - (size + 1)
        packed = np.full(int((size + 1).sum()), 32, np.uint8)
        packed[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = data[np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]
        data, start, end = packed, to, to + size
    found, rows = [], []
    for k in range(run):
        whole = np.flatnonzero(row[:len(row) - k] == row[k:])
        found.append(crc32(data, start[whole], end[whole + k]) % np.uint32(buckets))
        rows.append(row[whole])
    return np.concatenate(found).astype(np.int64), np.concatenate(rows), n


def count_buckets(texts: DataFrame, text: str = "text", run: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all texts: one number per bucket comes to the driver."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, off in parts(batch.column(0)):
                total += np.bincount(features(data, off, run, buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": at.astype(np.int32), "n": total[at]})

    out = np.zeros(buckets, np.int64)
    for r in texts.select(text).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) per bucket."""
    s, t = int(raw.sum()) + len(raw), int(target.sum()) + len(raw)
    return np.array([math.floor(1000 * math.log((int(y) + 1) * s / ((int(x) + 1) * t))) for x, y in zip(raw, target, strict=True)], np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """A thousand times a Gumbel variate, floored, from a hash of the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, run: int = 1, seed: int = SEED, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document."""

    def score(batches):
        for batch in batches:
            n_words, n, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for lo, hi, data, off in parts(batch.column(1)):
                bucket, row, own = features(data, off, run, len(gain))
                n_words[lo:hi] = own
                n[lo:hi] = np.bincount(row, minlength=hi - lo)
                # Sums of whole numbers below 2 ** 53.
                total[lo:hi] = np.bincount(row, gain[bucket], hi - lo).astype(np.int64)
            weight = total // np.maximum(n, 1)
            noise = np.array([gumbel(i, seed) for i in batch.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in (n_words, n, weight, weight + noise))],
                                             names=["doc_id", "n_words", "n_features", "weight", "score"])

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text)
    return d.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long, score long")


def _digit(key: list[tuple[Column, int]], lo: int, hi: int) -> Column:
    """Bits lo to hi of the concatenated components, the first of ``key`` being the least significant."""
    out, at = F.lit(0).cast("long"), 0
    for column, width in key:
        a, b = max(lo, at), min(hi, at + width)
        if a < b:
            piece = F.shiftrightunsigned(column, a - at).bitwiseAND(F.lit((1 << (b - a)) - 1))
            out = out.bitwiseOR(F.shiftleft(piece, a - lo))
        at += width
    return out.cast("int")


def radix_places(rows: DataFrame, key: list[Column], tables: Tables, digit: int = DIGIT, block: int = BLOCK) -> DataFrame:
    """``rows`` with ``place``, from 0 on, in the ascending order of ``key`` (long columns without nulls, most significant first)."""
    flip = F.lit(-(1 << 63))
    names = [f"_key{k}" for k in range(len(key))]
    # Blocks of neighbouring rows of one part; their numbers need no order of their own.
    rows = rows.select("*", *[c.bitwiseXOR(flip).alias(n) for c, n in zip(key, names, strict=True)], F.monotonically_increasing_id().alias("place"))
    ends = [F.min(F.col(n).bitwiseXOR(flip)) for n in names] + [F.max(F.col(n).bitwiseXOR(flip)) for n in names]
    ends = rows.agg(*[c.alias(f"e{k}") for k, c in enumerate(ends)]).first()
    if ends[0] is None:
        return rows.drop(*names)
    # Bits above the highest one in which any two keys differ are the same in all.
    widths = [(ends[k] ^ ends[k + len(key)]) & ((1 << 64) - 1) for k in range(len(key))]
    parts_ = [(F.col(n), w.bit_length()) for n, w in zip(names, widths, strict=True)][::-1]
    total = sum(w for _, w in parts_)
    passes = max(1, -(-total // digit))
    width = -(-total // passes)
    order = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("block", "digit").orderBy("place")
    now = tables.cut(rows, "places")
    for k in range(passes):
        own = now.withColumn("block", F.shiftright("place", block.bit_length() - 1)).withColumn("digit", _digit(parts_, k * width, min(total, (k + 1) * width)))
        counts = own.groupBy("block", "digit").agg(F.count(F.lit(1)).alias("n"))
        # At most 2 ** digit rows in this window.
        totals = counts.groupBy("digit").agg(F.sum("n").alias("n"))
        first = totals.select("digit", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("first"))
        starts = counts.join(F.broadcast(first), "digit").select(
            "block", "digit", (F.col("first") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("start"))
        moved = own.join(starts, ["block", "digit"]).withColumn("place", F.col("start") + F.row_number().over(inside) - 1)
        after = tables.cut(moved.drop("block", "digit", "start"), "places")
        tables.drop(now)
        now = after
    return now.drop(*names)


def resample(docs: DataFrame, target: DataFrame, run: int = 1, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS,
             seed: int = SEED, digit: int = DIGIT, block: int = BLOCK, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; rank is null where it was not drawn."""
    tables = Tables(docs.sparkSession)
    gain = gains(count_buckets(docs, text, run, buckets), count_buckets(target, text, run, buckets))
    scored = tables.cut(weigh(docs, gain, run, seed, text, id_col), "scored")
    able = scored.where(F.col("n_words") >= min_words).drop("n_words")
    key = [F.bitwise_not("score"), F.col("doc_id").isNull().cast("long"), F.coalesce("doc_id", F.lit(0)), F.col("n_features")]
    placed = radix_places(able, key, tables, digit, block)
    drawn = placed.withColumn("rank", F.when(F.col("place") < percent * able.count() // 100, F.col("place") + 1)).drop("place")
    rest = scored.where(F.col("n_words") < min_words).drop("n_words").withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest)
