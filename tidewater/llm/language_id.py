"""Language identification by rank-order n-gram profiles.

A profile lists the most frequent letter n-grams (one to three code points, words padded
with a space) by rank. A document's language is that whose profile has the least
out-of-place distance to the document's own: the sum of the differences of ranks, with
the length of the profile for n-grams that are missing.

Texts are used whole; a long one is counted in pieces that end at spaces. Null texts and
texts without a letter are ``und`` with score 0. Ties go to the first language by name.
Rows stand alone, so repeated rows and empty tables need no rule; without labelled rows
every text is ``und``. Further columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: N-grams in a profile.
RANKS = 300
#: Characters counted at once.
PIECE = 1 << 20
#: Languages whose profiles may go to every task (a profile has RANKS numbers).
MOST_LANGUAGES = 2000
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _table() -> np.ndarray:
    """Lower-case letter of each code point below 65536, 32 for all that is no letter."""
    if not _letters:
        chars = [chr(i) for i in range(1 << 16)]
        _letters.append(np.array([min(ord(c.lower()[0]), 0xFFFF) if c.isalpha() else 32 for c in chars], np.uint64))
    return _letters[0]


def _codes(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = _table()[np.minimum(cp, 0xFFFF)]
    if len(cp) and cp.max() > 0xFFFF:
        # Letters of the further planes share the private area.
        far = np.flatnonzero(cp > 0xFFFF)
        kinds = {c: (0xE000 | c & 0xFFF) if chr(c).isalpha() else 32 for c in set(cp[far].tolist())}
        out[far] = [kinds[c] for c in cp[far].tolist()]
    return out


def _pieces(text: str):
    at = 0
    while at < len(text):
        stop = at + PIECE
        if stop < len(text):
            while stop < len(text) and text[stop].isalpha():
                stop += 1
        yield text[at:stop]
        at = stop


def counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, n-gram and count, by row and n-gram."""
    c = np.concatenate([np.concatenate([_codes(t), [np.uint64(32)]]) for t in texts])
    row = np.repeat(np.arange(len(texts), dtype=np.uint64), [len(t) + 1 for t in texts])
    before = np.r_[np.uint64(32), c[:-1]]
    keep = (c != 32) | (before != 32)
    c, row = np.r_[np.uint64(32), c[keep]], np.r_[np.uint64(0), row[keep]]
    blank = c == 32
    high = row << np.uint64(48)
    one = (high | c)[~blank]
    two = (high[1:] | c[:-1] | c[1:] << np.uint64(16))[~(blank[:-1] & blank[1:])]
    inner = ~blank[1:-1]
    three = (high[1:-1] | c[:-2] | c[1:-1] << np.uint64(16) | c[2:] << np.uint64(32))[inner]
    found = np.concatenate([one, two, three])
    found.sort()
    first = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else np.zeros(0, np.int64)
    n = np.diff(np.r_[first, len(found)])
    found = found[first]
    return (found >> np.uint64(48)).astype(np.int64), found & np.uint64((1 << 48) - 1), n


def _grouped(texts: list[str | None]):
    """Counts of runs of rows: (first row, row, n-gram, count)."""
    lo = 0
    while lo < len(texts):
        if len(texts[lo] or "") > PIECE:
            grams, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            for piece in _pieces(texts[lo]):
                _, g, k = counts([piece])
                grams, at = np.unique(np.r_[grams, g], return_inverse=True)
                n = np.bincount(at, np.r_[n, k], len(grams)).astype(np.int64)
            yield lo, np.zeros(len(grams), np.int64), grams, n
            lo += 1
            continue
        hi, size = lo, 0
        while hi < len(texts) and hi - lo < 60_000 and (size := size + len(texts[hi] or "")) <= PIECE:
            hi += 1
        hi = max(hi, lo + 1)
        yield lo, *counts([t or "" for t in texts[lo:hi]])
        lo = hi


def _top(row: np.ndarray, grams: np.ndarray, n: np.ndarray, ranks: int):
    """The ``ranks`` most frequent n-grams of each row with their rank; ties by n-gram."""
    order = np.argsort((row << 40) - n, kind="stable")
    row, grams = row[order], grams[order]
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)
    rank = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)]))
    keep = rank < ranks
    return row[keep], grams[keep], rank[keep]


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", ranks: int = RANKS) -> dict[str, list[int]]:
    """Profiles of all languages from all labelled rows; n-grams by falling count, then by number."""

    def run(batches):
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            labels, own = names.dictionary.to_pylist(), names.indices.to_numpy()
            for lo, row, grams, n in _grouped(batch.column(1).to_pylist()):
                key = own[row + lo].astype(np.int64)
                order = np.lexsort((grams, key))
                key, grams, n = key[order], grams[order], n[order]
                first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (grams[1:] != grams[:-1])]) if len(key) else np.zeros(0, np.int64)
                total = np.add.reduceat(n, first) if len(first) else n
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([labels[k] for k in key[first]], pa.string()), "gram": pa.array(grams[first].astype(np.int64)),
                    "n": pa.array(total.astype(np.int64))})

    found = (labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(lang, text)
             .mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = found.withColumn("rank", place).where(F.col("rank") <= ranks)
    out: dict[str, list[int]] = {}
    for r in top.select("lang", "gram", "rank").orderBy("lang", "rank").limit(MOST_LANGUAGES * ranks + 1).toLocalIterator():
        out.setdefault(r.lang, []).append(r.gram)
    if len(out) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return out


def predict(df: DataFrame, profiles: dict[str, list[int]], text: str = "text", keep: tuple[str, ...] = ("doc_id",), ranks: int = RANKS) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` (1: the profile itself, 0: nothing in common)."""
    from pyspark.sql import types as T

    names = sorted(profiles)
    union = np.array(sorted({g for p in profiles.values() for g in p}), np.uint64)
    place = np.full((len(union) + 1, len(names)), -1, np.int64)
    for k, name in enumerate(names):
        place[np.searchsorted(union, np.array(profiles[name], np.uint64)), k] = np.arange(len(profiles[name]))
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            pred = np.full(batch.num_rows, -1)
            score = np.zeros(batch.num_rows)
            for lo, row, grams, n in _grouped(batch.column(len(keep)).to_pylist()) if names else ():
                row, grams, rank = _top(row, grams, n, ranks)
                if not len(row):
                    continue
                at = np.searchsorted(union, grams)
                at[(at == len(union)) | (union[np.minimum(at, len(union) - 1)] != grams)] = len(union)
                theirs = place[at]
                off = np.where(theirs >= 0, np.abs(theirs - rank[:, None]), ranks)
                first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                far = np.add.reduceat(off, first, axis=0) / (np.diff(np.r_[first, len(row)])[:, None] * ranks)
                pred[row[first] + lo] = far.argmin(1)
                score[row[first] + lo] = 1 - far.min(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array([names[k] if k >= 0 else UNKNOWN for k in pred], pa.string()), pa.array(np.clip(score, 0, 1))],
                names=schema.names)

    return df.select(*keep, text).mapInArrow(run, schema)
