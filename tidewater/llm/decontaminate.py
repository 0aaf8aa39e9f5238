"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Texts are words of letters and digits in lower case. Every document is searched for the
n-grams of the test items; their document frequencies over the whole corpus decide which
n-grams of an item are its seeds: those that some document holds, but for stock phrases
(in more than ``RARE`` documents and more than ``SHARED`` different items) that are more
frequent than the middle one of the item's n-grams that occur. So an edited or partial copy
has all its n-grams as seeds, also where other copies of the item make them frequent.
A document with ``min_seeds`` seeds of an item near one another is aligned with the item
around them, unless too few of the item's words are there at all; the local alignment score
over the best possible one says how much of the item the passage holds, also when words were
changed, added or left out. A copy that keeps fewer seeds than ``min_seeds`` is not found.

The test items go to the tasks in blocks of at most ``BLOCK_ITEMS``, each with one search
of the corpus, so any number of items is done and no block grows with it.

Null texts have no words. Items with fewer than ``n`` words are too short to tell and match
nothing. Equal items each get their own rows, repeated documents repeat their rows.
Empty tables give an empty result. Further columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import cut
from tidewater.llm.text import LOWER, MARKS, grams, hashes, parts, ranges, words

GRAM = 3
MIN_SEEDS = 2
MIN_SCORE = 0.5
GAP = MISS = 0.5
#: Test items that are searched for at once.
BLOCK_ITEMS = 20_000
#: Documents and different items up to which an n-gram is no stock phrase.
RARE, SHARED = 1000, 8


def tokens(column):
    """Row range, word hashes and their rows, slice by slice."""
    for lo, hi, data, off in parts(column):
        data = LOWER[data]
        start, end, row = words(data, off, MARKS)
        yield lo, hi, hashes(data, start, end), row


class Items:
    """The n-grams of a block of items, with the places where they occur."""

    def __init__(self, ids: list[int], texts: list[str], n: int) -> None:
        self.ids, self.n, self.words = ids, n, []
        found: list[np.ndarray] = []
        item: list[np.ndarray] = []
        place: list[np.ndarray] = []
        for lo, hi, h, row in tokens(pa.array(texts, pa.string())):
            at = ranges(row, hi - lo)
            for k in range(hi - lo):
                own = h[at[k]:at[k + 1]]
                self.words.append(own)
                g, where = grams(own, np.zeros(len(own), np.int64), n)
                found.append(g)
                item.append(np.full(len(g), lo + k))
                place.append(where)
        g, item_, place_ = (np.concatenate([*x, np.zeros(0, t)]) for x, t in ((found, np.uint64), (item, np.int64), (place, np.int64)))
        order = np.argsort(g, kind="stable")
        self.grams, self.item, self.place = g[order].astype(np.uint64), item_[order].astype(np.int64), place_[order].astype(np.int64)
        self.unique, self.first = np.unique(self.grams, return_index=True)
        self.first = np.r_[self.first, len(self.grams)]
        self.seed = np.ones(len(self.grams), bool)
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self._filter()

    def _filter(self) -> None:
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(self.unique >> np.uint64(42)).astype(np.int64)] = True

    def find(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``g`` that hold an n-gram of an item, and its number."""
        at = np.flatnonzero(self.maybe[(g >> np.uint64(42)).astype(np.int64)])
        k = np.searchsorted(self.unique, g[at])
        k[k == len(self.unique)] = 0
        hit = self.unique[k] == g[at] if len(self.unique) else np.zeros(len(at), bool)
        return at[hit], k[hit]

    def choose(self, df: np.ndarray) -> None:
        """Seeds: of each item the n-grams that occur, without stock phrases above its middle one."""
        entry = np.repeat(np.arange(len(self.unique)), np.diff(self.first))
        each = df[entry]
        self.seed = each > 0
        stock = self.seed & (each > RARE) & (self._holders(entry)[entry] > SHARED)
        for k in np.unique(self.item[stock]):
            own = self._of(k)
            own = own[self.seed[own]]
            self.seed[own] = ~stock[own] | (each[own] <= np.median(each[own]))
        keep = np.zeros(len(self.unique), bool)
        keep[entry[self.seed]] = True
        order = np.flatnonzero(self.seed)
        self.grams, self.item, self.place = self.grams[order], self.item[order], self.place[order]
        self.unique = self.unique[keep]
        self.first = np.r_[np.searchsorted(self.grams, self.unique), len(self.grams)]
        self._filter()

    def _holders(self, entry: np.ndarray) -> np.ndarray:
        """Different items that hold each n-gram; equal ones count once."""
        known: dict[bytes, int] = {}
        same = np.array([known.setdefault(w.tobytes(), len(known)) for w in self.words], np.int64)
        pairs = np.unique(entry * max(1, len(known)) + same[self.item]) // max(1, len(known))
        return np.bincount(pairs, minlength=len(self.unique))

    def _of(self, k: int) -> np.ndarray:
        if not hasattr(self, "_order"):
            self._order = np.argsort(self.item, kind="stable")
            self._ends = np.searchsorted(self.item[self._order], np.arange(len(self.ids) + 1))
        return self._order[self._ends[k]:self._ends[k + 1]]


def align(item: np.ndarray, text: np.ndarray) -> tuple[float, int]:
    """Best local alignment score (1 a match) and where it ends in the text."""
    step = GAP * np.arange(len(text) + 1)
    above = np.zeros(len(text) + 1)
    best, end = 0.0, 0
    for w in item:
        now = np.maximum(above - GAP, 0)
        now[1:] = np.maximum(now[1:], above[:-1] + np.where(text == w, 1.0, -MISS))
        # Gaps along the text: the best earlier cell less its distance.
        now = np.maximum.accumulate(now + step) - step
        k = int(now.argmax())
        if now[k] > best:
            best, end = float(now[k]), k
        above = now
    return best, end


def matches(items: Items, h: np.ndarray, row: np.ndarray, rows: int, min_seeds: int, min_score: float):
    """(row, item, score, seeds, first word, last word) of the passages that hold an item."""
    g, at = grams(h, row, items.n)
    hit, k = items.find(g)
    n = items.first[k + 1] - items.first[k]
    pos = np.repeat(at[hit], n)
    entry = np.repeat(items.first[k] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)
    item, place = items.item[entry], items.place[entry]
    order = np.lexsort((pos, item, row[pos]))
    pos, item, place = pos[order], item[order], place[order]
    begin = ranges(row, rows)
    if not len(pos):
        return
    # Seeds of one item in one document, each within an item's length of the one before.
    sizes = items.sizes[item]
    new = np.r_[True, (item[1:] != item[:-1]) | (row[pos[1:]] != row[pos[:-1]]) | (pos[1:] - pos[:-1] > sizes[1:])]
    start = np.flatnonzero(new)
    stop = np.r_[start[1:], len(pos)]
    # Seeds at different places of the item.
    cluster = np.cumsum(new) - 1
    seen = np.unique(cluster * (int(place.max()) + 1) + place) // (int(place.max()) + 1)
    enough = np.bincount(seen, minlength=len(start)) >= np.minimum(min_seeds, np.maximum(1, sizes[start] - items.n + 1))
    for lo, hi in zip(start[enough].tolist(), stop[enough].tolist(), strict=True):
        size, own = int(sizes[lo]), items.words[item[lo]]
        doc = row[pos[lo]]
        # Words beside those of the item cost GAP each, so a passage that scores enough is no longer.
        reach = int(size * (1 + (1 - min_score) / GAP))
        a = max(begin[doc], pos[lo] - reach)
        b = min(begin[doc + 1], pos[hi - 1] + items.n + reach)
        # No alignment has more matches than the item has words that are there.
        if np.isin(own, h[a:b]).sum() < min_score * size:
            continue
        best, end = align(own, h[a:b])
        if best >= min_score * size:
            yield int(doc), items.ids[item[lo]], best / size, hi - lo, int(a + end - begin[doc] - min(end, size)), int(a + end - begin[doc])


def leaks(docs: DataFrame, benchmark: DataFrame, n: int = GRAM, min_seeds: int = MIN_SEEDS, min_score: float = MIN_SCORE,
          text: str = "text", id_col: str = "doc_id", item_col: str = "item_id") -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, score, n_seeds, first_word, last_word (the best passage)."""
    spark = docs.sparkSession
    items = cut(benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text")), "items")
    blocks = -(-items.count() // BLOCK_ITEMS)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text)
    schema = "doc_id long, item_id long, score double, n_seeds long, first_word long, last_word long"
    out = spark.createDataFrame([], schema)
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").toPandas()
        out = out.unionByName(_block(rows, Items(own.item_id.tolist(), own.text.tolist(), n), min_seeds, min_score, schema))
    # Overlapping windows or repeated copies in a document: the best counts.
    best = F.max_by(F.struct("score", "n_seeds", "first_word", "last_word"), F.struct("score", -F.col("first_word")))
    return out.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def _block(rows: DataFrame, items: Items, min_seeds: int, min_score: float, schema: str) -> DataFrame:
    def frequencies(batches):
        df = np.zeros(len(items.unique), np.int64)
        for batch in batches:
            for _, hi, h, row in tokens(batch.column(1)):
                g, at = grams(h, row, items.n)
                hit, k = items.find(g)
                # Once per document.
                df += np.bincount(np.unique(row[at[hit]] * len(df) + k) % max(1, len(df)), minlength=len(df)).astype(np.int64)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"gram": pa.array(at, pa.int64()), "df": pa.array(df[at], pa.int64())})

    df = np.zeros(len(items.unique))
    # One row per n-gram of the block.
    for r in rows.mapInArrow(frequencies, "gram long, df long").groupBy("gram").agg(F.sum("df").alias("df")).collect():
        df[r.gram] = r.df
    items.choose(df)

    def search(batches):
        for batch in batches:
            ids = batch.column(0)
            found = []
            for lo, hi, h, row in tokens(batch.column(1)):
                found += [(ids[lo + m[0]].as_py(), *m[1:]) for m in matches(items, h, row, hi - lo, min_seeds, min_score)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), [pa.int64(), pa.int64(), pa.float64(), *[pa.int64()] * 3], strict=True)],
                                                 names=["doc_id", "item_id", "score", "n_seeds", "first_word", "last_word"])

    return rows.mapInArrow(search, schema)
