"""Line-first cleaning with quality rules, in SQL functions only.

Every line of a text is judged by three rules; lines that fail are removed, and a
document that loses more than ``max_lost`` of its word characters is rejected.

* punctuation: more than ``max_noisy`` of the words hold a run of two or more marks
  (``**``, ``%%``, ``!!``);
* navigation: more than ``max_bars`` of the words are separators (``|``, a bullet, an arrow);
* boilerplate: one of ``BOILERPLATE`` occurs in it.

Lines without a word are neither kept nor counted as lost. Null and empty texts have
no words: they fail the base rules. Rows stand alone, so ties, repeated rows and
empty tables need no rule; further columns are dropped.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = r"[\x20\x09-\x0D]+"
# Phrases that mark a line as boilerplate, in lower case.
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use cookies",
    "enable javascript", "subscribe to our", "click here", "licensed under", "is licensed", "lorem ipsum",
)
NOISY = r"[#*$%&<>!?=_~^+|\\/-]{2,}"
BARS = r"^(?:[|»›>•·→]+|[-–—/]{1,3})$"


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, WORDS), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where lambdas use it per element."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), 0)


def word_windows(words: Column, width: int = 8) -> Column:
    """A 64-bit hash of every ``width`` words in a row; ``width`` is a power of two."""
    out, have = F.transform(words, lambda w: F.xxhash64(w)), 1
    while have < width:
        # A window of twice the width: two windows that touch.
        out = let(out, lambda v, k=have: F.zip_with(v, F.slice(v, k + 1, F.size(v)), lambda a, b: F.xxhash64(a, b)))
        have *= 2
    return let(out, lambda v: F.slice(v, 1, F.greatest(F.size(v) - (width - 1), F.lit(0))))


def repeated_words(windows: Column, width: int = 8) -> Column:
    """Words covered by windows that occur twice or more."""
    def covered(at: Column) -> Column:
        # In order, each window adds the words up to its end that the one before left out.
        return F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(width), i + width - a["end"])).alias("n"), (i + width).alias("end")))["n"]

    def twins(pairs: Column) -> Column:
        twin = F.filter(pairs, lambda p, k: (F.get(pairs, k - 1)["h"] == p["h"]) | (F.get(pairs, k + 1)["h"] == p["h"]))
        return covered(F.array_sort(F.transform(twin, lambda p: p["i"])))

    return let(windows, lambda v: F.when(F.size(F.array_distinct(v)) == F.size(v), 0).otherwise(
        let(F.sort_array(F.transform(v, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), twins)))


def line_fails(line: Column, max_noisy: float = 0.3, max_bars: float = 0.2) -> Column:
    """Whether a line that has words fails one of the line rules."""
    def judge(words: Column) -> Column:
        noisy = F.size(F.filter(words, lambda w: F.regexp_like(w, F.lit(NOISY)))) > max_noisy * F.size(words)
        bars = F.size(F.filter(words, lambda w: F.regexp_like(w, F.lit(BARS)))) > max_bars * F.size(words)
        return noisy | bars

    # Most lines hold none of the marks, so their words need no split.
    marked = F.regexp_like(line, F.lit(r"[#*$%&<>!?=_~^+|\\/»›•·→–—-]"))
    plate = let(F.lower(line), lambda x: reduce(or_, [F.contains(x, F.lit(p)) for p in BOILERPLATE]))
    return plate | (marked & let(split_words(line), judge))


def clean_lines(docs: DataFrame, text: str = "text", id_col: str = "doc_id", max_lost: float = 0.5,
                min_words: int = 20, max_repeat: int = 30, width: int = 8) -> DataFrame:
    """Base counts, the cleaned text and the verdict for every document.

    Columns: ``id_col``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_lines, n_failed_lines, lost_chars, kept, clean_text.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(id_col), t.alias("_t")).select(
        id_col, "_t", split_words(F.col("_t")).alias("_w"), F.split("_t", "\n").alias("_l"))
    counted = base.select(
        id_col, "_l", F.aggregate("_w", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"), F.size("_w").cast("long").alias("n_words"),
        F.regexp_count("_t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter("_l", lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]"))).alias("_full"),
        word_windows(F.col("_w"), width).alias("_win"))
    judged = counted.select(
        id_col, "n_words", "word_chars", "n_symbols", "_l",
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_win"), width).cast("long").alias("n_repeat_words"),
        F.size("_full").cast("long").alias("n_lines"),
        F.filter("_full", lambda x: line_fails(x)).alias("_bad"))
    lost = F.aggregate("_bad", F.lit(0).cast("long"), lambda a, x: a + F.length(F.regexp_replace(x, WORDS, "")))
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    return judged.select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"),
        "n_lines", F.size("_bad").cast("long").alias("n_failed_lines"), lost.alias("lost_chars"),
        (~base_failed & (lost <= max_lost * F.col("word_chars"))).alias("kept"),
        F.array_join(F.filter("_l", lambda x: ~F.array_contains("_bad", x)), "\n").alias("clean_text"))
