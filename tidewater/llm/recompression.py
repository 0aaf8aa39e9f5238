"""Removal of repeated word windows by recompression.

A word is removed if a window of ``window`` consecutive words covers it whose words, in the
same order, also start in a document with a smaller id. Windows are judged on the input,
overlaps count, matches never cross documents.

Recompression. A text is a sequence of names, one per word. Each round first names runs of one
name (name and length), then deals the names into two halves by a bit of their own and
names each pair of a left and a right name; a pair is never in doubt, so equal strings are
compressed alike wherever they stand, up to their borders. Names are 64-bit fingerprints of
what they stand for, so a name means the same string in every task. What of a window is sure
whatever stands around it loses the first and last run of each round, and a first right or
last left name; the sure part of equal windows holds the same symbols at the same distance.

1. Reveal: the anchor of a window is the symbol with the least name in its sure part after
   ``ROUNDS`` rounds (or the first one of the last round that leaves any). Neighbouring windows of one anchor
   are one row, cut in two where the anchor passes the middle, so that all windows of a row
   share the ``window`` / 2 words on one side of the anchor. The number of these words is the bucket of the row, the
   number of all words that it covers its refined number.
2. Rows that agree in both are equal: all but those of the least document repeat whole. Equal
   rows of one task are reduced before the shuffle, so a passage that is everywhere sends
   rows of one document from each task.
3. A bucket that still holds rows of several documents is open: their words differ, but some
   windows may be common. These are verified one by one: each is numbered by all its
   words, and those that a smaller document also has repeat.

Buckets are dealt to tasks whole, but for hot ones: rows are counted in ``SLOTS`` slots of
buckets, and the rows of a slot with more than a ``HOT``-th of all are dealt by bucket and
refined number, and all that are left of them are open.

No name, row or window is dropped, sampled or capped. Words are runs of bytes outside
``[\\x20\\x09-\\x0D]``. Null and empty texts have no words; a text shorter than the window
loses nothing. Long texts are read in pieces that share ``window`` - 1 words. A null id
comes before all others. Rows of one id do not repeat each other, whatever their texts; equal
rows give equal results. An empty table gives an empty result. Further columns are dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import Tables
from tidewater.llm.text import _BASE, _INVERSE, SPACE, Sums, flat, hashes, mix, slices, words

WINDOW = 50
#: Bytes of text parsed at once, and rows reduced together.
PIECE, PART = 1 << 20, 1 << 18
SLOTS, HOT = 1 << 16, 1 << 12
#: Rounds of compression: symbols of about two words, of which a window has many.
ROUNDS = 3
FIRST = -(1 << 63)
_RUN, _LEFT, _RIGHT = (np.uint64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93))
_SALTS = mix(np.arange(1, 65, dtype=np.uint64))


class WordSums(Sums):
    """Running sums over the numbers of words, from which any range of words has its number."""

    def __init__(self, h: np.ndarray) -> None:
        steps = np.full(len(h) + 1, _BASE, np.uint64)
        steps[0] = 1
        power = np.cumprod(steps)
        steps[1:] = _INVERSE
        self.back = np.cumprod(steps)
        self.total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * power[:-1], out=self.total[1:])


def _least(value: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Where the least value of each range lo to hi is, the leftmost among equals."""
    size = hi - lo
    out = np.empty(len(lo), np.int64)
    at, width = np.arange(len(value)), 1
    while len(size):
        # Two overlapping ranges of this width cover each range of up to twice the width.
        own = np.flatnonzero((size >= width) & (size < 2 * width))
        a, b = at[lo[own]], at[hi[own] - width]
        out[own] = np.where(value[b] < value[a], b, a)
        if 2 * width > size.max():
            return out
        a, b = at[:len(at) - width], at[width:]
        at = np.where(value[b] < value[a], b, a)
        width *= 2
    return out


def anchors(h: np.ndarray, start: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Word and name of the anchor of each window; ``h``: numbers of all words, ``start``: first words of the windows."""
    name, at = h, np.arange(len(h) + 1)
    live, lo, hi = np.arange(len(start)), start, start + window
    place, found = start.copy(), h[start]
    for level in range(1, rounds + 1):
        # Runs: the first and the last of a window may go on outside.
        first = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
        run = np.zeros(len(name), np.int64)
        run[first[1:]] = 1
        run = np.cumsum(run)
        size = np.diff(np.r_[first, len(name)])
        name = np.where(size > 1, mix(name[first] * _RUN + size.astype(np.uint64)), name[first])
        at = at[np.r_[first, len(at) - 1]]
        lo, hi = run[lo] + 1, run[hi - 1]
        sure = lo < hi
        live, lo, hi = live[sure], lo[sure], hi[sure]
        # Pairs: a first right or a last left name may belong to one outside.
        left = (mix(name ^ _SALTS[level]) & np.uint64(1)).astype(bool)
        lo, hi = lo + ~left[lo], hi - left[hi - 1]
        second = np.zeros(len(name) + 1, bool)
        second[1:-1] = left[:-1] & ~left[1:]
        to = np.cumsum(~second) - 1
        pair = np.flatnonzero(second) - 1
        joined = name.copy()
        joined[pair] = mix(name[pair] * _LEFT + name[pair + 1] * _RIGHT)
        name, at = joined[~second[:-1]], at[~second]
        sure = lo < hi
        live, lo, hi = live[sure], to[lo[sure]], to[hi[sure]]
        if not len(live):
            break
        best = _least(name, lo, hi) if level == rounds else lo
        place[live], found[live] = at[best], name[best] ^ _SALTS[level]
    return place, found


def pieces(data: np.ndarray, off: np.ndarray, window: int = WINDOW):
    """First row, rows, number of the first word, numbers of words and their rows of each piece.

    A long text comes in pieces that begin with the last ``window`` - 1 words of the one before."""
    for lo, hi in slices(off, PIECE):
        if off[hi] - off[lo] <= PIECE:
            own, at = data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
            start, end, row = words(own, at)
            yield lo, hi - lo, 0, hashes(own, start, end), row
            continue
        carry, base = np.zeros(0, np.uint64), 0
        for a, b in cuts(data, int(off[lo]), int(off[hi])):
            own = data[a:b]
            start, end, _ = words(own, np.array([0, b - a]))
            h = np.r_[carry, hashes(own, start, end)]
            yield lo, 1, base, h, np.zeros(len(h), np.int64)
            carry = h[max(0, len(h) - window + 1):]
            base += len(h) - len(carry)


def cuts(data: np.ndarray, a: int, end: int):
    """Ranges of about ``PIECE`` bytes that end after white space, so that no word is cut."""
    while a < end:
        b = a + PIECE
        while b < end:
            gap = np.flatnonzero(SPACE[data[b:min(b + PIECE, end)]])
            if len(gap):
                b += int(gap[0]) + 1
                break
            b += PIECE
        b = min(b, end)
        yield a, b
        a = b


ROWS = "bucket long, refined long, doc long, tag long, code long"
RANGES = "doc long, tag long, lo long, hi long"


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _joined(doc: np.ndarray, tag: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[np.ndarray]:
    """Ranges of windows of one document that touch, as one."""
    if not len(doc):
        return [doc, tag, lo, hi]
    order = np.lexsort((lo, tag, doc))
    doc, tag, lo, hi = doc[order], tag[order], lo[order], hi[order]
    # Ranges of one document never overlap.
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (lo[1:] != hi[:-1] + 1)])
    return [doc[new], tag[new], lo[new], hi[np.r_[new[1:] - 1, len(hi) - 1]]]


def _reduced(held: list[list[np.ndarray]], bits: int):
    """Rows of the least document of each bucket and refined number, then the windows of all others (no refined number)."""
    bucket, refined, doc, tag, code = (np.concatenate(c) for c in zip(*held, strict=True))
    order = np.lexsort((doc, refined, bucket))
    bucket, refined, doc, tag, code = bucket[order], refined[order], doc[order], tag[order], code[order]
    head = np.r_[True, (bucket[1:] != bucket[:-1]) | (refined[1:] != refined[:-1])]
    least = doc == doc[np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))]
    yield pa.RecordBatch.from_arrays([_signed(bucket[least]), _signed(refined[least]), *(pa.array(x[least]) for x in (doc, tag, code))],
                                     names=["bucket", "refined", "doc", "tag", "code"])
    lo = code[~least] >> bits
    doc, tag, lo, hi = _joined(doc[~least], tag[~least], lo, lo + (code[~least] & ((1 << bits) - 1)))
    # As many windows as a code can count; the bucket only spreads the rows.
    most = 1 << bits
    times = (hi - lo) // most + 1
    doc, tag, hi, begin = (np.repeat(x, times) for x in (doc, tag, hi, lo))
    begin += (np.arange(len(begin)) - np.repeat(np.cumsum(times) - times, times)) * most
    code = begin << bits | np.minimum(hi - begin, most - 1)
    yield pa.RecordBatch.from_arrays([pa.array(tag ^ begin), pa.nulls(len(doc), pa.int64()), pa.array(doc), pa.array(tag), pa.array(code)], names=["bucket", "refined", "doc", "tag", "code"])


def _reveal(window: int, rounds: int):
    """Rows of all texts: bucket, refined number, document and code (first window, and how many more)."""
    bits, half = window.bit_length(), window // 2

    def run(batches):
        held: list[list[np.ndarray]] = []
        count = 0
        for batch in batches:
            docs, tags = batch.column(0).fill_null(FIRST).to_numpy(), batch.column(2).to_numpy()
            for first, _, base, h, row in pieces(*flat(batch.column(1)), window):
                start = np.flatnonzero(row[:max(0, len(row) - window + 1)] == row[window - 1:])
                if not len(start):
                    continue
                place, name = anchors(h, start, window, rounds)
                late = place - start >= half
                new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (name[1:] != name[:-1]) | (late[1:] != late[:-1]) | (start[1:] != start[:-1] + 1)])
                place, late, name = place[new], late[new], name[new]
                lo, hi = start[new], start[np.r_[new[1:] - 1, len(start) - 1]]
                sums = WordSums(h)
                # All windows of the row hold these words.
                bucket = sums.of(np.where(late, place - half, place), np.where(late, place + 1, place + window - half + 1)) ^ name
                refined = mix(sums.of(lo, hi + window) + (place - lo).astype(np.uint64))
                own = first + row[lo]
                # Words are numbered within their text.
                begin = np.searchsorted(row, row[lo])
                held.append([bucket, refined, docs[own], tags[own], (lo - begin + base) << bits | (hi - lo)])
                count += len(lo)
                if count >= PART:
                    yield from _reduced(held, bits)
                    held, count = [], 0
        if count:
            yield from _reduced(held, bits)

    return run


def _verify(window: int):
    """The windows of open rows by number, reduced like rows of one window each."""
    bits = window.bit_length()

    def run(batches):
        held: list[list[np.ndarray]] = []
        count = 0
        for batch in batches:
            docs, tags = batch.column(0).fill_null(FIRST).to_numpy(), batch.column(2).to_numpy()
            found = batch.column(3)
            listed = np.repeat(np.arange(batch.num_rows), np.diff(found.offsets.to_numpy()))
            bucket, code = (found.flatten().field(k).to_numpy() for k in (0, 1))
            for first, n, base, h, row in pieces(*flat(batch.column(1)), window):
                begin = np.searchsorted(row, np.arange(n + 1))
                at = np.arange(*np.searchsorted(listed, [first, first + n]))
                lo, more = code[at] >> bits, code[at] & ((1 << bits) - 1)
                which = np.repeat(at, more + 1)
                start = np.repeat(lo, more + 1) + np.arange(len(which)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
                own = listed[which] - first
                # Other pieces of a long text hold the other windows.
                here = (start >= base) & (start - base + begin[own] + window <= begin[own + 1])
                which, start, own = which[here], start[here], own[here]
                word = start - base + begin[own]
                number = WordSums(h).of(word, word + window)
                held.append([bucket[which].view(np.uint64), number, docs[own + first], tags[own + first], start << bits])
                count += len(which)
                if count >= PART:
                    yield from _reduced(held, bits)
                    held, count = [], 0
        if count:
            yield from _reduced(held, bits)

    return run


def _range(bits: int) -> list[Column]:
    lo = F.shiftright("code", bits)
    return [F.col("doc"), F.col("tag"), lo.alias("lo"), (lo + F.col("code").bitwiseAND(F.lit((1 << bits) - 1))).alias("hi")]


def repeated_windows(rows: DataFrame, tables: Tables, window: int, rounds: int) -> DataFrame:
    """doc, tag, lo, hi: first words of windows that a smaller document also has. ``rows``: doc_id, text, tag."""
    bits = window.bit_length()
    all_ = tables.cut(rows.mapInArrow(_reveal(window, rounds), ROWS), "anchors")
    live, decided = all_.where("refined IS NOT NULL"), all_.where("refined IS NULL").select(*_range(bits))
    slot = F.shiftrightunsigned("bucket", 64 - SLOTS.bit_length() + 1).cast("int")
    counts = live.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()
    # Fewer than HOT slots.
    most = sum(r.n for r in counts) // HOT
    hot = [r.slot for r in counts if r.n > most]
    salt = F.when(slot.isin(hot), F.col("refined")).otherwise(0) if hot else F.lit(0).cast("long")
    same, bucket = Window.partitionBy("bucket", "salt", "refined"), Window.partitionBy("bucket", "salt")
    # One shuffle serves both windows.
    seen = live.withColumn("salt", salt).repartition("bucket", "salt").withColumn("least", F.min("doc").over(same)).withColumn("open", F.min("least").over(bucket) < F.max("least").over(bucket))
    if hot:
        seen = seen.withColumn("open", F.col("open") | slot.isin(hot))
    found = tables.cut(seen.where("doc > least OR open").select("bucket", *_range(bits), "code", (F.col("doc") > F.col("least")).alias("repeats")), "open")
    ranges = decided.union(found.where("repeats").select("doc", "tag", "lo", "hi"))
    open_ = found.where("NOT repeats").groupBy("doc", "tag").agg(F.collect_list(F.struct("bucket", "code")).alias("ranges"))
    # The same columns as in the last join of remove_repeats, which reuses this shuffle of the texts.
    texts = rows.withColumn("doc", F.coalesce("doc_id", F.lit(FIRST))).join(open_, ["doc", "tag"]).select("doc_id", "text", "tag", "ranges")
    single = texts.mapInArrow(_verify(window), ROWS).withColumn("least", F.min("doc").over(Window.partitionBy("bucket", "refined")))
    return ranges.union(single.where("refined IS NULL OR doc > least").select(*_range(bits)))


def remove_repeats(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (the words left, joined by a space) and spans (start and end word) of every row."""
    tables = Tables(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tag", F.xxhash64("doc_id", "text"))
    lost = repeated_windows(rows, tables, window, rounds).groupBy("doc", "tag").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    whole = rows.withColumn("doc", F.coalesce("doc_id", F.lit(FIRST))).join(lost, ["doc", "tag"], "left").select("doc_id", "text", "tag", "ranges")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, spans array<struct<start: long, end: long>>"

    def run(batches):
        for batch in batches:
            data, off = flat(batch.column(1))
            size, removed, digest, kept, spans = [], [], [], [], []
            for k, found in enumerate(batch.column(3).to_pylist()):
                gone = []
                for lo, hi in sorted({(r["lo"], r["hi"] + window) for r in found or ()}):
                    if gone and lo <= gone[-1][1]:
                        gone[-1][1] = max(gone[-1][1], hi)
                    else:
                        gone.append([lo, hi])
                out, n, next_ = [], 0, 0
                for a, b in cuts(data, int(off[k]), int(off[k + 1])):
                    own = data[a:b].tobytes().split()
                    at = 0
                    while next_ < len(gone) and gone[next_][0] < n + len(own):
                        out += own[at:max(at, gone[next_][0] - n)]
                        at = max(at, min(gone[next_][1] - n, len(own)))
                        if gone[next_][1] > n + len(own):
                            break
                        next_ += 1
                    out += own[at:]
                    out = [b" ".join(out)] if out else out
                    n += len(own)
                rest = b" ".join(out)
                size.append(n)
                removed.append(sum(b - a for a, b in gone))
                digest.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
                spans.append([{"start": a, "end": b} for a, b in gone])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.binary()).cast(pa.string()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "spans"])

    return whole.mapInArrow(run, schema)
