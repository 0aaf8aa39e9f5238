"""Removal of repeated strings by bucket-pointer refinement over sampled suffixes.

A byte is removed if a string of ``length`` bytes covers it that also starts earlier: in a
document with a smaller id (or tag, below), or earlier in the same document. Strings are judged on the
input, overlaps count, and matches never cross documents.

Suffixes are sorted by their first bytes into q-gram buckets, and a bucket is refined by
the bucket numbers of its members' later offsets; refined numbers serve the next step
again: from q = 8 to 16 and 32 bytes, to ``GRAM`` = 40, 80 and 100. The numbers are 64-bit
fingerprints of the bytes, so the number at a later offset is known in the task that reads
the text and no rank table is held anywhere. Only suffixes that decide are sorted across
tasks:

1. Every string is represented by the suffix at its least ``GRAM`` bucket number (leftmost
   among equals), so equal strings meet in one bucket. The strings of one suffix, which
   are neighbours, form one refined number.
2. Buckets are sorted by refined number and place. In a refined bucket all but the first
   suffix repeat all their strings. A bucket that holds a single refined number is done.
3. In buckets of several refined numbers the first suffixes may still share some of their
   strings. A string that starts k bytes before the suffix also holds the 40-byte buckets
   40 before, 20 before and 20 after, or 40 after it, for k in three classes; each row
   carries 12 bits of these. A class that no other suffix of the bucket agrees with holds
   no common string and is done. The others are split into their strings, which are
   sorted by their own number: again all but the first repeat.

Equal suffixes of one part of the input are reduced to the first before the shuffle, so a
string that is everywhere sends at most one row from each part.

Null texts are empty; texts shorter than ``length`` lose nothing. Rows of one id and one
text are one document, so equal rows give equal results; other texts of that id, or of the
null id, are documents of their own, in the order of a hash (``tag``) of id and text. Null
ids come before all others. An empty table gives an empty result. Further columns are dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import cut
from tidewater.llm.text import flat

LENGTH = 100
GRAM = 40
#: Bytes whose suffixes are numbered at once, and suffixes reduced together.
PIECE, PART = 1 << 20, 1 << 19
_A, _B = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)
FIRST = -(1 << 63)


def _refine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of pairs of buckets."""
    h = left * _A + right
    h ^= h >> np.uint64(29)
    h *= _B
    h ^= h >> np.uint64(32)
    return h


def bucket_numbers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the GRAM bytes and of the LENGTH bytes that start at each offset."""
    n = len(data)
    pad = np.concatenate([data, np.zeros(16, np.uint8)])
    h = np.empty(n + 8, np.uint64)
    for k in range(8):
        view = pad[k:k + (n + 15 - k) // 8 * 8].view(np.uint64)
        h[k::8] = view[:len(h[k::8])]
    h = h[:n - 7]
    for step in (8, 16, GRAM - 32):
        h = _refine(h[:-step], h[step:])
    whole = _refine(h[:-GRAM], h[GRAM:])
    rest = LENGTH - 2 * GRAM
    return h, _refine(whole[:-rest], whole[rest:])


def suffixes(data: np.ndarray, off: np.ndarray):
    """row, first and last string start, bucket, refined number and code of each suffix that represents strings of one row.

    The code holds last minus first start (6 bits), suffix minus first start (6 bits),
    and 12 bits of the neighbouring buckets of each class of strings."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none
    h, whole = bucket_numbers(data)
    n = len(whole)
    # The least number of the GRAM buckets within each string, by windows of doubled width.
    least, at, width = h, np.arange(len(h), dtype=np.int32), 1
    want = LENGTH - GRAM + 1
    while width < want:
        step = min(width, want - width)
        later = least[step:] < least[:-step]
        least, at = np.where(later, least[step:], least[:-step]), np.where(later, at[step:], at[:-step])
        width += step
    valid = np.zeros(n, bool)
    size = np.diff(off)
    for k in np.flatnonzero(size >= LENGTH):
        valid[off[k]:off[k + 1] - LENGTH + 1] = True
    start = np.flatnonzero(valid)
    if not len(start):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none
    at = at[start].astype(np.int64)
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)])
    lo, hi = start[new], start[np.r_[new[1:] - 1, len(start) - 1]]
    anchor = at[new]
    part = _refine(whole[start], (at - start).astype(np.uint64))
    refined = np.add.reduceat(part, new)

    def near(step: int) -> np.ndarray:
        # Past the ends only where the class has no string.
        return h[np.clip(anchor + step, 0, len(h) - 1)]

    code = (hi - lo) | (anchor - lo) << 6
    for k, number in enumerate((near(GRAM), _refine(near(-GRAM // 2), near(GRAM // 2)), near(-GRAM))):
        code |= (number >> np.uint64(52)).astype(np.int64) << (12 + 12 * k)
    return np.searchsorted(off, lo, "right") - 1, lo, hi, h[anchor], refined, code


def _places(ids: np.ndarray, column):
    """Pieces of a column: ids of the rows, offset of the piece in its row, bytes, offsets."""
    data, off = flat(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        if off[lo + 1] - off[lo] > PIECE:
            # A long text: pieces that overlap by one string less one byte.
            for a in range(off[lo], off[lo + 1], PIECE):
                b = min(a + PIECE + LENGTH - 1, off[lo + 1])
                yield ids[lo:lo + 1], int(a - off[lo]), data[a:b], np.array([0, b - a])
            lo += 1
            continue
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + PIECE, "right")) - 1)
        yield ids[lo:hi], 0, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


#: Rows that are decided have no refined number, any bucket, and last minus first start as code.
SUFFIX = "bucket long, refined long, doc long, tag long, lo long, code long"
NAMES = ["bucket", "refined", "doc", "tag", "lo", "code"]
#: Least and greatest k of the three classes of strings.
CLASSES = ((0, 19), (20, 39), (40, 60))


def _suffix_rows(batches):
    """Suffixes of all texts; those that repeat one of the same part have no refined number, as they are decided."""
    held: list[list[np.ndarray]] = []
    count = 0

    def reduced():
        bucket, refined, doc, tag, lo, code = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((lo, tag, doc, refined, bucket))
        bucket, refined, doc, tag, lo, code = bucket[order], refined[order], doc[order], tag[order], lo[order], code[order]
        first = np.r_[True, (bucket[1:] != bucket[:-1]) | (refined[1:] != refined[:-1])]
        head = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        # The same place again (an equal row) is no repeat.
        own = (doc == doc[head]) & (tag == tag[head]) & (lo == lo[head])
        lone = ~own
        keep = own & first
        found = _joined(doc[lone], tag[lone], lo[lone], lo[lone] + (code[lone] & 63))
        yield pa.RecordBatch.from_arrays([pa.array(_signed(bucket[keep])), pa.array(_signed(refined[keep])),
                                          pa.array(doc[keep]), pa.array(tag[keep]), pa.array(lo[keep]), pa.array(code[keep])], names=NAMES)
        yield _decided(*found)

    for batch in batches:
        docs, tags = batch.column(0).fill_null(FIRST).to_numpy(), batch.column(2).to_numpy()
        for own, base, data, off in _places(np.arange(batch.num_rows), batch.column(1)):
            row, lo, _, bucket, refined, code = suffixes(data, off)
            held.append([bucket, refined, docs[own[row]], tags[own[row]], lo - off[row] + base, code])
            count += len(row)
            if count >= PART:
                yield from reduced()
                held, count = [], 0
    if count:
        yield from reduced()


def _decided(doc: np.ndarray, tag: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    # Their bucket only spreads them over tasks.
    return pa.RecordBatch.from_arrays([pa.array(tag + lo), pa.nulls(len(doc), pa.int64()), *(pa.array(x) for x in (doc, tag, lo, hi - lo))], names=NAMES)


def _joined(doc: np.ndarray, tag: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Ranges of one document that touch, as one."""
    if not len(doc):
        return doc, tag, lo, hi
    order = np.lexsort((lo, tag, doc))
    doc, tag, lo, hi = doc[order], tag[order], lo[order], hi[order]
    # Ranges of a part never overlap.
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (lo[1:] != hi[:-1] + 1)])
    return doc[new], tag[new], lo[new], hi[np.r_[new[1:] - 1, len(hi) - 1]]


def _common(group: np.ndarray, lo: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of the strings that each suffix may share with another of its group; first > last: none."""
    anchor, hi = lo + (code >> 6 & 63), lo + (code & 63)
    first, last = hi + 1, lo - 1
    for k, (least, most) in enumerate(CLASSES):
        a, b = np.maximum(lo, anchor - most), np.minimum(hi, anchor - least)
        at = np.flatnonzero(a <= b)
        key = group[at] << 12 | code[at] >> (12 + 12 * k) & 0xFFF
        _, which, n = np.unique(key, return_inverse=True, return_counts=True)
        at = at[n[which] > 1]
        first[at], last[at] = np.minimum(first[at], a[at]), np.maximum(last[at], b[at])
    return first, last


def _repeats(batches):
    """Rows sorted by bucket, refined number and place: the ranges that repeat (no bucket), and
    what the first suffixes of buckets with several refined numbers may share."""
    last: tuple | None = None  # first row of the refined bucket that is open: bucket, refined, doc, tag, lo, code
    several = False
    for batch in batches:
        bucket, refined, doc, tag, lo, code = (c.fill_null(0).to_numpy() for c in batch.columns)
        decided = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        yield _ranges(None, doc[decided], tag[decided], lo[decided], lo[decided] + code[decided])
        live = ~decided
        bucket, refined, doc, tag, lo, code = bucket[live], refined[live], doc[live], tag[live], lo[live], code[live]
        n = len(bucket)
        if not n:
            continue
        if last is not None:
            bucket, refined, doc, tag, lo, code = (np.r_[np.array([x], c.dtype), c] for x, c in zip(last, (bucket, refined, doc, tag, lo, code), strict=True))
        other = np.r_[True, bucket[1:] != bucket[:-1]]
        first = other | np.r_[True, refined[1:] != refined[:-1]]
        at = np.arange(len(bucket))
        head = np.maximum.accumulate(np.where(first, at, 0))
        repeat = (doc != doc[head]) | (tag != tag[head]) | (lo != lo[head])
        yield _ranges(None, doc[repeat], tag[repeat], lo[repeat], lo[repeat] + (code[repeat] & 63))
        # Heads of refined buckets; the last one stays open until its bucket's end is seen.
        heads = np.flatnonzero(first)
        group = np.cumsum(other[heads])
        sizes = np.bincount(group)
        mixed = sizes[group] > 1
        if several:
            mixed |= group == group[0]
        # A bucket that goes on may yet become mixed, so its only head waits.
        closing = heads[-1]
        # A bucket of which other batches hold a part is sent whole.
        part = group == group[-1]
        if several:
            part |= group == group[0]
        send = heads[mixed & part & (heads != closing)]
        yield _ranges(bucket[send], doc[send], tag[send], lo[send], lo[send] + (code[send] & 63))
        send, own = heads[mixed & ~part], group[mixed & ~part]
        a, b = _common(own, lo[send], code[send])
        send, a, b = send[a <= b], a[a <= b], b[a <= b]
        yield _ranges(bucket[send], doc[send], tag[send], a, b)
        several = bool(mixed[-1])
        last = (bucket[closing], refined[closing], doc[closing], tag[closing], lo[closing], code[closing])
    if last is not None and several:
        yield _ranges(*(np.array([x]) for x in (last[0], last[2], last[3], last[4], last[4] + (last[5] & 63))))


def _ranges(bucket, doc, tag, lo, hi) -> pa.RecordBatch:
    bucket = pa.nulls(len(doc), pa.int64()) if bucket is None else pa.array(bucket, pa.int64())
    return pa.RecordBatch.from_arrays([bucket, *(pa.array(x, pa.int64()) for x in (doc, tag, lo, hi))], names=["bucket", "doc", "tag", "lo", "hi"])


def _strings(batches):
    """Number and place of each string of the ranges given; equal ones of a batch only once, the others as decided."""
    for batch in batches:
        ids, tags = batch.column(0).fill_null(FIRST).to_numpy(), batch.column(3).to_numpy()
        lists = batch.column(2).to_pylist()
        held = []
        data, off = flat(batch.column(1))
        for k, found in enumerate(lists):
            text = data[off[k]:off[k + 1]]
            for r in found:
                _, whole = bucket_numbers(text[r["lo"]:r["hi"] + LENGTH])
                held.append((whole[:r["hi"] - r["lo"] + 1], np.full(r["hi"] - r["lo"] + 1, ids[k]), np.full(r["hi"] - r["lo"] + 1, tags[k]), np.arange(r["lo"], r["hi"] + 1),
                             np.full(r["hi"] - r["lo"] + 1, r["bucket"] & 0xFFFFFFFF)))
        if not held:
            continue
        number, doc, tag, lo, bucket = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((lo, tag, doc, number, bucket))
        number, doc, tag, lo, bucket = number[order], doc[order], tag[order], lo[order], bucket[order]
        first = np.r_[True, (bucket[1:] != bucket[:-1]) | (number[1:] != number[:-1])]
        head = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        repeat = (doc != doc[head]) | (tag != tag[head]) | (lo != lo[head])
        # Half of the bucket number beside the string's own: 96 bits.
        yield pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array(_signed(number[first])), pa.array(doc[first]), pa.array(tag[first]), pa.array(lo[first]),
                                          pa.array(np.zeros(int(first.sum()), np.int64))], names=NAMES)
        yield _decided(*_joined(doc[repeat], tag[repeat], lo[repeat], lo[repeat]))


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket").sortWithinPartitions("bucket", "refined", "doc", "tag", "lo")


def repeated_ranges(rows: DataFrame) -> DataFrame:
    """doc, tag, lo, hi: starts of strings that also start earlier. ``rows``: doc_id, text, tag."""
    out = "bucket long, doc long, tag long, lo long, hi long"
    found = cut(_sorted(rows.mapInArrow(_suffix_rows, SUFFIX)).mapInArrow(_repeats, out), "suffixes")
    open_ = (found.where("bucket IS NOT NULL").groupBy("doc", "tag").agg(F.collect_list(F.struct("bucket", "lo", "hi")).alias("ranges")))
    # The same columns as in the last join of remove_repeats, which reuses this shuffle of the texts.
    texts = rows.withColumn("doc", F.coalesce("doc_id", F.lit(FIRST))).join(open_, ["doc", "tag"]).select("doc_id", "text", "ranges", "tag")
    fine = _sorted(texts.mapInArrow(_strings, SUFFIX)).mapInArrow(_repeats, out)
    return found.where("bucket IS NULL").union(fine.where("bucket IS NULL")).select("doc", "tag", "lo", "hi")


def remove_repeats(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary) and spans (array of start, end) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tag", F.xxhash64("doc_id", "text"))
    lost = repeated_ranges(rows).groupBy("doc", "tag").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    whole = rows.withColumn("doc", F.coalesce("doc_id", F.lit(FIRST))).join(lost, ["doc", "tag"], "left").select("doc_id", "text", "ranges", "tag")
    schema = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, "
              "spans array<struct<start: long, end: long>>")

    def run(batches):
        for batch in batches:
            data, off = flat(batch.column(1))
            size, removed, spans, digest, kept, where = [], [], [], [], [], []
            for k, found in enumerate(batch.column(2).to_pylist()):
                own = data[off[k]:off[k + 1]]
                mark = np.zeros(len(own) + 1, np.int32)
                if found:
                    np.add.at(mark, [r["lo"] for r in found], 1)
                    np.add.at(mark, [r["hi"] + LENGTH for r in found], -1)
                gone = np.cumsum(mark[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8))).reshape(-1, 2)
                rest = own[~gone].tobytes() if found else own.tobytes()
                size.append(len(own))
                removed.append(len(own) - len(rest))
                spans.append(len(edge))
                digest.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
                where.append([{"start": int(a), "end": int(b)} for a, b in edge])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string()),
                 pa.array(kept, pa.binary()), pa.array(where, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    return whole.mapInArrow(run, schema)
