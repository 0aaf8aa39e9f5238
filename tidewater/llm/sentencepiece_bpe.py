"""SentencePiece encoding and decoding for merge-type vocabularies.

An agenda holds the adjacent symbol pairs that form a piece; the pair of the best
score (the leftmost among equals) is merged, its new neighbours enter the agenda,
until none is left. Symbols outside the vocabulary become byte pieces.

A text is cut before every run of meta spaces. No piece of such a vocabulary has a
space after a letter (checked when the model is loaded; otherwise a text is one
chunk), so merges never cross a cut and each distinct chunk is encoded once per
worker. New chunks of an Arrow batch are encoded together and compared with the
sentencepiece library; a difference stops the job.

Nulls and empty texts have the begin and end ids only. Each row stands alone, so
ties, repeated rows, empty tables and further columns change nothing.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidewater.llm.text import flat, slices

SPACE = "▁"
#: Chunks kept by a worker in each of two generations.
CACHED = 1 << 17
#: Chunks with more symbols than this use a heap, not rounds over many chunks.
LONG = 48
#: Characters of text tokenized at once, chunks looked up and chunks merged together.
PART_CHARS, HELD, TOGETHER = 1 << 20, 1 << 18, 1 << 13

#: Bytes of texts encoded together.
SLICE = 1 << 21

_loaded: dict[str, Encoder] = {}


class Encoder:
    """One model with the chunks that this worker has met."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.lib.get_piece_size()
        kinds = [self.lib.is_control(i) or self.lib.is_unknown(i) or self.lib.is_byte(i) or self.lib.is_unused(i) for i in range(n)]
        pieces = {self.lib.id_to_piece(i): i for i in range(n) if not kinds[i]}
        self.bytes = [self.lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bos, self.eos = self.lib.bos_id(), self.lib.eos_id()
        if self.bos < 0 or self.eos < 0 or self.lib.unk_id() in self.bytes:
            raise ValueError("the model needs begin, end and byte pieces")
        if self.lib.normalize(" a  Éẛﬁ ") != SPACE + " a  Éẛﬁ ".replace(" ", SPACE):
            raise ValueError("only the identity normalizer with a leading space is supported")
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.size, self.width = n, [1] * n
        for p, i in pieces.items():
            self.width[i] = len(p)
        #: Characters without a piece get numbers from ``size`` on: those in longer pieces here, all others 1.
        self.char = {p: i for p, i in pieces.items() if len(p) == 1}
        for p in pieces:
            for c in p:
                if c not in self.char:
                    self.char[c] = n + 2 + len(self.char)
        self.symbol = np.full(0x110000, n + 1, np.int32)
        for c, i in self.char.items():
            self.symbol[ord(c)] = i
        known = pieces | self.char
        pairs = {}
        for p, i in pieces.items():
            for k in range(1, len(p)):
                a, b = known.get(p[:k]), known.get(p[k:])
                if a is not None and b is not None:
                    pairs[a, b] = (self.lib.get_score(i), i)
        self.pairs = pairs
        order = sorted((a << 32 | b, s, i) for (a, b), (s, i) in pairs.items())
        self.keys = np.array([x[0] for x in order] + [np.iinfo(np.int64).max], np.int64)
        self.scores = np.array([x[1] for x in order] + [-np.inf], np.float32)
        self.merged = np.array([x[2] for x in order] + [0], np.int64)
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.begin, self.end = struct.pack("<I", self.bos), struct.pack("<I", self.eos)

    # One long chunk: a heap of (best score, leftmost) pairs over a linked list.
    def agenda(self, sym: list[int]) -> list[int]:
        n = len(sym)
        left, right, live = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
        heap: list[tuple[float, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (found := self.pairs.get((sym[i], sym[j]))):
                heap.append((-found[0], i, j, sym[i], sym[j])) if building else heapq.heappush(heap, (-found[0], i, j, sym[i], sym[j]))

        building = True
        for i in range(n - 1):
            offer(i, i + 1)
        heapq.heapify(heap)
        building = False
        while heap:
            _, i, j, a, b = heapq.heappop(heap)
            if not (live[i] and live[j] and sym[i] == a and sym[j] == b and right[i] == j):
                continue
            sym[i], live[j] = self.pairs[a, b][1], False
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [s for s, ok in zip(sym, live, strict=True) if ok]

    def _look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = a << 32 | b
        at = np.searchsorted(self.keys, key)
        hit = self.keys[at] == key
        return np.where(hit, self.scores[at], -np.inf).astype(np.float32), np.where(hit, self.merged[at], 0)

    # Many short chunks at once: every round takes the best pair of each chunk's agenda.
    def rounds(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of the chunk and symbol, in order."""
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        sym = self.symbol[np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)].astype(np.int64)
        own = np.repeat(np.arange(len(chunks)), size)
        done = [(own[:0], sym[:0])]
        score, into = np.full(len(sym), -np.inf, np.float32), np.zeros(len(sym), np.int64)

        def price(at: np.ndarray) -> None:
            at = at[(at >= 0) & (at < len(sym))]
            inner = at[at + 1 < len(sym)]
            inner = inner[own[inner] == own[inner + 1]]
            score[at] = -np.inf
            score[inner], into[inner] = self._look(sym[inner], sym[inner + 1])

        price(np.arange(len(sym)))
        while len(sym):
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            best = np.maximum.reduceat(score, first)
            length = np.diff(np.r_[first, len(sym)])
            over = best == -np.inf
            goes_on = ~np.repeat(over, length)
            done.append((own[~goes_on], sym[~goes_on]))
            # The leftmost pair of the best score in each chunk that goes on.
            place = np.flatnonzero((score == np.repeat(best, length)) & goes_on)
            place = place[np.r_[True, own[place][1:] != own[place][:-1]]] if len(place) else place
            sym[place] = into[place]
            keep = goes_on
            keep[place + 1] = False
            moved = (np.cumsum(keep) - 1)[place]
            sym, own, score, into = sym[keep], own[keep], score[keep], into[keep]
            price(np.r_[moved - 1, moved])
        own, sym = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(own, kind="stable")
        return own[order], sym[order]

    def _symbols(self, chunk: str) -> list[int]:
        get, other = self.char.get, self.size + 1
        return [get(c, other) for c in chunk]

    def _ids(self, chunk: str, sym: list[int]) -> list[int]:
        """Byte pieces for symbols outside the vocabulary."""
        if max(sym) < self.size:
            return sym
        out, at = [], 0
        for s in sym:
            k = self.width[s] if s < self.size else 1
            out.extend([s] if s < self.size else [self.bytes[b] for b in chunk[at].encode()])
            at += k
        return out

    def learn(self, chunks: list[str], check: bool) -> dict[str, bytes]:
        """Encode chunks not met before, and hold them against the library."""
        short = [c for c in chunks if len(c) <= LONG]
        own, sym = self.rounds(short)
        end = np.cumsum(np.bincount(own, minlength=len(short)))
        whole, at = sym.astype("<u4").tobytes(), 0
        out = {}
        for c, stop in zip(short, (end * 4).tolist(), strict=True):
            out[c] = whole[at:stop]
            at = stop
        # Byte pieces, and chunks with an agenda of their own.
        slow = {short[k]: sym[end[k - 1] if k else 0:end[k]].tolist() for k in np.unique(own[sym >= self.size]).tolist()}
        slow |= {c: self.agenda(self._symbols(c)) for c in chunks if len(c) > LONG}
        for c, found in slow.items():
            ids = self._ids(c, found)
            out[c] = struct.pack(f"<{len(ids)}I", *ids)
        if check:
            # The library puts the leading space back itself.
            tested = [c for c in chunks if c[0] == SPACE and len(c) > 1]
            theirs = self.lib.encode([c[1:] for c in tested], num_threads=1)
            flat = np.fromiter(chain.from_iterable(theirs), "<u4").tobytes()
            if b"".join([out[c] for c in tested]) != flat:
                wrong = next((c for c, ids in zip(tested, theirs, strict=True) if out[c] != struct.pack(f"<{len(ids)}I", *ids)), "")
                raise ValueError(f"encoding differs from the library for {wrong[:80]!r}")
        return out

    def meet(self, chunks: set[str], check: bool) -> None:
        """Bring distinct chunks into the new generation, from the old one or by learning them."""
        if len(self.new) + len(chunks) > CACHED:
            self.old, self.new = self.new, {}
        rest = chunks.difference(self.new)
        met = rest.intersection(self.old)
        self.new.update(zip(met, map(self.old.__getitem__, met), strict=True))
        missing = list(rest - met)
        for lo in range(0, len(missing), TOGETHER):
            self.new |= self.learn(missing[lo:lo + TOGETHER], check)

    def _parts(self, text: str) -> Iterator[list[str]]:
        """The chunks of a text, some at a time."""
        text = SPACE + text.replace(" ", SPACE)
        if not self.cuts:
            yield [text]
            return
        at = 0
        while at < len(text):
            stop = at + PART_CHARS
            if stop < len(text):
                # Up to the start of a run of spaces after another character.
                found = re.compile(f"(?<=[^{SPACE}]){SPACE}").search(text, stop)
                stop = found.start() if found else len(text)
            part = text[at:stop]
            if SPACE * 2 in part or part[-1] == SPACE:
                yield re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+$", part)
            else:
                yield [SPACE + w for w in part[1:].split(SPACE)]
            at = stop

    def encode(self, texts: list[str], check: bool = True) -> list[bytes]:
        """Ids of each text as little-endian numbers of 32 bits, begin and end ids included."""
        out = [[self.begin] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        count = 0

        def flush() -> None:
            self.meet(set().union(*[chunks for _, chunks in held]), check)
            for k, chunks in held:
                out[k].append(b"".join(map(self.new.__getitem__, chunks)))
            held.clear()

        for k, text in enumerate(texts):
            for chunks in self._parts(text) if text else ():
                held.append((k, chunks))
                count += len(chunks)
                if count >= HELD:
                    flush()
                    count = 0
        flush()
        return [b"".join([*ids, self.end]) for ids in out]

    def decode(self, ids: list[bytes]) -> list[str]:
        return self.lib.decode([np.frombuffer(x, "<u4").tolist() for x in ids])


def encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def encode(df: DataFrame, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), check: bool = True,
           decode: bool = True) -> DataFrame:
    """``keep`` columns, ``ids`` (binary, little-endian 32-bit numbers) and ``decoded`` of every text.

    ``model`` is a path that every executor can read. With ``check`` every new chunk is compared with the
    sentencepiece library. ``decoded`` is null unless ``decode`` is set.
    """
    from pyspark.sql import types as T

    fields = [df.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def run(batches):
        enc = encoder(model)
        for batch in batches:
            _, off = flat(batch.column(len(keep)))
            for lo, hi in slices(off, SLICE):
                some = pc.fill_null(batch.column(len(keep)).slice(lo, hi - lo), "").to_pylist()
                ids = enc.encode(some, check)
                back = enc.decode(ids) if decode else [None] * len(ids)
                own = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*own.columns[:len(keep)], pa.array(ids, pa.binary()), pa.array(back, pa.string())], names=schema.names)

    return df.select(*keep, text).mapInArrow(run, schema)
