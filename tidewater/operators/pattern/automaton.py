"""Row patterns of any length over keys of any size, without a time bound.

The pattern becomes positions (its variables), each with an ordered list of what may come
next. Whether a position can still lead to a full match depends on the rows from there on, so
these sets are found backward, and a set is a sum of what its members give:

1. each (key, chunk) hands on, for every position that may hold at its end, the positions that
   hold at its beginning: a table of as many sets as there are positions,
2. the tables are run through per key from the last chunk to the first (one row per chunk),
3. each chunk, knowing what holds after it, walks forward from its starts: among the next
   positions that hold, the first is the preferred one. No walk fails, so none is taken back.

A walk that leaves its chunk goes on in the next one from a position; these continuations do
not depend on where the walk began, so each chunk hands them out once per position, and
open matches are joined with them until all have ended. With SKIP PAST LAST ROW a chunk
walks only from starts that some way of entering it reaches, so long loops cost no more than their rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators import sequence as S
from tidewater.operators.pattern.groups import match_groups
from tidewater.operators.pattern.skip import KEY_TEXT
from tidewater.operators.pattern.spec import PatternError
from tidewater.session import work_dir

ACCEPT = -1
#: Conditions on a step from one row to the next: the new row is its partition's first, the old row its last.
FIRST, LAST = 1, 2


class Positions:
    """Positions of a row pattern: ``slots`` (variable, hidden), ``first`` and ``follow`` (position, conditions) by preference."""

    def __init__(self, pattern) -> None:
        self.slots: list[tuple[str, bool]] = []
        self.follow: list[list[tuple[int, int]]] = []
        self._at: dict[tuple, int] = {}
        self._then: list[Callable[[], list]] = []
        self._open: set[tuple] = set()
        self.first = _once(self._enter(pattern, (), False, lambda: [(ACCEPT, 0)]))
        while len(self.follow) < len(self.slots):
            # No row after another is the first of its partition.
            self.follow.append([(t, c) for t, c in _once(self._then[len(self.follow)]()) if not c & FIRST])

    def _enter(self, node, path: tuple, hide: bool, then: Callable[[], list]) -> list[tuple[int, int]]:
        if node.kind == "var":
            if path not in self._at:
                self._at[path] = len(self.slots)
                self.slots.append((node.name, hide))
                self._then.append(then)
            return [(self._at[path], 0)]
        if node.kind == "exclude":
            return self._enter(node.parts[0], (*path, 0), True, then)
        if node.kind in ("start", "end"):
            flag = FIRST if node.kind == "start" else LAST
            return [(t, c | flag) for t, c in then()]
        if node.kind == "alt":
            return [x for i, p in enumerate(node.parts) for x in self._enter(p, (*path, i), hide, then)]
        if node.kind == "seq":
            def rest(i: int) -> list:
                return then() if i == len(node.parts) else self._enter(node.parts[i], (*path, i), hide, lambda: rest(i + 1))

            return rest(0)

        def again(k: int) -> list:
            # Rounds beyond the least number of an unbounded loop are the same.
            k = min(k, node.low) if node.high is None else k
            here = (*path, k)
            if here in self._open:
                # A round that took no row.
                return []
            self._open.add(here)
            more = self._enter(node.parts[0], here, hide, lambda: again(k + 1)) if node.high is None or k < node.high else []
            self._open.discard(here)
            stop = then() if k >= node.low else []
            return more + stop if node.greedy else stop + more

        return again(0)


def _once(found: list) -> list:
    return list(dict.fromkeys(found))


class Walker:
    """Sets and steps over rows given as masks of the conditions that hold."""

    def __init__(self, pos: Positions, names: list[str]) -> None:
        self.pos = pos
        self.bit = [names.index(n) for n, _ in pos.slots]
        self.is_first, self.is_last = 1 << len(names), 1 << len(names) + 1
        self._sets: dict[tuple[int, int], int] = {}
        self._steps: dict[tuple[bool, int, int], int] = {}
        self._starts: dict[tuple[int, int], int] = {}

    def before(self, mask: int, after: int) -> int:
        """The positions that hold at a row, given those that hold at the next one."""
        found = self._sets.get((mask, after))
        if found is None:
            found = 0
            for s, b in enumerate(self.bit):
                if mask >> b & 1 and self.step(mask, after, s) is not None:
                    found |= 1 << s
            self._sets[mask, after] = found
        return found

    def step(self, mask: int, after: int, s: int) -> int | None:
        """Where position ``s`` at a row goes on: the first that holds."""
        key = (bool(mask & self.is_last), after, s)
        if key not in self._steps:
            self._steps[key] = next((t for t, c in self.pos.follow[s] if (not c & LAST or key[0]) and (t == ACCEPT or after >> t & 1)), None)
        return self._steps[key]

    def start(self, mask: int, here: int) -> int | None:
        """The position that a match beginning at a row begins with; an empty match is none."""
        key = (mask & self.is_first, here)
        if key not in self._starts:
            t = next((t for t, c in self.pos.first if (not c & FIRST or key[0]) and not (t == ACCEPT and c & LAST) and (t == ACCEPT or here >> t & 1)), None)
            self._starts[key] = None if t == ACCEPT else t
        return self._starts[key]

    def sets(self, masks: list[int], after: int) -> list[int]:
        """Per row the positions that hold, and what holds after the last."""
        out = [after] * (len(masks) + 1)
        for p in range(len(masks) - 1, -1, -1):
            out[p] = self.before(masks[p], out[p + 1])
        return out

    def walk(self, masks: list[int], sets: list[int], p: int, s: int) -> tuple[list[int], int]:
        """Positions of the rows from ``p`` on, and the position in the next chunk or ACCEPT."""
        taken = []
        while p < len(masks) and s != ACCEPT:
            taken.append(s)
            s = self.step(masks[p], sets[p + 1], s)
            p += 1
        return taken, s

    def table(self, masks: list[int]) -> list[str]:
        """What holds at the first row if nothing, or one position, holds after the last."""
        now = [0, *[1 << s for s in range(len(self.bit))]]
        for m in reversed(masks):
            known = {a: self.before(m, a) for a in set(now)}
            now = [known[a] for a in now]
        return [format(a, "x") for a in now]


def by_automaton(d: DataFrame, seq: S.Sequence, pattern, names: list[str], define: dict[str, str], event: Column, past_last: bool):
    """Preferred match of each start (KEY, CHUNK, items, ``__no``), and the slots."""
    if len(names) > 60:
        raise PatternError("more than 60 variables")
    spark = d.sparkSession
    pos = Positions(pattern)
    walker = Walker(pos, names)
    tests = [F.coalesce(F.expr(define.get(n, "true")).cast("boolean"), F.lit(False)) for n in names]
    tests += [F.col(c) if c in d.columns else F.lit(False) for c in ("__first", "__last")]
    mask = sum((F.when(t, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, t in enumerate(tests)), F.lit(0).cast("bigint"))
    tie = [t for t in seq.tie if t != seq.ts]
    order = ["__t", *[f"__o{i}" for i in range(len(tie))]]
    rows = S.chunked(d, seq).select(S.KEY, S.CHUNK, seq.ticks(d).alias("__t"), *[F.col(t).alias(f"__o{i}") for i, t in enumerate(tie)],
                                    mask.alias("__mask"), event.alias("__ev"))
    # Conditions are evaluated and chunks dealt once.
    rows = _written(spark, rows, "row-masks")

    lean = rows.select(S.KEY, S.CHUNK, *order, "__mask", F.struct(F.lit(0).alias("none")).alias("__ev"))
    tables = match_groups(lean, order, ["__mask"], lambda cols: [(json.dumps(walker.table(cols["__mask"])), [], [])])
    key_text = F.to_json(F.col(S.KEY), KEY_TEXT)
    tables = tables.select(S.KEY, key_text.alias("__k"), S.CHUNK, F.col("kind").alias("__table"))

    def thread(batches):
        key, after, chunk = None, 0, None
        for batch in batches:
            ks, cs, ts = (batch.column(i).to_pylist() for i in (1, 2, 3))
            ins, nexts = [], []
            for k, c, t in zip(ks, cs, ts, strict=True):
                if k != key:
                    key, after, chunk = k, 0, None
                ins.append(format(after, "x"))
                nexts.append(chunk)
                sets = [int(x, 16) for x in json.loads(t)]
                got, s = sets[0], 0
                while after:
                    s += 1
                    if after & 1:
                        got |= sets[s]
                    after >>= 1
                after, chunk = got, c
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(ins, pa.string()), pa.array(nexts, pa.int64())],
                                             names=[S.KEY, S.CHUNK, "__after", "__next"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    known = tables.repartition("__k").sortWithinPartitions("__k", F.col(S.CHUNK).desc()).mapInArrow(
        thread, f"`{S.KEY}` {kinds[S.KEY]}, `{S.CHUNK}` bigint, __after string, __next bigint")
    known = _written(spark, known, "row-sets")

    def handle(cols: dict[str, list]):
        masks = cols["__mask"]
        sets = walker.sets(masks, int(cols["__after"][0], 16))
        found = []

        def emit(kind: str, p: int, s: int) -> int:
            taken, out = walker.walk(masks, sets, p, s)
            found.append((f"{kind}:{out}", taken, list(range(p, p + len(taken)))))
            return p + len(taken)

        ends = [emit(f"tail:{s}", 0, s) for s in range(len(pos.slots)) if sets[0] >> s & 1]
        starts = [walker.start(m, here) for m, here in zip(masks, sets)]
        if not past_last:
            for p, s in enumerate(starts):
                if s is not None:
                    emit("match:", p, s)
            return found
        seen = set()
        for p in sorted({0, *ends}):
            while p < len(masks):
                if starts[p] is None:
                    p += 1
                    continue
                if p in seen:
                    break
                seen.add(p)
                p = emit("match:", p, starts[p])
        return found

    found = match_groups(S.join_chunks(rows, known.drop("__next")), order, ["__mask", "__after"], handle)
    part = F.split("kind", ":")
    found = found.select(S.KEY, S.CHUNK, part[0].alias("what"), F.when(part[1] != "", part[1].cast("int")).alias("come"), part[2].cast("int").alias("go"), "items", "__no")
    found = _written(spark, found.join(known.select(S.KEY, S.CHUNK, "__next"), [S.KEY, S.CHUNK]), "row-walks")
    tails = found.where("what = 'tail'").select(
        F.col(S.KEY).alias("__tk"), F.col(S.CHUNK).alias("__tc"), "come", F.col("go").alias("__go"), F.col("items").alias("__more"), F.col("__next").alias("__then"))
    start = found.where("what = 'match'").select(S.KEY, S.CHUNK, "go", "items", "__no", "__next")
    out = start.where(f"go = {ACCEPT}")
    open_ = start.where(f"go <> {ACCEPT}")
    while not open_.isEmpty():
        # One chunk further each time.
        met = open_.join(tails, (F.col(S.KEY) == F.col("__tk")) & (F.col("__next") == F.col("__tc")) & (F.col("go") == F.col("come")))
        met = met.select(S.KEY, S.CHUNK, F.col("__go").alias("go"), F.concat("items", "__more").alias("items"), "__no", F.col("__then").alias("__next"))
        met = _written(spark, met, "row-walks")
        out = out.unionByName(met.where(f"go = {ACCEPT}"))
        open_ = met.where(f"go <> {ACCEPT}")
    return out.select(S.KEY, S.CHUNK, "items", "__no"), pos.slots


def _written(spark, df: DataFrame, purpose: str) -> DataFrame:
    """Written to the shared folder and read again."""
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
