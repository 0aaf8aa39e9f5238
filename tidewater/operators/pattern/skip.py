"""After-match skip strategies.

Among matches ordered by start, an emitted match removes the later ones that
start too early. "To next" only looks at matches of one start. The others are a
chain of jumps along the key, which is cut at time chunks: per chunk, a table
says which bound the chunk hands on for each bound it may receive (jump chains
merge, so it has few rows); these tables are run through per key; then each
chunk picks its own matches knowing the bound it starts from.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidewater.operators import sequence as S
from tidewater.operators.pattern.spec import Skip


# Key as text that tells any two keys apart: times to the micro, NULLs spelled out.
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
KEY_TEXT = {"ignoreNullFields": "false", "timestampFormat": MICROS, "timestampNTZFormat": MICROS}


def pivot_ord(skip: Skip, graph, ord_of, last_ord: Column) -> Column:
    """Order of the event a match skips to."""
    if skip.kind == "past_last":
        return last_ord
    ids = [i for i, s in enumerate(graph.slots) if s.name == skip.step]
    hits = F.filter("items", lambda x: x["slot"].isin(ids))
    pick = F.try_element_at(hits, F.lit(1 if skip.kind == "to_first" else -1))
    found = ord_of(pick["e"])
    if skip.error_on_miss:
        fine = F.assert_true(pick.isNotNull(), f"skip target {skip.step} has no event").isNull()
        return F.when(fine, found)
    return F.when(pick.isNotNull(), found)


def apply_skip(matches: DataFrame, skip: Skip) -> DataFrame:
    """``matches`` has KEY, CHUNK, ``__so`` / ``__eo`` / ``__po`` (order of start,
    end and pivot event, structs of plain values) and ``__no`` (emission order)."""
    if skip.kind == "none":
        return matches
    order = F.struct("__eo", "__no")
    if skip.kind == "next":
        rest = [c for c in matches.columns if c not in (S.KEY, S.CHUNK, "__so")]
        first = matches.groupBy(S.KEY, S.CHUNK, "__so").agg(F.min_by(F.struct(*rest), order).alias("m"))
        return first.select(S.KEY, S.CHUNK, "__so", "m.*")
    return _pick(matches, past=skip.kind == "past_last")


def _pick(matches: DataFrame, past: bool) -> DataFrame:
    """Matches reached by jumping from pivot to the next start, per key.

    Three passes over sorted partitions. Each holds one running bound (the
    first also the starts of the current chunk), never a whole key.
    """
    fields = matches.schema["__so"].dataType.fieldNames()
    n = len(fields)
    s_cols, p_cols, b_cols = ([f"__{x}{i}" for i in range(n)] for x in "spb")
    pivot = F.coalesce("__po", "__so")
    jumps = F.lit(True) if past else pivot > F.col("__so")
    flat = matches.select(
        "*", F.to_json(S.KEY, KEY_TEXT).alias("__k"), jumps.alias("__j"),
        *[F.col("__so")[f].alias(s) for f, s in zip(fields, s_cols)], *[pivot[f].alias(p) for f, p in zip(fields, p_cols)])
    kinds = {c: flat.schema[c].dataType.simpleString() for c in s_cols}
    ddl = lambda cols: ", ".join(f"{c} {kinds[s]}" for cs in cols for c, s in zip(cs, s_cols))
    # A start lies beyond a bound: after it, or at it when skipping to an event.
    beyond = (lambda start, bound: start > bound) if past else (lambda start, bound: start >= bound)

    def rows(batch, names):
        return zip(*[batch.column(c).to_pylist() for c in names])

    def transfer(batches):
        """Per chunk: last start of each run of starts that share a way out, and that way."""
        here, starts, outs, latest = None, [], [], None

        def settle():
            if latest is not None:
                start, piv = latest
                j = find_desc(starts, piv)
                starts.append(start)
                outs.append(piv if j is None else outs[j])

        def find_desc(seen, bound):
            """Index of the least start beyond the bound; ``seen`` is descending."""
            lo, hi = 0, len(seen)
            while lo < hi:
                mid = (lo + hi) // 2
                if beyond(seen[mid], bound):
                    lo = mid + 1
                else:
                    hi = mid
            return lo - 1 if lo else None

        def result():
            keep = [i for i in range(len(outs)) if i == 0 or outs[i] != outs[i - 1]]
            cols = [[here[0]] * len(keep), [here[1]] * len(keep)]
            cols += [[starts[i][f] for i in keep] for f in range(n)] + [[outs[i][f] for i in keep] for f in range(n)]
            return cols

        for batch in batches:
            done = []
            for row in rows(batch, ["__k", S.CHUNK, "__j", *s_cols, *p_cols]):
                at, jump, start, piv = row[:2], row[2], row[3:3 + n], row[3 + n:]
                if at != here:
                    settle()
                    if here is not None:
                        done.append(result())
                    here, starts, outs, latest = at, [], [], None
                if latest is not None and latest[0] == start:
                    # Earlier rows of one start come later here and take over if they jump.
                    latest = (start, piv if jump else latest[1])
                else:
                    settle()
                    latest = (start, piv if jump else start)
            for cols in done:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types)], names=table_names)
        if here is not None:
            settle()
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(result(), types)], names=table_names)

    def thread(batches):
        """Per chunk that is not a key's first: the bound it receives."""
        key, chunk, bound, taken = None, None, None, False
        for batch in batches:
            out = []
            for row in rows(batch, ["__k", S.CHUNK, *s_cols, *p_cols]):
                k, c, start, way = row[0], row[1], row[2:2 + n], row[2 + n:]
                if k != key:
                    key, chunk, bound, taken = k, c, None, False
                elif c != chunk:
                    chunk, taken = c, False
                    out.append((k, c, *bound))
                if not taken and (bound is None or beyond(start, bound)):
                    bound, taken = way, True
            cols = list(zip(*out)) if out else [[]] * (2 + n)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types)], names=bound_names)

    def walk(batches):
        """Keep the matches that are reached."""
        here, bound, taken, closed = None, None, None, False
        for batch in batches:
            keep = []
            for row in rows(batch, ["__k", S.CHUNK, "__j", "__known", *s_cols, *p_cols, *b_cols]):
                at, jump, start, piv = row[:2], row[2], row[4:4 + n], row[4 + n:4 + 2 * n]
                if at != here:
                    here, taken, closed = at, None, False
                    bound = row[4 + 2 * n:] if row[3] else None
                if start != taken and (bound is None or beyond(start, bound)):
                    taken, closed, bound = start, False, start
                ok = start == taken and not closed
                keep.append(ok)
                if ok and jump:
                    bound, closed = piv, True
            yield batch.filter(pa.array(keep, pa.bool_())).select(out_names)

    arrow = {f.name: f.type for f in to_arrow_schema(flat.schema)}
    types = [pa.string(), pa.int64(), *[arrow[c] for c in s_cols], *[arrow[c] for c in s_cols]]
    table_names, bound_names = ["__k", S.CHUNK, *s_cols, *p_cols], ["__k", S.CHUNK, *b_cols]
    out_names = matches.columns
    lean = flat.select("__k", S.CHUNK, "__j", "__eo", "__no", *s_cols, *p_cols)
    down = [F.col(c).desc() for c in (*s_cols, "__eo", "__no")]
    table = lean.repartition("__k", S.CHUNK).sortWithinPartitions("__k", S.CHUNK, *down) \
        .mapInArrow(transfer, f"__k string, {S.CHUNK} bigint, {ddl([s_cols, p_cols])}")
    bounds = table.repartition("__k").sortWithinPartitions("__k", S.CHUNK, *s_cols) \
        .mapInArrow(thread, f"__k string, {S.CHUNK} bigint, {ddl([b_cols])}")
    # Chunks that receive no bound get a filler, so no column turns nullable.
    known = flat.join(bounds, ["__k", S.CHUNK], "left").select(
        *flat.columns, F.col("__b0").isNotNull().alias("__known"), *[F.coalesce(b, s).alias(b) for b, s in zip(b_cols, s_cols)])
    ordered = known.repartition("__k", S.CHUNK).sortWithinPartitions("__k", S.CHUNK, *s_cols, "__eo", "__no")
    return ordered.mapInArrow(walk, matches.schema)
