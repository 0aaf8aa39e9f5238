"""Ordered work per key that survives a hot key.

``Window.partitionBy(key).orderBy(ts)`` sends all rows of a key to one task. Here
a key's rows are cut along the order column into chunks, so a task holds one
(key, chunk). What a row needs from outside its chunk comes from

* a *carry*: one small summary row per (key, chunk), scanned over the chunks of
  the key and joined back on (key, chunk) - the partitioning the rows already
  have, so the rows are shuffled once; or
* a *halo*: copies of the rows just outside the chunk, for frames of bounded
  reach.

The chunk width is the knob: rows per (key, chunk) = event rate x width, chunks
per key = time span / width. ``sequence`` picks one that fits the hottest key. Frames that grow backwards are used throughout
(Spark evaluates frames that end at UNBOUNDED FOLLOWING in quadratic time), so
forward-looking scans sort descending.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

KEY, CHUNK, ORD = "__key", "__chunk", "__ord"


@dataclass(frozen=True)
class Sequence:
    """Rows of each ``by`` key, ordered by ``ts`` and then by ``tie``."""

    by: tuple[str, ...]
    ts: str
    tie: tuple[str, ...] = ()
    width: timedelta | float = timedelta(days=7)
    desc: bool = False
    extra: dict = field(default_factory=dict, compare=False)

    def ticks(self, df: DataFrame) -> Column:
        """The order column as a number, in the unit of ``span``."""
        if isinstance(self.width, timedelta):
            return F.unix_micros(F.col(self.ts).cast("timestamp"))
        return F.col(self.ts).cast("double")

    def span(self, width=None) -> float:
        width = self.width if width is None else width
        return micros(width) if isinstance(width, timedelta) else float(width)


# Rows without an order value are a chunk of their own, after all others.
NULL_CHUNK = 1 << 62
TARGET_ROWS = 1_000_000


def sequence(df: DataFrame, by, ts: str, tie=(), width=None, desc: bool = False, unit=timedelta(days=7)) -> Sequence:
    """A sequence whose chunks fit a task: with the given width, or with one
    measured on the data, at any size. ``unit`` tells by its type whether the
    order column is a time or a number; it is the width where all rows lie at
    one point."""
    probe = Sequence(tuple(by), ts, tuple(tie), unit if width is None else width, desc)
    return probe if width is not None else replace(probe, width=fit_width(df, probe))


def fit_width(df: DataFrame, seq: Sequence, target_rows: int = TARGET_ROWS, cells: int = 1024):
    """Chunk width at which the hottest key has about ``target_rows`` per chunk
    where the rows lie most densely. Reads the key and order columns only."""
    t = seq.ticks(df)
    keyed = df.select(*seq.by, t.alias("__t"))
    r = keyed.groupBy(*seq.by).agg(F.count(F.lit(1)).alias("n"), F.min("__t").alias("lo"), F.max("__t").alias("hi")).agg(
        F.max("n").alias("hot"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    span = float((r.hi or 0) - (r.lo or 0)) if r.n else 0.0
    if span <= 0:
        return seq.width
    cell = F.floor((F.col("__t") - F.lit(r.lo)) / F.lit(span) * F.lit(cells))
    dense = keyed.groupBy(cell.alias("c")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    peak = max(1.0, dense * cells / r.n)
    width = span * min(1.0, target_rows / (r.hot * peak))
    return timedelta(microseconds=max(1000, int(width))) if isinstance(seq.width, timedelta) else width


def micros(t: timedelta) -> int:
    return (t.days * 86400 + t.seconds) * 1000000 + t.microseconds


def chunked(df: DataFrame, seq: Sequence) -> DataFrame:
    """Add key, chunk and order columns.

    The key is one struct: struct equality treats NULL fields as equal, as
    PARTITION BY does, without giving up the plain hash partitioning.
    """
    sign = -1 if seq.desc else 1
    ord_fields = [F.col(seq.ts), *[F.col(c) for c in seq.tie]]
    return (
        df.withColumn(KEY, F.struct(*[F.col(c) for c in seq.by]) if seq.by else F.struct(F.lit(0).alias("all")))
        .withColumn(CHUNK, F.coalesce(F.floor(seq.ticks(df) / F.lit(seq.span())) * sign, F.lit(NULL_CHUNK)))
        .withColumn(ORD, F.struct(*ord_fields))
    )


def _order(seq: Sequence, backward: bool) -> list[Column]:
    first_desc = seq.desc != backward
    t = F.col(seq.ts)
    if backward:
        head = t.desc_nulls_first() if first_desc else t.asc_nulls_first()
    else:
        head = t.desc_nulls_last() if first_desc else t.asc_nulls_last()
    tail = [F.col(c).desc() if backward else F.col(c).asc() for c in seq.tie]
    return [head, *tail]


def local(seq: Sequence, backward: bool = False) -> WindowSpec:
    return Window.partitionBy(KEY, CHUNK).orderBy(*_order(seq, backward))


def over_chunks(backward: bool = False) -> WindowSpec:
    c = F.col(CHUNK)
    return Window.partitionBy(KEY).orderBy(c.desc() if backward else c.asc())


def join_chunks(df: DataFrame, per_chunk: DataFrame) -> DataFrame:
    return df.join(per_chunk, [KEY, CHUNK], "left")


def unchunked(df: DataFrame) -> DataFrame:
    return df.drop(KEY, CHUNK, ORD)


BEFORE = (Window.unboundedPreceding, -1)
UPTO = (Window.unboundedPreceding, 0)


def carry(
    df: DataFrame, seq: Sequence, values: dict[str, Column], forward: bool = False, inclusive: bool = False,
) -> DataFrame:
    """Nearest non-NULL of each value before the row (or after it, ``forward``)."""
    d = df if KEY in df.columns else chunked(df, seq)
    for name, v in values.items():
        d = d.withColumn(f"__v_{name}", v)
    frame = UPTO if inclusive else BEFORE
    nearest = F.min_by if (forward != seq.desc) else F.max_by
    w = local(seq, backward=forward).rowsBetween(*frame)
    ends = d.groupBy(KEY, CHUNK).agg(
        *[
            nearest(F.col(f"__v_{n}"), F.when(F.col(f"__v_{n}").isNotNull(), F.col(ORD))).alias(f"__e_{n}")
            for n in values
        ]
    )
    wc = over_chunks(backward=forward).rowsBetween(*BEFORE)
    carried = ends.select(
        KEY, CHUNK, *[F.last(f"__e_{n}", ignorenulls=True).over(wc).alias(f"__c_{n}") for n in values]
    )
    d = d.select("*", *[F.last(f"__v_{n}", ignorenulls=True).over(w).alias(f"__l_{n}") for n in values])
    d = join_chunks(d, carried)
    for n in values:
        d = d.withColumn(n, F.coalesce(f"__l_{n}", f"__c_{n}"))
    return d.drop(*[f"__{p}_{n}" for n in values for p in "vlc"])


MERGE = {"sum": lambda a, b: a + b, "count": lambda a, b: a + b, "min": F.least, "max": F.greatest}
AGG = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
CHUNK_AGG = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def running(df: DataFrame, seq: Sequence, values: dict[str, tuple[str, Column]], forward: bool = False) -> DataFrame:
    """Aggregates over all rows up to the row: ``{name: (agg, column)}``."""
    d = df if KEY in df.columns else chunked(df, seq)
    for n, (_, v) in values.items():
        d = d.withColumn(f"__v_{n}", v)
    w = local(seq, backward=forward).rowsBetween(*UPTO)
    per_chunk = d.groupBy(KEY, CHUNK).agg(*[AGG[a](f"__v_{n}").alias(f"__e_{n}") for n, (a, _) in values.items()])
    wc = over_chunks(backward=forward).rowsBetween(*BEFORE)
    base = per_chunk.select(
        KEY, CHUNK, *[CHUNK_AGG[a](f"__e_{n}").over(wc).alias(f"__c_{n}") for n, (a, _) in values.items()]
    )
    d = d.select("*", *[AGG[a](f"__v_{n}").over(w).alias(f"__l_{n}") for n, (a, _) in values.items()])
    d = join_chunks(d, base)
    for n, (a, _) in values.items():
        loc, car = F.col(f"__l_{n}"), F.col(f"__c_{n}")
        both = MERGE[a](loc, car)
        d = d.withColumn(n, F.when(loc.isNull(), car).when(car.isNull(), loc).otherwise(both))
    return d.drop(*[f"__{p}_{n}" for n in values for p in "vlc"])


def positions(df: DataFrame, seq: Sequence, name: str = "pos") -> DataFrame:
    """Row number per key, counting from 1."""
    d = df if KEY in df.columns else chunked(df, seq)
    counts = d.groupBy(KEY, CHUNK).agg(F.count(F.lit(1)).alias("__n"))
    base = counts.select(KEY, CHUNK, F.sum("__n").over(over_chunks().rowsBetween(*BEFORE)).alias("__base"))
    d = d.withColumn("__rn", F.row_number().over(local(seq)))
    d = join_chunks(d, base)
    return d.withColumn(name, F.col("__rn") + F.coalesce("__base", F.lit(0))).drop("__rn", "__base")


def shift(df: DataFrame, seq: Sequence, values: dict[str, Column], k: int) -> DataFrame:
    """``lag(v, k)`` for k > 0, ``lead(v, -k)`` for k < 0, across chunk borders.

    A chunk hands its last k rows to the next ones; k chunks back always hold
    k rows, so the summary stays at k x k values per chunk.
    """
    forward, k = k < 0, abs(k)
    d = df if KEY in df.columns else chunked(df, seq)
    packed = F.struct(*[v.alias(n) for n, v in values.items()])
    d = d.withColumn("__p", packed)
    w = local(seq, backward=forward)
    from_end = F.row_number().over(local(seq, backward=not forward))
    tails = (
        d.select(KEY, CHUNK, "__p", from_end.alias("__r")).where(F.col("__r") <= k)
        .groupBy(KEY, CHUNK).agg(F.collect_list(F.struct((-F.col("__r")).alias("r"), F.col("__p").alias("p"))).alias("__t"))
    )
    wc = over_chunks(backward=forward).rowsBetween(-k, -1)
    tails = tails.withColumn("__t", F.transform(F.array_sort("__t"), lambda s: s.p))
    tails = tails.select(KEY, CHUNK, F.flatten(F.collect_list("__t").over(wc)).alias("__t"))
    d = d.select("*", F.lag("__p", k).over(w).alias("__l"), F.row_number().over(w).alias("__r"))
    d = join_chunks(d, tails)
    got = F.when(F.col("__r") > k, F.col("__l")).otherwise(
        F.try_element_at("__t", (F.col("__r") - F.lit(k + 1)).cast("int"))
    )
    for n in values:
        d = d.withColumn(n, got[n])
    return d.drop("__p", "__l", "__r", "__t")


def row_halo(df: DataFrame, seq: Sequence, before: int, after: int = 0, rows: int = 1 << 16) -> DataFrame:
    """Blocks of ``rows`` positions plus the neighbours a ROWS frame reaches.

    Aggregate with ``halo_window()`` and keep ``__own`` rows.
    """
    d = positions(df, seq, "__pos")
    p = F.col("__pos") - 1
    lo, hi = F.floor((p - after) / rows), F.floor((p + before) / rows)
    own = F.floor(p / rows)
    d = d.withColumn(CHUNK, F.explode(F.sequence(F.greatest(lo, F.lit(0)), hi)))
    return d.withColumn("__own", F.col(CHUNK) == own)


def halo_window() -> WindowSpec:
    return Window.partitionBy(KEY, CHUNK).orderBy("__pos")


def time_halo(df: DataFrame, seq: Sequence, before=None, after=None) -> DataFrame:
    """Chunks plus the rows a RANGE frame reaches on either side."""
    d = chunked(df, seq)
    zero = timedelta(0) if isinstance(seq.width, timedelta) else 0.0
    b, a = seq.span(before if before is not None else zero), seq.span(after if after is not None else zero)
    t, w = seq.ticks(df), F.lit(seq.span())
    own = F.floor(t / w)
    d = d.withColumn("__own_chunk", own)
    d = d.withColumn(CHUNK, F.explode(F.sequence(F.floor((t - a) / w), F.floor((t + b) / w))))
    return d.withColumn("__own", F.col(CHUNK) == F.col("__own_chunk")).drop("__own_chunk")


def islands(df: DataFrame, seq: Sequence, label: Column, name: str = "run_id") -> DataFrame:
    """Number the maximal runs of equal ``label`` per key (gaps and islands).

    Runs are numbered inside each chunk; a chunk whose first label goes on from
    the chunk before does not count its first run again.
    """
    d = chunked(df, seq).withColumn("__label", label)
    w = local(seq)
    same = F.lag("__label").over(w).eqNullSafe(F.col("__label")) & F.lag(F.lit(1)).over(w).isNotNull()
    d = d.withColumn("__new", F.when(same, 0).otherwise(1))
    d = d.withColumn("__local", F.sum("__new").over(w.rowsBetween(*UPTO)))
    first, last = (F.max_by, F.min_by) if seq.desc else (F.min_by, F.max_by)
    ends = d.groupBy(KEY, CHUNK).agg(
        F.sum("__new").alias("__n"), first(F.struct("__label"), ORD).alias("__first"), last(F.struct("__label"), ORD).alias("__last"))
    wc = over_chunks()
    goes_on = F.when(F.lag("__last").over(wc) == F.col("__first"), 1).otherwise(0)
    ends = ends.withColumn("__joined", goes_on)
    base = ends.select(
        KEY, CHUNK,
        (F.coalesce(F.sum("__n").over(wc.rowsBetween(*BEFORE)), F.lit(0)) - F.sum("__joined").over(wc.rowsBetween(*UPTO))).alias("__base"))
    d = join_chunks(d, base)
    return d.withColumn(name, F.col("__local") + F.col("__base")).drop("__label", "__new", "__local", "__base")
