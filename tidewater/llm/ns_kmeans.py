"""k-means in whole numbers with ns-bounds: centroids of every round are kept.

A vector's components x become floor(``scale`` * x). The first centroids are the ``k``
vectors with the smallest hash of seed and id. Each round gives every vector to the
nearest centroid (squared Euclidean distance, ties to the smaller number) and replaces each
centroid that has vectors by their componentwise floored mean.

Bounds. For each centroid j a vector keeps its squared distance at the round T(j) in which
that distance was last evaluated. In a later round the distance is at least the stored
one less the norm of the whole way from centroid j of round T(j) to centroid j of now,
and for the vector's own centroid at most the stored one plus that norm. The norm of the
total displacement is never more than the sum of the displacements of single rounds, which is why
the centroids of all rounds are kept (rounds x k x components numbers). A vector
whose upper bound lies below all lower bounds keeps its centroid unread; else its own
distance is evaluated, and then every centroid whose lower bound does not exceed it.
Bounds carry a margin for rounding, and all distances that decide are whole numbers, so the
result is that of plain k-means.

Each round is one pass over a table of vectors with their bounds, written to the shared
folder; sums per cluster are added up in each task before they are shuffled, and k rows come
back. Centroids are k x components numbers and travel with the task.

Vectors that are null, have another number of components than ``width``, or hold a null or a
component that is not finite are left out. A null id hashes as ''. Equal hashes (repeated
ids) are ordered by the vector. Fewer than k vectors give as many centroids. Components beyond
2 ** 27 after scaling have no exact long distance and raise an error. An empty
table gives an empty result. Further columns are dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import Tables

SCALE, WIDTH, K, ROUNDS, SEED = 64, 64, 16, 3, 1
#: Vectors worked on at once.
SLICE = 4096
_MOST = 1 << 27
STATE = "vec_id long, vec array<int>, cluster int, own long, seen array<float>, at array<smallint>"


def whole_numbers(vectors: DataFrame, id_col: str, vec_col: str, width: int, scale: int) -> DataFrame:
    """vec_id and vec (array of int) of the vectors that count."""
    v = F.col(vec_col)
    fine = F.size(v).eqNullSafe(width) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(v, lambda x: F.floor(x.cast("double") * scale))
    small = F.forall(v, lambda x: F.abs(x.cast("double") * scale) <= _MOST)
    checked = F.when(small, scaled).otherwise(F.raise_error(F.lit("a component is beyond 2 ** 27 after scaling")))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v).where(fine).select("vec_id", checked.cast("array<int>").alias("vec"))


def _matrix(column, width: int, kind) -> np.ndarray:
    return np.asarray(column.flatten()).astype(kind, copy=False).reshape(-1, width)


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of c, exact."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if most < 1 << 20 and x.shape[1] <= 1 << 10:
        # Products and their sums stay below 2 ** 53.
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in c], axis=1)


def _list(values: np.ndarray, width: int, kind) -> pa.ListArray:
    off = np.arange(0, len(values) * width + 1, width, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values.ravel(), kind))


def nearest(x: np.ndarray, cluster: np.ndarray, own: np.ndarray, seen: np.ndarray, at: np.ndarray,
            history: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Cluster, squared distance to it when last evaluated, lower bounds and their rounds of each vector, and the distances evaluated.

    ``seen`` holds distances (not squared), rounded down, ``at`` the rounds they are of."""
    now = len(history) - 1
    c = history[now]
    rows = np.arange(len(x))
    # Norm of the total displacement of each centroid since each round, rounded up.
    moved = np.stack([np.sqrt(((c - h).astype(np.float64) ** 2).sum(1)) for h in history]) * (1 + 1e-9)
    lower = seen - moved[at, np.arange(len(c))[None]]
    lower[rows, cluster] = np.inf
    upper = np.sqrt(own.astype(np.float64)) * (1 + 1e-9) + moved[at[rows, cluster], cluster]
    fail = np.flatnonzero(upper >= lower.min(1)) if len(c) > 1 else np.zeros(0, np.int64)
    evaluated = 0
    if len(fail):
        d = ((x[fail] - c[cluster[fail]]) ** 2).sum(1)
        own[fail] = d
        seen[fail, cluster[fail]], at[fail, cluster[fail]] = np.sqrt(d) * (1 - 1e-6), now
        evaluated += len(fail)
        # Exactly those centroids that may be as near or nearer are evaluated.
        near = lower[fail] <= (np.sqrt(d) * (1 + 1e-9))[:, None]
        open_ = np.flatnonzero(near.any(1))
        if len(open_):
            who = fail[open_]
            exact = distances(x[who], c)
            want = near[open_]
            evaluated += int(want.sum())
            want[np.arange(len(who)), cluster[who]] = True
            best = np.where(want, exact, np.iinfo(np.int64).max).argmin(1)
            r, j = np.nonzero(want)
            seen[who[r], j] = np.sqrt(exact[r, j]) * (1 - 1e-6)
            at[who[r], j] = now
            cluster[who] = best
            own[who] = exact[np.arange(len(who)), best]
    return cluster, own, seen, at, evaluated


def _first(batch, width: int, c: np.ndarray):
    """All distances: the state of a vector before any bound is known."""
    x = _matrix(batch.column(1), width, np.int64)
    d = distances(x, c)
    cluster = d.argmin(1)
    return x, cluster, d[np.arange(len(x)), cluster], np.sqrt(d) * (1 - 1e-6), np.zeros(d.shape, np.int16)


def assign(state: DataFrame, history: list[np.ndarray], width: int) -> DataFrame:
    """The state of every vector after the assignment to the last of ``history``."""
    k = len(history[0])
    first = len(history) == 1

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, SLICE):
                batch = whole.slice(lo, SLICE)
                if first:
                    _, cluster, own, seen, at = _first(batch, width, history[0])
                else:
                    x = _matrix(batch.column(1), width, np.int64)
                    cluster, own, seen, at, _ = nearest(
                        x, np.array(batch.column(2)).astype(np.int64), np.array(batch.column(3)), _matrix(batch.column(4), k, np.float64).copy(),
                        _matrix(batch.column(5), k, np.int64).copy(), history)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(cluster.astype(np.int32)), pa.array(own), _list(np.nextafter(seen.astype(np.float32), np.float32(0)), k, pa.float32()),
                     _list(at.astype(np.int16), k, pa.int16())], names=["vec_id", "vec", "cluster", "own", "seen", "at"])

    return state.mapInArrow(run, STATE)


def _sums(state: DataFrame, k: int, width: int) -> list:
    """Rows of cluster, number of vectors and sums of their components: k rows, added up in each task first."""

    def run(batches):
        n, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            cluster, x = batch.column(0).to_numpy(), _matrix(batch.column(1), width, np.int64)
            order = np.argsort(cluster, kind="stable")
            own = cluster[order]
            new = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
            if len(new):
                total[own[new]] += np.add.reduceat(x[order], new, axis=0)
                n += np.bincount(own, minlength=k)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at]), _list(total[at], width, pa.int64())], names=["cluster", "n", "total"])

    found = state.select("cluster", "vec").mapInArrow(run, "cluster int, n long, total array<long>")
    each = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(width)]
    return found.groupBy("cluster").agg(F.sum("n").alias("n"), *each).collect()


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, scale: int = SCALE, width: int = WIDTH,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and centroid of every vector that counts."""
    spark = vectors.sparkSession
    tables = Tables(spark)
    kept = whole_numbers(vectors, id_col, vec_col, width, scale)
    start = kept.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256), "vec").limit(k).collect()
    if not start:
        return kept.select("vec_id", *[F.lit(None).cast(t).alias(n) for n, t in (
            ("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"), ("centroid", "array<int>"))])
    history = [np.array([r.vec for r in start], np.int64)]
    state = kept
    for _ in range(rounds):
        after = tables.cut(assign(state, history, width), "bounds")
        if state is not kept:
            tables.drop(state)
        state = after
        new = history[-1].copy()
        for r in _sums(state, len(new), width):
            new[r.cluster] = [int(t) // r.n for t in r[2:]]
        history.append(new)
    final = history[-1]

    def measure(batches):
        for batch in batches:
            x = _matrix(batch.column(1), width, np.int64)
            own = batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(((x - final[own]) ** 2).sum(1))], names=["vec_id", "cluster", "distance"])

    done = assign(state, history, width).select("vec_id", "vec", "cluster").mapInArrow(measure, "vec_id long, cluster int, distance long")
    done = tables.cut(done, "clusters")
    # k rows at most.
    each = done.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    inertia = {r.cluster: r.cluster_inertia for r in each.collect()}
    facts = [(j, n, sum(inertia.values()), hashlib.sha256(",".join(map(str, final[j].tolist())).encode()).hexdigest(), final[j].tolist()) for j, n in inertia.items()]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<int>")
    return done.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid")
