"""N-gram Jaccard join with adaptive multi-match prefixes, and its components.

A document's set holds the hashes of its distinct ``n``-word shingles. Documents of one
set are one node. In a global order of all shingles, two sets of Jaccard similarity t or
more share at least l of the first |x| - ceil(t |x|) + l of either. Every document chooses
its own l: frequent shingles are ordered last, and a document whose prefix reaches them
gets a longer prefix, by the estimated number of candidates that they bring. A pair is a
candidate only if the prefixes share as many shingles as the smaller l asks for; every
candidate that matters is then verified on the whole sets.

Frequent shingles are a hint for the order: at most ``HINTS`` of them, counted over all
documents, wherever they repeat within a part of the input. Any order gives the same links.

Large groups of similar texts do not need all their pairs: first every document is held
against the one document of its prefix lists that it shares most with, and only
candidates that this has not put into one component are verified afterwards. Documents
in one component are connected already, so no component is lost.

A prefix that reaches frequent shingles holds all rare ones of its set. So two documents
either share a rare shingle of their prefixes, or both reach frequent ones and share some
of those. The latter are few (texts made of little but frequent shingles, as in a large
family of edited copies); they are clustered by the frequent shingles that they share, a
cluster is dealt into blocks of about ``BLOCK`` documents, and each pair of blocks is
counted in one task, which hands back at most one link per document.

Null and empty texts and texts without words have no shingles and are linked with
nothing; with fewer than ``n`` words the whole sequence is the one shingle. Equal rows
have one set. Rows with a null id take no part and have a null component. An empty
table gives an empty result. Further columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import BROADCAST_IDS, Tables, cut, only
from tidewater.llm.components import components
from tidewater.llm.text import LOWER, flat, grams, hashes, mix, parts, ranges, slices, words

#: Frequent shingles that the order knows at most (two numbers each).
HINTS = 1 << 18
#: Documents from which a shingle may be ordered last.
FREQUENT = 50
#: Shingles counted together, and the count there from which one is reported.
PART_SHINGLES, PART_COUNT = 1 << 20, 3
LEAST_MATCH, MOST_MATCH = 2, 8
#: Lists that the list of a frequent shingle is dealt into.
DEALT = 64
#: Documents of a block of the frequent part.
BLOCK = 1024
#: Bytes of texts whose sets a task keeps while it verifies.
KEPT_SETS = 8 << 20


def sets(column, n: int):
    """Index and sorted distinct shingle hashes of every row."""
    for lo, hi, data, off in parts(column):
        data = LOWER[data]
        start, end, row = words(data, off)
        h = hashes(data, start, end)
        g, at = grams(h, row, n)
        begin, first = ranges(row, hi - lo), ranges(row[at], hi - lo)
        for k in range(hi - lo):
            own = g[first[k]:first[k + 1]]
            if len(own):
                own = np.sort(own)
                own = own[np.r_[True, own[1:] != own[:-1]]]
            elif begin[k] < begin[k + 1]:
                # Fewer words than n: the sequence itself, with its length.
                few = np.uint64(begin[k + 1] - begin[k])
                own = np.array([few])
                for w in h[begin[k]:begin[k + 1]]:
                    own = mix(own * np.uint64(31) ^ w)
            yield lo + k, own


def _need(size: int, percent: int) -> int:
    """The least overlap with any set of similarity ``percent`` or more: ceil(t |x|)."""
    return -(-percent * size // 100)


def fingerprints(docs: DataFrame, n: int, text: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            size, a, b = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.uint64)
            for k, own in sets(batch.column(1), n):
                size[k], a[k], b[k] = len(own), own.sum(), mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                             names=["doc_id", "n", "fp1", "fp2"])

    return docs.select("doc_id", text).mapInArrow(run, "doc_id long, n long, fp1 long, fp2 long")


def frequent(docs: DataFrame, n: int, text: str) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and their counts."""
    def tally(found):
        h = np.concatenate(found)
        h.sort()
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        count = np.diff(np.r_[first, len(h)])
        keep = count >= PART_COUNT
        return pa.RecordBatch.from_pydict({"token": h[first[keep]].view(np.int64), "n": count[keep].astype(np.int64)})

    def run(batches):
        found, total = [], 0
        for batch in batches:
            for _, own in sets(batch.column(0), n):
                found.append(own)
                total += len(own)
                if total >= PART_SHINGLES:
                    yield tally(found)
                    found, total = [], 0
        if total:
            yield tally(found)

    rows = docs.select(text).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = rows.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "token").limit(HINTS).toPandas()
    token = top.token.to_numpy(np.int64).view(np.uint64)
    order = np.argsort(token)
    return token[order], top.n.to_numpy(np.int64)[order]


def prefixes(docs: DataFrame, n: int, percent: int, hints: tuple[np.ndarray, np.ndarray], text: str) -> DataFrame:
    """token, doc and pack of every prefix shingle: set size, matches asked for (5 bits) and whether it is ordered last (1 bit)."""
    often, count = hints

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            token, doc, pack = [], [], []
            for k, own in sets(batch.column(1), n):
                if not len(own):
                    continue
                cost = np.zeros(len(own), np.int64)
                if len(often):
                    at = np.minimum(np.searchsorted(often, own), len(often) - 1)
                    cost = np.where(often[at] == own, count[at], 0)
                    own = np.r_[own[cost == 0], own[cost > 0]]
                    cost = np.r_[cost[cost == 0], cost[cost > 0]]
                first = len(own) - _need(len(own), percent) + 1
                # One more match for every doubling of the candidates that frequent shingles bring.
                match = min(MOST_MATCH, LEAST_MATCH + int(cost[:first].sum() // FREQUENT).bit_length())
                match = min(match, _need(len(own), percent))
                own_prefix = own[:first + match - 1]
                token.append(own_prefix)
                doc.append(np.full(len(own_prefix), ids[k]))
                pack.append((len(own) << 6 | match << 1) + (cost[:len(own_prefix)] > 0))
            if token:
                yield pa.RecordBatch.from_arrays([_signed(np.concatenate(token)), pa.array(np.concatenate(doc)), pa.array(np.concatenate(pack))], names=["token", "doc", "pack"])

    return docs.select("doc_id", text).mapInArrow(run, "token long, doc long, pack long")


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def token_lists(prefix: DataFrame) -> DataFrame:
    """token, doc, n (set size), l (matches asked for), often (ordered last) and head (the least
    document of the list) of the prefix shingles that another prefix holds too.

    The list of a frequent shingle is dealt into ``DEALT`` lists with a head each."""
    often = F.col("pack").bitwiseAND(F.lit(1)) == 1
    dealt = prefix.withColumn("often", often).withColumn("deal", F.when(often, F.pmod(F.xxhash64("doc"), F.lit(DEALT))).otherwise(0))
    own = Window.partitionBy("token", "deal")
    # Shingles that only one prefix holds bring no candidate.
    listed = dealt.withColumn("head", F.min("doc").over(own)).withColumn("last", F.max("doc").over(own)).where("often OR head <> last")
    return listed.select("token", "doc", F.shiftright("pack", 6).alias("n"), F.shiftright("pack", 1).bitwiseAND(F.lit(31)).cast("int").alias("l"), "often", "head")


def similar(docs: DataFrame, pairs: DataFrame, n: int, percent: int, text: str) -> DataFrame:
    """The pairs (x, y) whose whole sets have the similarity asked for, as edges u, v."""
    rows = docs.select("doc_id", F.col(text).alias("text"))
    small = pairs.count() <= BROADCAST_IDS
    left = rows.join(F.broadcast(pairs) if small else pairs, F.col("doc_id") == F.col("x")).select("x", "y", F.col("text").alias("text_x"))
    right = only(rows, pairs.select(F.col("y").alias("doc_id")).distinct(), "doc_id").select(F.col("doc_id").alias("y"), F.col("text").alias("text_y"))

    def run(batches):
        known: dict[int, np.ndarray] = {}
        held = 0
        for batch in batches:
            xs, ys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            u, v = [], []
            # As many pairs at once as keep the sets of their texts within bounds.
            for lo, hi in slices(flat(batch.column(2))[1] + flat(batch.column(3))[1], KEPT_SETS):
                for side, ids in ((2, xs), (3, ys)):
                    where = {ids[k]: k for k in range(lo, hi) if ids[k] not in known}
                    take = list(where.values())
                    for k, own in sets(batch.column(side).take(pa.array(take, pa.int64())), n):
                        known[ids[take[k]]] = own
                        held += own.nbytes
                for x, y in zip(xs[lo:hi], ys[lo:hi], strict=True):
                    a, b = known[x], known[y]
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    if 100 * both >= percent * (len(a) + len(b) - both):
                        u.append(x)
                        v.append(y)
                if held > KEPT_SETS:
                    known, held = {}, 0
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return left.join(right, "y").select("x", "y", "text_x", "text_y").mapInArrow(run, "u long, v long")


def _counted(table: pa.Table, n: int, percent: int) -> pa.Table:
    """Links between all documents of one pair of blocks: each document with the first of its component there."""
    ids = np.array(table.column("doc_id").to_pylist(), np.int64)
    own = [x for _, x in sets(table.column("text"), n)]
    size = np.array([len(x) for x in own], np.float32)
    row, (token, column, times) = np.repeat(np.arange(len(own)), size.astype(np.int64)), np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
    # Shingles of one document alone add to no overlap.
    shared = np.flatnonzero(times > 1)
    place = np.full(len(token), -1)
    place[shared] = np.arange(len(shared))
    row, column = row[place[column] >= 0], place[column][place[column] >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(own), len(own)), np.float32)
    for lo in range(0, len(shared), 2048):
        a, b = np.searchsorted(column, [lo, lo + 2048])
        part = np.zeros((len(own), 2048), np.float32)
        part[row[a:b], column[a:b] - lo] = 1
        both += part @ part.T
    near = 100 * both >= percent * (size[:, None] + size[None, :] - both)
    np.fill_diagonal(near, True)
    label = np.arange(len(own))
    while True:
        now = np.where(near, label[None, :], len(own)).min(1)
        now = now[now]
        if (now == label).all():
            break
        label = now
    linked = np.flatnonzero(label != np.arange(len(own)))
    return pa.table({"u": ids[linked], "v": ids[label[linked]]})


def frequent_links(docs: DataFrame, lists: DataFrame, n: int, percent: int) -> DataFrame:
    """Links between documents whose prefixes share frequent shingles, as edges u, v."""
    often = lists.where("often")
    # Heads of one shingle's lists meet in the least of them.
    heads = often.where("doc = head").groupBy("token").agg(F.collect_set("head").alias("heads")).select(F.explode("heads").alias("doc"), F.array_min("heads").alias("head"))
    reach = often.select("doc", "head").union(heads).where("doc <> head").distinct()
    cluster = cut(components(reach.select(F.col("doc").alias("u"), F.col("head").alias("v"))), "clusters")
    blocks = cluster.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    place = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = cut(cluster.join(blocks, "label").select(F.col("id").alias("doc_id"), "label", "blocks", place.alias("a")), "blocks")
    texts = docs.join(F.broadcast(dealt) if dealt.count() <= BROADCAST_IDS else dealt, "doc_id")
    met = texts.withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "label", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "doc_id", "text")
    return met.groupBy("label", "a", "b").applyInArrow(lambda t: _counted(t, n, percent), "u long, v long")


def _fits(percent: int):
    """Sizes that allow the similarity."""
    return F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent


def link(docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every row."""
    tables = Tables(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    base = cut(fingerprints(rows, n, "text"), "sets")
    full = base.where("n > 0 AND doc_id IS NOT NULL")
    nodes = full.groupBy("fp1", "fp2", "n").agg(F.min("doc_id").alias("node"))
    nodes = cut(nodes, "nodes")
    own = only(rows, nodes.select(F.col("node").alias("doc_id")), "doc_id")
    lists = tables.cut(token_lists(prefixes(own, n, percent, frequent(own, n, "text"), "text")), "lists")

    blocks = cut(frequent_links(own, lists, n, percent), "links")
    all_lists, lists = lists, lists.where("NOT often")

    # First round: each document with the head of a list that it shares most with.
    heads = lists.where("doc = head").select("token", F.col("n").alias("n2"), F.col("l").alias("l2"))
    near = (lists.where("doc <> head").join(heads, "token").where(_fits(percent))
            .groupBy("doc", "head").agg(F.count(F.lit(1)).alias("c"), F.min(F.least("l", "l2")).alias("l")).where("c >= l")
            .groupBy("doc").agg(F.max_by("head", F.struct("c", -F.col("head"))).alias("y")))
    first = cut(similar(own, cut(near.select(F.col("doc").alias("x"), "y"), "pairs"), n, percent, "text").union(blocks), "links")
    label = cut(components(first), "labels")

    # Second round: candidates that are still apart.
    far = lists.join(label.withColumnRenamed("id", "doc"), "doc", "left").select("token", "doc", "n", "l", F.coalesce("label", "doc").alias("label"))
    own_list = Window.partitionBy("token")
    far = tables.cut(far.withColumn("a", F.min("label").over(own_list)).withColumn("b", F.max("label").over(own_list)).where("a <> b").drop("a", "b"), "apart")
    other = far.select("token", F.col("doc").alias("doc2"), F.col("n").alias("n2"), F.col("l").alias("l2"), F.col("label").alias("label2"))
    # Both orders of a pair meet; the one with the larger id first stays.
    rest = (far.join(other, "token").where((F.col("doc") > F.col("doc2")) & (F.col("label") != F.col("label2"))).where(_fits(percent))
            .groupBy("doc", "doc2").agg(F.count(F.lit(1)).alias("c"), F.min(F.least("l", "l2")).alias("l")).where("c >= l"))
    pairs = cut(rest.select(F.col("doc").alias("x"), F.col("doc2").alias("y")), "pairs")
    tables.drop(all_lists, far)
    second = similar(own, pairs, n, percent, "text")
    label = components(first.union(second))

    named = nodes.join(label.withColumnRenamed("id", "node"), "node", "left").select("fp1", "fp2", "n", F.coalesce("label", "node").alias("component_id"))
    whole = full.join(named, ["fp1", "fp2", "n"]).select("doc_id", "n", "component_id")
    lone = base.where("NOT (n > 0 AND doc_id IS NOT NULL)").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return whole.union(lone).withColumnRenamed("n", "n_shingles")
