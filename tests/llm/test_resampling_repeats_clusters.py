"""Radix resampling, recompression and ns-bounds against brute force: nulls, ties, repeats, long texts, clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import ns_kmeans, radix_resampling, recompression


def same(df, want, n):
    return Counter(tuple(x)[:n] for x in df.collect()) == Counter(want)


# Radix resampling


def drawn(docs, bench, run, percent=10, min_words=20):
    def features(text):
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in range(1, run + 1) for i in range(len(w) - k + 1)]

    s, t = (Counter(b for _, text in table for b in features(text)[1]) for table in (docs, bench))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000))))
    out = []
    for i, text in docs:
        n, f = features(text)
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((n >= min_words, i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[0]), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2]))
    n = percent * len(able) // 100
    return [(*r[1:], k + 1 if k < n else None) for k, r in enumerate(able)] + [(*r[1:], None) for r in out if not r[0]]


@pytest.fixture(scope="module")
def prose():
    r = random.Random(3)
    forms = ["the", "Fox", "é日", "a1", "x" * 80, "b-c", "\x00d", "ÀB"]
    docs = [(i if i % 17 else None, " ".join(r.choices(forms, k=r.randrange(60)))) for i in range(200)]
    return docs + [(5, "the fox " * 30)] * 9 + [(5, "the fox " * 40), (7, None), (8, ""), (-2**63, "aa bb " * 20), (2**63 - 1, "aa bb cc " * 20)]


@pytest.mark.parametrize(("run", "digit", "block"), [(1, 11, 1 << 13), (2, 7, 8)])
def test_radix_resampling(spark, prose, run, digit, block):
    bench = [(0, "the fox a1 " * 10), (1, None), (2, "b c")]
    d = spark.createDataFrame(prose, "doc_id long, text string").withColumns({"score": F.lit(1), "place": F.lit(2), "rank": F.lit("x"), "digit": F.lit(0)}).repartition(5)
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = radix_resampling.resample(d, b, run=run, digit=digit, block=block, percent=60)
    assert same(got, drawn(prose, bench, run, percent=60), 5)


def test_radix_resampling_of_empty_tables(spark, prose):
    d = spark.createDataFrame(prose[:40], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert radix_resampling.resample(d.where("false"), d).count() == 0
    assert same(radix_resampling.resample(d, b), drawn(prose[:40], [], 1), 5)


def test_crc_of_byte_ranges():
    data = np.frombuffer(b"abc" * 200, np.uint8)
    start, end = np.array([0, 3, 0, 7, 5]), np.array([3, 3, 600, 8, 70])
    want = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(start, end, strict=True)]
    assert radix_resampling.crc32(data, start, end).tolist() == want


# Recompression


def without_repeats(docs, window):
    table = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    place = lambda i: -math.inf if i is None else i
    least = {}
    for i, w in table:
        for k in range(len(w) - window + 1):
            x = tuple(w[k:k + window])
            least[x] = min(least.get(x, math.inf), place(i))
    for i, w in table:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if least[tuple(w[k:k + window])] < place(i):
                gone[k:k + window] = [True] * window
        yield i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest()


@pytest.fixture(scope="module")
def passages():
    r = random.Random(1)
    prose = lambda n: [f"w{r.randrange(300)}" for _ in range(n)]
    shared = [prose(n) for n in (30, 48, 49, 50, 51, 60, 75, 99, 140)] + [["a"] * n for n in (49, 50, 80)] + [["a", "b"] * 40]
    docs = []
    for i in range(120):
        words = [w for _ in range(r.randrange(6)) for w in prose(r.randrange(40)) + r.choice(shared)]
        docs.append((i if i % 13 else r.choice([None, 3, 4]), r.choice([" ", "\n", "\t  "]).join(words)))
    docs += [(500, None), (501, ""), (502, " \n "), (503, "word"), (504, docs[5][1]), (504, docs[5][1]), (None, docs[6][1])]
    long = prose(3000)
    return docs + [(600, " ".join(long)), (601, " ".join(long[1000:2200] + prose(30) + long[100:160])), (602, " ".join(["x" * 4000, *long[:700]]))]


@pytest.mark.parametrize(("window", "piece", "part", "hot"), [(50, 1 << 20, 1 << 18, 1 << 12), (7, 1 << 20, 1 << 18, 1 << 12), (50, 1 << 20, 50, 4), (50, 900, 100, 1 << 30)])
def test_recompression(spark, passages, monkeypatch, window, piece, part, hot):
    """Whole, with short windows, in small parts with hot buckets, and long texts in pieces."""
    for name, value in (("PIECE", piece), ("PART", part), ("HOT", hot)):
        monkeypatch.setattr(recompression, name, value)
    d = spark.createDataFrame(passages, "doc_id long, text string").withColumns({"bucket": F.lit(1), "tag": F.lit("x"), "lo": F.lit(2), "doc": F.lit(3)}).repartition(4)
    got = recompression.remove_repeats(d, window=window)
    want = list(without_repeats(passages, window))
    assert same(got, want, 4) and sum(x[2] > 0 for x in want) > 50
    for r in got.collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_removed and len(r.kept.split()) == r.n_words - r.n_removed


def test_recompression_of_no_rows(spark):
    assert recompression.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("rounds", [1, 3, 6])
def test_anchors_depend_on_the_window_alone(rounds):
    r = random.Random(rounds)
    for _ in range(60):
        window = r.choice([5, 20, 50])
        word = np.random.default_rng(r.randrange(1 << 30)).integers(1, r.choice([2, 3, 500]) + 1, window).astype(np.uint64)
        found = set()
        for _ in range(4):
            before, after = ([r.choice(word) for _ in range(r.randrange(9))] for _ in range(2))
            h = np.array([*before, *word, *after], np.uint64)
            place, name = recompression.anchors(h, np.array([len(before)]), window, rounds)
            found.add((int(place[0]) - len(before), int(name[0])))
        assert len(found) == 1 and 0 <= found.pop()[0] < window


# Clusters


def clustered(rows, k=16, rounds=3, width=64):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [v for _, v in first]
    assign = lambda: [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        groups = defaultdict(list)
        for (_, j), (_, v) in zip(assign(), kept, strict=True):
            groups[j].append(v)
        centroids = [[sum(x) // len(groups[j]) for x in zip(*groups[j], strict=True)] if j in groups else c for j, c in enumerate(centroids)]
    final, inertia = assign(), Counter()
    for d, j in final:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, j, d, inertia[j], inertia.total(), digest[j]) for (i, _), (d, j) in zip(kept, final, strict=True)]


@pytest.fixture(scope="module")
def vectors():
    r = random.Random(1)
    rows = [(i if i % 9 else None, [r.choice([-1.5, 0.0, 0.3, 2.0, 5.0]) for _ in range(4)]) for i in range(400)]
    rows += [(3, [1.0, 2.0, 3.0, 4.0])] * 90 + [(4, None), (5, [1.0, 2.0]), (6, [None, 1.0, 2.0, 3.0]), (7, [math.nan, 1.0, 2.0, 3.0]), (8, [math.inf, 1.0, 2.0, 3.0])]
    return rows + [(9, [40000.0, -3e4, 2.0, 1e5])]


@pytest.mark.parametrize("rounds", [0, 1, 7])
def test_ns_kmeans(spark, vectors, rounds):
    d = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumns({"vec": F.lit(1), "cluster": F.lit("x"), "own": F.lit(2)}).repartition(3)
    assert same(ns_kmeans.cluster(d, width=4, rounds=rounds), clustered(vectors, rounds=rounds, width=4), 6)


def test_ns_kmeans_of_few_rows(spark, vectors):
    d = spark.createDataFrame(vectors[:5], "vec_id long, embedding array<float>")
    assert same(ns_kmeans.cluster(d, width=4), clustered(vectors[:5], width=4), 6)
    assert ns_kmeans.cluster(d.where("false"), width=4).count() == 0


def test_bounds_spare_distances():
    """Later rounds evaluate a part of all distances, and total displacement is a better bound than the sum of drifts."""
    g = np.random.default_rng(2)
    x = np.concatenate([g.integers(-40, 40, (1, 16)) * 4 + g.integers(-9, 10, (300, 16)) for _ in range(8)])
    # Centroids that wander and come back.
    base = np.stack([x[k * 300] for k in range(8)])
    history = [base]
    d = ns_kmeans.distances(x, base)
    cluster = d.argmin(1)
    own, seen, at = d[np.arange(len(x)), cluster], np.sqrt(d) * (1 - 1e-6), np.zeros(d.shape, np.int64)
    counts = []
    for step in (6, 12, 6, 0):
        history.append(base + step)
        cluster, own, seen, at, n = ns_kmeans.nearest(x, cluster, own, seen, at, history)
        assert (cluster == ns_kmeans.distances(x, history[-1]).argmin(1)).all()
        counts.append(n)
    assert max(counts) < d.size / 2 and counts[-1] <= counts[1]
