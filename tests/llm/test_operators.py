"""The text operators against brute force, on small tables with nulls, ties, repeats and long texts."""

import hashlib
import re
from collections import Counter

import oracle
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tidewater.llm import (chat, decontaminate, importance, jaccard_join, language_id, line_runs, quality_rules, queries,
                           sentencepiece_bpe, suffix_dedup, warc)

SF = "/root/testdata/sf0.001"
PROSE = "the quick brown fox jumps over a lazy dog while seven large boxes of red wine wait near the old harbour wall at dusk."
OTHER = " ".join(f"word{i}" for i in range(60)) + "."
DOCS = [
    (0, None), (1, ""), (2, " \n\t \n"), (3, PROSE), (4, PROSE), (5, PROSE.upper()), (6, PROSE + "\n" + OTHER), (7, OTHER),
    (8, OTHER.replace("word30", "changed")), (9, "ab" * 4000), (10, (PROSE + "\n") * 300), (11, "é🎉 日本 " * 50), (12, "one two"),
    (13, "one two"), (14, "line of some forty characters that repeats a lot\n" * 2 + "tail"), (15, OTHER + "\n" + PROSE), (None, PROSE),
    (16, "  " + PROSE + "  \r"), (17, "|".join(" a b " for _ in range(40))), (18, PROSE + "\x00"), (19, "a" * 99), (20, "a" * 100),
]


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.createDataFrame(DOCS, "doc_id long, text string")
    return d.select("doc_id", "text", F.lit("en").alias("lang"), F.lit(1).alias("n"), F.lit(2).alias("ids"), F.lit(3).alias("token")).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def rows(df, *cols):
    return {r.doc_id: tuple(r[c] for c in cols) for r in df.collect() if r.doc_id is not None}


def ordered():
    return sorted(DOCS, key=lambda x: -1 if x[0] is None else x[0])


def test_suffix_dedup(docs, none):
    seen, want = set(), {}
    for i, t in ordered():
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - 99):
            if b[k:k + 100] in seen:
                gone[k:k + 100] = [True] * 100
            seen.add(b[k:k + 100])
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not p for p, g in zip([False, *gone], gone, strict=False))
        want[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    want.pop(None)
    assert rows(suffix_dedup.remove_repeats(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_suffix_dedup_of_shared_phrases(spark):
    """Phrases of 40 to 160 letters between other letters: many suffixes share a bucket, few a whole string."""
    import random

    r = random.Random(5)
    letters = lambda n: "".join(r.choices("abcdefgh ", k=n))
    phrases = [letters(n) for n in (40, 55, 70, 85, 99, 100, 101, 130, 160)]
    texts = [letters(r.randrange(30)).join(r.choices(phrases, k=12)) + letters(r.randrange(60)) for _ in range(60)]
    seen, want = set(), {}
    for i, t in enumerate(texts):
        gone = [False] * len(t)
        for k in range(len(t) - 99):
            if t[k:k + 100] in seen:
                gone[k:k + 100] = [True] * 100
            seen.add(t[k:k + 100])
        want[i] = (sum(gone), hashlib.sha256("".join(x for x, g in zip(t, gone, strict=True) if not g).encode()).hexdigest())
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert rows(suffix_dedup.remove_repeats(d), "n_removed", "kept_sha256") == want
    assert 0 < sum(n for n, _ in want.values()) < sum(map(len, texts))


def test_suffix_dedup_of_texts_with_one_id(spark):
    """Null and repeated ids with texts of several lengths: each keeps what is its own, and of each repeat one stays."""
    import random

    r = random.Random(9)
    letters = lambda n: "".join(r.choices("abcdefgh ", k=n))
    shared, twin = letters(130), letters(400)
    table = [(None, letters(700) + shared + letters(300)), (None, shared + letters(20)), (None, letters(40) + shared), (None, "short"), (None, None),
             (5, shared + letters(50)), (5, letters(900) + shared), (5, twin), (5, twin), (7, twin + "x"), (8, letters(300))]
    # Texts of one id with a repeat at the same offset.
    table += [(9, (head := letters(150)) + letters(250)), (9, head + letters(60)), (None, (tail := letters(120)) + "b"), (None, tail + "c" * 80)]
    d = spark.createDataFrame(table, "doc_id long, text string").repartition(4)
    tag = {(x.doc_id, x.text): x.tag for x in d.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("tag")).collect()}
    seen, want = set(), Counter()
    own = Counter((i, t or "") for i, t in table)
    for i, t in sorted(own, key=lambda x: (x[0] is not None, x[0] or 0, tag[x])):
        gone = [False] * len(t)
        for k in range(len(t) - 99):
            if t[k:k + 100] in seen:
                gone[k:k + 100] = [True] * 100
            seen.add(t[k:k + 100])
        want[i, len(t), sum(gone), hashlib.sha256("".join(x for x, g in zip(t, gone, strict=True) if not g).encode()).hexdigest()] += own[i, t]
    got = suffix_dedup.remove_repeats(d).collect()
    assert Counter((x.doc_id, x.n_bytes, x.n_removed, x.kept_sha256) for x in got) == want
    assert sum(k[2] > 0 for k in want) == 7


def test_suffix_dedup_across_pieces(docs, monkeypatch):
    import numpy as np

    data = np.frombuffer((PROSE * 40).encode(), np.uint8)
    whole = suffix_dedup.suffixes(data, np.array([0, len(data)]))
    monkeypatch.setattr(suffix_dedup, "PIECE", 500)
    import pyarrow as pa

    covered = []
    for _, base, part, off in suffix_dedup._places(np.array([7]), pa.array([(PROSE * 40)])):
        _, lo, hi, *_ = suffix_dedup.suffixes(part, off)
        covered += [p for a, b in zip(lo + base, hi + base, strict=True) for p in range(a, b + 1)]
    assert sorted(covered) == sorted(p for a, b in zip(whole[1], whole[2], strict=True) for p in range(a, b + 1))


def test_sentencepiece_equals_library(docs, none):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=queries.model_path())
    got = sentencepiece_bpe.encode(docs, queries.model_path()).collect()
    texts = Counter(t or "" for _, t in DOCS)
    assert len(got) == len(DOCS)
    want = Counter()
    for t, n in texts.items():
        ids = lib.encode(t, add_bos=True, add_eos=True) if t else [lib.bos_id(), lib.eos_id()]
        want[b"".join(i.to_bytes(4, "little") for i in ids), lib.decode(ids)] += n
    assert Counter((bytes(r.ids), r.decoded) for r in got) == want
    assert sentencepiece_bpe.encode(none, queries.model_path()).count() == 0


def test_sentencepiece_long_chunks():
    e = sentencepiece_bpe.encoder(queries.model_path())
    texts = ["a" * 3000, "  " * 500 + "x", "the" * 2000, "▁", "a▁▁b ", "é" * 200 + " ﬁ"]
    want = e.lib.encode(texts, add_bos=True, add_eos=True)
    assert [list(memoryview(x).cast("I")) for x in e.encode(texts)] == want


def test_quality_rules(docs, none):
    got = rows(quality_rules.clean_lines(docs), "n_words", "n_dup_lines", "n_repeat_words", "kept")
    for i, t in DOCS:
        if i is None:
            continue
        w = [x for x in re.split(r"[\x20\x09-\x0d]+", t or "") if x]
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
        win = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        covered = {p for k in range(len(w) - 7) if win[tuple(w[k:k + 8])] > 1 for p in range(k, k + 8)}
        assert got[i][:3] == (len(w), len(lines) - len(set(lines)), len(covered)), i
    assert got[3][3] and not got[17][3] and not got[10][3]
    assert quality_rules.clean_lines(none).count() == 0


def test_warc_round_trip(spark):
    big = "x" * 1500
    pages = [(1, "u", big), (2, None, big), (3, "a b\r\nc", big), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (None, "u", "y" * 1200),
             (7, "u", "é\r\n\r\n" * 400)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    got = {r.record: r for r in warc.archive(df).collect()}
    assert {k: got[k].refers_to for k in got} == {1: 3, 2: 3, 3: None, 4: None, 5: None, 6: None, 7: None, None: None}
    assert {k for k in got if got[k].record_type == "revisit"} == {1, 2}
    for i, _, h in pages:
        b = (h or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(b), hashlib.sha1(b).hexdigest())
    assert warc.archive(df.where("false")).count() == 0


def test_importance_selects_target(spark, none):
    rows_ = [(i, f"{PROSE} item{i % 7} and more of it") for i in range(400)] + [(1000 + i, f"{PROSE} awful{i % 2} trash words here") for i in range(100)]
    d = spark.createDataFrame([*rows_, (2000, None), (2001, "")], "doc_id long, text string").repartition(4)
    target = spark.range(0, 200).withColumnRenamed("id", "doc_id")
    got = {r.doc_id: r for r in importance.resample(d, target).collect()}
    assert len(got) == 502 and got[2000].log_ratio == 0
    assert sum(got[i].kept for i in range(400)) >= 398 and not any(got[1000 + i].kept for i in range(100))
    k = importance.resample(d, target, k=50).where("kept").count()
    assert k == 50
    assert importance.resample(none, target).count() == 0


def test_importance_border_reads_few_rows(spark, monkeypatch):
    """Keys far apart, with ties: the border of sorting, and no step gives the driver a row per document."""
    keys = [int(((-1) ** i) * i ** 2.5 * importance.GRAIN) for i in range(3000)] + [-7] * 5
    scored = spark.createDataFrame([(k,) for k in keys], "sample_key long")
    sizes, collect = [], type(scored).collect
    monkeypatch.setattr(type(scored), "collect", lambda self: sizes.append(len(out := collect(self))) or out)
    for k in (1, 1500, 1503, 3005):
        assert importance.border(scored, k) == sorted(keys, reverse=True)[k - 1]
    assert importance.border(scored, 0) > max(keys) and importance.border(scored, 3006) < min(keys)
    assert importance.border(scored.where("false"), 3) < 0
    assert sizes and max(sizes) <= 1024


def test_jaccard_components(docs, none):
    def shingles(t):
        w = [x for x in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        return frozenset(tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset()

    s = {i: shingles(t) for i, t in DOCS if i is not None}
    label = {i: i for i in s}
    for _ in s:
        for a in s:
            for b in s:
                if s[a] and s[b] and 100 * len(s[a] & s[b]) >= 85 * len(s[a] | s[b]):
                    label[a] = min(label[a], label[b])
    assert rows(jaccard_join.link(docs, 4, 85), "n_shingles", "component_id") == {i: (len(s[i]), label[i]) for i in s}
    assert jaccard_join.link(none).count() == 0


def test_jaccard_frequent_blocks(spark, monkeypatch):
    import random

    r = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for k in range(260):
        w = list(base)
        for j in range(r.randint(0, 5)):
            w[r.randrange(150)] = f"new{k}x{j}"
        texts.append((k, " ".join(w)))
    s = {i: {tuple(t.split()[k:k + 4]) for k in range(147)} for i, t in texts}
    label = {i: i for i in s}
    edges = [(a, b) for a in s for b in s if a < b and 100 * len(s[a] & s[b]) >= 85 * len(s[a] | s[b])]
    for _ in range(20):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    monkeypatch.setattr(jaccard_join, "BLOCK", 64)
    got = rows(jaccard_join.link(spark.createDataFrame(texts, "doc_id long, text string"), 4, 85), "component_id")
    assert got == {i: (label[i],) for i in s}


def test_leaks(docs, none, spark):
    item = "a rare test question about the number of moons that circle the planet jupiter in total."
    edited = item.replace("moons", "satellites").replace("question", "problem")
    d = docs.select("doc_id", "text").union(spark.createDataFrame([(50, PROSE + " " + item + " " + OTHER), (51, OTHER + " " + edited.upper())], "doc_id long, text string"))
    bench = spark.createDataFrame([(1, item), (2, item), (3, None), (4, "too short"), (5, "nothing of these words is in any text at all here")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(d, bench).collect()}
    assert set(got) == {(50, 1), (50, 2), (51, 1), (51, 2)}
    assert got[50, 1] == 1 and 0.5 < got[51, 1] < 1
    assert decontaminate.leaks(none, bench).count() == 0 and decontaminate.leaks(d, bench.where("false")).count() == 0


def test_leaks_of_copies_only(spark):
    """Every item occurs only as an edited or partial copy, or edited beside exact copies: the same as aligning all with all."""
    import random

    r = random.Random(11)
    word = lambda: f"w{r.randrange(4000)}"
    items = [[word() for _ in range(r.randint(24, 60))] for _ in range(24)]
    texts = []
    for i, w in enumerate(items):
        prose = lambda: [word() for _ in range(r.randint(0, 120))]
        if i % 4 == 3:
            # Seven tenths, or the first six tenths with a word put in.
            copy = w[len(w) // 5:len(w) // 5 + len(w) * 7 // 10] if i % 8 == 3 else [*w[:len(w) // 3], "more", *w[len(w) // 3:len(w) * 6 // 10 + 2]]
        else:
            copy = [x if j % (4 + i % 3) else f"new{i}x{j}" for j, x in enumerate(w)]
        texts.append(prose() + copy + prose())
        if i % 4 == 2:
            # Exact copies: what the edited one lacks is rarer than what it shares.
            texts += [prose() + w + prose() for _ in range(3)]
    texts += [[word() for _ in range(80)] for _ in range(20)]
    want = {}
    for d, t in enumerate(texts):
        for i, w in enumerate(items):
            above, best = [0.0] * (len(t) + 1), 0.0
            for x in w:
                now = [0.0]
                for j, y in enumerate(t):
                    now.append(max(0.0, above[j] + (1 if x == y else -0.5), above[j + 1] - 0.5, now[j] - 0.5))
                best, above = max(best, *now), now
            if best >= 0.5 * len(w):
                want[d, i] = best / len(w)
    assert len(want) >= 24 and {i for _, i in want} == set(range(24))
    d = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    got = {(x.doc_id, x.item_id): x.score for x in decontaminate.leaks(d, bench).collect()}
    assert got == pytest.approx(want)


def test_alignment_is_smith_waterman():
    import random

    import numpy as np

    r = random.Random(1)
    for _ in range(50):
        a, b = [[r.randint(0, 4) for _ in range(r.randint(1, 12))] for _ in range(2)]
        h = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                h[i + 1][j + 1] = max(0, h[i][j] + (1 if x == y else -0.5), h[i][j + 1] - 0.5, h[i + 1][j] - 0.5)
        assert decontaminate.align(np.array(a), np.array(b))[0] == max(map(max, h))


def test_perspectives(spark):
    t = [(1, 0, "system", "rules"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (1, None, None, "first"), (2, 0, "system", "x"), (None, 1, "ann", "y")]
    got = chat.rotate(spark.createDataFrame(t, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit(1))).collect()
    for who in ("ann", "bob", "unknown"):
        own = sorted((r for r in got if r.conv_id == 1 and r.perspective == who), key=lambda r: r.start)
        whole = "".join(r.segment for r in own)
        assert len(own) == 5 and [r.start for r in own] == [sum(len(x.segment) for x in own[:k]) for k in range(5)]
        assert {r.name for r in own if r.mask_start is not None} == {who}
        assert all(whole[r.mask_start:r.mask_end].endswith("<|im_end|>") for r in own if r.mask_start is not None)
    assert not [r for r in got if r.conv_id == 2] and len([r for r in got if r.conv_id is None]) == 1


def test_languages(spark, docs, none):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    part = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    p = language_id.learn(d.where(part != 1))
    right = language_id.predict(d.where(part == 1), p, keep=("doc_id", "lang")).select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97
    got = rows(language_id.predict(docs, p), "lang_pred", "score")
    assert got[0] == got[1] == got[2] == ("und", 0.0) and got[3][0] == "en" and 0 < got[3][1] <= 1
    assert language_id.predict(docs, {}).where("lang_pred <> 'und'").count() == 0 and language_id.learn(none) == {}


def test_language_counts_in_pieces(monkeypatch):
    text = (PROSE + " Éa ") * 50
    want = [x.tolist() for x in language_id.counts([text])[1:]]
    monkeypatch.setattr(language_id, "PIECE", 100)
    ((_, _, grams, n),) = list(language_id._grouped([text]))
    assert [grams.tolist(), n.tolist()] == want


def test_odd_columns_and_ids(spark, docs):
    """Columns named like those inside, with dots and quotes, and ids at both ends of the range."""
    line = "a line of more than forty characters that repeats often"
    ids = [-2**63, -1, 0, 1, 2**63 - 1, None]
    d = spark.createDataFrame([(i, f"{line}\nown {i}") for i in ids], "doc_id long, text string")
    got = rows(line_runs.dedup_lines(d), "n_dropped", "kept_text")
    assert got == {i: (int(i != 2**63 - 1), f"own {i}" if i != 2**63 - 1 else f"{line}\nown {i}") for i in ids if i is not None}
    odd = d.withColumns({"_t": F.lit(1), "a.b": F.lit("x"), "c`d": F.lit(2), "_id": F.lit("y"), "n_chars": F.lit(0).cast("long")})
    out = corpus_pipeline.lines(spark, odd, SF)
    assert out.columns == odd.columns and {(r["a.b"], r["c`d"]) for r in out.collect()} == {("x", 2)}
    target = spark.createDataFrame([(1,), (2,)], "doc_id long")
    assert importance.resample(odd, target).count() == len(ids)


@pytest.mark.parametrize("batches", [1, 4])
def test_line_runs(docs, none, batches):
    key = {}
    for i, t in DOCS:
        for x in (t or "").split("\n"):
            k = re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
            if len(k) >= 40 and i is not None:
                key.setdefault(k, set()).add(i)
    want = {}
    for i, t in DOCS:
        parts = (t or "").split("\n")
        keep = [x for x in parts if not (len(d := key.get(re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r")), ())) >= 3 and max(d) != i)]
        want[i] = (len(parts), len(parts) - len(keep), "\n".join(keep))
    want.pop(None)
    assert rows(line_runs.dedup_lines(docs, min_docs=3, batches=batches), "n_lines", "n_dropped", "kept_text") == want
    assert line_runs.dedup_lines(none).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, name):
    assert oracle.compare(entry.queries()[name](spark, SF), oracle.connect(SF), queries.ORACLES[name]) is None


def test_pipeline_stages(spark, docs, none, tmp_path):
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    wide = docs.select("doc_id", "text", "lang", F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"), "ids")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, wide, str(tmp_path))
        assert stage(spark, wide.where("false"), str(tmp_path)).count() == 0
        if name != "encode":
            assert out.columns == wide.columns
        left = {r.doc_id for r in out.collect()}
        assert {7, 12} & left or name == "lines"
    near = {r.doc_id for r in corpus_pipeline.near_copies(spark, wide, str(tmp_path)).collect()}
    assert 3 in near and 4 not in near and 5 not in near and 8 not in near and None in near
