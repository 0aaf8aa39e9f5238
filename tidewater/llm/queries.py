"""One query per operator over whole tables, with oracle SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (chat, decontaminate, importance, jaccard_join, language_id, line_runs, ns_kmeans, quality_rules,
                           radix_resampling, recompression, sentencepiece_bpe, suffix_dedup, warc)
from tidewater.llm.quality_rules import BARS, BOILERPLATE, NOISY
from tidewater.session import load

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

WORDS = "list_filter(string_split_regex({0}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TRIM = "trim({0}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"

#: CRC-32 of a text column, byte by byte, and the one-row table it looks bytes up in.
CRC32 = """xor(list_reduce(list_transform(range(strlen({0})), lambda i: ('0x' || substr(hex(encode({0})), 2 * i + 1, 2))::BIGINT),
  lambda c, b: xor(c >> 8, crc_bytes[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"""
CRC_BYTES = "list_transform(range(256), lambda n: list_reduce(range(8), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, n)) AS crc_bytes"


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_suffix_dedup", """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS k FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - 99)) AS i FROM d WHERE len(h) >= 200)),
r AS (SELECT doc_id, i FROM s QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
n AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER w + 100 THEN 0 ELSE 1 END AS new FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM n),
p AS (SELECT doc_id, a, b, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS next FROM (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM g GROUP BY doc_id, g)),
q AS (SELECT p.doc_id, sum(b - a) AS lost, count(*) AS n, substr(any_value(h), 1, 2 * min(a)) || string_agg(substr(h, 2 * b + 1, 2 * (coalesce(next, len(h) // 2) - b)), '' ORDER BY a) AS kept
  FROM p JOIN d ON d.doc_id = p.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, len(h) // 2 AS n_bytes, coalesce(lost, 0)::BIGINT AS n_removed, coalesce(n, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN q ON q.doc_id = d.doc_id
""")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.remove_repeats(load(spark, sf, "documents")).drop("kept", "spans")


@query("op2_sentencepiece")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    d = sentencepiece_bpe.encode(load(spark, sf, "documents"), model_path())
    return d.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op3_quality_rules", f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, {WORDS.format("t")} AS w FROM d),
win AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM w WHERE len(w) >= 8),
key AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k FROM win),
twin AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM key) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twin) GROUP BY doc_id),
line AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d),
own AS (SELECT doc_id, l, {WORDS.format("l")} AS w FROM line WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')),
bad AS (SELECT doc_id, l, w,
  len(list_filter(w, lambda x: regexp_matches(x, '{NOISY}'))) > 0.3 * len(w)
  OR len(list_filter(w, lambda x: regexp_matches(x, '{BARS}'))) > 0.2 * len(w)
  OR {" OR ".join(f"contains(lower(l), '{p}')" for p in BOILERPLATE)} AS fails FROM own),
lines AS (SELECT doc_id, count(*) - count(DISTINCT l) AS dup, coalesce(sum(list_sum(list_transform(w, lambda x: length(x)))) FILTER (fails), 0) AS lost
  FROM bad GROUP BY doc_id),
base AS (SELECT w.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
  coalesce(lost, 0) AS lost FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id LEFT JOIN lines ON lines.doc_id = w.doc_id),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND lost <= 0.5 * word_chars AS kept FROM f
""")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.clean_lines(load(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op4_warc_revisits", """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
k AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS original FROM k)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to FROM m
""")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return warc.archive(load(spark, sf, "pages")).select(
        F.col("record").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_importance_resampling")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    good = load(spark, sf, "labels").where("quality = 1 AND toxic = 0")
    return importance.resample(load(spark, sf, "documents"), good)


@query("op6_jaccard_join", f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM both_ JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 85 * (a.n + b.n - i)),
r AS (SELECT doc_id, doc_id AS c FROM w UNION SELECT r.doc_id, link.y FROM r JOIN link ON link.x = r.c)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
""")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.link(load(spark, sf, "documents"), n=4, percent=85)


@query("op7_decontamination")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.leaks(load(spark, sf, "documents"), load(spark, sf, "benchmark"))


@query("op8_perspective_rotation", """
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS name, coalesce(text, '') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, name AS perspective FROM t WHERE name <> 'system'),
r AS (SELECT t.*, perspective, CASE WHEN name = perspective THEN 'assistant' WHEN name = 'system' THEN 'system' ELSE 'user' END AS role
  FROM t JOIN p ON p.conv_id = t.conv_id),
h AS (SELECT *, '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || regexp_replace(name, '[^\\pL\\pN_.-]', '_', 'g') ELSE '' END || chr(10) AS head FROM r),
s AS (SELECT *, head || replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS segment FROM h),
e AS (SELECT *, sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, name, text ROWS UNBOUNDED PRECEDING) AS "end" FROM s)
SELECT conv_id, perspective, turn, role, name, segment, "end" - length(segment) AS start, "end",
  CASE WHEN role = 'assistant' THEN "end" - length(segment) + length(head) END AS mask_start, CASE WHEN role = 'assistant' THEN "end" - 1 END AS mask_end FROM e
""")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return chat.rotate(load(spark, sf, "conversations"))


@query("op9_language_id")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    part = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    profiles = language_id.learn(docs.where(part != 1))
    d = language_id.predict(docs, profiles)
    return d.select("doc_id", F.coalesce(part == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op10_line_runs", f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i, ls[i] AS line, {TRIM.format(LOWER.format("ls[i]"))} AS k FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
g AS (SELECT k, count(DISTINCT doc_id) AS n, max(doc_id) AS last FROM l WHERE length(k) >= 40 GROUP BY k),
f AS (SELECT doc_id, i, line, coalesce(g.n >= 5 AND l.doc_id <> g.last, false) AS gone FROM l LEFT JOIN g ON g.k = l.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(array_to_string(list(line ORDER BY i) FILTER (NOT gone), chr(10)), '')) AS kept_sha256 FROM f GROUP BY doc_id
""")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    d = line_runs.dedup_lines(load(spark, sf, "documents"))
    return d.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op11_radix_resampling", f"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex({LOWER.format("coalesce(text, '')")}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT unnest(list_filter(string_split_regex({LOWER.format("coalesce(text, '')")}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')) AS f FROM benchmark),
f AS (SELECT doc_id, unnest(w) AS f FROM d),
crc AS (SELECT f, {CRC32.format("f")} % 10000 AS b FROM (SELECT f FROM f UNION SELECT f FROM b), (SELECT {CRC_BYTES})),
s AS (SELECT b, count(*) AS s FROM f JOIN crc USING (f) GROUP BY b),
t AS (SELECT crc.b, count(*) AS t FROM b JOIN crc USING (f) GROUP BY crc.b),
g AS (SELECT b, floor(1000 * ln((coalesce(t, 0) + 1) * (sum(s) OVER () + 10000) / ((s + 1) * ((SELECT count(*) FROM b) + 10000)))) AS g FROM s LEFT JOIN t USING (b)),
m AS (SELECT doc_id, floor(sum(g) / count(*)) AS weight FROM f JOIN crc USING (f) JOIN g USING (b) GROUP BY doc_id),
h AS (SELECT doc_id, len(w) AS n_features, coalesce(weight, 0)::BIGINT AS weight, ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h FROM d LEFT JOIN m USING (doc_id)),
c AS (SELECT doc_id, n_features, weight, (weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296))))::BIGINT AS score FROM h),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM c WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM c LEFT JOIN r USING (doc_id)
""")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return radix_resampling.resample(load(spark, sf, "documents"), load(spark, sf, "benchmark"))


@query("op12_recompression", f"""
WITH w AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
k AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)),
m AS (SELECT k, min(doc_id) AS least FROM k GROUP BY k),
g AS (SELECT DISTINCT doc_id, i + o AS p FROM k JOIN m USING (k), range(50) t(o) WHERE doc_id > least),
p AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM w),
r AS (SELECT p.doc_id, count(g.p) AS n, coalesce(array_to_string(list(x ORDER BY p.p) FILTER (g.p IS NULL), ' '), '') AS kept
  FROM p LEFT JOIN g ON g.doc_id = p.doc_id AND g.p = p.p GROUP BY p.doc_id)
SELECT w.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN r USING (doc_id)
""")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return recompression.remove_repeats(load(spark, sf, "documents")).drop("kept", "spans")


def _rounds(n: int) -> str:
    """Rounds of assignment and update as SQL."""
    nearest = "SELECT vec_id, j, d FROM (SELECT vec_id, j, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{0} c USING (i) GROUP BY vec_id, j) " \
              "QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, j) = 1"
    mean = "SELECT j, i, coalesce(m.x, c.x) AS x FROM c{0} c LEFT JOIN (SELECT j, i, floor(sum(x) / count(*))::BIGINT AS x FROM v JOIN a{0} USING (vec_id) " \
           "GROUP BY j, i) m USING (j, i)"
    steps = [f"a{k} AS ({nearest.format(k)}), c{k + 1} AS ({mean.format(k)})" for k in range(n)]
    return ",\n".join([*steps, f"a{n} AS ({nearest.format(n)})"])


@query("op13_ns_kmeans", f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
v AS (SELECT vec_id, unnest(v) AS x, unnest(range(64)) AS i FROM e),
s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS j FROM e QUALIFY j < 16),
c0 AS (SELECT j, i, x FROM v JOIN s USING (vec_id)),
{_rounds(3)},
z AS (SELECT j, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c3 GROUP BY j)
SELECT vec_id, j::INT AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY j))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a3 JOIN z USING (j)
""")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return ns_kmeans.cluster(load(spark, sf, "embeddings")).drop("centroid")
