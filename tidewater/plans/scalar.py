"""Scalar functions, collections, JSON, user functions, table changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import bags as B
from tidewater.functions import json as J
from tidewater.functions import numeric as N
from tidewater.functions import temporal as D
from tidewater.functions import udfs as U
from tidewater.operators import changelog as CL
from tidewater.plans.registry import query
from tidewater.session import load

c = F.col


@query("fn_math", """
    SELECT p_partkey, p_size + 2 * p_size - 1 AS arith, p_size // 7 AS div_int, p_size % 7 AS m, -p_size AS neg, abs(10 - p_size) AS ab,
           sign(10 - p_size) AS sg, round(power(p_size, 1.5), 6) AS pw, round(sqrt(p_size), 6) AS sq, round(exp(p_size / 50.0), 6) AS ex,
           round(ln(p_size), 6) AS l, round(log10(p_size), 6) AS lg, round(sin(p_size), 6) AS si, round(cos(p_size), 6) AS co, round(tan(p_size), 6) AS ta,
           round(cot(p_size), 6) AS ct, round(asin(p_size / 100.0), 6) AS asn, round(acos(p_size / 100.0), 6) AS acs, round(atan(p_size), 6) AS atn,
           round(atan2(p_size, 3), 6) AS at2, round(degrees(p_size), 6) AS dg, round(radians(p_size), 6) AS ra, round(pi(), 6) AS p,
           round(p_retailprice / 7, 1) AS rd, CAST(trunc(CAST((p_retailprice - 1000) / 8 AS DECIMAL(28,10)) * 100) / 100 AS DOUBLE) AS tr,
           floor(p_retailprice / 7) AS fl, ceil(p_retailprice / 7) AS ce FROM part""")
def fn_math(spark, d):
    s, x = c("p_size"), c("p_retailprice")
    r = lambda e: F.round(e, 6)
    return load(spark, d, "part").select(
        "p_partkey", (s + 2 * s - 1).alias("arith"), N.divide_integer(s, F.lit(7)).alias("div_int"), (s % 7).alias("m"),
        (-s).alias("neg"), F.abs(10 - s).alias("ab"), F.sign(10 - s).cast("int").alias("sg"), r(F.pow(s, F.lit(1.5))).alias("pw"),
        r(F.sqrt(s)).alias("sq"), r(F.exp(s / 50.0)).alias("ex"), r(F.ln(s)).alias("l"), r(F.log10(s)).alias("lg"),
        r(F.sin(s)).alias("si"), r(F.cos(s)).alias("co"), r(F.tan(s)).alias("ta"), r(F.cot(s)).alias("ct"),
        r(F.asin(s / 100.0)).alias("asn"), r(F.acos(s / 100.0)).alias("acs"), r(F.atan(s)).alias("atn"), r(F.atan2(s, F.lit(3))).alias("at2"),
        r(F.degrees(s)).alias("dg"), r(F.radians(s)).alias("ra"), r(F.pi()).alias("p"), F.round(x / 7, 1).alias("rd"),
        N.truncate((x - 1000) / 8, 2).cast("double").alias("tr"), F.floor(x / 7).cast("double").alias("fl"), F.ceil(x / 7).cast("double").alias("ce"))


@query("fn_rand_integer", "SELECT count(*) AS n, TRUE AS in_range FROM part")
def fn_rand_integer(spark, d):
    k = load(spark, d, "part").select(N.rand_integer(10, 3).alias("k"))
    return k.agg(F.count(F.lit(1)).alias("n"), F.bool_and(c("k").between(0, 9)).alias("in_range"))


@query("fn_string", """
    SELECT p_partkey, p_name || '-' || p_type AS cat, substring(p_name, 2, 3) AS sub, replace(p_name, 'e', '3') AS rep,
           substring(p_name, 1, 1) || 'XX' || substring(p_name, 4) AS ov, position('e' IN p_name) AS pos,
           CASE WHEN strpos(substring(p_name, 3), 'e') > 0 THEN strpos(substring(p_name, 3), 'e') + 2 ELSE 0 END AS pos_from,
           ltrim(p_name, 'sbr') AS lt, rtrim(p_name, 'gte') AS rt, trim(p_brand, 'B1') AS bt, upper(p_name) AS up, lower(p_type) AS lo,
           upper(p_type[1]) || lower(p_type[2:]) AS cap, length(p_name) AS len, ascii(p_name) AS asc, strlen(p_name) AS octets,
           translate(p_name, 'abc', 'xyz') AS tr FROM part""")
def fn_string(spark, d):
    return load(spark, d, "part").selectExpr(
        "p_partkey", "p_name || '-' || p_type AS cat", "substring(p_name FROM 2 FOR 3) AS sub", "replace(p_name, 'e', '3') AS rep",
        "overlay(p_name PLACING 'XX' FROM 2 FOR 2) AS ov", "position('e' IN p_name) AS pos", "locate('e', p_name, 3) AS pos_from",
        "trim(LEADING 'sbr' FROM p_name) AS lt", "trim(TRAILING 'gte' FROM p_name) AS rt", "trim(BOTH 'B1' FROM p_brand) AS bt",
        "upper(p_name) AS up", "lower(p_type) AS lo", "initcap(p_type) AS cap", "char_length(p_name) AS len", "ascii(p_name) AS asc",
        "octet_length(p_name) AS octets", "translate(p_name, 'abc', 'xyz') AS tr")


@query("fn_convert", "SELECT doc_id, length(text) AS chars, strlen(text) AS utf8_bytes, TRUE AS same FROM documents")
def fn_convert(spark, d):
    return load(spark, d, "documents").select(
        "doc_id", F.char_length("text").alias("chars"), F.octet_length("text").alias("utf8_bytes"),
        (F.decode(F.encode("text", "UTF-8"), "UTF-8") == c("text")).alias("same"))


@query("fn_datetime", """
    SELECT event_id, year(ts) AS y, quarter(ts) AS q, month(ts) AS mo, week(ts) AS wk, dayofyear(ts) AS doy, day(ts) AS dom, dayofweek(ts) + 1 AS dow,
           isodow(ts) AS idow, hour(ts) AS h, minute(ts) AS mi, CAST(second(ts) AS INTEGER) AS s, CAST(floor(epoch(ts)) AS BIGINT) AS ep,
           year(ts) // 10 AS dec, CAST(century(ts) AS INTEGER) AS cen, CAST(millennium(ts) AS INTEGER) AS mil, isoyear(ts) AS iy,
           date_trunc('hour', ts) AS fl, CASE WHEN date_trunc('day', ts) = ts THEN ts ELSE date_trunc('day', ts) + INTERVAL 1 DAY END AS ce,
           ts + INTERVAL 1 MONTH AS add_m, ts - INTERVAL 36 HOUR AS sub_h, date_sub('hour', TIMESTAMP '2024-01-01', ts) AS diff_h FROM events""")
def fn_datetime(spark, d):
    t = c("ts")
    ntz = lambda e: e.cast("timestamp_ntz")
    x = lambda u, name: D.extract(u, t).cast("int").alias(name)
    return load(spark, d, "events").select(
        "event_id", x("YEAR", "y"), x("QUARTER", "q"), x("MONTH", "mo"), x("WEEK", "wk"), x("DOY", "doy"), F.dayofmonth(t).alias("dom"),
        x("DOW", "dow"), x("ISODOW", "idow"), x("HOUR", "h"), x("MINUTE", "mi"), F.second(t).alias("s"),
        F.floor(D.extract("EPOCH", t)).cast("bigint").alias("ep"), x("DECADE", "dec"), x("CENTURY", "cen"), x("MILLENNIUM", "mil"), x("ISOYEAR", "iy"),
        ntz(D.floor_to(t, "HOUR")).alias("fl"), ntz(D.ceil_to(t, "DAY")).alias("ce"), F.expr("timestampadd(MONTH, 1, ts)").cast("timestamp_ntz").alias("add_m"),
        (t - F.expr("INTERVAL 36 HOUR")).alias("sub_h"), F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ '2024-01-01', ts)").alias("diff_h"))


@query("fn_timestr2long", """
    SELECT o_orderkey, epoch_ms(try_cast(CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN 'P' THEN 'no time' END AS TIMESTAMP)) AS ms FROM orders""")
def fn_timestr2long(spark, d):
    text = F.when(c("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).when(c("o_orderstatus") == "P", "no time")
    return load(spark, d, "orders").select("o_orderkey", D.timestr2long(text).alias("ms"))


@query("fn_session", "SELECT count(*) AS n, TRUE AS user_known, TRUE AS clock_ok FROM region")
def fn_session(spark, d):
    return load(spark, d, "region").selectExpr(
        "current_user() IS NOT NULL AND session_user() IS NOT NULL AND current_catalog() IS NOT NULL AND current_schema() IS NOT NULL AS u",
        "current_date() <= to_date(current_timestamp()) AND localtimestamp() IS NOT NULL AS k").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and("u").alias("user_known"), F.bool_and("k").alias("clock_ok"))


@query("fn_collections", """
    SELECT vec_id, CAST(embedding[2] AS DOUBLE) AS second, embedding[100000] IS NULL AS out_of_range, len(embedding) AS card,
           CAST(embedding[1] AS DOUBLE) AS m_first, label * 2 AS m_item, [label][1] AS only, label + 1 AS rec FROM embeddings""")
def fn_collections(spark, d):
    e = c("embedding")
    m = F.create_map(F.lit("first"), e[0].cast("double"), F.lit("twice"), (c("label") * 2).cast("double"))
    recs = F.array(F.struct((c("label") + 1).alias("f")))
    return load(spark, d, "embeddings").select(
        "vec_id", B.item(e, 2).cast("double").alias("second"), B.item(e, 100000).isNull().alias("out_of_range"),
        F.cardinality(e).alias("card"), B.item(m, "first").alias("m_first"), B.item(m, "twice").cast("int").alias("m_item"),
        B.element(F.array(c("label").cast("string"))).cast("int").alias("only"), B.item(B.slice_field(recs, "f"), 1).alias("rec"))


@query("fn_collection_queries", """
    SELECT n_name, (SELECT string_agg(r_name, ',' ORDER BY r_name) FROM region) AS regions,
           (SELECT r_name FROM region WHERE r_regionkey = n_regionkey) AS own FROM nation""")
def fn_collection_queries(spark, d):
    r = load(spark, d, "region")
    arr = r.agg(F.array_sort(F.collect_list("r_name"))).scalar()
    m = r.agg(F.map_from_entries(F.collect_list(F.struct("r_regionkey", "r_name")))).scalar()
    return load(spark, d, "nation").select("n_name", F.array_join(arr, ",").alias("regions"), B.item(m, c("n_regionkey")).alias("own"))


@query("fn_str_to_map", """
    SELECT event_id, event_type AS kind, CAST(user_id AS VARCHAR) AS who, TRUE AS no_third FROM events""")
def fn_str_to_map(spark, d):
    text = F.concat(F.lit("kind:"), c("event_type"), F.lit(",who:"), c("user_id"))
    m = F.call_function("str_to_map", text)
    return load(spark, d, "events").select("event_id", m["kind"].alias("kind"), m["who"].alias("who"), F.try_element_at(m, F.lit("x")).isNull().alias("no_third"))


_BAGS = """SELECT l_orderkey AS o, l_partkey AS p, l_linenumber AS n, l_suppkey AS u, [l_linenumber % 3, l_linenumber % 2, l_suppkey % 3, l_suppkey % 3] AS a,
    [l_partkey % 3, l_partkey % 2, l_suppkey % 3] AS b FROM lineitem"""


@query("fn_multiset", f"""
    SELECT o, p, n, u, len(a) + len(b) AS ua, len(list_distinct(list_concat(a, b))) AS ud,
      CAST(list_sum([least(len(list_filter(a, lambda y: y = x)), len(list_filter(b, lambda y: y = x))) for x in [0, 1, 2]]) AS INTEGER) AS ia,
      len(list_intersect(a, b)) AS idd,
      CAST(list_sum([greatest(len(list_filter(a, lambda y: y = x)) - len(list_filter(b, lambda y: y = x)), 0) for x in [0, 1, 2]]) AS INTEGER) AS ea,
      len(list_distinct(list_filter(a, lambda y: NOT list_contains(b, y)))) AS ed, list_contains(a, 2) AS mem,
      list_sum([greatest(len(list_filter(b, lambda y: y = x)) - len(list_filter(a, lambda y: y = x)), 0) for x in [0, 1, 2]]) = 0 AS sub,
      len(list_distinct(b)) = len(b) AS is_set, FALSE AS empty FROM ({_BAGS})""")
def fn_multiset(spark, d):
    part, line, supp = c("l_partkey"), c("l_linenumber"), c("l_suppkey")
    bag = lambda *xs: F.array(*[x.cast("int") for x in xs])
    li = load(spark, d, "lineitem").select(
        c("l_orderkey").alias("o"), part.alias("p"), line.alias("n"), supp.alias("u"),
        bag(line % 3, line % 2, supp % 3, supp % 3).alias("a"), bag(part % 3, part % 2, supp % 3).alias("b"))
    a, b = c("a"), c("b")
    return li.select(
        "o", "p", "n", "u", F.size(B.union_all(a, b)).alias("ua"), F.size(B.union_distinct(a, b)).alias("ud"), F.size(B.intersect_all(a, b)).alias("ia"),
        F.size(B.intersect_distinct(a, b)).alias("idd"), F.size(B.except_all(a, b)).alias("ea"), F.size(B.except_distinct(a, b)).alias("ed"),
        B.member_of(F.lit(2), a).alias("mem"), B.submultiset_of(b, a).alias("sub"), B.is_a_set(b).alias("is_set"), B.is_empty(a).alias("empty"))


@query("json_extract", """
    SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(json_extract_string(props, '$.k') AS INTEGER) AS n,
           json_exists(props, '$.k') AS has_k, json_exists(props, '$.z') AS has_z, -1 AS z FROM events""")
def json_extract(spark, d):
    s = c("props")
    return load(spark, d, "events").select(
        "event_id", F.get_json_object(s, "$.k").alias("k"), J.json_value(s, "$.k", "int").alias("n"), J.json_exists(s, "$.k").alias("has_k"),
        J.json_exists(s, "$.z").alias("has_z"), J.json_value(s, "$.z", "int", on_empty=F.lit(-1)).alias("z"))


_SHAPES = """CASE event_type WHEN 'view' THEN props WHEN 'click' THEN '[1,[' || user_id || ',{}]]' WHEN 'error' THEN '{oops' WHEN 'signup' THEN '"s"' END"""


@query("json_predicates", f"""
    SELECT event_id, json_valid(s) AS is_value, CASE WHEN s IS NOT NULL THEN json_valid(s) AND s LIKE '{{%' END AS is_object,
           CASE WHEN s IS NOT NULL THEN s LIKE '[%' END AS is_array, CASE WHEN s IS NOT NULL THEN s LIKE '"%' END AS is_scalar,
           CASE event_type WHEN 'view' THEN 'OBJECT' WHEN 'click' THEN 'ARRAY' WHEN 'signup' THEN 'STRING' END AS t,
           CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'signup' THEN 1 END AS depth,
           CASE event_type WHEN 'click' THEN '[' || user_id || ',{{}}]' END AS q
    FROM (SELECT event_id, event_type, user_id, {_SHAPES} AS s FROM events)""")
def json_predicates(spark, d):
    s = c("s")
    return load(spark, d, "events").withColumn("s", F.expr(_SHAPES)).select(
        "event_id", J.is_json_value(s).alias("is_value"), J.is_json_object(s).alias("is_object"), J.is_json_array(s).alias("is_array"),
        J.is_json_scalar(s).alias("is_scalar"), J.json_type(s).alias("t"), J.json_depth(s).alias("depth"), J.json_query(s, "$[1]").alias("q"))


@query("json_build", """
    SELECT event_id, CASE WHEN event_type = 'view' THEN '{"id":' || event_id || ',"kind":null}' ELSE '{"id":' || event_id || ',"kind":"' || event_type || '"}' END AS obj,
           CASE WHEN event_type = 'view' THEN '{"id":' || event_id || '}' ELSE '{"id":' || event_id || ',"kind":"' || event_type || '"}' END AS absent,
           CASE WHEN event_type = 'view' THEN '[' || user_id || ']' ELSE '[' || user_id || ',' || event_id || ']' END AS arr,
           'cb({"id":' || event_id || '})' AS jsonp FROM events""")
def json_build(spark, d):
    kind = F.when(c("event_type") != "view", c("event_type"))
    fields = {"id": c("event_id"), "kind": kind}
    return load(spark, d, "events").select(
        "event_id", J.json_object(fields).alias("obj"), J.json_object(fields, absent_on_null=True).alias("absent"),
        J.json_array([c("user_id"), F.when(c("event_type") != "view", c("event_id"))]).alias("arr"),
        J.jsonp("cb", F.struct(c("event_id").alias("id"))).alias("jsonp"))


@query("json_regular_join", """
    SELECT json_extract_string(props, '$.k') AS k, count(*) AS n, CAST(sum(m) AS BIGINT) AS pairs FROM events
    JOIN (SELECT json_extract_string(props, '$.k') AS k2, count(*) AS m FROM events WHERE event_type = 'signup' GROUP BY 1) ON json_extract_string(props, '$.k') = k2
    WHERE event_type = 'click' GROUP BY 1""")
def json_regular_join(spark, d):
    ev = load(spark, d, "events").select("event_type", F.get_json_object("props", "$.k").alias("k"))
    # Both sides are counted per key first, so equal keys never form pairs.
    side = lambda kind, name: ev.where(c("event_type") == kind).groupBy("k").agg(F.count(F.lit(1)).alias(name))
    return side("click", "n").join(side("signup", "m"), "k").select("k", "n", (c("n") * c("m")).alias("pairs"))


@query("json_lenient_map", """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS id, CASE WHEN event_type = 'click' THEN event_type WHEN event_type <> 'error' THEN '' END AS name,
           CASE WHEN event_type = 'click' THEN event_type ELSE 'old' END AS merged FROM events""")
def json_lenient_map(spark, d):
    schema = "id bigint, name string"
    from pyspark.sql.types import StructType
    st = StructType.fromDDL(schema)
    text = F.when(c("event_type") == "click", F.concat(F.lit("{id:"), c("user_id"), F.lit(",'name':'click',other:[1]}"))) \
        .when(c("event_type") == "error", F.lit("{'id'")).otherwise(F.concat(F.lit("{'id':"), c("user_id"), F.lit("}")))
    row = J.from_lenient(text, st)
    old = F.struct(F.lit(0).cast("bigint").alias("id"), F.lit("old").alias("name"))
    return load(spark, d, "events").select(
        "event_id", row["id"].alias("id"), row["name"].alias("name"), J.partial_update(old, text, st)["name"].alias("merged"))


@query("wc_flatmap", """
    SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z0-9_]+')) AS word FROM documents) WHERE word <> '' GROUP BY word""")
def wc_flatmap(spark, d):
    words = load(spark, d, "documents").select(F.explode(F.split(F.lower("text"), "[^a-z0-9_]+")).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("udf_cast_pair", """
    SELECT o_orderkey, CAST(CAST(o_custkey AS VARCHAR) AS INTEGER) AS n, CAST(o_custkey AS VARCHAR) AS t FROM orders""")
def udf_cast_pair(spark, d):
    return load(spark, d, "orders").select(
        "o_orderkey", U.text_to_int(c("o_custkey").cast("string")).alias("n"), U.int_to_text(c("o_custkey").cast("int")).alias("t"))


@query("udf_event_fields", "SELECT event_id, 'k:' || json_extract_string(props, '$.k') AS fields, json_extract_string(props, '$.k') AS k FROM events")
def udf_event_fields(spark, d):
    ev = load(spark, d, "events").select("event_id", U.event_fields("props").alias("fields"))
    return ev.select("event_id", "fields", F.call_function("str_to_map", c("fields"))["k"].alias("k"))


@query("udf_rule_text", """
    SELECT event_id, value > 90 AS high, event_type = 'click' AND event_id % 2 = 0 AS even_click FROM events""")
def udf_rule_text(spark, d):
    """Rules kept as text, one column each."""
    rules = {"high": "getValue(value) > 90", "even_click": "getValue(event_type) = 'click' AND getValue( event_id ) % 2 = 0"}
    return load(spark, d, "events").select("event_id", *[U.rule_predicate(text).alias(name) for name, text in rules.items()])


@query("udtf_tokens", """
    SELECT item_id, count(*) AS n, count(DISTINCT w) AS words, max(length(w)) AS longest FROM
      (SELECT item_id, unnest(regexp_split_to_array(trim(text), '\\s+')) AS w FROM benchmark) GROUP BY item_id""")
def udtf_tokens(spark, d):
    U.register(spark)
    t = spark.sql("SELECT item_id, token FROM {b}, LATERAL tokens(text)", b=load(spark, d, "benchmark"))
    return t.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("token").alias("words"), F.max(F.length("token")).alias("longest"))


# Table changes

@query("upsert_latest", """
    SELECT user_id, event_id, event_type, value FROM
      (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'""")
def upsert_latest(spark, d):
    ev = load(spark, d, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return CL.latest_per_key(ev, ["user_id"], ["ts", "event_id"], c("event_type") == "error").select("user_id", "event_id", "event_type", "value")


@query("retract_totals", """
    WITH a AS (SELECT user_id, CAST(count(*) AS BIGINT) AS total FROM events WHERE event_type <> 'purchase' GROUP BY 1),
         b AS (SELECT user_id, CAST(count(*) AS BIGINT) AS total FROM events WHERE event_type <> 'error' GROUP BY 1)
    SELECT '-U' AS op, a.user_id, a.total FROM a JOIN b USING (user_id) WHERE a.total <> b.total
    UNION ALL SELECT '+U', b.user_id, b.total FROM a JOIN b USING (user_id) WHERE a.total <> b.total
    UNION ALL SELECT '+I', user_id, total FROM b WHERE user_id NOT IN (SELECT user_id FROM a)
    UNION ALL SELECT '-D', user_id, total FROM a WHERE user_id NOT IN (SELECT user_id FROM b)""")
def retract_totals(spark, d):
    ev = load(spark, d, "events").select("user_id", "event_type")
    # Totals before purchases came in, and after errors were taken back.
    snap = lambda cond: ev.where(cond).groupBy("user_id").agg(F.count(F.lit(1)).alias("total"))
    return CL.retract_diff(snap("event_type <> 'purchase'"), snap("event_type <> 'error'"), ["user_id"])


@query("merge_files", """
    SELECT coalesce(o_orderkey, k) AS o_orderkey, CASE WHEN k IS NOT NULL AND o_orderkey IS NOT NULL THEN 'M' WHEN o_orderkey IS NULL THEN 'N' ELSE o_orderstatus END AS o_orderstatus,
           coalesce(CASE WHEN k IS NOT NULL THEN n END, o_totalprice) AS o_totalprice
    FROM (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders)
    FULL OUTER JOIN (SELECT l_orderkey AS k, CAST(sum(l_quantity) AS DOUBLE) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 5) ON o_orderkey = k""")
def merge_files(spark, d):
    target = load(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    source = load(spark, d, "lineitem").groupBy(c("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("k"), F.sum("l_quantity").alias("n")).where("k > 5")
    return CL.merge(target, source, ["o_orderkey"], {"o_orderstatus": F.lit("M"), "o_totalprice": c("s.n")},
                    {"o_orderstatus": F.lit("N"), "o_totalprice": c("s.n")})


@query("update_delete_rewrite", """
    SELECT d.doc_id, CASE WHEN quality = 1 THEN 'good' ELSE lang END AS lang, n_chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE NOT coalesce(toxic = 1, FALSE)""")
def update_delete_rewrite(spark, d):
    j = load(spark, d, "documents").select("doc_id", "lang", "n_chars").join(load(spark, d, "labels"), "doc_id", "left")
    kept = CL.delete_where(j, c("toxic") == 1)
    return CL.update_where(kept, c("quality") == 1, {"lang": F.lit("good")}).select("doc_id", "lang", "n_chars")
