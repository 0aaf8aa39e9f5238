"""Projection, predicates, joins, aggregation, windows, set operators."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.functions import predicates as P
from tidewater.operators import aggregates as A
from tidewater.operators import joins as J
from tidewater.operators import quantified as Q
from tidewater.operators import ranking as R
from tidewater.operators import sequence as S
from tidewater.plans.registry import query
from tidewater.session import load

c = F.col


@query("proj_filter_case", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(CAST(l_extendedprice * (1 - l_discount) * (1 + l_tax) AS DECIMAL(18,6)) AS DOUBLE) AS charge,
           CASE WHEN l_discount >= 0.08 THEN 'deep' WHEN l_discount > 0 THEN 'some' ELSE 'none' END AS band,
           CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 0 END AS flag,
           coalesce(nullif(l_linestatus, 'O'), 'open') AS status,
           CAST(l_quantity AS INTEGER) AS qty
    FROM lineitem WHERE l_quantity > 10 AND l_tax <> 0.04 AND NOT (l_suppkey <= 5)""")
def proj_filter_case(spark, d):
    li = load(spark, d, "lineitem").where((c("l_quantity") > 10) & (c("l_tax") != 0.04) & ~(c("l_suppkey") <= 5))
    band = F.when(c("l_discount") >= 0.08, "deep").when(c("l_discount") > 0, "some").otherwise("none")
    row = F.struct(c("l_orderkey"), c("l_linenumber"), c("l_partkey"))
    return li.select(
        row.alias("r"),
        (c("l_extendedprice") * (1 - c("l_discount")) * (1 + c("l_tax"))).cast("decimal(18,6)").cast("double").alias("charge"),
        band.alias("band"),
        F.expr("CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 0 END").alias("flag"),
        F.coalesce(F.nullif(c("l_linestatus"), F.lit("O")), F.lit("open")).alias("status"),
        c("l_quantity").cast("int").alias("qty"),
    ).select("r.*", "charge", "band", "flag", "status", "qty")


@query("proj_distinct_cte", """
    WITH recent AS (SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
    SELECT DISTINCT s AS status, p AS priority FROM (SELECT o_orderstatus, o_orderpriority FROM recent) AS t(s, p)""")
def proj_distinct_cte(spark, d):
    return spark.sql("""
        WITH recent AS (SELECT o_custkey, o_orderstatus, o_orderpriority FROM {o} WHERE o_orderdate >= TIMESTAMP_NTZ '1998-01-01')
        SELECT DISTINCT s AS status, p AS priority FROM (SELECT o_orderstatus, o_orderpriority FROM recent) AS t(s, p)""",
        o=load(spark, d, "orders"))


@query("pred_between_symmetric", """
    SELECT o_orderkey,
           (o_totalprice BETWEEN least(150000.0, 50000.0) AND greatest(150000.0, 50000.0)) AS in_band,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE (o_custkey BETWEEN least(o_custkey - 1, 700) AND greatest(o_custkey - 1, 700)) END AS near_700,
           NOT (o_totalprice BETWEEN 50000.0 AND 150000.0) AS out_band
    FROM orders""")
def pred_between_symmetric(spark, d):
    bound = F.when(c("o_orderstatus") != "P", F.lit(700))
    return load(spark, d, "orders").select(
        "o_orderkey",
        P.between_symmetric(c("o_totalprice"), F.lit(150000.0), F.lit(50000.0)).alias("in_band"),
        P.between_symmetric(c("o_custkey"), c("o_custkey") - 1, bound).alias("near_700"),
        (~P.between_symmetric(c("o_totalprice"), F.lit(150000.0), F.lit(50000.0))).alias("out_band"),
    )


@query("pred_similar_to", """
    SELECT p_partkey,
           regexp_full_match(p_name, '(red|blue) .*') AS two_colors,
           regexp_full_match(p_brand, 'Brand#[1-3].') AS two_digits,
           p_name LIKE '%g_ar%' AS like_gear,
           NOT regexp_full_match(p_type, '(SMALL|LARGE)+') AS other_type,
           p_brand LIKE 'Brand__' AND NOT p_name LIKE '%!%%' ESCAPE '!' AS esc
    FROM part""")
def pred_similar_to(spark, d):
    return load(spark, d, "part").select(
        "p_partkey",
        P.similar_to(c("p_name"), "(red|blue) %").alias("two_colors"),
        P.similar_to(c("p_brand"), "Brand#[1-3]_").alias("two_digits"),
        c("p_name").like("%g_ar%").alias("like_gear"),
        (~P.similar_to(c("p_type"), "(SMALL|LARGE)+")).alias("other_type"),
        F.expr("p_brand LIKE 'Brand__' AND NOT p_name LIKE '%!%%' ESCAPE '!'").alias("esc"),
    )


@query("pred_null_logic", """
    SELECT t.doc_id, (q AND x) IS TRUE AS both_true, (q OR x) IS NOT FALSE AS or_not_false,
           (NOT q) IS UNKNOWN AS unknown, q IS NOT TRUE AS not_true, q IS FALSE AS is_false,
           q IS DISTINCT FROM x AS differs, q IS NOT DISTINCT FROM x AS same, q IS NULL AS no_label
    FROM (SELECT d.doc_id, l.quality = 1 AS q, l.toxic = 1 AS x FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) t""")
def pred_null_logic(spark, d):
    docs = load(spark, d, "documents").select("doc_id")
    j = docs.join(load(spark, d, "labels"), "doc_id", "left").select(
        "doc_id", (c("quality") == 1).alias("q"), (c("toxic") == 1).alias("x"))
    q, x = c("q"), c("x")
    return j.select(
        "doc_id", P.is_true(q & x).alias("both_true"), (~P.is_false(q | x)).alias("or_not_false"),
        P.is_unknown(~q).alias("unknown"), (~P.is_true(q)).alias("not_true"), P.is_false(q).alias("is_false"),
        P.is_distinct_from(q, x).alias("differs"), q.eqNullSafe(x).alias("same"), q.isNull().alias("no_label"),
    )


@query("pred_some_all", """
    WITH b AS (SELECT p_retailprice AS v FROM part WHERE p_brand = 'Brand#7'),
         nope AS (SELECT p_retailprice AS v FROM part WHERE p_brand = 'none')
    SELECT p_partkey, p_retailprice < ANY (SELECT v FROM b) AS lt_some, p_retailprice >= ANY (SELECT v FROM b) AS ge_some,
           p_retailprice > ALL (SELECT v FROM b) AS gt_all, p_retailprice <= ALL (SELECT v FROM b) AS le_all,
           p_retailprice <> ANY (SELECT v FROM b) AS ne_some, p_retailprice = ALL (SELECT v FROM b) AS eq_all,
           p_retailprice < ANY (SELECT v FROM nope) AS some_empty, p_retailprice < ALL (SELECT v FROM nope) AS all_empty
    FROM part""")
def pred_some_all(spark, d):
    part = load(spark, d, "part")
    b = part.where("p_brand = 'Brand#7'").select(c("p_retailprice").alias("v"))
    nope = part.where("p_brand = 'none'").select(c("p_retailprice").alias("v"))
    x = c("p_retailprice")
    return part.select(
        "p_partkey", Q.some(x, "<", b, "v").alias("lt_some"), Q.some(x, ">=", b, "v").alias("ge_some"),
        Q.every(x, ">", b, "v").alias("gt_all"), Q.every(x, "<=", b, "v").alias("le_all"),
        Q.some(x, "<>", b, "v").alias("ne_some"), Q.every(x, "=", b, "v").alias("eq_all"),
        Q.some(x, "<", nope, "v").alias("some_empty"), Q.every(x, "<", nope, "v").alias("all_empty"),
    )


_PERIODS = """
    SELECT o.o_orderkey AS k, l.l_linenumber AS n, o.o_orderdate AS s1, o.o_orderdate + INTERVAL 60 DAY AS e1,
           l.l_shipdate AS s2, l.l_shipdate + INTERVAL 30 DAY AS e2
    FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey"""


@query("period_overlaps", f"""
    SELECT (s1 < e2 AND s2 < e1) AS overlaps, (s1 <= s2 AND e2 <= e1) AS contains, e1 <= s2 AS precedes,
           e1 = s2 AS precedes_now, s1 >= e2 AS succeeds, s1 = e2 AS succeeds_now, (s1 = s2 AND e1 = e2) AS equals,
           count(*) AS n, sum(k) AS keys
    FROM ({_PERIODS}) GROUP BY ALL""")
def period_overlaps(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_orderdate")
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    j = li.join(o, c("l_orderkey") == c("o_orderkey"))
    # The ends are given in the other order on purpose.
    p = (c("o_orderdate") + F.expr("INTERVAL 60 DAY"), c("o_orderdate"))
    q = (c("l_shipdate"), c("l_shipdate") + F.expr("INTERVAL 30 DAY"))
    flags = [
        P.overlaps(p, q).alias("overlaps"), P.contains(p, q).alias("contains"), P.precedes(p, q).alias("precedes"),
        P.immediately_precedes(p, q).alias("precedes_now"), P.succeeds(p, q).alias("succeeds"),
        P.immediately_succeeds(p, q).alias("succeeds_now"), P.period_equals(p, q).alias("equals"),
    ]
    return j.groupBy(*flags).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query("subq_exists_in_scalar", """
    SELECT c_custkey, c_acctbal > (SELECT avg(c_acctbal) FROM customer) AS above_avg,
           EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS has_f,
           c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS never_urgent
    FROM customer""")
def subq_exists_in_scalar(spark, d):
    cust, o = load(spark, d, "customer"), load(spark, d, "orders")
    mean = cust.agg(F.avg("c_acctbal")).scalar()
    # One aggregate answers both membership questions with one pass over orders.
    per = o.groupBy("o_custkey").agg(
        F.bool_or(c("o_orderstatus") == "F").alias("f"), F.bool_or(c("o_orderpriority") == "1-URGENT").alias("u"))
    return cust.join(per, c("c_custkey") == c("o_custkey"), "left").select(
        "c_custkey", (c("c_acctbal") > mean).alias("above_avg"), P.is_true(c("f")).alias("has_f"),
        (~P.is_true(c("u"))).alias("never_urgent"))


@query("join_semi_anti", """
    SELECT 'semi' AS kind, count(*) AS n, sum(c_custkey) AS s FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
    UNION ALL SELECT 'anti', count(*), sum(c_custkey) FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 150000)
    UNION ALL SELECT 'not_in', count(*), sum(c_custkey) FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 150000)
    UNION ALL SELECT 'not_in_null', count(*), sum(c_custkey) FROM customer
        WHERE c_custkey NOT IN (SELECT CASE WHEN o_totalprice > 150000 THEN NULL ELSE o_custkey END FROM orders)""")
def join_semi_anti(spark, d):
    cust = load(spark, d, "customer").select("c_custkey")
    o = load(spark, d, "orders").select("o_custkey", "o_totalprice")
    high = o.where(c("o_totalprice") > 150000)
    holes = o.select(F.when(c("o_totalprice") > 150000, None).otherwise(c("o_custkey")).alias("k"))
    parts = {
        "semi": Q.in_query(cust, "c_custkey", o, "o_custkey"),
        "anti": cust.join(high, c("c_custkey") == c("o_custkey"), "left_anti"),
        "not_in": Q.not_in_query(cust, "c_custkey", high, "o_custkey"),
        "not_in_null": Q.not_in_query(cust, "c_custkey", holes, "k"),
    }
    out = None
    for kind, p in parts.items():
        one = p.agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("s")).select(F.lit(kind).alias("kind"), "n", "s")
        out = one if out is None else out.unionAll(one)
    return out


@query("join_inner_star", """
    SELECT r_name, n_name, c_mktsegment, count(*) AS n, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
    GROUP BY r_name, n_name, c_mktsegment""")
def join_inner_star(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    o = load(spark, d, "orders").where(
        "o_orderdate >= TIMESTAMP_NTZ '1996-01-01' AND o_orderdate < TIMESTAMP_NTZ '1998-01-01'"
    ).select("o_orderkey", "o_custkey")
    cu = load(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    geo = load(spark, d, "nation").join(load(spark, d, "region"), c("n_regionkey") == c("r_regionkey"))
    rev = F.sum((c("l_extendedprice") * (1 - c("l_discount"))).cast("decimal(18,4)"))
    # Orders are enriched before the fact table joins, then names are joined
    # onto the few aggregated rows.
    oc = o.join(cu, c("o_custkey") == c("c_custkey"))
    sums = li.join(oc, c("l_orderkey") == c("o_orderkey")).groupBy("c_nationkey", "c_mktsegment") \
        .agg(F.count(F.lit(1)).alias("n"), rev.alias("revenue"))
    return sums.join(geo, c("c_nationkey") == c("n_nationkey")).select(
        "r_name", "n_name", "c_mktsegment", "n", c("revenue").cast("double").alias("revenue"))


@query("join_outer_full", """
    SELECT coalesce(a.k, b.k) AS k, a.n AS orders_1996, b.n AS orders_1997
    FROM (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 1) a
    FULL OUTER JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1) b ON a.k = b.k""")
def join_outer_full(spark, d):
    o = load(spark, d, "orders")
    year = lambda y, name: o.where(F.year("o_orderdate") == y).groupBy(c("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias(name))
    return year(1996, "orders_1996").join(year(1997, "orders_1997"), "k", "full")


@query("join_left_right", """
    SELECT 'left' AS side, count(*) AS n, count(o_orderkey) AS matched FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P'
    UNION ALL SELECT 'right', count(*), count(c_custkey) FROM customer RIGHT JOIN orders ON c_custkey = o_custkey AND c_acctbal > 5000""")
def join_left_right(spark, d):
    cu = load(spark, d, "customer").select("c_custkey", "c_acctbal")
    o = load(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    left = cu.join(o.where("o_orderstatus = 'P'"), c("c_custkey") == c("o_custkey"), "left")
    right = cu.where("c_acctbal > 5000").join(o, c("c_custkey") == c("o_custkey"), "right")
    n = F.count(F.lit(1)).alias("n")
    return left.agg(n, F.count("o_orderkey").alias("matched")).select(F.lit("left").alias("side"), "n", "matched").unionAll(
        right.agg(n, F.count("c_custkey").alias("matched")).select(F.lit("right").alias("side"), "n", "matched"))


@query("join_natural_using", """
    SELECT conv_id, count(*) AS n, sum(length(text)) AS chars, min(m) AS first_turn
    FROM conversations JOIN (SELECT conv_id, min(turn) AS m FROM conversations GROUP BY conv_id) USING (conv_id)
    GROUP BY conv_id
    UNION ALL SELECT -1, count(*), sum(n_chars), sum(quality) FROM documents NATURAL JOIN labels""")
def join_natural_using(spark, d):
    cv = load(spark, d, "conversations")
    using = spark.sql("""SELECT conv_id, count(*) AS n, sum(char_length(text)) AS chars, min(m) AS first_turn
        FROM {cv} JOIN (SELECT conv_id, min(turn) AS m FROM {cv} GROUP BY conv_id) USING (conv_id) GROUP BY conv_id""", cv=cv)
    natural = spark.sql("""SELECT -1L AS conv_id, count(*) AS n, sum(n_chars) AS chars, sum(quality) AS first_turn
        FROM {a} NATURAL JOIN {b}""", a=load(spark, d, "documents"), b=load(spark, d, "labels"))
    return using.unionAll(natural)


@query("join_theta_range", """
    SELECT band, count(*) AS n, round(sum(p_retailprice), 2) AS total
    FROM part JOIN (SELECT n_nationkey AS band, 900.0 + 40 * n_nationkey AS lo, 900.0 + 40 * n_nationkey + 100 AS hi FROM nation) r
      ON p_retailprice >= lo AND p_retailprice < hi GROUP BY band""")
def join_theta_range(spark, d):
    r = load(spark, d, "nation").select(
        c("n_nationkey").alias("band"), (F.lit(900.0) + 40 * c("n_nationkey")).alias("lo"),
        (F.lit(1000.0) + 40 * c("n_nationkey")).alias("hi"))
    p = load(spark, d, "part").select("p_retailprice")
    return J.range_join(p, r, "p_retailprice", "lo", "hi", 100.0).groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("p_retailprice"), 2).alias("total"))


@query("join_cross_small", """
    SELECT r_name, p AS priority, (SELECT count(*) FROM orders WHERE o_orderpriority = p) AS n
    FROM region, (SELECT DISTINCT o_orderpriority AS p FROM orders)""")
def join_cross_small(spark, d):
    counts = load(spark, d, "orders").groupBy(c("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n"))
    # Five regions by five priorities, both aggregated first.
    return load(spark, d, "region").select("r_name").crossJoin(counts)


@query("join_lateral_topk", """
    SELECT c_custkey, o_orderkey, o_totalprice FROM customer
    LEFT JOIN LATERAL (SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = c_custkey
                       ORDER BY o_totalprice DESC, o_orderkey LIMIT 2) t ON TRUE""")
def join_lateral_topk(spark, d):
    top = R.top_per_group(
        load(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"],
        [c("o_totalprice").desc(), c("o_orderkey").asc()], 2)
    return load(spark, d, "customer").select("c_custkey").join(top, c("c_custkey") == c("o_custkey"), "left") \
        .select("c_custkey", "o_orderkey", "o_totalprice")


@query("join_lateral_apply", """
    SELECT n_nationkey, n_name, m AS top_balance, k AS n_rich FROM nation
    CROSS JOIN LATERAL (SELECT max(c_acctbal) AS m, count(*) AS k FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal > 0) t""")
def join_lateral_apply(spark, d):
    return spark.sql("""SELECT n_nationkey, n_name, m AS top_balance, k AS n_rich FROM {n},
        LATERAL (SELECT max(c_acctbal) AS m, count(*) AS k FROM {c} WHERE c_nationkey = n_nationkey AND c_acctbal > 0) t""",
        n=load(spark, d, "nation"), c=load(spark, d, "customer"))


@query("unnest_ordinality", """
    SELECT word_pos, count(*) AS n, count(DISTINCT doc_id) AS docs FROM
      (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS word_pos FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents))
    WHERE length(word) > 0 GROUP BY word_pos""")
def unnest_ordinality(spark, d):
    docs = load(spark, d, "documents").select("doc_id", F.split("text", " ").alias("w"))
    words = docs.select("doc_id", F.posexplode("w").alias("p", "word"))
    # A position occurs once per document, so rows are documents already.
    return words.where(F.length("word") > 0).groupBy((c("p") + 1).cast("bigint").alias("word_pos")) \
        .agg(F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("docs"))


@query("join_asof", """
    SELECT p.event_id, p.user_id, p.ts, k.event_id AS click_id, k.ts AS click_ts
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF JOIN (SELECT * FROM events WHERE event_type = 'click') k ON p.user_id = k.user_id AND p.ts > k.ts""")
def join_asof(spark, d):
    ev = load(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    buy = ev.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    click = ev.where("event_type = 'click'").select("user_id", c("ts").alias("click_ts"), c("event_id").alias("click_id"))
    return J.asof_join(buy, click, ["user_id"], "ts", "click_ts", ["click_id", "click_ts"],
                       allow_equal=False, keep_unmatched=False)


@query("join_interval", """
    SELECT a.event_id AS click_id, b.event_id AS buy_id, a.user_id
    FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts AND b.ts < a.ts + INTERVAL 1 HOUR
    WHERE a.event_type = 'click' AND b.event_type = 'purchase'""")
def join_interval(spark, d):
    ev = load(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    a = ev.where("event_type = 'click'").select(c("event_id").alias("click_id"), "user_id", c("ts").alias("t1"))
    b = ev.where("event_type = 'purchase'").select(c("event_id").alias("buy_id"), c("user_id").alias("u2"), c("ts").alias("t2"))
    return J.interval_join(a, b, ["user_id"], ["u2"], "t1", "t2", timedelta(hours=1)).select("click_id", "buy_id", "user_id")


# Aggregation

@query("agg_group_having", """
    SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price,
           round(avg(l_discount), 6) AS avg_disc, count(*) AS n, count(DISTINCT l_partkey) AS parts,
           min(l_shipdate) AS first_ship, max(l_tax) AS max_tax
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-09-02' GROUP BY l_returnflag, l_linestatus HAVING count(*) > 100""")
def agg_group_having(spark, d):
    li = load(spark, d, "lineitem").where("l_shipdate <= TIMESTAMP_NTZ '2000-09-02'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count(F.lit(1)).alias("n"),
        F.countDistinct("l_partkey").alias("parts"), F.min("l_shipdate").alias("first_ship"),
        F.max("l_tax").alias("max_tax")).where(c("n") > 100)


def _grouped(kind):
    return f"""SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag) AS INTEGER) AS g1,
        CAST(grouping_id(l_returnflag, l_linestatus) AS INTEGER) AS gid, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS qty
        FROM lineitem GROUP BY {kind}"""


def _grouping_cols():
    return [F.grouping("l_returnflag").cast("int").alias("g1"), F.grouping_id().cast("int").alias("gid"),
            F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty")]


@query("agg_rollup", _grouped("ROLLUP (l_returnflag, l_linestatus)"))
def agg_rollup(spark, d):
    return load(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(*_grouping_cols())


@query("agg_cube", _grouped("CUBE (l_returnflag, l_linestatus)"))
def agg_cube(spark, d):
    return load(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(*_grouping_cols())


@query("agg_grouping_sets", _grouped("GROUPING SETS ((l_returnflag), (l_linestatus), ())"))
def agg_grouping_sets(spark, d):
    li = load(spark, d, "lineitem")
    return li.groupingSets([[c("l_returnflag")], [c("l_linestatus")], []], c("l_returnflag"), c("l_linestatus")).agg(*_grouping_cols())


@query("agg_group_id", """
    SELECT l_returnflag, l_linestatus, 0 AS group_id, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus))
    UNION ALL SELECT l_returnflag, NULL, 1, count(*) FROM lineitem GROUP BY l_returnflag""")
def agg_group_id(spark, d):
    cols = ["l_returnflag", "l_linestatus"]
    return A.group_id_union(load(spark, d, "lineitem").select(*cols), cols, [["l_returnflag"], ["l_linestatus"], ["l_returnflag"]],
                            [F.count(F.lit(1)).alias("n")]).select("l_returnflag", "l_linestatus", "group_id", "n")


@query("agg_filter_within_group", """
    SELECT l_returnflag, count(*) FILTER (WHERE l_discount > 0.05) AS deep, round(sum(l_quantity) FILTER (WHERE l_tax = 0), 2) AS untaxed,
           quantile_cont(l_quantity, 0.25) AS q25, quantile_disc(l_quantity, 0.5) AS q50
    FROM lineitem GROUP BY l_returnflag""")
def agg_filter_within_group(spark, d):
    # Spark's percentile keeps one counter per distinct quantity (50 of them).
    return spark.sql("""SELECT l_returnflag, count(*) FILTER (WHERE l_discount > 0.05) AS deep,
        round(sum(l_quantity) FILTER (WHERE l_tax = 0), 2) AS untaxed,
        percentile_cont(0.25) WITHIN GROUP (ORDER BY l_quantity) AS q25,
        percentile_disc(0.5) WITHIN GROUP (ORDER BY l_quantity) AS q50
        FROM {li} GROUP BY l_returnflag""", li=load(spark, d, "lineitem"))


@query("agg_listagg", """
    SELECT o_orderstatus, string_agg(p, ',' ORDER BY p) AS priorities FROM
      (SELECT DISTINCT o_orderstatus, o_orderpriority AS p FROM orders) GROUP BY o_orderstatus""")
def agg_listagg(spark, d):
    seen = load(spark, d, "orders").select("o_orderstatus", c("o_orderpriority").alias("p")).distinct()
    return spark.sql("SELECT o_orderstatus, listagg(p, ',') WITHIN GROUP (ORDER BY p) AS priorities FROM {s} GROUP BY o_orderstatus", s=seen)


@query("agg_stats_regr", """
    SELECT l_linestatus, round(stddev_pop(l_quantity), 5) AS sp, round(stddev_samp(l_quantity), 5) AS ss,
           round(var_pop(l_quantity), 4) AS vp, round(var_samp(l_quantity), 4) AS vs,
           round(covar_pop(l_extendedprice, l_quantity), 2) AS cp, round(covar_samp(l_extendedprice, l_quantity), 2) AS cs,
           CAST(regr_count(l_quantity, l_discount) AS BIGINT) AS rc, round(regr_sxx(l_quantity, l_discount), 5) AS rx, round(regr_syy(l_quantity, l_discount), 2) AS ry
    FROM lineitem GROUP BY l_linestatus""")
def agg_stats_regr(spark, d):
    q, x, disc = c("l_quantity"), c("l_extendedprice"), c("l_discount")
    return load(spark, d, "lineitem").groupBy("l_linestatus").agg(
        F.round(F.stddev_pop(q), 5).alias("sp"), F.round(F.stddev_samp(q), 5).alias("ss"),
        F.round(F.var_pop(q), 4).alias("vp"), F.round(F.var_samp(q), 4).alias("vs"),
        F.round(F.covar_pop(x, q), 2).alias("cp"), F.round(F.covar_samp(x, q), 2).alias("cs"),
        F.regr_count(q, disc).alias("rc"), F.round(F.regr_sxx(q, disc), 5).alias("rx"), F.round(F.regr_syy(q, disc), 2).alias("ry"))


@query("agg_bits", """
    SELECT o_orderstatus, bit_and(o_custkey | 4096) AS ba, bit_or(o_custkey) AS bo, CAST(coalesce(sum(CASE WHEN o_orderkey < 0 THEN o_orderkey END), 0) AS BIGINT) AS s0,
           any_value(o_orderstatus) AS anyv FROM orders GROUP BY o_orderstatus""")
def agg_bits(spark, d):
    return load(spark, d, "orders").groupBy("o_orderstatus").agg(
        F.bit_and(c("o_custkey").bitwiseOR(F.lit(4096))).alias("ba"), F.bit_or("o_custkey").alias("bo"),
        A.sum0(F.when(c("o_orderkey") < 0, c("o_orderkey"))).alias("s0"), F.any_value("o_orderstatus").alias("anyv"))


@query("agg_single_value", """
    SELECT n_regionkey, CAST(any_value(r_name) AS VARCHAR) AS region, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY n_regionkey""")
def agg_single_value(spark, d):
    per = load(spark, d, "region").groupBy("r_regionkey").agg(A.single_value(c("r_name")).alias("region"))
    return load(spark, d, "nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("nations")) \
        .join(per, c("n_regionkey") == c("r_regionkey")).select("n_regionkey", "region", "nations")


@query("agg_collect_fusion", """
    SELECT l_returnflag, string_agg(q || ':' || n, ',' ORDER BY q) AS bag, CAST(sum(n) AS BIGINT) AS size FROM
      (SELECT l_returnflag, CAST(l_quantity AS INTEGER) AS q, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY l_returnflag""")
def agg_collect_fusion(spark, d):
    li = load(spark, d, "lineitem").select("l_returnflag", "l_linestatus", c("l_quantity").cast("int").alias("q"))
    bags = A.collect_bag(li, ["l_returnflag", "l_linestatus"], "q")
    fused = A.fuse_bags(bags, ["l_returnflag"], "bag")
    text = F.array_join(F.transform("bag", lambda p: F.concat_ws(":", p.value, p.n)), ",")
    size = F.aggregate("bag", F.lit(0).cast("bigint"), lambda acc, p: acc + p.n)
    return fused.select("l_returnflag", text.alias("bag"), size.alias("size"))


@query("agg_json", """
    SELECT o_orderstatus, '{' || string_agg('"' || p || '":' || n, ',' ORDER BY p) || '}' AS obj,
           '[' || string_agg(CAST(n AS VARCHAR), ',' ORDER BY n) || ']' AS arr
    FROM (SELECT o_orderstatus, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY o_orderstatus""")
def agg_json(spark, d):
    per = load(spark, d, "orders").groupBy("o_orderstatus", c("o_orderpriority").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("o_orderstatus").agg(
        A.json_objectagg(c("p"), c("n")).alias("obj"), A.json_arrayagg(c("n")).alias("arr"))


@query("agg_approx_distinct", """
    SELECT event_type, count(DISTINCT user_id) AS exact_users, TRUE AS close FROM events GROUP BY event_type""")
def agg_approx_distinct(spark, d):
    # Sketches do not count repeats: over distinct pairs there is one per event type and task. Beside
    # countDistinct there would be one per pair.
    seen = load(spark, d, "events").select("event_type", "user_id").distinct()
    per = seen.groupBy("event_type").agg(F.count("user_id").alias("exact_users"), F.approx_count_distinct("user_id", 0.02).alias("a"))
    return per.select("event_type", "exact_users", (F.abs(c("a") - c("exact_users")) <= 0.1 * c("exact_users")).alias("close"))


@query("bucket_skew", """
    WITH t AS (SELECT CAST(floor((user_id % 128) * 4 / 128.0) AS INTEGER) AS task, count(*) AS n FROM events GROUP BY 1)
    SELECT task, n, round((SELECT max(n) / avg(n) FROM t), 6) AS skew FROM t""")
def bucket_skew(spark, d):
    return A.skew_report(load(spark, d, "events"), c("user_id"), 128, 4).select("task", "n", F.round("skew", 6).alias("skew"))


@query("hash_range_assign", """
    SELECT CAST(floor((2 * (o_orderkey % 4096) * 1048576.0 + 1048575) / 2 / 4294967296.0 * 8) AS INTEGER) AS bucket, count(*) AS n, min(o_orderkey) AS first_key
    FROM orders WHERE o_orderstatus = 'O' GROUP BY 1""")
def hash_range_assign(spark, d):
    lo = (c("o_orderkey") % 4096) * 1048576
    open_rows = load(spark, d, "orders").where("o_orderstatus = 'O'")
    return open_rows.groupBy(A.hash_range_bucket(lo, lo + 1048575, 4294967296.0, 8).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"))


# Windows

def _by_user(ev):
    return S.sequence(ev, ("user_id",), "ts", ("event_id",))


@query("win_rank", """
    SELECT o_orderkey, row_number() OVER w AS row_number, rank() OVER w2 AS rank, dense_rank() OVER w2 AS dense_rank,
           round(percent_rank() OVER w2, 9) AS percent_rank, round(cume_dist() OVER w2, 9) AS cume_dist, ntile(4) OVER w AS ntile
    FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey), w2 AS (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC)""")
def win_rank(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    seq = S.sequence(o, ("o_orderstatus",), "o_totalprice", ("o_orderkey",), desc=True, unit=5000.0)
    return R.ranked(o, seq, 4).select(
        "o_orderkey", "row_number", "rank", "dense_rank", F.round("percent_rank", 9).alias("percent_rank"),
        F.round("cume_dist", 9).alias("cume_dist"), c("ntile").cast("bigint").alias("ntile"))


@query("win_offset", """
    SELECT event_id, lag(event_id, 2, -1) OVER w AS two_before, lead(event_id) OVER w AS after,
           first_value(event_id) OVER w AS first_id, last_value(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_id
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def win_offset(spark, d):
    ev = load(spark, d, "events").select("event_id", "user_id", "ts")
    seq = _by_user(ev)
    e = c("event_id")
    out = S.shift(ev, seq, {"two_before": e}, 2)
    out = S.shift(out, seq, {"after": e}, -1)
    ends = ev.groupBy("user_id").agg(
        F.min_by(e, F.struct("ts", "event_id")).alias("first_id"), F.max_by(e, F.struct("ts", "event_id")).alias("last_id"))
    return out.join(ends, "user_id").select(
        "event_id", F.coalesce("two_before", F.lit(-1)).alias("two_before"), "after", "first_id", "last_id")


@query("win_frames", """
    SELECT event_id, round(sum(value) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 FOLLOWING), 4) AS near_sum,
           nth_value(event_id, 2) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS second,
           count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW) AS last_6h,
           round(max(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS top_so_far
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def win_frames(spark, d):
    ev = load(spark, d, "events").select("event_id", "user_id", "ts", "value")
    seq = _by_user(ev)
    w = S.halo_window()
    rows = S.row_halo(S.running(ev, seq, {"top_so_far": ("max", c("value"))}), seq, 3, 1).select(
        "*", F.round(F.sum("value").over(w.rowsBetween(-3, 1)), 4).alias("near_sum"),
        F.nth_value("event_id", 2).over(w.rowsBetween(-2, 0)).alias("second")).where("__own")
    reach = timedelta(hours=6)
    t = F.unix_micros(c("ts").cast("timestamp"))
    wr = Window.partitionBy(S.KEY, S.CHUNK).orderBy(t).rangeBetween(-S.micros(reach), 0)
    near = S.time_halo(ev.select("event_id", "user_id", "ts"), seq, before=reach).withColumn(
        "last_6h", F.count(F.lit(1)).over(wr)).where("__own").select("event_id", "last_6h")
    return rows.join(near, "event_id").select("event_id", "near_sum", "second", "last_6h", F.round("top_so_far", 4).alias("top_so_far"))


@query("win_disallow_partial", """
    SELECT event_id, CASE WHEN count(*) OVER w = 4 THEN round(avg(value) OVER w, 6) END AS full_avg
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""")
def win_disallow_partial(spark, d):
    ev = load(spark, d, "events").select("event_id", "user_id", "ts", "value")
    w = S.halo_window().rowsBetween(-3, 0)
    out = S.row_halo(ev, _by_user(ev), 3)
    return out.withColumn("full_avg", R.full_frame_only(F.round(F.avg("value").over(w), 6), w, 4)) \
        .where("__own").select("event_id", "full_avg")


@query("win_sliding_minmax", """
    SELECT event_id, min(value) OVER w AS lo, max(value) OVER w AS hi, first_value(value) OVER w AS oldest, last_value(value) OVER w AS newest
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""")
def win_sliding_minmax(spark, d):
    ev = load(spark, d, "events").select("event_id", "event_type", "ts", "value")
    w = S.halo_window().rowsBetween(-9, 0)
    out = S.row_halo(ev, S.sequence(ev, ("event_type",), "ts", ("event_id",)), 9)
    return out.select("event_id", "__own", F.min("value").over(w).alias("lo"), F.max("value").over(w).alias("hi"),
                      F.first("value").over(w).alias("oldest"), F.last("value").over(w).alias("newest")).where("__own").drop("__own")


# Sort, limit, sets

@query("topk_per_group", """
    SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, rn FROM
      (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn <= 5""")
def topk_per_group(spark, d):
    cols = ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    top = R.top_per_group(load(spark, d, "lineitem").select(*cols), ["l_returnflag"],
                          [c("l_extendedprice").desc(), c("l_orderkey"), c("l_linenumber"), c("l_partkey"), c("l_suppkey")], 5)
    return top.select(*cols, c("rn").cast("bigint").alias("rn"))


@query("paging_nulls", """
    SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    ORDER BY l.quality DESC NULLS LAST, d.doc_id LIMIT 20 OFFSET 10""")
def paging_nulls(spark, d):
    j = load(spark, d, "documents").select("doc_id").join(load(spark, d, "labels"), "doc_id", "left")
    return j.orderBy(c("quality").desc_nulls_last(), c("doc_id")).offset(10).limit(20).select("doc_id", "quality")


@query("set_ops_all", """
    WITH a AS (SELECT o_custkey % 50 AS k FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT o_custkey % 60 AS k FROM orders WHERE o_orderstatus = 'P')
    SELECT 'union' AS op, k, count(*) AS n FROM (SELECT k FROM a UNION SELECT k FROM b) GROUP BY k
    UNION ALL SELECT 'union_all', k, count(*) FROM (SELECT k FROM a UNION ALL SELECT k FROM b) GROUP BY k
    UNION ALL SELECT 'intersect', k, count(*) FROM (SELECT k FROM a INTERSECT SELECT k FROM b) GROUP BY k
    UNION ALL SELECT 'intersect_all', k, count(*) FROM (SELECT k FROM a INTERSECT ALL SELECT k FROM b) GROUP BY k
    UNION ALL SELECT 'except', k, count(*) FROM (SELECT k FROM b EXCEPT SELECT k FROM a) GROUP BY k
    UNION ALL SELECT 'except_all', k, count(*) FROM (SELECT k FROM a EXCEPT ALL SELECT k FROM b) GROUP BY k""")
def set_ops_all(spark, d):
    o = load(spark, d, "orders")
    a = o.where("o_orderstatus = 'F'").select((c("o_custkey") % 50).alias("k"))
    b = o.where("o_orderstatus = 'P'").select((c("o_custkey") % 60).alias("k"))
    parts = {"union": a.union(b).distinct(), "union_all": a.unionAll(b), "intersect": a.intersect(b),
             "intersect_all": a.intersectAll(b), "except": b.subtract(a), "except_all": a.exceptAll(b)}
    out = None
    for op, p in parts.items():
        one = p.groupBy("k").agg(F.count(F.lit(1)).alias("n")).select(F.lit(op).alias("op"), "k", "n")
        out = one if out is None else out.unionAll(one)
    return out


@query("union_streams_filter", """
    SELECT event_id, user_id, event_type, value FROM events WHERE event_type = 'view' AND value > 20
    UNION ALL SELECT event_id, user_id, event_type, value FROM events WHERE event_type = 'error' AND value < 20""")
def union_streams_filter(spark, d):
    ev = load(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    return ev.where("event_type = 'view' AND value > 20").unionAll(ev.where("event_type = 'error' AND value < 20"))


@query("sample_bernoulli", """
    SELECT l_returnflag, count(*) AS n, TRUE AS share_fits, CAST(0 AS BIGINT) AS strangers FROM lineitem GROUP BY 1""")
def sample_bernoulli(spark, d):
    """The engine's own generator draws the rows, so the draw is judged: per flag, the rows of
    the table, whether the share drawn is within five sigma of a tenth, and drawn rows that
    the table does not hold."""
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"]
    li = load(spark, d, "lineitem").select(*key)
    table = li.groupBy(*key).agg(F.count(F.lit(1)).alias("held"))
    drawn = li.sample(fraction=0.1, seed=7).groupBy(*key).agg(F.count(F.lit(1)).alias("drawn"))
    both = table.join(drawn, key, "full").groupBy("l_returnflag").agg(
        F.coalesce(F.sum("held"), F.lit(0)).alias("n"), F.coalesce(F.sum("drawn"), F.lit(0)).alias("got"),
        F.sum(F.greatest(F.coalesce("drawn", F.lit(0)) - F.coalesce("held", F.lit(0)), F.lit(0))).alias("strangers"))
    fits = F.abs(c("got") - c("n") * 0.1) <= 5 * F.sqrt(c("n") * 0.09)
    return both.select("l_returnflag", "n", fits.alias("share_fits"), "strangers")
