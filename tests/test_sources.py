"""Sources, sinks and table statements."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import aggregates as A
from tidewater.operators.changelog import retract_diff
from tidewater.session import load, work_dir
from tidewater.sources import mailbox, readers, sinks
from tidewater.streaming.runner import write_all

SF = "/root/testdata/sf0.001"
MAIL = """Received: from a by b; Tue, 02 Jan 2024 10:00:05 +0000
Date: Tue, 02 Jan 2024 10:00:00 +0000
Subject: Hello {n}

body
"""


@pytest.fixture()
def mails(tmp_path):
    for n in range(3):
        (tmp_path / f"m{n}.eml").write_text(MAIL.format(n=n))
    return tmp_path


def options(path):
    return {"path": str(path), "host": "h", "user": "u", "password": "p"}


def test_mailbox_table(spark, mails):
    mailbox.register(spark)
    df = spark.read.format("mailbox").options(**options(mails)).load()
    r = df.orderBy("subject").first()
    assert df.count() == 3 and r.subject == "Hello 0" and (r.received - r.sent).total_seconds() == 5
    some = spark.read.format("mailbox").schema("SENT timestamp, Subject string").options(**options(mails)).load()
    assert some.columns == ["SENT", "Subject"] and some.count() == 3
    with pytest.raises(Exception, match="password"):
        spark.read.format("mailbox").options(path=str(mails), host="h", user="u").load().count()
    with pytest.raises(Exception, match="no column"):
        spark.read.format("mailbox").schema("size int").options(**options(mails)).load().count()


def test_mailbox_stream(spark, mails):
    mailbox.register(spark)
    src = lambda: spark.readStream.format("mailbox").schema("subject string").options(**options(mails)).load()
    ck, out = work_dir(spark, "ck"), work_dir(spark, "out")

    def run():
        q = src().writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).start()
        q.processAllAvailable()
        q.stop()
        return spark.read.parquet(out).count()

    assert run() == 3
    (mails / "m9.eml").write_text(MAIL.format(n=9))
    assert run() == 4


def test_generated_streams_have_schemas(spark):
    assert readers.ticker(spark).columns == ["subject", "sent"]
    g = readers.datagen(spark)
    assert g.isStreaming and [f.dataType.simpleString() for f in g.schema] == ["int", "int", "string", "timestamp"]


def test_good_and_broken(spark):
    df = spark.createDataFrame([('{"id":1}',), ("{x",), (None,)], "value string")
    got = readers.good_and_broken(df, "value", T.StructType.fromDDL("id int"))
    assert [r.broken for r in got.collect()] == [False, True, True]


def test_demo_tables(spark):
    """The documented inputs and results of the SQL demos."""
    a = readers.collection(spark, [(1, "beer", 3), (1, "diaper", 4), (3, "rubber", 2)], "user bigint, product string, amount int")
    b = readers.collection(spark, [(2, "pen", 3), (2, "rubber", 3), (4, "beer", 1)], "user bigint, product string, amount int")
    got = a.where("amount > 2").unionAll(b.where("amount < 2"))
    assert sorted(map(tuple, got.collect())) == [(1, "beer", 3), (1, "diaper", 4), (4, "beer", 1)]
    orders = readers.collection(spark, [(1, 1, 3), (2, 2, 4), (3, 2, 6), (4, 3, 2), (5, 3, 5)], "id bigint, uid bigint, amount int")
    users = readers.collection(spark, [(1, "Alice", 27), (2, "Bob", 26), (3, "Charlie", 25)], "id bigint, name string, age int")
    sums = orders.join(users.where("age < 27").withColumnRenamed("id", "uid"), "uid").groupBy("name").agg(F.sum("amount").alias("n"))
    assert {r.name: r.n for r in sums.collect()} == {"Bob": 10, "Charlie": 7}
    l = readers.collection(spark, [('{"id":1,"name":"zhangsan"}',)], "f0 string")
    r = readers.collection(spark, [('{"id":1,"sex":"man"}',)], "f0 string")
    g = lambda p: F.get_json_object("f0", p)
    j = l.select(g("$.id").alias("id"), g("$.name").alias("name")).join(r.select(g("$.id").alias("id"), g("$.sex").alias("sex")), "id")
    assert tuple(j.first()) == ("1", "zhangsan", "man")


def test_table_statements(spark):
    where = work_dir(spark, "t")
    spark.sql(f"CREATE TABLE src_t (a INT, b STRING, c DOUBLE) USING parquet LOCATION '{where}/a'")
    spark.sql("CREATE TABLE dst_t (a INT, b STRING, c DOUBLE) USING parquet LOCATION '%s/b'" % where)
    try:
        sinks.insert_columns(spark.sql("SELECT * FROM VALUES (1, 'x'), (2, 'y')"), "src_t", ["a", "b"])
        assert spark.table("src_t").where("c IS NULL").count() == 2
        assert spark.sql("TABLE src_t").count() == 2
        spark.sql("INSERT INTO dst_t SELECT * FROM src_t")
        assert spark.table("dst_t").count() == 2
        spark.sql("DROP TABLE dst_t")
        sinks.create_like(spark, "dst_t", "src_t")
        assert spark.table("dst_t").columns == ["a", "b", "c"] and spark.table("dst_t").count() == 0
        names = {r.tableName for r in spark.sql("SHOW TABLES").collect()}
        assert {"src_t", "dst_t"} <= names and spark.sql("DESCRIBE src_t").count() == 3
        assert "Scan parquet" in spark.sql("EXPLAIN FORMATTED SELECT a FROM src_t").first()[0]
        out, _ = write_all(spark.readStream.table("src_t"))
        assert spark.read.parquet(out).count() == 2
        assert any(f.name == "str_to_map" for f in spark.catalog.listFunctions())
    finally:
        spark.sql("DROP TABLE IF EXISTS src_t")
        spark.sql("DROP TABLE IF EXISTS dst_t")


def test_repeatable_sample(spark):
    li = load(spark, SF, "lineitem")
    q = "SELECT * FROM {t} TABLESAMPLE (20 PERCENT) REPEATABLE (3)"
    a, b = spark.sql(q, t=li), spark.sql(q, t=li)
    assert a.exceptAll(b).count() == 0 and 0 < a.count() < li.count()


def test_retract_diff_kinds(spark):
    old = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "k int, n int")
    new = spark.createDataFrame([(1, 5), (2, 8), (4, 9)], "k int, n int")
    assert sorted(map(tuple, retract_diff(old, new, ["k"]).collect())) == [("+I", 4, 9), ("+U", 2, 8), ("-D", 3, 7), ("-U", 2, 6)]


def test_group_id_counts_copies(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2)], "a string, b int")
    got = A.group_id_union(df, ["a", "b"], [["a"], ["a"], []], [F.count(F.lit(1)).alias("n")])
    assert sorted((r.a or "", r.group_id, r.n) for r in got.collect()) == [("", 0, 2), ("x", 0, 1), ("x", 1, 1), ("y", 0, 1), ("y", 1, 1)]
