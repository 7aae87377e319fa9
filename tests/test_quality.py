"""Table-quality operators on the result-pair and screen fixtures."""

from pyspark.sql import functions as F

from conftest import rows
from quarry.operators import quality as q


def test_table_diff_multiset(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k long, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "z"), (4, "w")], "k long, v string")
    assert rows(q.table_diff(a, b)) == [(1, "x", 1), (4, "w", -1)]
    eq = q.tables_equal(a, a.orderBy(F.desc("k"))).collect()[0]
    assert eq["equal"] is True


def test_canonical_rounding_and_trim(spark):
    a = spark.createDataFrame([(1.0000001, " t "), (2.5, "u")], "x double, s string")
    b = spark.createDataFrame([(1.0, "t"), (2.5, "u ")], "x double, s string")
    assert rows(q.table_diff(a, b, canonicalize=True)) == []
    c = spark.createDataFrame([(1.00001, "t")], "x double, s string")
    assert len(rows(q.table_diff(c, b.limit(1), canonicalize=True))) == 2


def test_canonical_parts_numeric_text(spark):
    df = spark.createDataFrame([(" 2.50 ",), ("2.5",), ("abc ",), (None,)], "raw string")
    out = df.select(q.canonical_parts("raw").alias("c")).select("c.kind", "c.num", "c.txt")
    assert rows(out) == [("null", None, None), ("num", 2.5, None), ("num", 2.5, None), ("text", None, "abc")]


def test_ordered_diff_first_mismatch(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "pos long, v string")
    b = spark.createDataFrame([(1, "a"), (2, "c"), (3, "b"), (4, "d")], "pos long, v string")
    out = q.ordered_diff(a, b, "pos", ["v"])
    assert rows(out) == [(2, "both", True), (3, "both", False), (4, "only_b", False)]


def test_tolerant_diff(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None), (4, 4.0)], "k long, x double")
    b = spark.createDataFrame([(1, 1.0000001), (2, 2.00001), (3, None), (5, 5.0)], "k long, x double")
    out = q.tolerant_diff(a, b, "k", ["x"])
    assert rows(out, "k", "column") == [(2, "x"), (4, "<row>"), (5, "<row>")]


def test_key_audit_and_required_and_domain(spark):
    df = spark.createDataFrame([(1, "a", "EASY"), (1, "b", "HARD"), (None, " ", "WILD"), (3, None, None)],
                               "id long, title string, difficulty string")
    assert rows(q.key_audit(df, "id"), "id", "n", "problem") == [(1, 2, "duplicate"), (None, 1, "null key")]
    req = q.required(df, "id", ["title", "difficulty"])
    assert rows(req.select("id", F.array_join("missing", ",").alias("m"))) == [(3, "title,difficulty"), (None, "title")]
    assert rows(q.domain(df, "difficulty", ["EASY", "MEDIUM", "HARD"], ["id"])) == [(3, None), (None, "WILD")]


def test_cardinality_counts_zero_children(spark):
    parents = spark.createDataFrame([(1,), (2,), (3,)], "pid long")
    kids = spark.createDataFrame([(1,), (1,), (3,), (3,), (3,), (3,), (3,)], "pid long")
    out = q.cardinality(parents, "pid", kids, "pid", 1, 4)
    assert rows(out) == [(2, 0), (3, 5)]


def test_first_failure_order(spark):
    df = spark.createDataFrame([(1, ""), (2, "DROP TABLE x"), (3, "SELECT 1; SELECT 2"), (4, "SELECT 1")],
                               "id long, sql string")
    rules = [("empty", F.col("sql") == ""),
             ("banned keyword", F.col("sql").rlike(r"(?i)\b(drop|delete|insert)\b")),
             ("several statements", F.col("sql").contains(";")),
             ("not a query", ~F.col("sql").rlike(r"(?i)^\s*(select|with)\b"))]
    out = q.first_failure(df, rules)
    assert rows(out, "id", "reason") == [(1, "empty"), (2, "banned keyword"), (3, "several statements"), (4, None)]


def test_shape_audit_case_insensitive(spark):
    df = spark.createDataFrame([('{"a":1,"b":2}',), ('{"A":1,"B":2}',), ('{"b":2,"a":1}',), ("not json",)], "j string")
    out = q.shape_audit(df, "j", ["a", "b"])
    assert rows(out, "shape", "n", "matches") == [("a,b", 2, True), ("b,a", 1, False), (None, 1, False)]


def test_mentions_unique_members_flags(spark):
    df = spark.createDataFrame([(1, "The cat and dog", "Tag tag x"), (2, "dog only", "a b")], "id long, t string, w string")
    m = q.mentions(df, "t", ["the", "AND"], ["id"])
    assert rows(m.select("id", F.array_join("missing", ",").alias("m"))) == [(2, "the,AND")]
    u = q.unique_members(df, F.split("w", " "), ["id"])
    assert rows(u) == [(1, 3, 2)]
    f = q.flag_consistency(df.withColumn("flag", F.lit(1)), F.col("flag") == 1, F.col("t").contains("cat"), ["id"])
    assert rows(f, "id") == [(2,)]


def test_order_stability_detects_tie_dependence(spark):
    df = spark.createDataFrame([(i, float(i // 3)) for i in range(30)], "id long, v double")
    prone = q.order_stability(lambda x: x.orderBy(F.desc("v")).limit(4), [df])
    broken = q.order_stability(lambda x: x.orderBy(F.desc("v"), "id").limit(4), [df])
    assert broken.select("digest").distinct().count() == 1
    assert prone.count() == 6


def test_agreement(spark):
    a = spark.createDataFrame([(1,), (2,)], "x long")
    b = spark.createDataFrame([(2,), (1,)], "X long")
    c = spark.createDataFrame([(2,), (3,)], "x long")
    assert q.agreement(a, b).collect()[0]["agree"] is True
    r = q.agreement(a, c).collect()[0]
    assert (r["agree"], r["only_a"], r["only_b"]) == (False, 1, 1)


def test_duplicate_text_first_and_previous(spark):
    df = spark.createDataFrame([(1, "Hello"), (2, "hello "), (3, "other"), (4, " HELLO"), (5, "x")], "id long, t string")
    assert rows(q.duplicate_text(df, "id", "t", "first")) == [(2, 1), (4, 1)]
    assert rows(q.duplicate_text(df, "id", "t", "previous")) == [(2, 1), (4, 2)]
