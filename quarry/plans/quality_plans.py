"""Plans for table-quality operators (inventory D1, D2, D4-D23) over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import compare
from quarry.operators import quality as q
from quarry.operators import relational as rel
from quarry.operators import windows as win
from quarry.operators.scan import ordered_scan
from quarry.plans.core import ALTERED_PART_SQL, altered_part
from quarry.plans.registry import plan
from quarry.sources.tables import Tables

# ---- fixed values: screening patterns for the document screen (rules in order)
DOC_RULES = (
    ("empty", None),
    ("too short", None),
    ("secret", r'(?i)token\s*=\s*"[0-9a-f]{16,}"'),
    ("card number", r"[0-9]{16}"),
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.]+"),
    ("junk", r"[#$%&*]{3}"),
)
LICENSE_PATTERN = r"(?i)licen[cs]e"
MIN_CHARS = 20


# a literal every match must contain: a cheap substring test skips the regex
# on most rows (the e-mail pattern backtracks on every word otherwise)
PREFILTER = {"email": "@"}


def doc_rules(text: str = "text", n_chars: str = "n_chars"):
    t = F.col(text)

    def rule(name: str, p: str):
        hit = t.rlike(p)
        return (t.contains(PREFILTER[name]) & hit) if name in PREFILTER else hit

    return [
        ("empty", F.trim(t) == ""),
        ("too short", F.col(n_chars) < MIN_CHARS),
        *[(name, rule(name, p)) for name, p in DOC_RULES[2:]],
    ]


DOC_RULES_SQL = f"""CASE WHEN trim(text) = '' THEN 'empty' WHEN n_chars < {MIN_CHARS} THEN 'too short'
  WHEN regexp_matches(text, '{DOC_RULES[2][1]}') THEN 'secret'
  WHEN regexp_matches(text, '{DOC_RULES[3][1]}') THEN 'card number'
  WHEN regexp_matches(text, '{DOC_RULES[4][1]}') THEN 'email'
  WHEN regexp_matches(text, '{DOC_RULES[5][1]}') THEN 'junk' END"""


@plan("d1_key_audit", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n,
  CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'null key' ELSE 'duplicate' END AS problem
FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING COUNT(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""")
def d1(spark, sf):
    return q.key_audit(Tables(spark, sf).lineitem, ["l_orderkey", "l_linenumber"])


@plan("d2_duplicate_text_first", """
WITH k AS (SELECT doc_id, sha256(lower(trim(text))) AS tk FROM documents),
f AS (SELECT tk, MIN(doc_id) AS holder_id FROM k GROUP BY tk HAVING COUNT(*) > 1)
SELECT k.doc_id, f.holder_id FROM k JOIN f ON k.tk = f.tk WHERE k.doc_id <> f.holder_id""")
def d2_first(spark, sf):
    return q.duplicate_text(Tables(spark, sf).documents, "doc_id", "text", holder="first")


@plan("d2_duplicate_text_previous", """
WITH k AS (SELECT doc_id, sha256(lower(trim(text))) AS tk FROM documents),
p AS (SELECT doc_id, LAG(doc_id) OVER (PARTITION BY tk ORDER BY doc_id) AS holder_id FROM k)
SELECT doc_id, holder_id FROM p WHERE holder_id IS NOT NULL""")
def d2_prev(spark, sf):
    return q.duplicate_text(Tables(spark, sf).documents, "doc_id", "text", holder="previous")


@plan("d4_required", """
SELECT d.doc_id, concat_ws(',', CASE WHEN d.text IS NULL OR trim(d.text) = '' THEN 'text' END,
  CASE WHEN l.quality IS NULL THEN 'quality' END, CASE WHEN l.toxic IS NULL THEN 'toxic' END) AS missing
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
WHERE d.text IS NULL OR trim(d.text) = '' OR l.quality IS NULL OR l.toxic IS NULL""")
def d4(spark, sf):
    t = Tables(spark, sf)
    j = t.documents.select("doc_id", "text").join(t.labels, "doc_id", "left")
    r = q.required(j, "doc_id", ["text", "quality", "toxic"])
    return r.select("doc_id", F.array_join("missing", ",").alias("missing"))


@plan("d5_domain", """
SELECT event_id, event_type FROM events WHERE event_type IS NULL OR event_type NOT IN ('click', 'view', 'purchase')""")
def d5(spark, sf):
    return q.domain(Tables(spark, sf).events, "event_type", ["click", "view", "purchase"], keep=["event_id"])


@plan("d6_cardinality_lines", """
SELECT o.o_orderkey, CAST(COALESCE(c.n, 0) AS BIGINT) AS n_children FROM orders o
LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey) c ON c.l_orderkey = o.o_orderkey
WHERE COALESCE(c.n, 0) NOT BETWEEN 1 AND 7""")
def d6_lines(spark, sf):
    t = Tables(spark, sf)
    return q.cardinality(t.orders, "o_orderkey", t.lineitem, "l_orderkey", 1, 7)


@plan("d6_cardinality_turns", """
SELECT conv_id, COUNT(*) AS n_children FROM conversations GROUP BY conv_id HAVING COUNT(*) NOT BETWEEN 2 AND 6""")
def d6_turns(spark, sf):
    c = Tables(spark, sf).conversations
    parents = c.select("conv_id").distinct()
    return q.cardinality(parents, "conv_id", c, "conv_id", 2, 6)


@plan("d7_table_diff", f"""
WITH u AS (SELECT *, 1 AS d FROM part UNION ALL SELECT *, -1 AS d FROM {ALTERED_PART_SQL})
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, CAST(SUM(d) AS BIGINT) AS delta
FROM u GROUP BY p_partkey, p_name, p_brand, p_type, p_size, p_retailprice HAVING SUM(d) <> 0""")
def d7(spark, sf):
    t = Tables(spark, sf)
    return q.table_diff(t.part, altered_part(t))


@plan("d7_tables_equal", f"""
WITH u AS (SELECT *, 1 AS d FROM part UNION ALL SELECT *, -1 AS d FROM {ALTERED_PART_SQL}),
g AS (SELECT SUM(d) AS delta FROM u GROUP BY p_partkey, p_name, p_brand, p_type, p_size, p_retailprice)
SELECT CAST(COALESCE(SUM(delta) FILTER (WHERE delta > 0), 0) AS BIGINT) AS only_a,
       CAST(COALESCE(SUM(-delta) FILTER (WHERE delta < 0), 0) AS BIGINT) AS only_b,
       COALESCE(SUM(delta) FILTER (WHERE delta > 0), 0) = 0 AND COALESCE(SUM(-delta) FILTER (WHERE delta < 0), 0) = 0 AS equal
FROM g""")
def d7_eq(spark, sf):
    t = Tables(spark, sf)
    e = q.tables_equal(t.part, altered_part(t))
    return e.select(F.col("only_a").cast("bigint").alias("only_a"), F.col("only_b").cast("bigint").alias("only_b"),
                    "equal")


@plan("d8_ordered_diff", """
WITH a AS (SELECT ROW_NUMBER() OVER (ORDER BY c_acctbal DESC, c_custkey ASC) AS pos, c_custkey FROM customer),
b AS (SELECT ROW_NUMBER() OVER (ORDER BY FLOOR(c_acctbal / 100) DESC, c_custkey ASC) AS pos, c_custkey FROM customer),
bad AS (SELECT COALESCE(a.pos, b.pos) AS pos,
          CASE WHEN a.pos IS NULL THEN 'only_b' WHEN b.pos IS NULL THEN 'only_a' ELSE 'both' END AS side
        FROM a FULL OUTER JOIN b ON a.pos = b.pos
        WHERE a.pos IS NULL OR b.pos IS NULL OR a.c_custkey IS DISTINCT FROM b.c_custkey)
SELECT pos, side, pos = (SELECT MIN(pos) FROM bad) AS is_first FROM bad""")
def d8(spark, sf):
    """Two rankings of customers (exact balance vs balance in hundreds, both
    broken by key), numbered by the blocked scan, compared by position."""
    c = Tables(spark, sf).customer.select("c_custkey", "c_acctbal")
    a = ordered_scan(c.withColumn("_k", -F.col("c_acctbal")), None, ["_k", "c_custkey"], row_number="pos")
    b = ordered_scan(c.withColumn("_k", -F.floor(F.col("c_acctbal") / 100)), None, ["_k", "c_custkey"],
                     row_number="pos")
    d = q.ordered_diff(a.withColumn("pos", F.col("pos").cast("bigint")),
                       b.withColumn("pos", F.col("pos").cast("bigint")), "pos", ["c_custkey"])
    return d


@plan("d9_canonical", """
WITH m AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(value AS VARCHAR)
                                  WHEN 1 THEN '  ' || CAST(value AS VARCHAR) || ' '
                                  WHEN 2 THEN '  ' || event_type || ' ' ELSE NULL END AS raw FROM events)
SELECT event_id, CASE WHEN raw IS NULL THEN 'null' WHEN TRY_CAST(raw AS DOUBLE) IS NOT NULL THEN 'num' ELSE 'text' END AS kind,
  ROUND(TRY_CAST(raw AS DOUBLE), 6) AS num,
  CASE WHEN raw IS NOT NULL AND TRY_CAST(raw AS DOUBLE) IS NULL THEN trim(raw) END AS txt
FROM m""")
def d9(spark, sf):
    ev = Tables(spark, sf).events
    raw = (F.when(F.col("event_id") % 4 == 0, F.col("value").cast("string"))
           .when(F.col("event_id") % 4 == 1, F.concat(F.lit("  "), F.col("value").cast("string"), F.lit(" ")))
           .when(F.col("event_id") % 4 == 2, F.concat(F.lit("  "), F.col("event_type"), F.lit(" "))))
    return ev.select("event_id", q.canonical_parts(raw).alias("c")).select("event_id", "c.kind", "c.num", "c.txt")


@plan("d10_tolerant_diff", """
WITH t AS (SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem GROUP BY 1),
b AS (SELECT l_orderkey, CASE WHEN l_orderkey % 13 = 0 THEN total + 0.001 WHEN l_orderkey % 17 = 0 THEN total + 1e-7
                              ELSE total END AS total FROM t WHERE l_orderkey % 19 <> 0)
SELECT COALESCE(a.l_orderkey, b.l_orderkey) AS l_orderkey,
  CASE WHEN a.l_orderkey IS NULL OR b.l_orderkey IS NULL THEN '<row>' ELSE 'total' END AS "column",
  CASE WHEN a.l_orderkey IS NULL OR b.l_orderkey IS NULL THEN NULL ELSE a.total END AS a,
  CASE WHEN a.l_orderkey IS NULL OR b.l_orderkey IS NULL THEN NULL ELSE b.total END AS b
FROM t a FULL OUTER JOIN b ON a.l_orderkey = b.l_orderkey
WHERE a.l_orderkey IS NULL OR b.l_orderkey IS NULL OR abs(a.total - b.total) >= 1e-6""")
def d10(spark, sf):
    """Stored totals against recomputed ones: 1e-3 off on key % 13 (found),
    1e-7 off on key % 17 (within tolerance), missing on key % 19 (row)."""
    li = Tables(spark, sf).lineitem
    t = li.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("total"))
    k = F.col("l_orderkey")
    b = t.where(k % 19 != 0).select("l_orderkey", F.when(k % 13 == 0, F.col("total") + 0.001)
                                    .when(k % 17 == 0, F.col("total") + 1e-7).otherwise(F.col("total")).alias("total"))
    return q.tolerant_diff(t, b, "l_orderkey", ["total"])


PROPS2_SQL = """CASE WHEN event_id % 7 = 0 THEN replace(props, '"k"', '"K2"')
  WHEN event_id % 10 = 0 THEN replace(props, '"k"', '"K"') ELSE props END"""


def props2(ev: DataFrame) -> DataFrame:
    """``events.props`` with the member renamed on every 7th row and only its
    case changed on every 10th (which must still match)."""
    k = F.col("event_id")
    return ev.withColumn("props2", F.when(k % 7 == 0, F.replace("props", F.lit('"k"'), F.lit('"K2"')))
                         .when(k % 10 == 0, F.replace("props", F.lit('"k"'), F.lit('"K"'))).otherwise(F.col("props")))


@plan("d11_shape_audit", f"""
SELECT array_to_string(list_transform(json_keys({PROPS2_SQL}), lambda x: lower(x)), ',') AS shape, COUNT(*) AS n,
  COALESCE(array_to_string(list_transform(json_keys({PROPS2_SQL}), lambda x: lower(x)), ',') = 'k', false) AS matches
FROM events GROUP BY 1, 3""")
def d11(spark, sf):
    return q.shape_audit(props2(Tables(spark, sf).events), "props2", ["k"])


@plan("d12_row_count_check", """
SELECT (SELECT COUNT(*) FROM orders) AS n_a, (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) AS n_b,
  (SELECT COUNT(*) FROM orders) = (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) AS equal,
  (SELECT COUNT(*) FROM orders) > 0 AND (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) > 0 AS both_nonempty""")
def d12(spark, sf):
    t = Tables(spark, sf)
    return q.row_count_check(t.orders.select("o_orderkey"), t.lineitem.select("l_orderkey").distinct())


@plan("d13_arity", """
SELECT conv_id, turn, CAST(len(string_split(text, chr(10))) AS INTEGER) AS width FROM conversations
WHERE len(string_split(text, chr(10))) <> 1""")
def d13(spark, sf):
    c = Tables(spark, sf).conversations
    return q.arity(c, F.split("text", "\n"), 1, ["conv_id", "turn"])


@plan("d14_not_null_audit", """
WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT 'doc_id' AS "column", COUNT(*) FILTER (WHERE doc_id IS NULL) AS n_null FROM j
UNION ALL SELECT 'lang', COUNT(*) FILTER (WHERE lang IS NULL) FROM j
UNION ALL SELECT 'quality', COUNT(*) FILTER (WHERE quality IS NULL) FROM j
UNION ALL SELECT 'toxic', COUNT(*) FILTER (WHERE toxic IS NULL) FROM j""")
def d14(spark, sf):
    t = Tables(spark, sf)
    j = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left").select("doc_id", "lang", "quality", "toxic")
    return q.not_null_audit(j)


@plan("d15_type_audit", """
SELECT event_id, CASE WHEN event_id % 11 = 0 THEN json_extract_string(props, '$.k') || 'x'
                      ELSE json_extract_string(props, '$.k') END AS value
FROM events WHERE TRY_CAST(CASE WHEN event_id % 11 = 0 THEN json_extract_string(props, '$.k') || 'x'
                      ELSE json_extract_string(props, '$.k') END AS INTEGER) IS NULL""")
def d15(spark, sf):
    ev = Tables(spark, sf).events
    k = F.get_json_object("props", "$.k")
    raw = F.when(F.col("event_id") % 11 == 0, F.concat(k, F.lit("x"))).otherwise(k)
    return q.type_audit(ev, raw, "int", ["event_id"])


PAGE_LANG_URL = r"^[a-z]+://[^/]+/([a-z]{2})/"
PAGE_LANG_HTML = r'<html lang="([A-Za-z-]+)"'


@plan("d16_id_matches_source", f"""
WITH p AS (SELECT page_id, url, html FROM pages
           UNION ALL SELECT page_id + 100000, 'http://example.org/xx/' || page_id, html FROM pages WHERE page_id % 7 = 0)
SELECT page_id, regexp_extract(html, '{PAGE_LANG_HTML}', 1) AS declared, regexp_extract(url, '{PAGE_LANG_URL}', 1) AS derived
FROM p WHERE regexp_extract(html, '{PAGE_LANG_HTML}', 1) IS DISTINCT FROM regexp_extract(url, '{PAGE_LANG_URL}', 1)""")
def d16(spark, sf):
    pg = Tables(spark, sf).pages
    damaged = pg.where(F.col("page_id") % 7 == 0).select(
        (F.col("page_id") + 100000).alias("page_id"),
        F.concat(F.lit("http://example.org/xx/"), F.col("page_id").cast("string")).alias("url"), "html")
    p = pg.select("page_id", "url", "html").unionByName(damaged)
    return q.id_matches_source(p, F.regexp_extract("html", PAGE_LANG_HTML, 1),
                               F.regexp_extract("url", PAGE_LANG_URL, 1), ["page_id"])


@plan("d17_first_failure", f"SELECT doc_id, lang, {DOC_RULES_SQL} AS reason FROM documents")
def d17(spark, sf):
    d = Tables(spark, sf).documents
    return q.first_failure(d, doc_rules()).select("doc_id", "lang", "reason")


def _top9(p: DataFrame, tie_break: bool) -> DataFrame:
    order = [F.col("p_retailprice").desc()] + ([F.col("p_partkey").asc()] if tie_break else [])
    return p.orderBy(*order).limit(9).select("p_partkey", "p_retailprice")


@plan("d18_order_stability")
def d18(spark, sf):
    """Rows-only: a top-9 by price without a tie-break (ties straddle the cut)
    against the tie-broken one, each run on six reorderings of ``part``.
    The tie-broken variant must show one digest."""
    p = Tables(spark, sf).part.select("p_partkey", "p_retailprice")
    a = q.order_stability(lambda x: _top9(x, False), [p]).withColumn("variant", F.lit("tie_prone"))
    b = q.order_stability(lambda x: _top9(x, True), [p]).withColumn("variant", F.lit("tie_broken"))
    runs = a.unionByName(b)
    return runs.groupBy("variant").agg(F.count(F.lit(1)).alias("runs"),
                                       F.count_distinct("digest").alias("distinct_digests"))


@plan("d18_tie_broken", """
WITH t AS (SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 9)
SELECT CAST(seed AS INTEGER) AS seed, p_partkey, p_retailprice FROM t, range(6) s(seed)""")
def d18_tie_broken(spark, sf):
    """The tie-broken top-9 on six reorderings of ``part``: the same rows each time."""
    p = Tables(spark, sf).part.select("p_partkey", "p_retailprice")
    runs = [_top9(q.reorder(p, seed, 8 + seed), True).select(F.lit(seed).alias("seed"), "p_partkey", "p_retailprice") for seed in range(6)]
    out = runs[0]
    for run in runs[1:]:
        out = out.unionByName(run)
    return out


@plan("d19_agreement", """
WITH a AS (SELECT c_custkey FROM (SELECT c_custkey, DENSE_RANK() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS r
                                   FROM customer) t WHERE r <= 3),
v AS (SELECT c_nationkey, c_acctbal FROM (SELECT c_nationkey, c_acctbal,
        ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS r
        FROM (SELECT DISTINCT c_nationkey, c_acctbal FROM customer) d) t WHERE r <= 3),
b AS (SELECT c.c_custkey FROM customer c JOIN v ON v.c_nationkey = c.c_nationkey AND v.c_acctbal = c.c_acctbal),
oa AS (SELECT COUNT(*) AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) x),
ob AS (SELECT COUNT(*) AS n FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) x)
SELECT (SELECT n FROM oa) = 0 AND (SELECT n FROM ob) = 0 AS agree, (SELECT n FROM oa) AS only_a, (SELECT n FROM ob) AS only_b""")
def d19(spark, sf):
    """Window form (dense rank) against join form (top-3 distinct balances per
    nation joined back) of the same top-N question."""
    c = Tables(spark, sf).customer
    a = win.top_n_per_group(c, "c_nationkey", [F.col("c_acctbal").desc()], 3).select("c_custkey")
    v = win.top_n_per_group(c.select("c_nationkey", "c_acctbal").distinct(), "c_nationkey",
                            [F.col("c_acctbal").desc()], 3, kind="row_number").select("c_nationkey", "c_acctbal")
    b = c.join(v, ["c_nationkey", "c_acctbal"]).select("c_custkey")
    return q.agreement(a, b)


REVENUE = "CAST(l_extendedprice * (1 - l_discount) AS DOUBLE)"


def _revenue_texts(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Revenue per order, summed as doubles; and the same from exact decimals, as
    padded text, a cent higher on every 13th order and missing on every 19th.
    Every 7th order has its quantity times 1e38 on both sides."""
    li, k = t.lineitem, F.col("l_orderkey")
    line = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("double")
    huge = F.sum("l_quantity").cast("double") * 1e38
    a = li.groupBy("l_orderkey").agg(F.when(k % 7 == 0, huge).otherwise(F.sum(line)).alias("revenue"))
    exact = F.sum(line.cast("decimal(18,6)")).cast("double")
    stored = F.when(k % 13 == 0, exact + 0.01).when(k % 7 == 0, huge).otherwise(exact)
    b = li.where(k % 19 != 0).groupBy("l_orderkey").agg(stored.alias("revenue"))
    return a, b.select(F.concat(F.lit(" "), k.cast("string")).alias("l_orderkey"),
                       F.concat(F.lit("  "), F.col("revenue").cast("string"), F.lit(" ")).alias("revenue"))


@plan("d7_tolerant_rows", f"""
WITH a AS (SELECT l_orderkey, CASE WHEN l_orderkey % 7 = 0 THEN CAST(sum(l_quantity) AS DOUBLE) * 1e38 ELSE sum({REVENUE}) END AS x
           FROM lineitem GROUP BY 1),
e AS (SELECT l_orderkey, CAST(sum(CAST({REVENUE} AS DECIMAL(18,6))) AS DOUBLE) AS r, CAST(sum(l_quantity) AS DOUBLE) * 1e38 AS h
      FROM lineitem WHERE l_orderkey % 19 <> 0 GROUP BY 1),
b AS (SELECT l_orderkey, CASE WHEN l_orderkey % 13 = 0 THEN r + 0.01 WHEN l_orderkey % 7 = 0 THEN h ELSE r END AS x FROM e),
p AS (SELECT a.l_orderkey FROM a JOIN b ON a.l_orderkey = b.l_orderkey AND (a.x = b.x OR abs(a.x - b.x) < 1e-6))
SELECT 'a' AS side, l_orderkey, CAST(1 AS BIGINT) AS n FROM a WHERE l_orderkey NOT IN (SELECT l_orderkey FROM p)
UNION ALL SELECT 'b', l_orderkey, CAST(1 AS BIGINT) FROM b WHERE l_orderkey NOT IN (SELECT l_orderkey FROM p)""")
def d7_tolerant(spark, sf):
    """Order-free differences of two results: float noise, padded numeric text and
    numbers beyond 1e38 are no differences; changed and missing rows are."""
    a, b = _revenue_texts(Tables(spark, sf))
    d = compare.tolerant_rows(a, b)
    return d.select("side", F.get("nums", F.lit(0)).cast("bigint").alias("l_orderkey"), "n")


@plan("d9_tolerant_multiset", """
WITH a AS (SELECT trim(c_mktsegment) AS s, c_nationkey AS n, floor(CAST(c_acctbal AS DOUBLE) / 50) / 3 * 3 AS x FROM customer),
b AS (SELECT trim(c_mktsegment) AS s, c_nationkey AS n, floor(CAST(c_acctbal AS DOUBLE) / 50) + CASE WHEN c_custkey % 29 = 0 THEN 0.5 ELSE 0 END AS x FROM customer),
ca AS (SELECT s, n, round(x, 1) AS x, count(*) AS c FROM a GROUP BY ALL),
cb AS (SELECT s, n, round(x, 1) AS x, count(*) AS c FROM b GROUP BY ALL),
j AS (SELECT coalesce(ca.c, 0) - coalesce(cb.c, 0) AS d FROM ca FULL OUTER JOIN cb ON ca.s = cb.s AND ca.n = cb.n AND ca.x = cb.x)
SELECT CAST(coalesce(sum(greatest(d, 0)), 0) AS BIGINT) AS only_a, CAST(coalesce(sum(greatest(-d, 0)), 0) AS BIGINT) AS only_b,
  coalesce(sum(abs(d)), 0) = 0 AS agree FROM j""")
def d9_multiset(spark, sf):
    """Rows without a key, many repeated: segment (padded on one side), nation and
    balance in fifties with float noise; every 29th is half a step off."""
    c = Tables(spark, sf).customer
    step = F.floor(F.col("c_acctbal").cast("double") / 50)
    a = c.select(F.concat(F.lit(" "), "c_mktsegment", F.lit("\t")).alias("s"), "c_nationkey", (step / 3 * 3).alias("x"))
    b = c.select(F.col("c_mktsegment").alias("s"), "c_nationkey", (step + F.when(F.col("c_custkey") % 29 == 0, 0.5).otherwise(0.0)).alias("x"))
    return compare.tolerant_agreement(a, b)


@plan("d8_tolerant_ordered", """
WITH a AS (SELECT o_orderkey AS pos, CAST(o_totalprice AS DOUBLE) AS x, o_orderstatus AS s FROM orders),
b AS (SELECT o_orderkey AS pos, CASE WHEN o_orderkey % 23 = 0 THEN CAST(o_totalprice AS DOUBLE) + 1e-5 ELSE CAST(o_totalprice AS DOUBLE) + 4e-7 END AS x,
        CASE WHEN o_orderkey % 31 = 0 THEN lower(o_orderstatus) ELSE o_orderstatus || ' ' END AS s FROM orders WHERE o_orderkey % 41 <> 0)
SELECT a.pos, CASE WHEN b.pos IS NULL THEN 'only_a' ELSE 'both' END AS side,
  CASE WHEN b.pos IS NULL THEN NULL ELSE concat_ws(',', CASE WHEN abs(a.x - b.x) >= 1e-6 THEN '1' END, CASE WHEN trim(a.s) <> trim(b.s) THEN '2' END) END AS columns
FROM a LEFT JOIN b ON a.pos = b.pos WHERE b.pos IS NULL OR abs(a.x - b.x) >= 1e-6 OR trim(a.s) <> trim(b.s)""")
def d8_tolerant(spark, sf):
    """Two ordered results by position: noise of 4e-7 and padding are no differences."""
    o, k = Tables(spark, sf).orders, F.col("o_orderkey")
    x = F.col("o_totalprice").cast("double")
    a = o.select(k.alias("pos"), x.alias("x"), F.col("o_orderstatus").alias("s"))
    b = o.where(k % 41 != 0).select(k.alias("pos"), F.when(k % 23 == 0, x + 1e-5).otherwise(x + 4e-7).cast("string").alias("x"),
                                    F.when(k % 31 == 0, F.lower("o_orderstatus")).otherwise(F.concat("o_orderstatus", F.lit(" "))).alias("s"))
    d = compare.tolerant_ordered(a, b, "pos")
    return d.select("pos", "side", F.array_join("columns", ",").alias("columns"))


@plan("d19_agreement_noise", """
SELECT count(*) > 0 AS agree, CAST(0 AS BIGINT) AS only_a, CAST(0 AS BIGINT) AS only_b FROM lineitem""")
def d19_noise(spark, sf):
    """Average line value per part, as an average and as the sum of tenths over a
    count: equal but for float noise in nearly every row, so the answers agree."""
    li = Tables(spark, sf).lineitem
    tenth = F.col("l_extendedprice").cast("double") * 0.1
    a = li.groupBy("l_partkey").agg(F.avg("l_extendedprice").cast("double").alias("mean"))
    b = li.groupBy("l_partkey").agg((F.sum(tenth) / F.count(F.lit(1)) * 10).alias("mean"))
    return q.agreement(a, b)


@plan("d20_text_screen", f"""
SELECT 'secret' AS rule, COUNT(*) FILTER (WHERE regexp_matches(text, '{DOC_RULES[2][1]}')) AS hits FROM documents
UNION ALL SELECT 'card number', COUNT(*) FILTER (WHERE regexp_matches(text, '{DOC_RULES[3][1]}')) FROM documents
UNION ALL SELECT 'email', COUNT(*) FILTER (WHERE regexp_matches(text, '{DOC_RULES[4][1]}')) FROM documents
UNION ALL SELECT 'junk', COUNT(*) FILTER (WHERE regexp_matches(text, '{DOC_RULES[5][1]}')) FROM documents
UNION ALL SELECT 'license', COUNT(*) FILTER (WHERE regexp_matches(text, '{LICENSE_PATTERN}')) FROM documents""")
def d20(spark, sf):
    pats = {name: (p, PREFILTER[name]) if name in PREFILTER else p for name, p in DOC_RULES[2:]}
    pats["license"] = LICENSE_PATTERN
    return q.text_screen(Tables(spark, sf).documents, "text", pats)


STATEMENT_SQL = r"""CASE doc_id % 8
  WHEN 0 THEN 'SELECT ''' || text || ''' AS t FROM d;' WHEN 1 THEN 'SELECT '';'' AS a; ' || chr(10) || ';' WHEN 2 THEN 'SELECT 1; SELECT ' || doc_id
  WHEN 3 THEN '-- note; ' || replace(text, chr(10), ' ') || chr(10) || 'with a AS (SELECT 1) SELECT * FROM a'
  WHEN 4 THEN 'SELECT "a;b" /* ; ' || text || ' */ ;;' WHEN 5 THEN 'DELETE FROM d' WHEN 6 THEN '/* SELECT */ ' || text
  ELSE 'SELECT ''it''''s; drop'', selected FROM d -- ;' END"""
MASK_SQL = r"""regexp_replace(st, '''[^'']*''?|"[^"]*"?|--[^\n]*|/\*(?s:.*?)(?:\*/|\z)', ' ', 'g')"""


@plan("d20_statement_rules", rf"""
WITH s AS (SELECT doc_id, {STATEMENT_SQL} AS st FROM documents), m AS (SELECT doc_id, {MASK_SQL} AS m FROM s),
n AS (SELECT doc_id, m, len(list_filter(string_split(m, ';'), lambda x: regexp_matches(x, '[^\s]'))) AS n FROM m)
SELECT doc_id, CASE WHEN n = 0 THEN 'empty' WHEN n > 1 THEN 'more than one statement'
  WHEN NOT regexp_matches(m, '(?i)^\s*(?:select|with)\b') THEN 'wrong start' WHEN regexp_matches(m, '(?i)\b(?:drop|delete|update)\b') THEN 'banned word' END AS reason
FROM n""")
def d20_statements(spark, sf):
    """Start, single-statement and banned-word rules over statements that hold whole
    documents in quotes, comments or bare: what is quoted does not count."""
    d, k = Tables(spark, sf).documents, F.col("doc_id") % 8
    text, lit = F.col("text"), F.lit
    cases = [F.concat(lit("SELECT '"), text, lit("' AS t FROM d;")), lit("SELECT ';' AS a; \n;"), F.concat(lit("SELECT 1; SELECT "), F.col("doc_id").cast("string")),
             F.concat(lit("-- note; "), F.replace(text, lit("\n"), lit(" ")), lit("\nwith a AS (SELECT 1) SELECT * FROM a")),
             F.concat(lit('SELECT "a;b" /* ; '), text, lit(" */ ;;")), lit("DELETE FROM d"), F.concat(lit("/* SELECT */ "), text)]
    st = lit("SELECT 'it''s; drop', selected FROM d -- ;")
    for n, case in enumerate(cases):
        st = F.when(k == n, case).otherwise(st)
    statements = d.select("doc_id", st.alias("st"))
    return q.first_failure(statements, q.statement_rules("st", banned=["drop", "delete", "update"])).select("doc_id", "reason")


@plan("d21_mentions", """
SELECT doc_id, concat_ws(',', CASE WHEN NOT contains(lower(text), 'the') THEN 'the' END,
                              CASE WHEN NOT contains(lower(text), 'and') THEN 'and' END,
                              CASE WHEN NOT contains(lower(text), 'with') THEN 'with' END) AS missing
FROM documents WHERE (NOT contains(lower(text), 'the') OR NOT contains(lower(text), 'and')
                                      OR NOT contains(lower(text), 'with'))""")
def d21(spark, sf):
    d = Tables(spark, sf).documents
    m = q.mentions(d, "text", ["the", "and", "with"], ["doc_id"])
    return m.select("doc_id", F.array_join("missing", ",").alias("missing"))


@plan("d22_unique_members", """
WITH w AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
SELECT doc_id, CAST(len(lines) AS INTEGER) AS members,
  CAST(len(list_distinct(list_transform(lines, lambda x: lower(x)))) AS INTEGER) AS distinct_members
FROM w WHERE len(lines) <> len(list_distinct(list_transform(lines, lambda x: lower(x))))""")
def d22(spark, sf):
    """Documents that repeat a line, ignoring case: members are all lines of
    the whole text."""
    d = Tables(spark, sf).documents
    return q.unique_members(d, F.split("text", "\n"), ["doc_id"])


@plan("d23_flag_consistency", f"""
SELECT l.doc_id, l.quality = 0 AS flag, regexp_matches(d.text, '{DOC_RULES[5][1]}') AS evidence
FROM labels l JOIN documents d ON d.doc_id = l.doc_id
WHERE (l.quality = 0) IS DISTINCT FROM regexp_matches(d.text, '{DOC_RULES[5][1]}')""")
def d23(spark, sf):
    """Declared low quality (``quality = 0``) against junk markers in the text."""
    t = Tables(spark, sf)
    j = t.labels.join(t.documents.select("doc_id", "text"), "doc_id")
    return q.flag_consistency(j, F.col("quality") == 0, F.col("text").rlike(DOC_RULES[5][1]), ["doc_id"])


@plan("o4_tie_audit_nation_top", """
WITH kth AS (SELECT MIN(c_nationkey) AS v FROM (SELECT c_nationkey FROM customer ORDER BY c_nationkey DESC LIMIT 100))
SELECT CAST(100 AS BIGINT) AS k, (SELECT v FROM kth) AS kth_value,
  COUNT(*) FILTER (WHERE c_nationkey > (SELECT v FROM kth)) AS better,
  COUNT(*) FILTER (WHERE c_nationkey = (SELECT v FROM kth)) AS at_kth,
  (COUNT(*) FILTER (WHERE c_nationkey > (SELECT v FROM kth)) < 100 AND
   COUNT(*) FILTER (WHERE c_nationkey > (SELECT v FROM kth)) + COUNT(*) FILTER (WHERE c_nationkey = (SELECT v FROM kth)) > 100) AS ambiguous
FROM customer""")
def o4_nation(spark, sf):
    """Tie audit where the cut certainly falls inside a tie (25 nation keys)."""
    return rel.tie_audit(Tables(spark, sf).customer, "c_nationkey", 100)
