"""Plans for filters, joins, aggregates, sorts and set operations
(inventory F1-F11, J1-J6, A1-A9, O1-O4, U1-U2) over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.expr import band, money
from quarry.operators import joins, recursion, relational as rel
from quarry.operators.scan import ordered_scan
from quarry.plans.registry import plan
from quarry.sources.tables import Tables

# dimension tables have a fixed size by definition (25 nations, 5 regions);
# the broadcast is still guarded by a checked bound
DIM_ROWS = 10_000


def revenue_expr():
    """Exact line revenue: DECIMAL price * (1 - DECIMAL discount)."""
    return money("l_extendedprice") * (1 - money("l_discount"))


REVENUE_SQL = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))"


# ===================================================================== F: filters, subqueries, CTEs

@plan("f1_filter_project", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
WHERE l_returnflag = 'R' AND l_quantity > 45""")
def f1(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    return rel.filter_project(li, (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45),
                              ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"])


@plan("f2_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def f2(spark, sf):
    return rel.distinct_rows(Tables(spark, sf).part, ["p_brand", "p_type"])


@plan("f3_case_band", """
SELECT p_partkey, p_retailprice,
  CASE WHEN p_retailprice >= 980 THEN 'premium' WHEN p_retailprice >= 940 THEN 'standard'
       ELSE 'budget' END AS price_band
FROM part""")
def f3(spark, sf):
    p = Tables(spark, sf).part
    return p.select("p_partkey", "p_retailprice",
                    band("p_retailprice", [(980, "premium"), (940, "standard")], "budget").alias("price_band"))


@plan("f4_coalesce", """
SELECT d.doc_id, CAST(COALESCE(l.quality, -1) AS INTEGER) AS quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def f4(spark, sf):
    t = Tables(spark, sf)
    j = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return rel.fill_defaults(j, {"quality": -1}).select("doc_id", F.col("quality").cast("int").alias("quality"))


@plan("f5_null_tests", """
SELECT d.lang, COUNT(*) FILTER (WHERE l.quality IS NULL) AS unlabelled,
       COUNT(*) FILTER (WHERE l.quality IS NOT NULL) AS labelled
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang""")
def f5(spark, sf):
    t = Tables(spark, sf)
    j = t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return j.groupBy("lang").agg(F.count_if(F.col("quality").isNull()).alias("unlabelled"),
                                 F.count_if(F.col("quality").isNotNull()).alias("labelled"))


@plan("f5_null_rows", """
SELECT d.doc_id, 'unlabelled' AS kind FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL
UNION ALL SELECT d.doc_id, 'labelled' FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL""")
def f5_rows(spark, sf):
    t = Tables(spark, sf)
    j = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    kinds = [rel.null_rows(j, "quality", is_null).select("doc_id", F.lit(kind).alias("kind")) for is_null, kind in ((True, "unlabelled"), (False, "labelled"))]
    return kinds[0].unionByName(kinds[1])


@plan("f6_like_in_between", """
SELECT p_partkey, p_name, p_type, p_size FROM part
WHERE p_name ILIKE '%RING%' AND p_size BETWEEN 10 AND 30 AND p_type IN ('ECONOMY', 'SMALL', 'PROMO')""")
def f6(spark, sf):
    from quarry.functions.expr import between, in_set, like_ci
    p = Tables(spark, sf).part
    return p.where(like_ci("p_name", "%RING%") & between("p_size", 10, 30)
                   & in_set("p_type", ["ECONOMY", "SMALL", "PROMO"])) \
        .select("p_partkey", "p_name", "p_type", "p_size")


@plan("f7_scalar_subquery", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice > (SELECT AVG(o_totalprice) FROM orders)""")
def f7(spark, sf):
    return rel.above_scalar(Tables(spark, sf).orders, "o_totalprice").select("o_orderkey", "o_totalprice")


@plan("f8_exists", """
SELECT c_custkey, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')""")
def f8_exists(spark, sf):
    t = Tables(spark, sf)
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return joins.semi_join(t.customer, urgent, "c_custkey").select("c_custkey", "c_name")


@plan("f8_not_in", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def f8_not_in(spark, sf):
    t = Tables(spark, sf)
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    return joins.not_in(t.customer, "c_custkey", urgent, "o_custkey").select("c_custkey", "c_name")


@plan("f8_not_in_with_null", """
SELECT c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT CASE WHEN o_orderkey % 1000 = 7 THEN NULL ELSE o_custkey END FROM orders
                        WHERE o_orderpriority = '1-URGENT')
UNION ALL SELECT -1 AS c_custkey""")
def f8_not_in_null(spark, sf):
    """NULL in the subquery empties NOT IN; the sentinel row keeps the result
    non-empty so the check cannot pass on two empty sides."""
    t = Tables(spark, sf)
    vals = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.when(F.col("o_orderkey") % 1000 == 7, F.lit(None)).otherwise(F.col("o_custkey")).alias("v"))
    out = joins.not_in(t.customer, "c_custkey", vals, "v").select("c_custkey")
    return out.unionByName(spark.range(1).select(F.lit(-1).cast("bigint").alias("c_custkey")))


@plan("f9_correlated", """
SELECT c_custkey, c_nationkey, c_acctbal FROM customer c
WHERE c_acctbal > (SELECT AVG(c2.c_acctbal) FROM customer c2 WHERE c2.c_nationkey = c.c_nationkey)""")
def f9(spark, sf):
    c = Tables(spark, sf).customer
    return rel.above_group_stat(c, "c_nationkey", "c_acctbal").select("c_custkey", "c_nationkey", "c_acctbal")


F10_SQL = f"""
WITH line_rev AS (SELECT l_orderkey, SUM({REVENUE_SQL}) AS rev FROM lineitem GROUP BY l_orderkey),
order_rev AS (SELECT o.o_custkey, YEAR(o.o_orderdate) AS yr, lr.rev FROM orders o
              JOIN line_rev lr ON lr.l_orderkey = o.o_orderkey),
region_rev AS (SELECT r.r_name, orv.yr, SUM(orv.rev) AS rev FROM order_rev orv
               JOIN customer c ON c.c_custkey = orv.o_custkey
               JOIN nation n ON n.n_nationkey = c.c_nationkey
               JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY r.r_name, orv.yr),
ranked AS (SELECT r_name, yr, rev, DENSE_RANK() OVER (PARTITION BY yr ORDER BY rev DESC) AS rnk FROM region_rev)
SELECT r_name, CAST(yr AS INTEGER) AS order_year, CAST(rev AS DOUBLE) AS revenue, CAST(rnk AS BIGINT) AS region_rank
FROM ranked"""


@plan("f10_cte_pipeline", F10_SQL)
def f10(spark, sf):
    """Four steps: line revenue per order -> order year -> region via the
    dimension chain -> rank regions within each year. The per-order aggregate
    runs before the joins, so the fact-side join input is one row per order."""
    t = Tables(spark, sf)
    line_rev = t.lineitem.groupBy("l_orderkey").agg(F.sum(revenue_expr()).alias("rev"))
    order_rev = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("yr")) \
        .join(line_rev, F.col("o_orderkey") == F.col("l_orderkey"))
    geo = joins.broadcast_if_bounded(
        t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name"),
        DIM_ROWS)
    cust = t.customer.select("c_custkey", "c_nationkey").join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    region_rev = order_rev.join(cust, F.col("o_custkey") == F.col("c_custkey")) \
        .groupBy("r_name", "yr").agg(F.sum("rev").alias("rev"))
    # (region, year) pairs: bounded by 5 regions x years, a small window
    ranked = region_rev.withColumn("rnk", F.dense_rank().over(Window.partitionBy("yr").orderBy(F.col("rev").desc())))
    return ranked.select("r_name", F.col("yr").cast("int").alias("order_year"),
                         F.col("rev").cast("double").alias("revenue"), F.col("rnk").cast("bigint").alias("region_rank"))


@plan("f11_recursive_chain", """
WITH RECURSIVE chain(conv_id, turn, role, depth) AS (
  SELECT conv_id, turn, role, 1 FROM conversations WHERE turn = 0
  UNION ALL
  SELECT c.conv_id, c.turn, c.role, ch.depth + 1 FROM chain ch
  JOIN conversations c ON c.conv_id = ch.conv_id AND c.turn = ch.turn + 1 AND c.role <> ch.role)
SELECT conv_id, CAST(MAX(depth) AS BIGINT) AS depth FROM chain GROUP BY conv_id""")
def f11_chain(spark, sf):
    """Recursive CTE by path doubling: nodes are (conversation, turn, role), an
    edge leads to the next turn of another role."""
    conv = Tables(spark, sf).conversations.select(F.struct("conv_id", "turn", "role").alias("node"))
    n = F.col("node")
    following = conv.select(n.alias("dst"), n["conv_id"].alias("c"), (n["turn"] - 1).alias("t"), n["role"].alias("r"))
    edges = conv.select(n.alias("src"), n["conv_id"].alias("c"), n["turn"].alias("t"), n["role"].alias("r0")).join(
        following, ["c", "t"]).where(F.col("r0") != F.col("r"))
    found = recursion.reachable(conv.where(n["turn"] == 0), edges)
    return found.groupBy(F.col("node.conv_id").alias("conv_id")).agg((F.max("depth") + 1).alias("depth"))


@plan("f11_day_chain", """
WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
i AS (SELECT day, day - CAST(ROW_NUMBER() OVER (ORDER BY day) AS INTEGER) AS g FROM d)
SELECT day, MIN(day) OVER (PARTITION BY g) AS root, CAST(day - MIN(day) OVER (PARTITION BY g) AS BIGINT) AS depth FROM i""")
def f11_days(spark, sf):
    """Parent chain of every active day to the day before it, hundreds of levels
    deep: root and depth by pointer doubling."""
    days = Tables(spark, sf).events.select(F.to_date("ts").alias("day")).distinct()
    return recursion.roots(days.select("day", F.date_sub("day", 1).alias("before")), "day", "before")


@plan("f11_day_spine", """
WITH daily AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1),
spine AS (SELECT CAST(d AS DATE) AS day FROM (SELECT UNNEST(generate_series(MIN(day), MAX(day), INTERVAL 1 DAY)) AS d FROM daily))
SELECT s.day, CAST(COALESCE(d.n, 0) AS BIGINT) AS purchases FROM spine s LEFT JOIN daily d ON d.day = s.day""")
def f11_spine(spark, sf):
    """Gap fill over a day spine: ``sequence(min, max)`` exploded from the one
    row of the min/max aggregate; the spine is bounded by the date range."""
    ev = Tables(spark, sf).events.where(F.col("event_type") == "purchase")
    daily = ev.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    spine = daily.agg(F.explode(F.sequence(F.min("day"), F.max("day"))).alias("day"))
    return spine.join(daily, "day", "left").select("day", F.coalesce("n", F.lit(0)).cast("bigint").alias("purchases"))


# ===================================================================== J: joins

@plan("j1_inner_join", """
SELECT c.c_custkey, c.c_name, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def j1(spark, sf):
    t = Tables(spark, sf)
    return joins.equi_join(t.customer, t.nation, F.col("c_nationkey") == F.col("n_nationkey"),
                           small_right_rows=DIM_ROWS).select("c_custkey", "c_name", "n_name")


@plan("j2_multi_join", f"""
SELECT r.r_name, CAST(SUM({REVENUE_SQL}) AS DOUBLE) AS revenue, COUNT(*) AS lines
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY r.r_name""")
def j2(spark, sf):
    """Revenue and line count per region. Lines are aggregated per order first
    (the partial aggregate collapses an order's lines inside the task that
    read them), so the fact side reaches the joins as one row per order; the
    dimension chain (nation + region, one checked bound) is broadcast."""
    t = Tables(spark, sf)
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.sum(revenue_expr()).alias("rev"),
                                                     F.count(F.lit(1)).alias("n"))
    geo = joins.broadcast_if_bounded(
        t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name"),
        DIM_ROWS)
    cust = t.customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name")
    oc = t.orders.select("o_orderkey", "o_custkey").join(cust, F.col("o_custkey") == F.col("c_custkey"))
    j = per_order.join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy("r_name").agg(F.sum("rev").cast("double").alias("revenue"),
                                   F.sum("n").cast("bigint").alias("lines"))


@plan("j3_anti_join", """
SELECT o.o_orderkey FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE l.l_orderkey IS NULL""")
def j3(spark, sf):
    t = Tables(spark, sf)
    return joins.anti_join(t.orders.select("o_orderkey"), t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")),
                           "o_orderkey")


@plan("j3_docs_without_labels", """
SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.doc_id IS NULL""")
def j3_docs(spark, sf):
    t = Tables(spark, sf)
    return joins.anti_join(t.documents.select("doc_id", "lang"), t.labels.select("doc_id"), "doc_id")


@plan("j4_left_join", """
SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def j4(spark, sf):
    t = Tables(spark, sf)
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").select("doc_id", "quality", "toxic")


@plan("j5_self_join", """
SELECT a.conv_id, a.turn, b.turn AS reply_turn, CAST(LENGTH(a.text) AS INTEGER) AS prompt_chars,
       CAST(LENGTH(b.text) AS INTEGER) AS reply_chars
FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
WHERE a.role = 'user' AND b.role = 'assistant'""")
def j5(spark, sf):
    conv = Tables(spark, sf).conversations
    pairs = joins.next_row_pairs(conv, ["conv_id"], "turn", ["role", "text"], ["role", "text"])
    return pairs.where((F.col("a_role") == "user") & (F.col("b_role") == "assistant")).select(
        "conv_id", F.col("_seq_a").alias("turn"), F.col("_seq_b").alias("reply_turn"),
        F.length("a_text").alias("prompt_chars"), F.length("b_text").alias("reply_chars"))


def altered_part(t: Tables, shift: int = 1_000_000) -> DataFrame:
    """Second snapshot of ``part``: removed where key % 89 = 0, size + 1 where
    key % 97 = 0, renamed where key % 83 = 0, and new keys (key + ``shift``) for
    key % 101 = 0. Modular rules so DuckDB builds the same input."""
    p = t.part
    kept = p.where(F.col("p_partkey") % 89 != 0).select(
        "p_partkey",
        F.when(F.col("p_partkey") % 83 == 0, F.concat("p_name", F.lit(" v2"))).otherwise(F.col("p_name")).alias("p_name"),
        "p_brand", "p_type",
        F.when(F.col("p_partkey") % 97 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")).alias("p_size"),
        "p_retailprice")
    added = p.where(F.col("p_partkey") % 101 == 0).withColumn("p_partkey", F.col("p_partkey") + shift)
    return kept.unionByName(added)


ALTERED_PART_SQL = """(SELECT p_partkey, CASE WHEN p_partkey % 83 = 0 THEN p_name || ' v2' ELSE p_name END AS p_name,
  p_brand, p_type, CASE WHEN p_partkey % 97 = 0 THEN p_size + 1 ELSE p_size END AS p_size, p_retailprice
  FROM part WHERE p_partkey % 89 <> 0
  UNION ALL SELECT p_partkey + 1000000, p_name, p_brand, p_type, p_size, p_retailprice FROM part WHERE p_partkey % 101 = 0)"""


@plan("j6_reconcile", f"""
WITH o AS (SELECT * FROM part), n AS {ALTERED_PART_SQL}
SELECT COALESCE(o.p_partkey, n.p_partkey) AS p_partkey,
  CASE WHEN o.p_partkey IS NULL THEN 'added' WHEN n.p_partkey IS NULL THEN 'removed'
       WHEN o.p_name IS DISTINCT FROM n.p_name OR o.p_size IS DISTINCT FROM n.p_size
         OR o.p_retailprice IS DISTINCT FROM n.p_retailprice THEN 'changed' ELSE 'same' END AS status,
  CASE WHEN o.p_partkey IS NOT NULL AND n.p_partkey IS NOT NULL THEN
    concat_ws(',', CASE WHEN o.p_name IS DISTINCT FROM n.p_name THEN 'p_name' END,
                   CASE WHEN o.p_size IS DISTINCT FROM n.p_size THEN 'p_size' END,
                   CASE WHEN o.p_retailprice IS DISTINCT FROM n.p_retailprice THEN 'p_retailprice' END) END AS changed_cols
FROM o FULL OUTER JOIN n ON o.p_partkey = n.p_partkey""")
def j6(spark, sf):
    t = Tables(spark, sf)
    r = joins.reconcile(t.part, altered_part(t), "p_partkey", ["p_name", "p_size", "p_retailprice"])
    return r.select("p_partkey", "status", F.array_join("changed_cols", ",").alias("changed_cols"))


# ===================================================================== A: aggregates

@plan("a1_count_by", "SELECT o_orderpriority, COUNT(*) AS n_orders FROM orders GROUP BY o_orderpriority")
def a1(spark, sf):
    return rel.count_by(Tables(spark, sf).orders, "o_orderpriority", "n_orders")


@plan("a2_null_aware_totals", """
SELECT COUNT(*) AS n_lines, COUNT(NULLIF(l_discount, 0)) AS n_discounted,
  CAST(ROUND(SUM(COALESCE(CAST(NULLIF(l_discount, 0) AS DECIMAL(18,2)), 0) + COALESCE(CAST(l_tax AS DECIMAL(18,2)), 0)), 2) AS DOUBLE) AS total_rate,
  MAX(NULLIF(l_discount, 0)) AS max_discount, MIN(NULLIF(l_discount, 0)) AS min_discount,
  CAST(ROUND(AVG(CAST(NULLIF(l_discount, 0) AS DECIMAL(18,2))), 6) AS DOUBLE) AS avg_discount
FROM lineitem""")
def a2(spark, sf):
    li = Tables(spark, sf).lineitem
    d = F.nullif(F.col("l_discount"), F.lit(0.0))
    return li.agg(F.count(F.lit(1)).alias("n_lines"), F.count(d).alias("n_discounted"),
                  F.round(F.sum(F.coalesce(money(d), F.lit(0)) + F.coalesce(money("l_tax"), F.lit(0))), 2)
                  .cast("double").alias("total_rate"),
                  F.max(d).alias("max_discount"), F.min(d).alias("min_discount"),
                  F.round(F.avg(money(d)), 6).cast("double").alias("avg_discount"))


@plan("a3_duplicate_names", "SELECT p_name, COUNT(*) AS n FROM part GROUP BY p_name HAVING COUNT(*) > 1")
def a3(spark, sf):
    return rel.duplicate_keys(Tables(spark, sf).part, "p_name")


@plan("a3_duplicate_text", """
SELECT sha256(text) AS digest, COUNT(*) AS n, MIN(doc_id) AS first_doc FROM documents
GROUP BY sha256(text) HAVING COUNT(*) > 1""")
def a3_text(spark, sf):
    """Duplicate documents grouped by a digest: the shuffle carries 64 hex
    characters per row instead of the whole text."""
    d = Tables(spark, sf).documents.select("doc_id", F.sha2("text", 256).alias("digest"))
    return d.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")) \
        .where(F.col("n") > 1)


@plan("a4_having", """
SELECT o_custkey, COUNT(*) AS n_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spent
FROM orders GROUP BY o_custkey
HAVING COUNT(*) >= 12 AND SUM(CAST(o_totalprice AS DECIMAL(18,2))) > 3000000""")
def a4(spark, sf):
    o = Tables(spark, sf).orders
    g = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.sum(money("o_totalprice")).alias("_t"))
    return g.where((F.col("n_orders") >= 12) & (F.col("_t") > 3000000)) \
        .select("o_custkey", "n_orders", F.col("_t").cast("double").alias("total_spent"))


@plan("a5_conditional_agg", """
SELECT c.c_mktsegment,
  CAST(SUM(CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS rev_f,
  CAST(SUM(CASE WHEN o.o_orderstatus = 'O' THEN CAST(o.o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS rev_o,
  CAST(SUM(CASE WHEN o.o_orderstatus = 'P' THEN CAST(o.o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS rev_p
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY c.c_mktsegment""")
def a5(spark, sf):
    t = Tables(spark, sf)
    j = t.orders.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    cases = {f"rev_{s.lower()}": (F.col("o_orderstatus") == s, money("o_totalprice")) for s in ("F", "O", "P")}
    g = rel.conditional_sums(j, "c_mktsegment", cases)
    return g.select("c_mktsegment", *[F.col(c).cast("double").alias(c) for c in cases])


@plan("a6_second_highest", """
SELECT MAX(o_totalprice) AS second_price FROM orders WHERE o_totalprice < (SELECT MAX(o_totalprice) FROM orders)""")
def a6_second(spark, sf):
    o = Tables(spark, sf).orders
    return o.where(F.col("o_totalprice") < o.select(F.max("o_totalprice")).scalar()) \
        .agg(F.max("o_totalprice").alias("second_price"))


@plan("a6_nth_highest", """
SELECT (SELECT MIN(v) FROM (SELECT DISTINCT o_totalprice AS v FROM orders ORDER BY v DESC LIMIT 5) t
        HAVING COUNT(*) = 5) AS fifth_price,
       (SELECT MIN(v) FROM (SELECT DISTINCT c_nationkey AS v FROM customer ORDER BY v DESC LIMIT 40) t
        HAVING COUNT(*) = 40) AS fortieth_nation""")
def a6_nth(spark, sf):
    """Fifth highest price, and the 40th highest of only 25 distinct nation
    keys: NULL, one row."""
    t = Tables(spark, sf)
    a = rel.nth_highest(t.orders, "o_totalprice", 5, "fifth_price")
    b = rel.nth_highest(t.customer, "c_nationkey", 40, "fortieth_nation")
    return a.select(F.col("fifth_price"), b.scalar().alias("fortieth_nation"))


@plan("a7_median_per_brand", """
SELECT p_brand, ROUND(quantile_cont(p_retailprice, 0.5), 6) AS median_price FROM part GROUP BY p_brand""")
def a7(spark, sf):
    out = rel.exact_percentile(Tables(spark, sf).part, "p_brand", "p_retailprice", 0.5, name="median_price")
    return out.select("p_brand", F.round("median_price", 6).alias("median_price"))


@plan("a7_percentiles_global", """
WITH v AS (SELECT o_totalprice AS x, ROW_NUMBER() OVER (ORDER BY o_totalprice) AS rn, COUNT(*) OVER () AS n FROM orders)
SELECT ROUND((SELECT quantile_cont(o_totalprice, 0.9) FROM orders), 6) AS p90_cont,
       (SELECT MIN(x) FROM v WHERE rn >= CEIL(0.9 * n)) AS p90_disc""")
def a7_global(spark, sf):
    o = Tables(spark, sf).orders
    both = rel.exact_percentiles(o, None, "o_totalprice", [(0.9, "cont", "p90_cont"), (0.9, "disc", "p90_disc")])
    return both.select(F.round("p90_cont", 6).alias("p90_cont"), "p90_disc")


@plan("a7_sketch_percentiles", """
SELECT l_returnflag, p, true AS within FROM (SELECT DISTINCT l_returnflag FROM lineitem), (SELECT CAST(unnest([0.1, 0.5, 0.99]) AS DOUBLE) AS p)""")
def a7_sketch(spark, sf):
    """Percentiles of line values per flag from sketches per flag and ship month,
    merged; their ranks are then counted over all lines and must lie within the
    stated error."""
    li = Tables(spark, sf).lineitem.select("l_returnflag", "l_shipdate", F.col("l_extendedprice").cast("double").alias("x"))
    parts = rel.quantile_sketches(li.withColumn("month", F.date_trunc("month", F.col("l_shipdate").cast("timestamp"))), ["l_returnflag", "month"], "x")
    wanted = [0.1, 0.5, 0.99]
    found = rel.sketch_percentiles(rel.merge_sketches(parts, "l_returnflag"), [(p, f"q{k}") for k, p in enumerate(wanted)])
    found = joins.broadcast_if_bounded(found.withColumnRenamed("l_returnflag", "flag"), 1000)
    counted = li.join(found, F.col("l_returnflag").eqNullSafe(F.col("flag"))).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("x") < F.col(f"q{k}")).alias(f"below{k}") for k in range(3)],
        *[F.count_if(F.col("x") <= F.col(f"q{k}")).alias(f"upto{k}") for k in range(3)])
    near = [F.struct(F.lit(p).alias("p"), ((F.col(f"below{k}") <= (p + rel.SKETCH_ERROR) * F.col("n"))
                                                               & (F.col(f"upto{k}") >= (p - rel.SKETCH_ERROR) * F.col("n"))).alias("within"))
            for k, p in enumerate(wanted)]
    return counted.select("l_returnflag", F.inline(F.array(*near)))


@plan("a9_pivot_counts", """
SELECT user_id, COUNT(*) FILTER (WHERE event_type = 'click') AS n_click,
  COUNT(*) FILTER (WHERE event_type = 'view') AS n_view, COUNT(*) FILTER (WHERE event_type = 'purchase') AS n_purchase,
  COUNT(*) FILTER (WHERE event_type = 'signup') AS n_signup, COUNT(*) FILTER (WHERE event_type = 'error') AS n_error
FROM events GROUP BY user_id""")
def a9(spark, sf):
    return rel.pivot_counts(Tables(spark, sf).events, "user_id", "event_type",
                            ["click", "view", "purchase", "signup", "error"])


# ===================================================================== O: sorts and top-k

@plan("o1_sorted_ordinal", """
SELECT c_custkey, c_mktsegment, c_acctbal,
  ROW_NUMBER() OVER (ORDER BY c_mktsegment ASC, c_acctbal DESC, c_custkey ASC) AS pos FROM customer""")
def o1(spark, sf):
    """A full multi-key sort whose order is kept as an ordinal: a blocked
    ordered scan numbers the rows, so no single-partition window is needed.
    (Descending numeric keys are negated for the ascending scan.)"""
    c = Tables(spark, sf).customer.select("c_custkey", "c_mktsegment", "c_acctbal") \
        .withColumn("_neg_bal", -F.col("c_acctbal"))
    out = ordered_scan(c, None, ["c_mktsegment", "_neg_bal", "c_custkey"], row_number="pos")
    return out.select("c_custkey", "c_mktsegment", "c_acctbal", F.col("pos").cast("bigint").alias("pos"))


@plan("o2_top_k", """
SELECT o_orderkey, o_totalprice, ROW_NUMBER() OVER (ORDER BY o_totalprice DESC, o_orderkey ASC) AS pos
FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 10""")
def o2(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    out = rel.top_k(o, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 10)
    return out.withColumn("pos", F.col("pos").cast("bigint"))


@plan("o3_bottom_k", """
SELECT p_partkey, p_retailprice, ROW_NUMBER() OVER (ORDER BY p_retailprice ASC, p_partkey ASC) AS pos
FROM part ORDER BY p_retailprice ASC, p_partkey ASC LIMIT 5""")
def o3(spark, sf):
    p = Tables(spark, sf).part.select("p_partkey", "p_retailprice")
    out = rel.top_k(p, [F.col("p_retailprice").asc(), F.col("p_partkey").asc()], 5)
    return out.withColumn("pos", F.col("pos").cast("bigint"))


@plan("o4_tie_audit", """
WITH kth AS (SELECT MIN(p_retailprice) AS v FROM (SELECT p_retailprice FROM part ORDER BY p_retailprice DESC LIMIT 9))
SELECT CAST(9 AS BIGINT) AS k, (SELECT v FROM kth) AS kth_value,
  COUNT(*) FILTER (WHERE p_retailprice > (SELECT v FROM kth)) AS better,
  COUNT(*) FILTER (WHERE p_retailprice = (SELECT v FROM kth)) AS at_kth,
  (COUNT(*) FILTER (WHERE p_retailprice > (SELECT v FROM kth)) < 9 AND
   COUNT(*) FILTER (WHERE p_retailprice > (SELECT v FROM kth)) + COUNT(*) FILTER (WHERE p_retailprice = (SELECT v FROM kth)) > 9) AS ambiguous
FROM part""")
def o4(spark, sf):
    return rel.tie_audit(Tables(spark, sf).part, "p_retailprice", 9)


# ===================================================================== U: set operations

def _active_customers(t: Tables, year: int) -> DataFrame:
    kind = t.orders.schema["o_orderdate"].dataType  # a half-open range of the column itself reaches the scan
    return t.orders.where((F.col("o_orderdate") >= F.lit(f"{year}-01-01").cast(kind)) & (F.col("o_orderdate") < F.lit(f"{year + 1}-01-01").cast(kind))).select(F.col("o_custkey").alias("c_custkey"))


@plan("u1_union", """
SELECT o_custkey AS c_custkey FROM orders WHERE YEAR(o_orderdate) = 1996
UNION SELECT o_custkey AS c_custkey FROM orders WHERE YEAR(o_orderdate) = 2000""")
def u1(spark, sf):
    t = Tables(spark, sf)
    return rel.union_distinct(_active_customers(t, 1996), _active_customers(t, 2000))


@plan("u2_except", """
SELECT o_custkey AS c_custkey FROM orders WHERE YEAR(o_orderdate) = 1996
EXCEPT SELECT o_custkey AS c_custkey FROM orders WHERE YEAR(o_orderdate) = 2000""")
def u2(spark, sf):
    t = Tables(spark, sf)
    return rel.except_distinct(_active_customers(t, 1996), _active_customers(t, 2000))


@plan("u2_except_all", """
SELECT o_custkey AS c_custkey FROM orders WHERE YEAR(o_orderdate) = 1996
EXCEPT ALL SELECT o_custkey AS c_custkey FROM orders WHERE YEAR(o_orderdate) = 2000""")
def u2_all(spark, sf):
    t = Tables(spark, sf)
    return rel.except_all(_active_customers(t, 1996), _active_customers(t, 2000))


@plan("u3_intersect", """
SELECT o_custkey AS c_custkey FROM orders WHERE YEAR(o_orderdate) = 1996
INTERSECT SELECT o_custkey AS c_custkey FROM orders WHERE YEAR(o_orderdate) = 2000""")
def u3(spark, sf):
    t = Tables(spark, sf)
    return rel.intersect_distinct(_active_customers(t, 1996), _active_customers(t, 2000))
