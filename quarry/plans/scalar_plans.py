"""Plans for scalar functions (inventory X1-X16) as projections over the
test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import expr as X
from quarry.plans.registry import plan
from quarry.sources.tables import Tables


@plan("x1_string_functions", """
SELECT p_partkey, upper(p_name) AS upper_name, CAST(length(p_name) AS INTEGER) AS name_len,
       substr(p_name, 1, 3) AS head3, substr(p_name, -4, 4) AS tail4 FROM part""")
def x1(spark, sf):
    p = Tables(spark, sf).part
    return p.select("p_partkey", F.upper("p_name").alias("upper_name"), F.length("p_name").alias("name_len"),
                    X.substr_sql("p_name", 1, 3).alias("head3"), X.substr_sql("p_name", -4, 4).alias("tail4"))


@plan("x2_coalesce", """
SELECT l_orderkey, l_linenumber,
  CAST(COALESCE(NULLIF(l_discount, 0), NULLIF(l_tax, 0), 0.0) AS DOUBLE) AS first_rate,
  COALESCE(CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END, l_linestatus) AS flag_or_status
FROM lineitem""")
def x2(spark, sf):
    """COALESCE over several arguments: the first non-NULL wins (NULLs built
    with NULLIF / CASE, the tables have none)."""
    li = Tables(spark, sf).lineitem
    rate = F.coalesce(F.nullif("l_discount", F.lit(0.0)), F.nullif("l_tax", F.lit(0.0)), F.lit(0.0))
    flag = F.coalesce(F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")), F.col("l_linestatus"))
    return li.select("l_orderkey", "l_linenumber", rate.cast("double").alias("first_rate"),
                     flag.alias("flag_or_status"))


@plan("x3_round_half_up", """
SELECT p_partkey, CAST(ROUND(CAST(p_retailprice AS DECIMAL(18,2)) * 0.35, 1) AS DOUBLE) AS rounded FROM part""")
def x3(spark, sf):
    """ROUND on an exact DECIMAL product: halves go away from zero in both
    engines (no binary-half drift)."""
    p = Tables(spark, sf).part
    v = X.money("p_retailprice") * F.lit(0.35).cast("decimal(3,2)")
    return p.select("p_partkey", X.round_half_up(v, 1).alias("rounded"))


@plan("x4_date_functions", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) + 1 AS next_day, CAST(o_orderdate AS DATE) + 30 AS plus30,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS plus_month,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS INTEGER) AS days_to_end,
  CAST(dayofweek(o_orderdate) AS INTEGER) AS weekday, strftime(o_orderdate, '%Y-%m') AS month
FROM orders""")
def x4(spark, sf):
    o = Tables(spark, sf).orders
    d = X.to_day("o_orderdate")
    return o.select("o_orderkey", F.date_add(d, 1).alias("next_day"), F.date_add(d, 30).alias("plus30"),
                    F.add_months(d, 1).alias("plus_month"),
                    F.datediff(F.lit("2001-12-31").cast("date"), d).alias("days_to_end"),
                    X.weekday_sun0("o_orderdate").alias("weekday"), X.month_key("o_orderdate").alias("month"))


@plan("x5_date_format", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day_text, strftime(ts, '%Y-%m-%d %H') AS hour_text,
  strftime(ts, '%Y') AS year_text, CAST(ts AS DATE) AS day,
  CAST(strptime(strftime(ts, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS day_roundtrip,
  CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS day_index
FROM events""")
def x5(spark, sf):
    """strftime / date equivalents: text renderings of a timestamp, the date
    part, text back to a date, and a day index (``datediff``)."""
    ev = Tables(spark, sf).events
    day_text = F.date_format("ts", "yyyy-MM-dd")
    return ev.select("event_id", day_text.alias("day_text"), F.date_format("ts", "yyyy-MM-dd HH").alias("hour_text"),
                     F.date_format("ts", "yyyy").alias("year_text"), X.to_day("ts").alias("day"),
                     F.try_to_date(day_text, "yyyy-MM-dd").alias("day_roundtrip"),
                     F.datediff(X.to_day("ts"), F.lit("2024-01-01").cast("date")).alias("day_index"))


@plan("x6_arithmetic", """
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge,
  l_quantity / 7 AS per_week, CAST(l_quantity AS BIGINT) // 7 AS whole_weeks, l_quantity > 25 AS big
FROM lineitem""")
def x6(spark, sf):
    """Row arithmetic in double (identical IEEE results in both engines);
    integer division is explicit (``div``), ``/`` is true division."""
    li = Tables(spark, sf).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("charge"),
                     (F.col("l_quantity") / 7).alias("per_week"),
                     F.expr("cast(l_quantity as bigint) div 7").alias("whole_weeks"),
                     (F.col("l_quantity") > 25).alias("big"))


@plan("x7_case", """
SELECT o_orderkey,
  CASE WHEN o_totalprice >= 300000 THEN 'high' WHEN o_totalprice >= 100000 THEN 'mid'
       WHEN o_orderpriority = '1-URGENT' THEN 'urgent-low' END AS price_class,
  CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE -1 END AS INTEGER) AS status_code
FROM orders""")
def x7(spark, sf):
    """Searched CASE (first match wins, no ELSE gives NULL) and simple CASE
    on a value."""
    o = Tables(spark, sf).orders
    price = (F.when(F.col("o_totalprice") >= 300000, "high").when(F.col("o_totalprice") >= 100000, "mid")
             .when(F.col("o_orderpriority") == "1-URGENT", "urgent-low"))
    status = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0).otherwise(-1)
    return o.select("o_orderkey", price.alias("price_class"), status.cast("int").alias("status_code"))


@plan("x8_normalize_text", """
SELECT item_id, trim(regexp_replace(lower(text), '[^a-z0-9 ]', '', 'g')) AS norm FROM benchmark""")
def x8(spark, sf):
    b = Tables(spark, sf).benchmark
    return b.select("item_id", X.normalized_text("text").alias("norm"))


@plan("x9_x14_keys_and_contains", """
SELECT doc_id, lower(trim(source)) AS source_key, contains(lower(text), 'the') AS has_the,
       contains(lower(text), lower('LICENSE')) AS has_license FROM documents""")
def x9(spark, sf):
    d = Tables(spark, sf).documents
    return d.select("doc_id", X.ci_key("source").alias("source_key"), X.contains_ci("text", "the").alias("has_the"),
                    X.contains_ci("text", "LICENSE").alias("has_license"))


@plan("x10_padded_id", "SELECT p_partkey, printf('item_%03d', p_partkey) AS qid FROM part")
def x10(spark, sf):
    p = Tables(spark, sf).part
    return p.select("p_partkey", X.padded_id("item_", "p_partkey").alias("qid"))


@plan("x11_array_slice", """
SELECT p_partkey, array_to_string(list_transform(string_split(p_name || ' Extra TAG more words here x', ' ')[1:6],
                                  lambda t: lower(t)), '|') AS tags FROM part""")
def x11(spark, sf):
    p = Tables(spark, sf).part
    arr = F.split(F.concat("p_name", F.lit(" Extra TAG more words here x")), " ")
    return p.select("p_partkey", F.array_join(X.first_lower(arr, 6), "|").alias("tags"))


@plan("x12_sha256", "SELECT item_id, sha256(text) AS sha256 FROM benchmark")
def x12(spark, sf):
    b = Tables(spark, sf).benchmark
    return b.select("item_id", X.sha256_hex("text").alias("sha256"))


@plan("x13_json_from_text", r"""
WITH m AS (SELECT event_id, 'Here you go:' || chr(10) || '```json' || chr(10) || props || chr(10) || '```' AS reply FROM events)
SELECT event_id, regexp_extract(reply, '(?s)\{.*\}', 0) AS span,
       CAST(json_extract_string(regexp_extract(reply, '(?s)\{.*\}', 0), '$.k') AS BIGINT) AS k FROM m""")
def x13(spark, sf):
    """First ``{`` to last ``}`` of a fenced reply, then the JSON member."""
    ev = Tables(spark, sf).events
    reply = F.concat(F.lit("Here you go:\n```json\n"), F.col("props"), F.lit("\n```"))
    span = X.braces_span(reply)
    return ev.select("event_id", span.alias("span"), F.get_json_object(span, "$.k").try_cast("bigint").alias("k"))


@plan("x15_regex_classes", """
SELECT page_id, regexp_matches(url, '^https://') AS secure, regexp_matches(url, '(?i)://m\\.') AS mobile,
       regexp_matches(url, '(?i)[?&]page=[0-9]+') AS paged FROM pages""")
def x15(spark, sf):
    pg = Tables(spark, sf).pages
    return pg.select("page_id", X.matches("url", "^https://", ignore_case=False).alias("secure"),
                     X.matches("url", r"://m\.").alias("mobile"), X.matches("url", r"[?&]page=[0-9]+").alias("paged"))


@plan("x16_numeric_or_text", """
WITH v AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN ' ' || turn || '.50' ELSE ' ' || role || ' ' END AS raw FROM conversations)
SELECT conv_id, turn, CASE WHEN TRY_CAST(raw AS DOUBLE) IS NOT NULL THEN 'n:' || CAST(ROUND(TRY_CAST(raw AS DOUBLE), 6) AS VARCHAR)
                           ELSE 's:' || trim(raw) END AS value FROM v""")
def x16(spark, sf):
    """Numeric coercion of text (padded, with trailing zeros), else trimmed text."""
    c = Tables(spark, sf).conversations
    raw = F.when(F.col("turn") % 2 == 0, F.concat(F.lit(" "), F.col("turn").cast("string"), F.lit(".50"))).otherwise(
        F.concat(F.lit(" "), F.col("role"), F.lit(" ")))
    return c.select("conv_id", "turn", X.numeric_or_text(raw).alias("value"))
