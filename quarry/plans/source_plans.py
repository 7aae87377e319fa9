"""Plans for sources and sinks (inventory S1-S5, S7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import lifecycle as lc
from quarry.operators import quality as q
from quarry.plans.quality_plans import DOC_RULES_SQL, doc_rules
from quarry.plans.registry import plan
from quarry.sources import documents as docs
from quarry.sources.sinks import write_documents, write_run_report
from quarry.sources.tables import Tables

EVENT_LINE_SQL = """'{"event_id":' || event_id || ',"event_type":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}'"""


@plan("s1_json_collection", f"""
WITH l AS (SELECT event_id, {EVENT_LINE_SQL} AS line FROM events)
SELECT CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_id END AS event_id,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN event_id % 13 = 0 THEN substr(line, 1, length(line) - 1) END AS _corrupt_record
FROM events JOIN l USING (event_id)""")
def s1(spark, sf):
    """Write ``events`` as JSON lines (every 13th line truncated, i.e. broken)
    to a fresh folder, then scan it with an explicit schema in PERMISSIVE
    mode: broken lines come back in ``_corrupt_record`` instead of vanishing."""
    ev = Tables(spark, sf).events
    j = F.to_json(F.struct("event_id", "event_type", F.get_json_object("props", "$.k").try_cast("bigint").alias("k")))
    lines = ev.select("event_id", j.alias("j")).select(
        F.when(F.col("event_id") % 13 == 0, F.expr("substring(j, 1, length(j) - 1)")).otherwise(F.col("j")).alias("value"))
    path = lc.scratch_path(spark, "jsonl")
    lines.write.mode("errorifexists").text(path)
    schema = "event_id long, event_type string, k long, _corrupt_record string"
    back = docs.read_json_collection(spark, path, schema=docs.T.StructType.fromDDL(schema), multiline=False,
                                     glob=None)
    # a quarantined line carries no trusted field, even where parsing got partway
    ok = F.col("_corrupt_record").isNull()
    return back.select(*[F.when(ok, F.col(c)).alias(c) for c in ("event_id", "event_type", "k")], "_corrupt_record")


@plan("s2_invalid_capture", """
WITH p AS (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN substr(props, 2) ELSE props END AS raw FROM events)
SELECT event_id, CASE WHEN json_valid(raw) THEN 'ok' ELSE 'invalid' END AS status,
       CASE WHEN json_valid(raw) THEN CAST(json_extract_string(raw, '$.k') AS BIGINT) END AS k
FROM p""")
def s2(spark, sf):
    """``events.props`` with every 9th value damaged (first character cut):
    the column splits into ``ok`` rows with a typed value and ``invalid`` rows."""
    ev = Tables(spark, sf).events
    raw = ev.select("event_id", F.when(F.col("event_id") % 9 == 0, F.expr("substring(props, 2)"))
                    .otherwise(F.col("props")).alias("raw"))
    parsed = docs.parse_json_column(raw, "raw", "k long")
    return parsed.select("event_id", "status", F.col("parsed.k").alias("k"))


@plan("s3_long_format", """
SELECT event_id, k.key AS key, CAST(json_extract_string(props, '$.' || k.key) AS BIGINT) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events) k""")
def s3(spark, sf):
    """Nested members -> long format -> typed value."""
    lf = docs.json_long_format(Tables(spark, sf).events, "event_id", "props")
    return lf.select("event_id", "key", F.col("value").try_cast("bigint").alias("value"))


@plan("s2_strict_json", r"""
WITH p AS (SELECT event_id, CASE event_id % 10
  WHEN 0 THEN props || ' x' WHEN 1 THEN props || props WHEN 2 THEN props || ',' || props WHEN 3 THEN '1],[2' WHEN 4 THEN ''
  WHEN 5 THEN '"' || event_type || '"' WHEN 6 THEN ' ' || props || chr(10) WHEN 7 THEN replace(props, '"', chr(39)) WHEN 8 THEN '[' || props || ',null,-1.5e3]'
  ELSE props || ']' END AS raw FROM events)
SELECT event_id, json_valid(raw) AS valid FROM p""")
def s2_strict(spark, sf):
    """Whole-text validity: trailing text, two values, lone brackets, an empty text and
    single quotes are invalid; scalars, arrays and surrounding white space are valid."""
    ev = Tables(spark, sf).events
    props, k = F.col("props"), F.col("event_id") % 10
    cases = [F.concat(props, F.lit(" x")), F.concat(props, props), F.concat(props, F.lit(","), props), F.lit("1],[2"), F.lit(""),
             F.concat(F.lit('"'), F.col("event_type"), F.lit('"')), F.concat(F.lit(" "), props, F.lit("\n")),
             F.replace(props, F.lit('"'), F.lit("'")), F.concat(F.lit("["), props, F.lit(",null,-1.5e3]"))]
    raw = F.concat(props, F.lit("]"))
    for n, case in enumerate(cases):
        raw = F.when(k == n, case).otherwise(raw)
    return ev.select("event_id", docs.is_json(raw).alias("valid"))


@plan("s2_quarantine", f"""
WITH l AS (SELECT event_id, {EVENT_LINE_SQL} AS line FROM events)
SELECT event_id % 13 = 0 AS quarantined, COUNT(*) AS n,
  CAST(SUM(CASE WHEN event_id % 13 = 0 THEN length(line) - 1 ELSE event_id END) AS BIGINT) AS total FROM l GROUP BY 1""")
def s2_quarantine(spark, sf):
    """A collection scanned from files and split into valid and quarantined rows."""
    valid, bad = docs.split_valid(s1(spark, sf).select("event_id", "_corrupt_record"))

    def count(df, value, flag):
        return df.agg(F.lit(flag).alias("quarantined"), F.count(F.lit(1)).alias("n"), F.sum(value).cast("bigint").alias("total"))
    return count(valid, F.col("event_id"), False).unionByName(count(bad, F.length("_corrupt_record"), True))


@plan("s3_inline_tables", """
WITH c AS (SELECT conv_id, turn, role, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS row_no,
    CASE WHEN turn % 5 = 3 THEN 'turn ' || turn ELSE CAST(turn AS VARCHAR) END AS a, role AS b,
    CASE WHEN turn % 7 = 2 THEN NULL ELSE CAST(length(text) / 4 AS VARCHAR) END AS s FROM conversations)
SELECT conv_id AS id, 'turns' AS "table", row_no, 0 AS col_no, 'turn' AS "column", 'INTEGER' AS type, a AS text, TRY_CAST(a AS BIGINT) AS as_long,
  CAST(NULL AS DOUBLE) AS as_double, turn % 5 <> 3 AS fits, role <> 'system' AS arity_ok FROM c
UNION ALL SELECT conv_id, 'turns', row_no, 1, 'role', 'TEXT', b, NULL, NULL, true, role <> 'system' FROM c
UNION ALL SELECT conv_id, 'turns', row_no, 2, 'size', 'REAL', s, NULL, CAST(s AS DOUBLE), true, role <> 'system' FROM c WHERE role <> 'system'""")
def s3_inline(spark, sf):
    """Conversations as JSON documents that hold an inline table: declared columns and
    positional rows, some cells of the wrong type, some NULL, rows of system turns a cell
    short. Read back from the text into typed cells with misfits and arity flagged."""
    c = Tables(spark, sf).conversations
    turn = F.when(F.col("turn") % 5 == 3, F.concat(F.lit("turn "), F.col("turn").cast("string"))).otherwise(F.col("turn").cast("string"))
    size = F.when(F.col("turn") % 7 == 2, F.lit(None)).otherwise((F.length("text") / 4).cast("string"))
    row = F.when(F.col("role") == "system", F.array(turn, F.col("role"))).otherwise(F.array(turn, F.col("role"), size))
    rows = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", row.alias("row")))).alias("rows"))
    declared = [("turn", "integer"), ("role", "TEXT"), ("size", "Real")]
    columns = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type")) for n, t in declared])
    table = F.struct(F.lit("turns").alias("name"), columns.alias("columns"), F.transform("rows", lambda r: r["row"]).alias("rows"))
    text = F.to_json(F.struct(F.array(table).alias("tables")), {"ignoreNullFields": "false"})
    return docs.typed_cells(docs.tables_from_json(rows.select("conv_id", text.alias("doc")), "conv_id", "doc"))


@plan("s4_content_digest", "SELECT page_id, CAST(length(html) AS INTEGER) AS n_chars, sha256(html) AS sha256 FROM pages")
def s4(spark, sf):
    """Content digest of every page (the hash a manifest keeps)."""
    pg = Tables(spark, sf).pages
    return pg.select("page_id", F.length("html").alias("n_chars"), F.sha2("html", 256).alias("sha256"))


@plan("s4_file_digests")
def s4_files(spark, sf):
    """Rows-only: whole-file scan of the table files, each read as a stream,
    with a SHA-256 per file."""
    d = docs.binary_digests(spark, sf, glob="*.parquet")
    return d.select(F.element_at(F.split("path", "/"), -1).alias("file"), "length", "sha256")


@plan("s5_document_roundtrip", """
SELECT lang, COUNT(*) AS n, CAST(SUM(n_chars) AS BIGINT) AS n_chars, COUNT(DISTINCT sha256(text)) AS distinct_texts
FROM documents GROUP BY lang""")
def s5(spark, sf):
    """Write ``documents`` as JSON partitioned by language to a fresh folder,
    read it back (partition column recovered from the folder names)."""
    d = Tables(spark, sf).documents
    path = lc.scratch_path(spark, "documents")
    write_documents(d, path, ["lang"])
    back = spark.read.schema("doc_id long, text string, source string, n_chars long, lang string").json(path)
    return back.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").cast("bigint").alias("n_chars"),
                                    F.count_distinct(F.sha2("text", 256)).alias("distinct_texts"))


@plan("s7_run_report", f"""
SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS outcome, reason, lang, COUNT(*) AS n
FROM (SELECT lang, {DOC_RULES_SQL} AS reason FROM documents) s GROUP BY 1, 2, 3""")
def s7(spark, sf):
    """Screen documents, write accepted / rejected / ledger folders, return the
    ledger as read back from storage."""
    screened = q.first_failure(Tables(spark, sf).documents, doc_rules())
    return write_run_report(screened, lc.scratch_path(spark, "report"), "reason", ["lang"])
