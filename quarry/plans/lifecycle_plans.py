"""Plans for snapshot and lifecycle operators (inventory M1-M5, M7-M11, S6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import lifecycle as lc
from quarry.operators import quality as q
from quarry.operators import relational as rel
from quarry.operators import snapshots
from quarry.plans.core import ALTERED_PART_SQL, altered_part
from quarry.plans.quality_plans import DOC_RULES_SQL, doc_rules
from quarry.plans.registry import plan
from quarry.sources.tables import Tables


@plan("m1_manifest", "SELECT page_id AS id, sha256(html) AS sha256, url FROM pages")
def m1(spark, sf):
    return lc.manifest(Tables(spark, sf).pages, "page_id", ["html"], ["url"])


@plan("m2_first_seen", """
WITH prev AS (SELECT o_custkey AS id, MIN(CAST(o_orderdate AS DATE)) AS added_at FROM orders
              WHERE o_orderdate <= TIMESTAMP '2000-12-31 00:00:00' GROUP BY o_custkey),
cur AS (SELECT DISTINCT o_custkey AS id FROM orders)
SELECT cur.id, COALESCE(prev.added_at, DATE '2001-08-02') AS added_at FROM cur LEFT JOIN prev ON prev.id = cur.id""")
def m2(spark, sf):
    """Customers seen up to 2000-12-31 keep their first order date; customers
    first seen afterwards get the run date."""
    o = Tables(spark, sf).orders
    prev = o.where(F.col("o_orderdate") <= F.lit("2000-12-31 00:00:00").cast("timestamp_ntz")) \
        .groupBy(F.col("o_custkey").alias("id")).agg(F.min(F.to_date("o_orderdate")).alias("added_at"))
    cur = o.select(F.col("o_custkey").alias("id")).distinct()
    return lc.carry_first_seen(cur, prev, "2001-08-02")


M3_CHANGES_SQL = """
WITH o AS (SELECT p_partkey, p_name, p_size, p_retailprice FROM part),
n AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 97 = 0 THEN p_size + 1 ELSE p_size END AS p_size, p_retailprice FROM part),
r AS (SELECT CASE WHEN o.p_partkey IS NULL THEN 'added' WHEN n.p_partkey IS NULL THEN 'removed'
                  WHEN o.p_name IS DISTINCT FROM n.p_name OR o.p_size IS DISTINCT FROM n.p_size
                    OR o.p_retailprice IS DISTINCT FROM n.p_retailprice THEN 'changed' ELSE 'same' END AS status
      FROM o FULL OUTER JOIN n ON o.p_partkey = n.p_partkey)
SELECT CAST(1 + CASE WHEN COUNT(*) FILTER (WHERE status <> 'same') > 0 THEN 1 ELSE 0 END AS BIGINT) AS version,
  COUNT(*) FILTER (WHERE status <> 'same') > 0 AS changed,
  COUNT(*) FILTER (WHERE status = 'added') AS n_added, COUNT(*) FILTER (WHERE status = 'removed') AS n_removed,
  COUNT(*) FILTER (WHERE status = 'changed') AS n_changed FROM r"""


def _part_manifest(df):
    return lc.manifest(df, "p_partkey", ["p_name", "p_size", "p_retailprice"])


@plan("m3_version_changed", M3_CHANGES_SQL)
def m3_changed(spark, sf):
    """``part`` against ``part`` with size + 1 on key % 97 = 0: version 1 -> 2."""
    p = Tables(spark, sf).part
    bumped = p.withColumn("p_size", F.when(F.col("p_partkey") % 97 == 0, F.col("p_size") + 1)
                          .otherwise(F.col("p_size")))
    return lc.next_version(_part_manifest(p), _part_manifest(bumped), 1)


@plan("m3_version_same", M3_CHANGES_SQL.replace("CASE WHEN p_partkey % 97 = 0 THEN p_size + 1 ELSE p_size END", "p_size"))
def m3_same(spark, sf):
    """``part`` against itself: the version stays 1."""
    p = Tables(spark, sf).part
    return lc.next_version(_part_manifest(p), _part_manifest(p), 1)


@plan("m4_assign_ids", """
SELECT o_orderkey, CAST((SELECT MAX(o_orderkey) FROM orders) + ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT)
  AS new_id
FROM orders""")
def m4(spark, sf):
    """Re-issue every order as a new record, numbered after the current maximum
    key in (date, key) order: a global ordinal over the whole table, run as the
    blocked scan rather than a single-partition ROW_NUMBER."""
    o = Tables(spark, sf).orders
    new = o.select("o_orderkey", "o_orderdate")
    out = lc.assign_ids(new, o.select(F.max("o_orderkey")).scalar(), ["o_orderdate", "o_orderkey"])
    return out.select("o_orderkey", "new_id")


@plan("m5_quota", """
SELECT lang, doc_id, pos FROM (
  SELECT d.lang, d.doc_id, ROW_NUMBER() OVER (PARTITION BY d.lang ORDER BY d.doc_id) AS pos
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.toxic = 0) t WHERE pos <= 50""")
def m5(spark, sf):
    t = Tables(spark, sf)
    cand = t.documents.select("doc_id", "lang").join(t.labels.where(F.col("toxic") == 0).select("doc_id"), "doc_id")
    out = lc.quota(cand, "lang", [F.col("doc_id")], 50)
    return out.select("lang", "doc_id", F.col("pos").cast("bigint").alias("pos"))


@plan("m7_sample", """
SELECT p_partkey, md5('7:' || CAST(p_partkey AS VARCHAR)) AS draw FROM part
WHERE p_type = 'SMALL' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 50)
ORDER BY draw, p_partkey LIMIT 20""")
def m7(spark, sf):
    """20 'SMALL' parts not used before, seed 7. A part counts as used when it
    is on some full-quantity line (``l_quantity >= 50``): the used set comes
    from the data and grows with it; the pool may hold fewer than 20."""
    t = Tables(spark, sf)
    used = t.lineitem.where(F.col("l_quantity") >= 50).select(F.col("l_partkey").alias("p_partkey"))
    s = lc.sample_without_replacement(t.part, "p_partkey", 20, 7, used=used, where=F.col("p_type") == "SMALL")
    return s.select("p_partkey", "draw")


@plan("m8_tag_inventory", """
SELECT tag, COUNT(*) AS n_items FROM (
  SELECT DISTINCT p_partkey, lower(trim(unnest(string_split(p_name, ' ')[1:6]))) AS tag FROM part) t GROUP BY tag""")
def m8(spark, sf):
    p = Tables(spark, sf).part
    return lc.tag_inventory(p, F.split("p_name", " "))


@plan("m9_ledger", f"""
SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS outcome, reason, lang, COUNT(*) AS n
FROM (SELECT lang, {DOC_RULES_SQL} AS reason FROM documents) s GROUP BY 1, 2, 3""")
def m9(spark, sf):
    screened = q.first_failure(Tables(spark, sf).documents, doc_rules())
    return lc.ledger(screened, "reason", ["lang"])


@plan("m10_fill_defaults", """
SELECT d.doc_id, CAST(COALESCE(l.quality, 0) AS INTEGER) AS quality, CAST(COALESCE(l.toxic, 0) AS INTEGER) AS toxic
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def m10(spark, sf):
    t = Tables(spark, sf)
    j = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return rel.fill_defaults(j, {"quality": 0, "toxic": 0}).select("doc_id", "quality", "toxic")


def _gate_sql(variant: str, source: str) -> str:
    """Finding counts of the two publish checks over one staged table."""
    return f"""SELECT '{variant}' AS variant, 'key_audit' AS chk, (SELECT COUNT(*) FROM (SELECT p_partkey FROM ({source}) s
  GROUP BY p_partkey HAVING COUNT(*) > 1 OR p_partkey IS NULL) d) AS findings
UNION ALL SELECT '{variant}', 'required', (SELECT COUNT(*) FROM ({source}) s WHERE p_partkey IS NOT NULL AND
  (p_name IS NULL OR trim(p_name) = '' OR p_brand IS NULL OR trim(p_brand) = ''))"""


@plan("m11_publish", f"""
WITH f AS ({_gate_sql('clean', 'SELECT * FROM part')}
  UNION ALL {_gate_sql('duplicate key', 'SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_partkey % 37 = 0')})
SELECT chk AS "check", CAST(findings AS BIGINT) AS findings,
  SUM(findings) OVER (PARTITION BY variant) = 0 AS promoted, variant FROM f""")
def m11(spark, sf):
    """Stage ``part`` twice, once clean and once with a duplicated key (every
    37th row repeated); only the clean one is promoted. The oracle recomputes
    the finding counts and the gate decision; the promotion itself is a
    folder rename."""
    p = Tables(spark, sf).part
    dup = p.unionByName(p.where(F.col("p_partkey") % 37 == 0))
    checks = {"key_audit": lambda d: q.key_audit(d, "p_partkey"),
              "required": lambda d: q.required(d, "p_partkey", ["p_name", "p_brand"])}
    root = lc.scratch_path(spark, "publish")
    clean = lc.publish_if_clean(p, f"{root}/clean/current", checks).withColumn("variant", F.lit("clean"))
    dirty = lc.publish_if_clean(dup, f"{root}/dirty/current", checks).withColumn("variant", F.lit("duplicate key"))
    return clean.unionByName(dirty)


_SEEN_SQL = "COUNT(*) AS n, CAST(SUM(p_size) AS BIGINT) AS size, COUNT(DISTINCT p_name) AS names"


@plan("m11_snapshots", f"""
SELECT '1 first' AS step, {_SEEN_SQL} FROM part
UNION ALL SELECT '2 second', {_SEEN_SQL} FROM {ALTERED_PART_SQL}
UNION ALL SELECT '3 refused', {_SEEN_SQL} FROM {ALTERED_PART_SQL}
UNION ALL SELECT '4 rolled back', {_SEEN_SQL} FROM part
UNION ALL SELECT '5 third', {_SEEN_SQL} FROM {ALTERED_PART_SQL}""")
def m11_snapshots(spark, sf):
    """``part`` published, published again altered, a dirty version refused, rolled
    back and published once more: what a reader of the pointer finds after each step.
    Added parts get keys above every key there is: a fixed step meets keys of a table
    of a million parts, and the key check would refuse the altered version."""
    t = Tables(spark, sf)
    keys = t.part.agg(F.max("p_partkey") - F.min("p_partkey") + 1).first()[0]
    altered = altered_part(t, max(1_000_000, keys or 0))
    root = lc.scratch_path(spark, "published")
    checks = {"key_audit": lambda d: q.key_audit(d, "p_partkey")}

    def seen(step):
        d = snapshots.read_snapshot(spark, root)
        return d.agg(F.lit(step).alias("step"), F.count(F.lit(1)).alias("n"), F.sum("p_size").cast("bigint").alias("size"),
                     F.count_distinct("p_name").alias("names"))
    snapshots.publish(t.part, root, checks)
    out = seen("1 first")
    snapshots.publish(altered, root, checks)
    out = out.unionByName(seen("2 second"))
    snapshots.publish(t.part.unionByName(t.part), root, checks)
    out = out.unionByName(seen("3 refused"))
    snapshots.roll_back(spark, root)
    out = out.unionByName(seen("4 rolled back"))
    snapshots.publish(altered, root, checks)
    return out.unionByName(seen("5 third"))


def _changes_sql(step: str, old: str, new: str, prev_version: int) -> str:
    """M3 over two versions of ``part`` compared column by column (equal
    content gives an equal digest), as the snapshot sink reports it."""
    return f"""SELECT '{step}' AS step, {prev_version} AS pv,
  COUNT(*) FILTER (WHERE o.p_partkey IS NULL) AS n_added, COUNT(*) FILTER (WHERE n.p_partkey IS NULL) AS n_removed,
  COUNT(*) FILTER (WHERE o.p_partkey IS NOT NULL AND n.p_partkey IS NOT NULL AND (o.p_name IS DISTINCT FROM n.p_name
    OR o.p_size IS DISTINCT FROM n.p_size OR o.p_retailprice IS DISTINCT FROM n.p_retailprice)) AS n_changed
FROM ({old}) o FULL OUTER JOIN ({new}) n ON o.p_partkey = n.p_partkey"""


@plan("s6_conditional_snapshot", f"""
WITH c AS ({_changes_sql('initial', 'SELECT * FROM part WHERE FALSE', 'SELECT * FROM part', 0)}
  UNION ALL {_changes_sql('unchanged', 'SELECT * FROM part', 'SELECT * FROM part', 1)}
  UNION ALL {_changes_sql('altered', 'SELECT * FROM part', 'SELECT * FROM ' + ALTERED_PART_SQL, 1)})
SELECT CAST(pv + CAST(n_added + n_removed + n_changed > 0 AS INTEGER) AS BIGINT) AS version,
  n_added + n_removed + n_changed > 0 AS changed, CAST(n_added AS BIGINT) AS n_added,
  CAST(n_removed AS BIGINT) AS n_removed, CAST(n_changed AS BIGINT) AS n_changed,
  n_added + n_removed + n_changed > 0 AS written, step FROM c""")
def s6(spark, sf):
    """Write the ``part`` manifest as version 1, rebuild it unchanged (no
    write), then with altered parts (version 2 written). The oracle recomputes
    the change counts, versions and write decisions."""
    t = Tables(spark, sf)
    root = lc.scratch_path(spark, "snapshots")
    first = lc.write_if_changed(_part_manifest(t.part), None, root, 0)
    v1 = f"{root}/v=1"
    same = lc.write_if_changed(_part_manifest(t.part), v1, root, 1)
    changed = lc.write_if_changed(_part_manifest(altered_part(t)), v1, root, 1)
    return (first.withColumn("step", F.lit("initial")).unionByName(same.withColumn("step", F.lit("unchanged")))
            .unionByName(changed.withColumn("step", F.lit("altered"))))


@plan("s6_manifest_stream", """
SELECT CAST(1 AS BIGINT) AS version, COUNT(*) AS entries, COUNT(DISTINCT sha256(html)) AS distinct_digests
FROM pages WHERE page_id % 2 = 0
UNION ALL
SELECT CAST(2 AS BIGINT), COUNT(*),
  COUNT(DISTINCT sha256(CASE WHEN page_id % 5 = 0 THEN html || '<!-- v2 -->' ELSE html END)) FROM pages""")
def s6_stream(spark, sf):
    """``pages`` arrive as JSON files in two waves (even ids, then every id
    with the html of ids % 5 = 0 altered); an incremental Structured
    Streaming job digests each wave and writes a new manifest version only on
    change. Returns one row per version: entries and distinct digests."""
    from quarry.streaming.manifest_stream import snapshot_versions, start_manifest_stream

    pg = Tables(spark, sf).pages.select("page_id", "url", "html")
    src, out = lc.scratch_path(spark, "pages-in"), lc.scratch_path(spark, "pages-manifest")
    pg.where(F.col("page_id") % 2 == 0).write.json(f"{src}/wave=1")
    schema = "page_id long, url string, html string"
    start_manifest_stream(spark, f"{src}/wave=1", schema, "page_id", ["html"], out, ["url"],
                          checkpoint_location=f"{out}-ckpt1").awaitTermination()
    changed = pg.withColumn("html", F.when(F.col("page_id") % 5 == 0, F.concat("html", F.lit("<!-- v2 -->")))
                            .otherwise(F.col("html")))
    changed.write.json(f"{src}/wave=2")
    start_manifest_stream(spark, f"{src}/wave=2", schema, "page_id", ["html"], out, ["url"],
                          checkpoint_location=f"{out}-ckpt2").awaitTermination()
    frames = [spark.read.parquet(f"{out}/v={v}").select(F.lit(v).cast("bigint").alias("version"), "id", "sha256")
              for v in snapshot_versions(spark, out)]
    allv = frames[0]
    for f in frames[1:]:
        allv = allv.unionByName(f)
    return allv.groupBy("version").agg(F.count(F.lit(1)).alias("entries"),
                                       F.count_distinct("sha256").alias("distinct_digests"))
