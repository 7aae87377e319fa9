"""Plans for the similarity join, near-duplicate detection and
accept-as-you-go dedupe (inventory D3, J7, M6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import accept
from quarry.operators import similarity as sim
from quarry.plans.registry import plan
from quarry.sources.tables import Tables


def mutated_benchmark(t: Tables) -> DataFrame:
    """Altered copies of ``benchmark.text`` (ids + 1000), by a rule on the id:
    key % 3 = 0 drops every 'a', 1 turns every 'e' into 'x', 2 reorders the
    sentence halves. Both engines derive the same strings."""
    b = t.benchmark
    k, txt = F.col("item_id"), F.col("text")
    half = F.floor(F.length(txt) / 2).cast("int")
    swapped = F.concat(F.substring(txt, half + 1, 1 << 30), F.substring(txt, 1, half))
    return b.select((k + 1000).alias("item_id"),
                    F.when(k % 3 == 0, F.replace(txt, F.lit("a"), F.lit("")))
                    .when(k % 3 == 1, F.replace(txt, F.lit("e"), F.lit("x")))
                    .otherwise(swapped).alias("text"))


MUTATED_SQL = """SELECT item_id + 1000 AS item_id,
  CASE WHEN item_id % 3 = 0 THEN replace(text, 'a', '') WHEN item_id % 3 = 1 THEN replace(text, 'e', 'x')
       ELSE substr(text, CAST(floor(length(text) / 2) AS INTEGER) + 1) || substr(text, 1, CAST(floor(length(text) / 2) AS INTEGER)) END AS text
FROM benchmark"""

NORM_SQL = "trim(regexp_replace(lower(text), '[^a-z0-9 ]', '', 'g'))"


def _reps_sql(name: str, source: str) -> str:
    return f"""{name}_n AS (SELECT item_id AS id, {NORM_SQL} AS norm FROM ({source}) s),
{name} AS (SELECT MIN(id) AS id, norm, length(norm) AS len FROM {name}_n GROUP BY norm),
{name}_g AS (SELECT id, g, COUNT(*) AS k FROM (SELECT id, substr(norm, i, 2) AS g FROM {name},
             LATERAL (SELECT unnest(generate_series(1, len - 1)) AS i) x WHERE len >= 2) y GROUP BY id, g)"""


CANDIDATES_SQL = f"""
WITH {_reps_sql('ra', 'SELECT item_id, text FROM benchmark')},
{_reps_sql('rb', MUTATED_SQL)},
ov AS (SELECT a.id AS id_a, b.id AS id_b, SUM(LEAST(a.k, b.k)) AS shared FROM ra_g a JOIN rb_g b ON a.g = b.g GROUP BY 1, 2),
c AS (SELECT ov.id_a, ov.id_b, ra.len AS len_a, rb.len AS len_b, CAST(ov.shared AS BIGINT) AS shared,
             CAST(ceil((40 * GREATEST(ra.len, rb.len) - 100) / 100) AS INTEGER) AS need
      FROM ov JOIN ra ON ra.id = ov.id_a JOIN rb ON rb.id = ov.id_b
      WHERE ra.norm <> rb.norm AND GREATEST(ra.len, rb.len) >= 3
        AND LEAST(ra.len, rb.len) * 115 >= GREATEST(ra.len, rb.len) * 85)
SELECT id_a, id_b, CAST(len_a AS INTEGER) AS len_a, CAST(len_b AS INTEGER) AS len_b, shared, need
FROM c WHERE shared >= need"""


@plan("d3_blocking_candidates", CANDIDATES_SQL)
def d3_blocking(spark, sf):
    """Stage (i)+(ii) of the similarity join: every pair that can reach ratio
    0.85 (length band and exact shared-bigram bound), found via prefix
    filtering. The oracle computes the same set by brute force."""
    t = Tables(spark, sf)
    ra, rb = sim.distinct_texts_two(t.benchmark, "item_id", "text", mutated_benchmark(t), "item_id", "text")
    return sim.candidate_pairs(ra, rb)


@plan("j7_similarity_join")
def j7(spark, sf):
    """Rows-only: benchmark texts against their altered copies, ratio >= 0.85
    (``difflib`` semantics, verified exactly on the candidates)."""
    t = Tables(spark, sf)
    return sim.near_duplicates(t.benchmark, "item_id", "text", mutated_benchmark(t), "item_id", "text")


@plan("d3_near_duplicates_self")
def d3_self(spark, sf):
    """Rows-only: near duplicates within ``benchmark`` plus its altered copies
    (later id first), whole texts."""
    t = Tables(spark, sf)
    both = t.benchmark.select("item_id", "text").unionByName(mutated_benchmark(t))
    return sim.near_duplicates(both, "item_id", "text")


@plan("m6_dedupe_exact", """
WITH n AS (SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9 ]', '', 'g')) AS norm FROM documents),
f AS (SELECT norm, MIN(doc_id) AS rep FROM n GROUP BY norm)
SELECT n.doc_id, n.doc_id = f.rep AS accepted, CASE WHEN n.doc_id = f.rep THEN NULL ELSE f.rep END AS rejected_by
FROM n JOIN f ON f.norm = n.norm""")
def m6_exact(spark, sf):
    """Exact form of accept-as-you-go on ``documents``: the first holder (by
    id) of each normalised text is accepted, later holders are rejected by it."""
    reps, members = sim.distinct_texts(Tables(spark, sf).documents, "doc_id", "text")
    return members.select(F.col("id").alias("doc_id"), (F.col("id") == F.col("rep")).alias("accepted"),
                          F.when(F.col("id") != F.col("rep"), F.col("rep")).alias("rejected_by"))


@plan("m6_dedupe_similar")
def m6_similar(spark, sf):
    """Rows-only: accept-as-you-go with the 0.85 similarity over ``benchmark``
    and its altered copies, in id order."""
    t = Tables(spark, sf)
    both = t.benchmark.select("item_id", "text").unionByName(mutated_benchmark(t))
    return sim.dedupe_in_order(both, "item_id", "text")


WORDS_SQL = """words AS (SELECT DISTINCT doc_id, unnest(list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda w: length(w) >= 7)) AS w FROM documents),
rare AS (SELECT w FROM words GROUP BY w HAVING count(*) BETWEEN 2 AND 3),
e AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM words a JOIN words b ON a.w = b.w AND a.doc_id <> b.doc_id WHERE a.w IN (SELECT w FROM rare))"""
QUOTAS = {"en": 60, "de": 25, "fr": 40}


@plan("m5_m6_capped_accept", f"""
WITH RECURSIVE {WORDS_SQL},
items AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) AS k,
    CASE lang WHEN 'en' THEN 60 WHEN 'de' THEN 25 WHEN 'fr' THEN 40 ELSE 0 END AS room,
    coalesce((SELECT list(b) FROM e WHERE e.a = d.doc_id), []) AS near FROM documents d),
s(k, acc, counts, doc_id, outcome) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]), {{'en': 0, 'de': 0, 'fr': 0}}, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR)
  UNION ALL
  SELECT i.k, CASE WHEN o.outcome = 'accepted' THEN list_append(s.acc, i.doc_id) ELSE s.acc END,
    {{'en': s.counts.en + CAST(o.outcome = 'accepted' AND i.lang = 'en' AS INTEGER), 'de': s.counts.de + CAST(o.outcome = 'accepted' AND i.lang = 'de' AS INTEGER),
      'fr': s.counts.fr + CAST(o.outcome = 'accepted' AND i.lang = 'fr' AS INTEGER)}}, i.doc_id, o.outcome
  FROM s JOIN items i ON i.k = s.k + 1,
    LATERAL (SELECT CASE WHEN (CASE i.lang WHEN 'en' THEN s.counts.en WHEN 'de' THEN s.counts.de WHEN 'fr' THEN s.counts.fr ELSE 0 END) >= i.room THEN 'full'
                         WHEN list_has_any(s.acc, i.near) THEN 'similar' ELSE 'accepted' END AS outcome) o)
SELECT doc_id, outcome FROM s WHERE doc_id IS NOT NULL""")
def m5_m6_capped(spark, sf):
    """Documents offered in id order under quotas by language; two are similar if they
    share a long word that two or three documents have. The oracle walks the documents
    one by one."""
    d = Tables(spark, sf).documents
    words = d.select("doc_id", F.explode(F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda w: F.length(w) >= 7)).alias("w")).distinct()
    rare = words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("n between 2 and 3").select("w")
    held = words.join(rare, "w")
    edges = held.select("w", F.col("doc_id").alias("a")).join(held.select("w", F.col("doc_id").alias("b")), "w").where("a < b").select("a", "b").distinct()
    out = accept.accept_capped(d.select("doc_id", F.col("doc_id").alias("value"), "lang"), edges, QUOTAS, "doc_id", "value", "lang")
    return out.select("doc_id", "outcome")
