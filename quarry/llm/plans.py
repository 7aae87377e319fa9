"""Registered queries of the operators over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.apportion import mix_sources
from quarry.llm.automaton import token_counts
from quarry.llm.chat import digests, format_chats
from quarry.llm.containment import contaminated
from quarry.llm.ftrl import fit as fit_toxicity
from quarry.llm.ftrl import score as score_toxicity
from quarry.llm.katz import score as katz_score
from quarry.llm.language import fit as fit_language
from quarry.llm.language import predict as predict_language
from quarry.llm.repair import damage, repair, repair_report
from quarry.llm.secrets import KINDS
from quarry.llm.secrets import scan as scan_secrets
from quarry.llm.spelling import spelling_variants
from quarry.llm.splitters import shard_documents
from quarry.llm.superminhash import near_duplicates
from quarry.llm.threshold import top_k
from quarry.sources.tables import read_table

PLANS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def plan(fn):
    PLANS[fn.__name__] = fn
    return fn


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """Whether a document is set aside for testing; a null id never is."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == remainder, F.lit(False))


@plan
def op7_superminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of documents by 2-word shingles, Jaccard 0.8. Rows-only here: tested against brute force."""
    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle_words=2, min_percent=80)


@plan
def op2_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Budgeted chat windows of all conversations, read back. Rows-only here: tested against brute force."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(r"\### Assistant: </turn> ok").alias("text"))
    return digests(format_chats(turns.unionByName(extra)))


@plan
def op6_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to a mix of 150% at source weights 3, 1, 2. Rows-only here: tested against brute force."""
    return mix_sources(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "shard")


@plan
def op8_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a model of the rows not held out. Rows-only here: tested by held-out accuracy."""
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = fit_toxicity(docs, labels.where(~held_out("doc_id", 4, 2)))
    return score_toxicity(docs, model).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted")


@plan
def op9_guess_cost_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: fixed patterns and guess costs. Rows-only here: tested against brute force."""
    found = scan_secrets(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select("doc_id", *map(count, KINDS[:3]), F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"), count("guess"))


@plan
def op10_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold at least 80% of, by 5-word shingles."""
    docs, items = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return contaminated(docs, items)


_WORDS = """SELECT {id}, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {table} WHERE {id} IS NOT NULL"""
_RUNS = "unnest(list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(w[i:i + {k} - 1], ' ')))"

ORACLE["op10_benchmark_containment"] = f"""
WITH dw AS ({_WORDS.format(id='doc_id', table='documents')}),
     iw AS ({_WORDS.format(id='item_id', table='benchmark')}),
     k AS (SELECT DISTINCT least(len(w), 5) AS k FROM iw WHERE len(w) > 0),
     d AS (SELECT DISTINCT doc_id, k, {_RUNS.format(k='k')} AS s FROM dw, k WHERE len(w) >= k),
     i AS (SELECT DISTINCT item_id, least(len(w), 5) AS k, {_RUNS.format(k='least(len(w), 5)')} AS s FROM iw WHERE len(w) > 0),
     n AS (SELECT item_id, count(*) AS item_shingles FROM i GROUP BY item_id),
     c AS (SELECT doc_id, item_id, count(*) AS common FROM d JOIN i USING (k, s) GROUP BY ALL)
SELECT doc_id, item_id, item_shingles, common, common / item_shingles AS containment
FROM c JOIN n USING (item_id) WHERE common * 100 >= item_shingles * 80"""

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@plan
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy longest-match token counts of every document. Rows-only here: tested against brute force."""
    return token_counts(read_table(spark, sf_dir, "documents"), VOCABULARY)


@plan
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a string kernel. Rows-only here: tested by held-out accuracy."""
    docs = read_table(spark, sf_dir, "documents")
    model = fit_language(docs, ~held_out("doc_id", 4, 2))
    return predict_language(docs, model).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


@plan
def op4_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best integer inner products of every 100th vector id against all other rows."""
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE["op4_threshold_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e,
             row_number() OVER () AS i
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, q.i, c.vec_id,
             CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda d: q.e[d] * c.e[d])) AS BIGINT) AS score
           FROM v q JOIN v c ON q.i <> c.i AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
     r AS (SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id, i ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10"""


@plan
def op5_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz backoff log probability of every document, all word pairs in the model. Rows-only here: tested against brute force."""
    docs = read_table(spark, sf_dir, "documents")
    return katz_score(docs, ~held_out("doc_id", 5, 1)).withColumn("held_out", held_out("doc_id", 5, 1))


def _crc32(text: str) -> str:
    """DuckDB's words for the unsigned crc32 of a text's UTF-8 bytes: a fold over them with the table of the 256 remainders."""
    table = list(range(256))
    for _ in range(8):
        table = [(c >> 1) ^ 0xEDB88320 if c & 1 else c >> 1 for c in table]
    return f"""xor(coalesce(list_reduce(
        list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT),
        lambda c, b: xor(c >> 8, ({table}::BIGINT[])[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295), 4294967295::BIGINT)"""


@plan
def op11_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of near equal bytes, equal texts together where a shard can hold them."""
    return shard_documents(read_table(spark, sf_dir, "documents"), shards=8)


ORACLE["op11_sampled_splitters"] = f"""
WITH r AS (SELECT doc_id, coalesce(text, '') AS text, octet_length(encode(coalesce(text, ''))) + 1 AS size,
             md5(coalesce(text, '')) AS key FROM documents),
     p AS (SELECT doc_id, text, size, key, sum(size) OVER (ORDER BY key, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS e,
             row_number() OVER (ORDER BY key, doc_id NULLS FIRST) AS n, sum(size) OVER () AS total,
             sum(size) OVER (PARTITION BY key) AS g FROM r),
     m AS (SELECT *, CASE WHEN g > 0.02 * total / 8 THEN 2 * e - size
             ELSE min(e - size) OVER (PARTITION BY key) + max(e) OVER (PARTITION BY key) END AS middle FROM p),
     s AS (SELECT *, CAST(middle * 8 // (2 * total) AS INTEGER) AS shard FROM m)
SELECT doc_id, CAST(size AS BIGINT) AS size, {_crc32('text')} AS text_crc32, 'bytes' AS law, shard,
    CAST(n - min(n) OVER (PARTITION BY shard) AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s"""


@plan
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their commonest near word and their root, one letter dropped from some runs."""
    return spelling_variants(read_table(spark, sf_dir, "documents"), drop_every=199)


ORACLE["op12_spelling_variants"] = f"""
WITH RECURSIVE
r AS (SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
d AS (SELECT doc_id, run, count(*) AS c FROM r GROUP BY ALL),
h AS (SELECT run, c, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM d),
t AS (SELECT CASE WHEN h % 199 = 0 THEN run[1:CAST(h % length(run) AS BIGINT)] || run[CAST(h % length(run) AS BIGINT) + 2:]
        ELSE run END AS word, c FROM h),
w AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM t WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
x AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
e AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM x),
p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM e a JOIN e b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
      UNION SELECT w.word, e.word, e.n FROM w JOIN e ON e.rest = w.word
      UNION SELECT e.word, w.word, w.n FROM w JOIN e ON e.rest = w.word),
b AS (SELECT word, count(*) AS n_near, max(near_n) AS most FROM p GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * w.n THEN most END AS form_n,
        CASE WHEN most >= 5 * w.n THEN (SELECT min(near) FROM p WHERE p.word = w.word AND p.near_n = b.most) END AS form
      FROM w LEFT JOIN b ON b.word = w.word),
g AS (SELECT word, word AS root, form AS next FROM f
      UNION ALL SELECT g.word, f.word, f.form FROM g JOIN f ON f.word = g.next)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, g.root FROM f JOIN g ON g.word = f.word WHERE g.next IS NULL"""


@plan
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of all conversations after damage. Rows-only here: tested against brute force."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair_report(turns, repair(damage(turns)))
