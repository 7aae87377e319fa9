"""Benchmark decontamination by size-partitioned MinHash containment search (operator 10).

An item is the set of its distinct ``shingle_words``-word shingles (words are
maximal runs without white space, ``A``-``Z`` lower-cased; fewer words: the whole
sequence is the one shingle). An item is found in a document when the document
holds at least ``min_percent`` of the item's shingles; a shorter item's sequence
may stand anywhere in the document, which is then shingled by that width as well
(at most ``shingle_words - 1`` more widths, only those that items have).

Items are partitioned by set size into classes (upper bounds are powers of two).
The class fixes the sketch: the ``k`` shingles of smallest hash, ``k`` being the
number that may be missing at the class's upper bound plus ``spare``. A document
that contains the item holds all of the sketch but what may be missing, so the
search for documents with that many sketch shingles overlooks none, and reads each
document once whatever its length. Candidates are then verified: exact shingle
texts of the documents found against all shingles of the item.

Only DataFrame functions are used. The sketches and item shingles are broadcast
when their rows and bytes are proved small, and joined by shuffle otherwise.

Defined cases: null and empty texts have no shingles and are in no result, as item
or as document. Rows with a null id are left out. Rows that share an id are one
document (item). Extra columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.scratch import materialize
from quarry.operators.joins import broadcast_if_bounded

SEPARATORS = r"[\x20\x09-\x0D]+"
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 32 << 20


def word_array(text: str) -> Column:
    """Words of a text column, ``A``-``Z`` lower-cased; null text: none."""
    lowered = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def shingle_rows(df: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``id, w1..wN`` per shingle occurrence; a short text's missing words are null."""
    n = F.size("w") - (width - 1)
    names = [f"w{k + 1}" for k in range(width)]
    whole = F.array(F.struct(*[F.get("w", F.lit(k)).alias(x) for k, x in enumerate(names)]))
    each = F.arrays_zip(*[F.slice("w", F.lit(k + 1), n).alias(x) for k, x in enumerate(names)])
    return (df.select(F.col(id_col).cast("long").alias("id"), word_array(text_col).alias("w"))
            .where(F.col("id").isNotNull() & (F.size("w") > 0))
            .select("id", F.inline(F.when(n > 0, each).otherwise(whole))))


def document_rows(df: DataFrame, id_col: str, text_col: str, width: int, widths: list[int]) -> DataFrame:
    """``id, w1..wN`` per occurrence of a run of as many words as one of ``widths`` (``width`` at most)."""
    words = df.select(F.col(id_col).cast("long").alias("id"), word_array(text_col).alias("w")).where(F.col("id").isNotNull())
    out = None
    for k in widths:
        each = F.arrays_zip(*[F.slice("w", F.lit(i + 1), F.size("w") - (k - 1)).alias(f"w{i + 1}") for i in range(k)])
        runs = words.where(F.size("w") >= k).select("id", F.inline(each))
        runs = runs.select("*", *[F.lit(None).cast("string").alias(f"w{i + 1}") for i in range(k, width)])
        out = runs if out is None else out.unionByName(runs)
    return out


def _hash(width: int) -> Column:
    return F.xxhash64(*[f"w{k + 1}" for k in range(width)])


def _text(width: int) -> Column:
    return F.concat_ws(" ", *[f"w{k + 1}" for k in range(width)])


def sketches(items: DataFrame, min_percent: int, spare: int) -> DataFrame:
    """``item_id, h, least``: the smallest hashes of each item, as many as its size class has, and how many a match holds at least."""
    allowed = 100 - min_percent
    upper = F.pow(F.lit(2), F.ceil(F.log2(F.col("n").cast("double")))).cast("long")
    hashes = F.array_sort(F.collect_set("h"))
    return (items.groupBy("item_id").agg(hashes.alias("hs")).withColumn("n", F.size("hs"))
            .withColumn("k", F.least(F.col("n").cast("long"), F.floor(upper * allowed / 100) + spare))
            .select("item_id", F.explode(F.slice("hs", F.lit(1), F.col("k").cast("int"))).alias("h"),
                    (F.col("k") - F.floor(F.col("n") * allowed / 100)).alias("least")))


def contaminated(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", shingle_words: int = 5,
                 min_percent: int = 80, spare: int = 3) -> DataFrame:
    """``doc_id, item_id, item_shingles, common, containment`` per item found in a document."""
    own_width = sum(F.col(f"w{k + 1}").isNotNull().cast("int") for k in range(shingle_words))
    item_rows = materialize(
        shingle_rows(items, item_id_col, item_text_col, shingle_words)
        .select(F.col("id").alias("item_id"), own_width.alias("width"), _hash(shingle_words).alias("h"), _text(shingle_words).alias("s")).distinct(),
        "items")
    widths = sorted((r.width for r in item_rows.select("width").distinct().collect()), reverse=True) or [shingle_words]
    count, size = item_rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("s"))).first()
    small = count <= MAX_BROADCAST_ROWS and (size or 0) <= MAX_BROADCAST_BYTES
    sketch = sketches(item_rows, min_percent, spare)
    rows = document_rows(docs, id_col, text_col, shingle_words, widths)
    hits = (rows.select(F.col("id").alias("doc_id"), _hash(shingle_words).alias("h")).join(F.broadcast(sketch) if small else sketch, "h")
            .select("doc_id", "item_id", "h", "least").distinct())
    found = materialize(hits.groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("hits"), F.max("least").alias("least"))
                        .where("hits >= least").select("doc_id", "item_id"), "candidates")
    some = docs.join(broadcast_if_bounded(found.select(F.col("doc_id").alias(id_col)).distinct()), id_col, "left_semi")
    shingles = item_rows.select("item_id", "s")
    sizes = item_rows.groupBy("item_id").agg(F.count_distinct("s").alias("item_shingles"))
    common = (document_rows(some, id_col, text_col, shingle_words, widths)
              .select(F.col("id").alias("doc_id"), _text(shingle_words).alias("s")).join(F.broadcast(shingles) if small else shingles, "s")
              .select("doc_id", "item_id", "s").distinct()
              .groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("common"))
              .join(found, ["doc_id", "item_id"], "left_semi"))
    return (common.join(broadcast_if_bounded(sizes), "item_id")
            .where(F.col("common") * 100 >= F.col("item_shingles") * min_percent)
            .select("doc_id", "item_id", "item_shingles", "common",
                    (F.col("common") / F.col("item_shingles")).alias("containment")))
