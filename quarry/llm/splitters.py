"""Sharding by sampled splitters (operator 11). DataFrame functions only.

Records are ordered by ``(digest of the text, id, position in the table)``, cut into
ranges at sampled splitters, and dealt to shards of near equal bytes.

1. *Sample.* A record is drawn with a probability in proportion to its size (certainly, if
   it is larger than a step), ``SAMPLES`` records for each range wanted. A drawn record stands
   for ``max(size, step)`` bytes.
2. *Splitters.* Records of the ordered sample at whose weight a quantile of the total is
   reached. A splitter is the start of its text's group, so that equal texts stay in one
   range, unless the group holds over ``keep_whole`` of a shard: such a hot group is cut at
   records.
3. *Ranges.* Each record finds its range by binary search in the splitters (an array from a
   scalar subquery). A range of more than twice its share, its largest record not counted, is
   overfull: it is sampled again and subdivided, until none is.
4. *Shards.* Exact bytes of the ranges before, and of the records before in the range, give
   each record its place in the total; a group that is not hot goes by its middle, whole, to
   the shard in which that falls, a record of a hot group by its own middle. So a shard's
   bytes differ from the mean by half a record or by ``keep_whole`` of a shard at most.
   Slots count the records of a shard in order, from 0.

No task holds more than a range; only splitters and sums of ranges, whose number is the
rows by ``rows_per_range``, are gathered in one place, 40 sampled rows for each.

Defined cases: null text: size 1 (no bytes plus 1), crc 0, in one group with empty texts.
Null id: before all ids of its group. Repeated rows are records of their own, in the
table's order. A very long text is one record, and its shard is larger by up to half of it. Empty
table: empty result. Extra columns are ignored, or kept whole in ``record``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.scratch import materialize
from quarry.operators.joins import broadcast_if_bounded

SAMPLES = 40             # sampled records for each range wanted
RANGES_PER_SHARD = 32
_POWERS = [1 << k for k in range(24, -1, -1)]


def _at() -> Column:
    """A record's place in the order."""
    return F.struct("key", "doc_id", "row")


def _range_of(at: Column, splitters: Column) -> Column:
    """How many splitters of an ascending array are at or before ``at``."""
    return F.aggregate(F.lit(_POWERS), F.lit(0),
                       lambda n, step: F.when(F.get(splitters, n + step - 1) <= at, n + step).otherwise(n))


def _ranged(rows: DataFrame, splitters: DataFrame) -> DataFrame:
    """``rows`` with their ``range``."""
    ordered = splitters.agg(F.array_sort(F.collect_list("at"))).scalar()
    return (rows.withColumn("_splitters", ordered)
            .withColumn("range", _range_of(_at(), F.col("_splitters"))).drop("_splitters"))


def _cuts(sample: DataFrame, large: DataFrame, step: float) -> DataFrame:
    """Splitters of each range's sample, ``step`` bytes apart."""
    order = Window.partitionBy("range").orderBy("key", "doc_id", "row").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum("weight").over(order)
    at = F.when(F.col("hot"), _at()).otherwise(F.struct("key", F.lit(None).cast("long").alias("doc_id"), F.lit(-1).cast("long").alias("row")))
    return (sample.join(F.broadcast(large.select("key", F.lit(True).alias("_hot"))), "key", "left")
            .withColumn("hot", F.coalesce("_hot", F.lit(False)))
            .withColumn("end", end)
            .where(F.floor(F.col("end") / step) > F.floor((F.col("end") - F.col("weight")) / step))
            .select(at.alias("at")).distinct())


def _sample(rows: DataFrame, step: float, seed: int) -> DataFrame:
    """Records drawn by size, one each ``step`` bytes, with the bytes that each stands for."""
    drawn = rows.where(F.rand(seed) * step < F.col("size"))
    return materialize(drawn.select("range", "key", "doc_id", "row", F.greatest("size", F.lit(step)).cast("double").alias("weight")), "sample")


def _ranges(rows: DataFrame, total: int, wanted: int, hot_bytes: float, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``rows`` with their range; rows, bytes of each range; the keys of hot groups."""
    share = total / wanted
    sample = _sample(rows.withColumn("range", F.lit(0)), share / SAMPLES, seed)
    # a hot group has 25 sampled records or so; sums over all rows decide
    likely = sample.groupBy("key").agg(F.sum("weight").alias("w")).where(F.col("w") >= hot_bytes / 8).select("key")
    large = materialize(rows.join(F.broadcast(likely), "key", "left_semi").groupBy("key").agg(F.sum("size").alias("bytes"))
                        .where(F.col("bytes") > hot_bytes).select("key"), "large")
    splitters = materialize(_cuts(sample, large, share), "splitters")
    while True:
        ranged = _ranged(rows, splitters)
        sizes = materialize(ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"),
                                                        F.max("size").alias("largest")), "ranges")
        overfull = sizes.where(F.col("bytes") - F.col("largest") > 2 * share).select("range")
        if overfull.isEmpty():
            return ranged, sizes, large
        seed += 1
        again = _sample(ranged.join(F.broadcast(overfull), "range", "left_semi"), share / SAMPLES, seed)
        splitters = materialize(splitters.union(_cuts(again, large, share)).distinct(), "splitters")


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shards: int = 8, keep_whole: float = 0.02,
                    rows_per_range: int = 2_000_000, seed: int = 11, with_record: bool = False) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row; with ``with_record`` its columns as ``record``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    record = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record")] if with_record else []
    rows = materialize(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("key"),
        F.monotonically_increasing_id().alias("row"), *record), "records")
    count, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    wanted = max(shards * RANGES_PER_SHARD, math.ceil(count / rows_per_range))
    ranged, sizes, large = _ranges(rows, total or 1, wanted, keep_whole * (total or 1) / shards, seed)

    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = sizes.select("range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
                          F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"))
    order = Window.partitionBy("range").orderBy("key", "doc_id", "row")
    group = Window.partitionBy("range", "key")
    placed = (ranged.join(broadcast_if_bounded(materialize(starts, "starts")), "range")
              .join(F.broadcast(large.select("key", F.lit(True).alias("hot"))), "key", "left")
              .withColumn("end", F.col("bytes_before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("rank", F.col("rows_before") + F.row_number().over(order) - 1)
              .withColumn("begin", F.col("end") - F.col("size"))
              .withColumn("twice_middle", F.when(F.col("hot"), F.col("begin") + F.col("end"))
                          .otherwise(F.min("begin").over(group) + F.max("end").over(group)))
              .withColumn("shard", F.expr(f"twice_middle * {shards} div {2 * (total or 1)}").cast("int")))
    placed = materialize(placed.select("doc_id", "size", "text_crc32", "shard", "rank", *(["record"] if with_record else [])), "placed")
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *(["record"] if with_record else []))


def write_shards(docs: DataFrame, path: str, *, rows_per_file: int = 1_000_000, **options) -> None:
    """Write the records as Parquet below ``path/shard=N``, each shard's in the order of its slots, in files of ``rows_per_file``."""
    dealt = shard_documents(docs, with_record=True, **options)
    part = F.floor(F.col("slot") / rows_per_file)
    parts = max(1, dealt.agg(F.sum(F.when(F.col("slot") % rows_per_file == 0, 1))).first()[0] or 1)
    (dealt.withColumn("_part", part).repartition(parts, "shard", "_part").sortWithinPartitions("shard", "slot")
     .select("record.*", F.col("shard"), F.col("slot")).write.partitionBy("shard").parquet(path))
