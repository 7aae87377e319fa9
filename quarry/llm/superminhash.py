"""MinHash near-duplicates with SuperMinHash signatures (operator 7).

Each text is the set of its distinct ``shingle_words``-word shingles (words as in
``tokens``, ``A``-``Z`` lower-cased; fewer words: the whole sequence is the one
shingle; no words: empty set). Two texts are linked when
``100 * |intersection| >= min_percent * |union|``.

1. *Signatures.* Every shingle draws its own random permutation of the signature's
   positions, one swap per level, and offers ``level + r`` at the position drawn;
   a position keeps its smallest offer. A text stops after the first level that
   cannot lower any position: most texts after one or two (early stopping), short
   texts after all. A chunk of texts goes through the levels together in numpy.
2. *Exact copies.* Texts with equal sets (128-bit set digest) collapse to their
   smallest id before any pairing, so a group of copies costs one row a copy.
3. *Banding.* ``bands`` groups of ``rows_per_band`` positions; a bucket is a band's
   value. At similarity 0.8 and 25 bands of 4 rows, two texts share no bucket with
   probability 2e-6.
4. *Verification.* Inside a bucket all texts are compared with one centre, the text whose
   buckets hold most texts (in a group of near copies, the one with the fewest edits);
   links are verified on full sets. Then a text of the largest other component of the
   bucket is the centre, and so on, while a round still joins a fiftieth of the texts that
   are left. The pairs of texts from different components that remain are found exactly:

   * in a bucket of up to ``SMALL`` texts, all pairs, but for those that shingles found in one
     text alone rule out;
   * in a larger one by differences from a centre. Two sets are similar enough if
     their symmetric difference is at most ``r`` times the sum of their sizes. As that of the
     two differences is the same, and neither text that is not linked with the centre differs
     little from it, both must share a known number of differing shingles: a prefix join,
     rarest shingles first, on those finds all such pairs. Near copies that have drifted
     apart share the common text but few edits, so few pairs meet.
5. *Union-find* over the links (``components``).

Defined cases: null or empty text: empty set, linked with nothing, its own
component. Null id: takes no part in links, ``component_id`` null, ``kept`` true.
Rows that share an id are one node, whose texts all link (with ``by_id``; without, only equal
and similar sets link). Extra columns are ignored; the result has only the columns named
below. Very long texts are hashed in pieces and their sets are whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.components import connected_components
from quarry.llm.scratch import materialize, remove
from quarry.llm.tokens import list_array, mix, shingles, words
from quarry.operators.joins import broadcast_if_bounded

_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64((1 << 48) - 1)
PIECE = 1 << 19            # bytes of texts whose signatures are made together
SMALL = 32                 # texts of a bucket that may meet in all pairs
SETTLED = 50               # a round of centres goes on if it links one in so many open texts
BROADCAST_IDS = 1_000_000
_SLACK = 1e-6              # bounds are compared in floating point: err to more candidates


def _draw(elements: np.ndarray, level: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Swap partner and offer of each element at a level."""
    x = mix(elements + np.uint64(int(_STEP) * (level + 1) & 0xFFFFFFFFFFFFFFFF))
    partner = level + (((x >> np.uint64(48)) * np.uint64(size - level)) >> np.uint64(16)).astype(np.int64)
    return partner, (np.uint64(level) << np.uint64(48)) | (x & _LOW)


def signatures(elements: np.ndarray, ptr: np.ndarray, size: int) -> np.ndarray:
    """SuperMinHash signatures, one row a set; an empty set's row is all ones."""
    n = len(ptr) - 1
    best = np.full((n, size), np.iinfo(np.uint64).max, np.uint64)
    flat = best.reshape(-1)
    owner = np.repeat(np.arange(n), np.diff(ptr))
    partner, offer = _draw(elements, 0, size)
    np.minimum.at(flat, owner * size + partner, offer)
    alive, order = elements, None
    for level in range(1, size):
        open_sets = best.max(axis=1) >= np.uint64(level) << np.uint64(48)
        keep = open_sets[owner]
        if not keep.any():
            break
        if order is None:  # permutations are kept for the sets that need a second level
            alive, owner, first = alive[keep], owner[keep], partner[keep]
            order = np.tile(np.arange(size, dtype=np.int16), (len(alive), 1))
            order[np.arange(len(alive)), first] = 0
            order[:, 0] = first
        elif keep.mean() < 0.7:
            alive, owner, order = alive[keep], owner[keep], order[keep]
        partner, offer = _draw(alive, level, size)
        row = np.arange(len(alive))
        at = order[row, partner]
        order[row, partner] = order[:, level]
        order[:, level] = at
        np.minimum.at(flat, owner * size + at, offer)
    return best


def _sets(batches: Iterator[pa.RecordBatch], width: int):
    for batch in batches:
        for part in words(batch.column("text"), PIECE):
            elements, ptr = shingles(part.hashes(), part.ptr, width)
            yield {c: batch.column(c).slice(part.first, part.count) for c in batch.schema.names if c != "text"}, elements, ptr


def _sum_by_set(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    total = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    return (total[ptr[1:]] - total[ptr[:-1]]).view(np.int64)


def _digests(elements: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _sum_by_set(mix(elements ^ _STEP), ptr), _sum_by_set(mix(elements + _STEP), ptr)


def signature_table(docs: DataFrame, shingle_words: int, bands: int, rows_per_band: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, set_a, set_b, bands`` per text."""
    def run(batches):
        for batch in batches:
            for ids, elements, ptr in _sets([batch], shingle_words):
                sig = signatures(elements, ptr, bands * rows_per_band)
                key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(sig), bands)).copy()
                for k in range(rows_per_band):
                    key = mix(key * _STEP + sig[:, k::rows_per_band])
                a, b = _digests(elements, ptr)
                yield pa.RecordBatch.from_arrays(
                    [ids["doc_id"], ids["text_key"], pa.array(np.diff(ptr)), pa.array(a), pa.array(b),
                     list_array(key.reshape(-1).view(np.int64), np.arange(len(sig) + 1) * bands)],
                    ["doc_id", "text_key", "n_shingles", "set_a", "set_b", "bands"])
    return docs.mapInArrow(run, "doc_id long, text_key long, n_shingles long, set_a long, set_b long, bands array<long>")


def set_table(docs: DataFrame, shingle_words: int) -> DataFrame:
    """``doc_id, set_a, set_b, shingles`` per text."""
    def run(batches):
        for ids, elements, ptr in _sets(batches, shingle_words):
            a, b = _digests(elements, ptr)
            yield pa.RecordBatch.from_arrays(
                [ids["doc_id"], pa.array(a), pa.array(b), list_array(elements.view(np.int64), ptr)],
                ["doc_id", "set_a", "set_b", "shingles"])
    return docs.mapInArrow(run, "doc_id long, set_a long, set_b long, shingles array<long>")


def known(table: DataFrame) -> DataFrame:
    """A written table of ids, to be broadcast while it has at most ``BROADCAST_IDS`` rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_IDS else table


def _verified(pairs: DataFrame, sets: DataFrame, min_percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough, as a written table."""
    def side(name: str) -> DataFrame:
        ids = known(materialize(pairs.select(F.col(name).alias("node")).distinct(), "wanted"))
        return sets.join(ids, "node", "left_semi").select(F.col("node").alias(name), F.col("shingles").alias(f"s_{name}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    union = F.size("s_a") + F.size("s_b") - common
    return materialize(both.where(100 * common >= min_percent * union).select("a", "b"), "links")


def _fits(min_percent: int, one: str = "n_a", two: str = "n_b") -> Column:
    """Sizes that leave the similarity possible."""
    return 100 * F.least(one, two) >= min_percent * F.greatest(one, two)


def _centres(now: DataFrame, first: DataFrame | None) -> DataFrame:
    """``bucket, top, b, n_b``: in each bucket of several components the foremost text of the largest one, or, after the
    ``first`` centres, of the largest that does not hold the first centre."""
    if first is not None:
        held = now.join(first.select("bucket", F.col("b").alias("node")), ["bucket", "node"]).select("bucket", F.col("component").alias("main"))
        now = now.join(held, "bucket", "left").where("main is null or component <> main")
    best = now.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("c"), F.max(F.struct("score", (-F.col("node")).alias("less"), "n")).alias("best"))
    found = best.groupBy("bucket").agg(F.max(F.struct("c", "best", "component")).alias("x"), F.min("component").alias("low"), F.max("component").alias("high"))
    if first is None:
        found = found.where("low <> high")
    return materialize(found.select("bucket", F.col("x.component").alias("top"), (-F.col("x.best.less")).alias("b"), F.col("x.best.n").alias("n_b")), "centres")


def _same_id(table: DataFrame, reps: DataFrame) -> DataFrame:
    """Links between the sets that one id has; empty where ids are unique."""
    own = table.where("n_shingles > 0 and doc_id is not null")
    several = materialize(own.groupBy("doc_id").agg(F.min(F.struct("set_a", "set_b")).alias("low"), F.max(F.struct("set_a", "set_b")).alias("high"))
                          .where("low <> high").select("doc_id"), "several")
    nodes = (own.join(known(several), "doc_id", "left_semi").select("doc_id", "set_a", "set_b").distinct()
             .join(reps.select("set_a", "set_b", "node"), ["set_a", "set_b"]))
    low = nodes.groupBy(F.col("doc_id").alias("id")).agg(F.min("node").alias("a"))
    return materialize(nodes.join(low, F.col("doc_id").eqNullSafe(F.col("id"))).where("a <> node").select("a", F.col("node").alias("b")), "same_id")


def representatives(table: DataFrame) -> DataFrame:
    """``node, doc_id, set_a, set_b, n, bands, repeated`` of each distinct set; ``doc_id`` is its smallest id, ``repeated``
    whether that has the set more than once."""
    own = table.where("n_shingles > 0 and doc_id is not null")
    ids = (own.groupBy("set_a", "set_b", "doc_id").agg(F.count(F.lit(1)).alias("c"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
           .groupBy("set_a", "set_b").agg(F.min(F.struct("doc_id", "c")).alias("low"), F.first("n").alias("n"), F.first("bands").alias("bands")))
    return materialize(ids.select(F.monotonically_increasing_id().alias("node"), "low.doc_id", "set_a", "set_b", "n", "bands",
                                  (F.col("low.c") > 1).alias("repeated")), "representatives")


def _members(reps: DataFrame) -> DataFrame:
    """``node, n, bucket, members, score`` of the texts in buckets of two or more; ``score`` sums the sizes of a text's buckets."""
    rows = reps.select("node", "n", F.explode("bands").alias("bucket"))
    open_ = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    held = materialize(rows.join(open_, "bucket"), "held")
    score = held.groupBy("node").agg(F.sum("members").alias("score"))
    now = materialize(held.join(score, "node"), "members")
    remove(held)
    return now


def _sets_of(now: DataFrame, reps: DataFrame, docs: DataFrame, shingle_words: int) -> DataFrame:
    """``node, shingles`` of the nodes in ``now``, read from the texts."""
    wanted = materialize(now.select("node").distinct().join(reps.select("node", "doc_id", "set_a", "set_b", "repeated"), "node"), "wanted")
    texts = docs.join(known(wanted.select("doc_id").distinct()), "doc_id", "left_semi")
    found = set_table(texts, shingle_words).join(known(wanted), ["doc_id", "set_a", "set_b"])
    once = found.where("not repeated").select("node", "shingles")
    again = found.where("repeated").select("node", "shingles").dropDuplicates(["node"])
    if wanted.where("repeated").isEmpty():
        return materialize(once, "sets")
    return materialize(once.union(again), "sets")


def similar_components(table: DataFrame, docs: DataFrame, reps: DataFrame, shingle_words: int, min_percent: int, by_id: bool) -> DataFrame:
    """``(node, component)`` of the linked representatives of a signature table."""
    now = _members(reps)
    sets = _sets_of(now, reps, docs, shingle_words)
    state = _State(sets, min_percent)
    if by_id:
        links = _same_id(table, reps)
        if not links.isEmpty():
            state.component = _merged(None, links)
    now = state.labelled(now)
    first = centre = _centres(now, None)
    now = state.settle(now, centre, first)
    if now is not None:
        state.link(_remaining_small(now, sets, min_percent).union(_remaining_large(now, first, sets, min_percent)))
    none = reps.select(F.col("node").alias("a"), F.col("node").alias("b")).where("false")
    return state.component if state.component is not None else _merged(None, none)


class _State:
    """Components so far and the pairs already compared."""

    def __init__(self, sets: DataFrame, min_percent: int):
        self.sets, self.min_percent = sets, min_percent
        self.component: DataFrame | None = None
        self.tried: DataFrame | None = None

    def labelled(self, members: DataFrame) -> DataFrame:
        """``members`` with each text's present component, as a written table."""
        if self.component is None:
            return materialize(members.withColumn("component", F.col("node")), "now")
        label = self.component.select(F.col("node").alias("x"), "component")
        return materialize(members.join(label, F.col("node") == F.col("x"), "left")
                           .select(*members.columns, F.coalesce("component", "node").alias("component")), "now")

    def link(self, pairs: DataFrame) -> int:
        """Compare pairs ``(a, b)`` that were not compared before; how many were linked."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = materialize(pairs if self.tried is None else pairs.join(self.tried, ["a", "b"], "left_anti"), "pairs")
        links = _verified(pairs, self.sets, self.min_percent)
        self.tried = pairs if self.tried is None else self.tried.union(pairs)
        found = links.count()
        if found:
            self.component = _merged(self.component, links)
        return found

    def settle(self, now: DataFrame, centre: DataFrame, first: DataFrame) -> DataFrame | None:
        """Rounds of one centre a bucket while they join many texts; what is in open buckets then (None: nothing)."""
        while not centre.isEmpty():
            pairs = (now.join(centre, "bucket").where("component <> top")
                     .select(F.col("node").alias("a"), "b", F.col("n").alias("n_a"), "n_b").where(_fits(self.min_percent)))
            found = self.link(pairs)
            last, now = now, self.labelled(now.drop("component"))
            remove(last)
            several = now.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
            last, now = now, materialize(now.join(several.select("bucket"), "bucket"), "open")
            remove(last)
            if now.isEmpty():
                return None
            if SETTLED * found < now.select("node").distinct().count():
                return now
            centre = _centres(now, first)
        return now


def _remaining_small(now: DataFrame, sets: DataFrame, min_percent: int) -> DataFrame:
    """Pairs ``a, b`` of texts from different components that share a bucket of ``SMALL`` texts or fewer and can be similar enough.

    Shingles that no other such text has bound a pair's intersection.
    """
    now = now.where(F.col("members") <= SMALL)
    own = sets.join(known(materialize(now.select("node").distinct(), "small")), "node", "left_semi")
    alone = (own.select("node", F.explode("shingles").alias("s")).groupBy("s")
             .agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node")).where("c = 1")
             .groupBy("node").agg(F.count(F.lit(1)).alias("alone")))
    now = materialize(now.join(alone, "node", "left").withColumn("v", F.col("n") - F.coalesce("alone", F.lit(0)))
                      .where(F.col("v") * 100 >= min_percent * F.col("n"))
                      .select("bucket", "node", "n", "v", "component"), "bounded")
    one, two = (now.select("bucket", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "v", "component")]) for side in "ab")
    common = F.least("v_a", "v_b")
    return (one.join(two, "bucket").where("component_a <> component_b and node_a < node_b")
            .where(100 * common >= min_percent * (F.col("n_a") + F.col("n_b") - common))
            .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct())


def _remaining_large(now: DataFrame, first: DataFrame, sets: DataFrame, min_percent: int) -> DataFrame:
    """The same for larger buckets, by a prefix join on differences from a centre.

    The buckets whose first centres lie in one component are one group, and the foremost of these centres is its centre.
    ``d`` is the size of a text's difference from the centre, ``r = (100 - p) / (100 + p)``. A pair is similar if
    its differences share ``(d_a + d_b - r * (n_a + n_b)) / 2`` shingles. One of the two at least (``a``) is outside the centre's
    component, so ``d_a > r * (n_a + n_c)`` (otherwise it is linked with the centre, and counts as inside) and that number is over
    ``(d_b + r * (n_c - n_b)) / 2``; it is ``d_a - r * (n_a + n_b)`` at least, as ``b`` must have so many. With rarest shingles first,
    the first one shared stands where so many can follow.
    """
    r = (100 - min_percent) / (100 + min_percent)
    now = now.where(F.col("members") > SMALL)
    held = now.join(first.select("bucket", F.col("b").alias("node")), ["bucket", "node"]).select("bucket", "node", "n", "score", F.col("component").alias("main"))
    centre = held.groupBy("main").agg(F.max(F.struct("score", (-F.col("node")).alias("less"), "n")).alias("x")).select(
        "main", (-F.col("x.less")).alias("centre"), F.col("x.n").alias("n_c"))
    group = materialize(now.join(held.select("bucket", "main"), "bucket").select("main", "node", "n", "component").distinct()
                        .join(centre, "main").where("node <> centre"), "group")
    wanted = known(materialize(centre.select(F.col("centre").alias("node")), "centre"))
    base = sets.join(wanted, "node", "left_semi").select(F.col("node").alias("centre"), F.col("shingles").alias("base"))
    full = group.join(sets, "node").join(base, "centre")
    differing = F.concat(F.array_except("shingles", "base"), F.array_except("base", "shingles"))
    full = full.withColumn("t", differing).withColumn("d", F.size("t")).withColumn(
        "inside", (F.col("component") == F.col("main")) | (F.col("d") <= r * (F.col("n") + F.col("n_c")) + _SLACK))
    full = materialize(full.select("main", "centre", "n_c", "node", "n", "component", "inside", "d", "t"), "differences")
    tokens = full.select("main", "node", F.explode("t").alias("s"))
    common = materialize(tokens.groupBy("main", "s").agg(F.count(F.lit(1)).alias("f")).where("f > 1"), "common")
    # a shingle that one text has alone comes first and meets nothing: only its place counts
    shared = tokens.join(common, ["main", "s"]).groupBy("main", "node").agg(F.array_sort(F.collect_list(F.struct("f", "s"))).alias("t"))
    placed = full.drop("t").join(shared, ["main", "node"]).select("*", F.posexplode("t").alias("k", "x")).withColumn(
        "at", F.col("d") - F.size("t") + F.col("k")).withColumn("s", F.col("x.s"))
    half = (F.col("d") + r * (F.col("n_c") - F.col("n"))) / 2
    as_a = F.col("d") - F.col("at") >= F.col("d") - r * F.col("n") * (1 + 100 / min_percent) - _SLACK
    as_b = F.col("d") - F.col("at") >= half - _SLACK
    placed = materialize(placed.select("main", "s", "node", "n", "component", "d", "at", "inside", (~F.col("inside") & as_a).alias("as_a"), as_b.alias("as_b"))
                         .where("as_a or as_b"), "placed")
    one, two = (placed.where(use).select("main", "s", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "component", "d", "at", "inside")])
                for side, use in (("a", "as_a"), ("b", "as_b")))
    follow = F.least(F.col("d_a") - F.col("at_a"), F.col("d_b") - F.col("at_b"))
    pairs = one.join(two, ["main", "s"]).where(
        (F.col("component_a") != F.col("component_b")) & (F.col("inside_b") | (F.col("node_a") < F.col("node_b")))
        & (2 * follow >= F.col("d_a") + F.col("d_b") - r * (F.col("n_a") + F.col("n_b")) - _SLACK) & _fits(min_percent))
    centres = full.where((F.col("component") != F.col("main")) & F.col("inside")).select(F.col("node").alias("a"), F.col("centre").alias("b"))
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).union(centres).distinct()


def _merged(component: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after adding links between nodes of earlier components."""
    if component is None:
        return materialize(connected_components(links), "components")
    label = component.select(F.col("node").alias("x"), F.col("component").alias("label"))
    for side in ("a", "b"):
        links = (links.join(label, F.col(side) == F.col("x"), "left")
                 .withColumn(side, F.coalesce("label", side)).select("a", "b"))
    over = materialize(connected_components(links), "merged")
    moved = component.join(over.withColumnRenamed("node", "n").withColumnRenamed("component", "to"),
                           F.col("component") == F.col("n"), "left").select("node", F.coalesce("to", "component").alias("component"))
    fresh = over.join(component.select("node"), "node", "left_anti")
    return materialize(moved.union(fresh), "components")


def text_key(text: Column) -> Column:
    """64-bit hash that tells the texts of one id apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle_words: int = 5,
            min_percent: int = 80, bands: int = 25, rows_per_band: int = 4, by_id: bool = True) -> DataFrame:
    """``doc_id, text_key, n_shingles, group, component_id`` per row of ``docs``.

    ``group`` is the same for texts that reach each other over links (null without words or id), ``component_id`` the
    smallest id of the group.
    """
    text = F.col(text_col).cast("string")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), text_key(text).alias("text_key"))
    table = materialize(signature_table(slim, shingle_words, bands, rows_per_band), "signatures")
    reps = representatives(table)
    component = similar_components(table, slim.drop("text_key"), reps, shingle_words, min_percent, by_id)
    # exact copies hang on their representative, near copies on the smallest id of their component
    nodes = reps.select("node", "doc_id", "set_a", "set_b").join(component.select(F.col("node").alias("x"), "component"),
                                                                 F.col("node") == F.col("x"), "left")
    low = nodes.where("component is not null").groupBy(F.col("component").alias("c")).agg(F.min("doc_id").alias("low"))
    label = materialize(nodes.join(low, F.col("component").eqNullSafe(F.col("c")), "left")
                        .select("set_a", "set_b", F.coalesce("component", "node").alias("group"), F.coalesce("low", "doc_id").alias("component_id")),
                        "labels")
    # texts without words or id link with nothing
    return (table.select("doc_id", "text_key", "n_shingles", *[F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col(c)).alias(c)
                                                               for c in ("set_a", "set_b")])
            .join(label, ["set_a", "set_b"], "left")
            .select("doc_id", "text_key", "n_shingles", "group", F.coalesce("component_id", "doc_id").alias("component_id")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``; options as for ``grouped``.

    ``kept`` marks the one text of each component that stays.
    """
    return grouped(docs, id_col, text_col, **options).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
