"""String-similarity join and accept-as-you-go dedupe (inventory D3, J7, M6).

Similarity is Python's ``difflib.SequenceMatcher(None, new, old).ratio()``
after normalisation (lower case, keep ``[a-z0-9 ]``, trim), threshold 0.85;
normalised-equal strings always match. Comparing every pair is quadratic, so
the work is staged:

0. **Exact groups.** Rows are grouped by a digest of their normalised text
   (partial aggregation collapses a hot duplicate before the shuffle); each
   distinct value is represented by its smallest id. Exact duplicates are
   reported as ``id -> representative`` (linear), never as all pairs of a
   group, and similarity runs between distinct values only.
1. **Lossless blocking.** For lengths ``la, lb`` and ``r = 2M/(la+lb) >= t``:
   ``M <= min(la, lb)`` gives the band ``min/max >= t/(2-t)``. The matching
   blocks form a common subsequence, so the insert/delete distance is
   ``d <= (1-t)(la+lb) <= 2(1-t)·max``; by the q-gram lemma (q = 2) the
   bigram multisets share at least ``max - 1 - 2d >= (1-4(1-t))·max - 1``
   members (``0.4·max - 1`` at 0.85), positive from ``max >= 3``. Distinct
   values of length <= 2 can only match an equal value, which step 0 handles.
   Prefix filtering: bigrams are numbered per string (``ab#1``, ``ab#2``:
   multiset -> set), ordered by global rarity, and each string indexes only
   its ``|G| - c_x + 1`` rarest (``c_x`` = the bound at its own length); two
   strings that share ``c`` bigrams share a prefix member.
2. **Count check** on candidates: exact shared-bigram count >= bound,
   JVM-side as ``array_intersect`` of the two strings' numbered-token arrays
   (one array per string), so candidates are not multiplied by tokens in a
   shuffle.
   Then a character-count bound (the matcher's own quick bound), JVM-side too.
3. **Exact verification** in an Arrow-batched pandas UDF over surviving pairs
   (the only Python on the executors). Python's matcher applies its popular-
   character heuristic to strings of 200+ characters; it can only lower M,
   so the blocking bound still covers every pair it accepts.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.expr import normalized_text

THRESHOLD = 0.85


LEAST_THRESHOLD = 0.8  # the bigram bound is proved from here on


def _pct(t: float) -> int:
    """Threshold in whole percents, rounded down: blocking may admit more, never less."""
    if not LEAST_THRESHOLD <= t <= 1:
        raise ValueError(f"similarity threshold {t} outside [{LEAST_THRESHOLD}, 1], where blocking is lossless")
    return math.floor(t * 100 + 1e-9)


def in_length_band(shorter: Column, longer: Column, t: float = THRESHOLD) -> Column:
    """``shorter / longer >= t / (2 - t)`` in integer arithmetic (a pair
    exactly on the band can still reach ratio t, so no float rounding here)."""
    tp = _pct(t)
    return shorter * (200 - tp) >= longer * tp


def overlap_bound(max_len: Column, t: float = THRESHOLD) -> Column:
    """Lower bound ``ceil((1 - 4(1-t))·max - 1)`` on shared bigrams, from an
    integer numerator over 100 (exact whenever the value is an integer)."""
    slope = 4 * _pct(t) - 300
    return F.ceil((F.lit(slope) * max_len - 100) / 100).cast("int")


def distinct_texts(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Step 0: ``reps(id, norm, len, digest)`` one row per distinct normalised
    text (id = smallest holder) and ``members(id, rep)`` for every row. A NULL
    text counts as empty."""
    n = df.select(F.col(id_col).alias("id"), F.coalesce(normalized_text(text_col), F.lit("")).alias("norm")) \
        .withColumn("digest", F.unhex(F.sha2("norm", 256)))
    reps = n.groupBy("digest").agg(F.min_by(F.struct("id", "norm"), F.col("id")).alias("r")) \
        .select(F.col("r.id").alias("id"), F.col("r.norm").alias("norm"), "digest") \
        .withColumn("len", F.length("norm"))
    # reused by the token, verification and membership stages: materialise it
    # once in the reliable checkpoint folder instead of re-scanning and
    # re-shuffling the texts for every use
    reps = _materialise(reps)
    members = n.select("id", "digest").join(reps.select("digest", F.col("id").alias("rep")), "digest") \
        .select("id", "rep")
    return reps, members


def distinct_texts_two(a: DataFrame, a_id: str, a_text: str, b: DataFrame, b_id: str,
                       b_text: str) -> tuple[DataFrame, DataFrame]:
    """Representatives of both sides of a two-sided join (step 0 per side),
    materialised together in one job; ids may repeat across the sides."""
    def side(df, id_col, text_col, tag):
        return df.select(F.lit(tag).alias("_side"), F.col(id_col).alias("id"), F.coalesce(normalized_text(text_col), F.lit("")).alias("norm"))
    n = side(a, a_id, a_text, 0).unionByName(side(b, b_id, b_text, 1)) \
        .withColumn("digest", F.unhex(F.sha2("norm", 256)))
    reps = n.groupBy("_side", "digest").agg(F.min_by(F.struct("id", "norm"), F.col("id")).alias("r")) \
        .select("_side", F.col("r.id").alias("id"), F.col("r.norm").alias("norm"), "digest") \
        .withColumn("len", F.length("norm"))
    both = _materialise(reps)
    return (both.where(F.col("_side") == 0).drop("_side"), both.where(F.col("_side") == 1).drop("_side"))


def _materialise(df: DataFrame) -> DataFrame:
    from quarry.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bigram_tokens(reps: DataFrame) -> DataFrame:
    """``(id, len, tok)``: every bigram of the normalised text, numbered by
    occurrence (multiset -> set); the text is split into characters once and
    neighbours are paired (linear in its length), one grouped count, no window.
    The string length rides along so later stages need no join to find it."""
    side = ["_side"] if "_side" in reps.columns else []
    chars = reps.where(F.col("len") >= 2).select(*side, "id", "len", F.split("norm", "").alias("c"))
    pairs = F.zip_with(F.slice("c", F.lit(1), F.col("len") - 1), F.slice("c", F.lit(2), F.col("len") - 1), lambda x, y: F.concat(x, y))
    grams = chars.select(*side, "id", "len", F.explode(pairs).alias("g"))
    counted = grams.groupBy(*side, "id", "len", "g").agg(F.count(F.lit(1)).alias("k"))
    return counted.select(*side, "id", "len",
                          F.explode(F.expr("transform(sequence(1, k), j -> concat(g, '#', j))")).alias("tok"))


ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789 "  # what a normalised text is made of


def character_counts(norm: Column) -> Column:
    """How often each character of the normalised alphabet occurs."""
    return F.array(*[(F.length(norm) - F.length(F.replace(norm, F.lit(c), F.lit("")))).alias(c) for c in ALPHABET])


def can_reach(counts_a: Column, counts_b: Column, t: float = THRESHOLD) -> Column:
    """Whether the ratio of two texts can be ``t``: matching blocks use each
    character at most as often as both texts have it, so ``2 * sum(min) / (la + lb)``
    bounds the ratio (integer arithmetic in percents, rounded to admit)."""
    total = lambda arr: F.aggregate(arr, F.lit(0), lambda s, x: s + x)
    shared = total(F.zip_with(counts_a, counts_b, lambda x, y: F.least(x, y)))
    return 200 * shared >= _pct(t) * (total(counts_a) + total(counts_b))


def _prefixes(tokens: DataFrame, freq: DataFrame, t: float) -> DataFrame:
    """Each string's rarest ``|G| - c_x + 1`` tokens; the window spans one
    string's own bigrams."""
    ranked = tokens.join(freq, "tok")
    w = Window.partitionBy("id").orderBy(F.col("df").asc(), F.col("tok").asc())
    cx = F.greatest(overlap_bound(F.col("len"), t), F.lit(1))
    keep = (F.col("len") - 1) - cx + 1
    return ranked.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= keep).select("id", "len", "tok", "_r")


def _length_class(length: Column, t: float) -> Column:
    """Lengths of one class, or of neighbouring ones, are all that the band allows."""
    ratio = (200 - _pct(t)) / _pct(t)
    return F.floor(F.log(length.cast("double")) / math.log(ratio) + 1e-9).cast("int")


def candidate_pairs(a: DataFrame, b: DataFrame | None = None, t: float = THRESHOLD,
                    exact_overlap: bool = True) -> DataFrame:
    """Lossless candidates between distinct values: ``(id_a, id_b, len_a,
    len_b, shared, need)``, ``shared >= need``. ``b=None``: within ``a``, each
    unordered pair once as ``id_a > id_b`` (later item first: the reference
    compares a new title with existing ones). Equal values are excluded here
    (step 0 / :func:`equal_pairs`). With ``exact_overlap=False`` the count
    check is left to the verifier and only ``(id_a, id_b, len_a, len_b)`` of
    the prefix/length-band candidates come back."""
    self_join = b is None
    b = a if self_join else b
    # each token table feeds the rarity count and the prefixes (and the
    # overlap arrays): materialise it once
    if self_join:
        ta = tb = both = _materialise(bigram_tokens(a))
    else:  # both sides' tokens in one job, split by a side tag
        tagged = _materialise(bigram_tokens(a.select(F.lit(0).alias("_side"), "id", "len", "norm").unionByName(
            b.select(F.lit(1).alias("_side"), "id", "len", "norm"))))
        ta = tagged.where(F.col("_side") == 0).drop("_side")
        tb = tagged.where(F.col("_side") == 1).drop("_side")
        both = tagged.drop("_side")
    freq = both.groupBy("tok").agg(F.count(F.lit(1)).alias("df"))
    pa, pb = _prefixes(ta, freq, t), _prefixes(tb, freq, t)
    # a token meets texts of its own length class and the two beside it, not all that hold it
    near = F.explode(F.array(*[_length_class(F.col("len"), t) + step for step in (-1, 0, 1)]))
    cand = pa.select(F.col("id").alias("id_a"), F.col("len").alias("len_a"), "tok", F.col("_r").alias("r_a"), _length_class(F.col("len"), t).alias("lc")).join(
        pb.select(F.col("id").alias("id_b"), F.col("len").alias("len_b"), "tok", F.col("_r").alias("r_b"), near.alias("lc")), ["tok", "lc"])
    mx, mn = F.greatest("len_a", "len_b"), F.least("len_a", "len_b")
    # shared tokens stand in the same order on both sides: what can follow the first bounds them all
    follow = F.least(F.col("len_a") - F.col("r_a"), F.col("len_b") - F.col("r_b"))
    keep = (mx >= 3) & in_length_band(mn, mx, t) & (follow >= overlap_bound(mx, t))
    if self_join:
        keep = keep & (F.col("id_a") > F.col("id_b"))
    found = cand.where(keep).select("id_a", "id_b", "len_a", "len_b").distinct()
    if not self_join:  # equal values across the sides are reported by equal_pairs
        found = (found.join(a.select(F.col("id").alias("id_a"), F.col("digest").alias("da")), "id_a")
                 .join(b.select(F.col("id").alias("id_b"), F.col("digest").alias("db")), "id_b")
                 .where(F.col("da") != F.col("db")).drop("da", "db"))
    if not exact_overlap:
        return found.select("id_a", "id_b", "len_a", "len_b")
    # exact overlap on candidates only: numbered tokens make the multiset
    # intersection a set intersection; one array per string (bounded by its
    # own length), two joins of candidate rows, no per-token shuffle
    arr_a = ta.groupBy("id").agg(F.collect_list("tok").alias("toks"))
    arr_b = arr_a if self_join else tb.groupBy("id").agg(F.collect_list("tok").alias("toks"))
    shared = F.size(F.array_intersect("toks_a", "toks_b")).cast("bigint")
    scored = (found.join(arr_a.select(F.col("id").alias("id_a"), F.col("toks").alias("toks_a")), "id_a")
              .join(arr_b.select(F.col("id").alias("id_b"), F.col("toks").alias("toks_b")), "id_b")
              .select("id_a", "id_b", "len_a", "len_b", shared.alias("shared"), overlap_bound(mx, t).alias("need")))
    return scored.where(F.col("shared") >= F.col("need"))


def equal_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct values present on both sides: an equi-join on the digest, at
    most one partner per value."""
    return a.select(F.col("id").alias("id_a"), "digest").join(
        b.select(F.col("id").alias("id_b"), "digest"), "digest").select("id_a", "id_b")


def make_ratio_udf(t: float = THRESHOLD):
    """Arrow-batched UDF: ``SequenceMatcher(None, a, b).ratio()`` when it can
    reach ``t``, else an upper bound below ``t``. ``real_quick_ratio`` and
    ``quick_ratio`` bound ``ratio`` from above in linear time, so pairs that
    cannot reach the threshold skip the quadratic matcher; the decision
    ``>= t`` is exactly the matcher's. Everything the workers run is defined
    inside, so the UDF ships by value and needs no package on the executors."""

    @F.pandas_udf(T.DoubleType())
    def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        import difflib

        def one(x, y):
            if x is None or y is None:
                return None
            if x == y:
                return 1.0
            m = difflib.SequenceMatcher(None, x, y)
            bound = m.real_quick_ratio()
            if bound < t:
                return bound
            bound = m.quick_ratio()
            if bound < t:
                return bound
            return m.ratio()

        return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")

    return sequence_ratio


def near_duplicates(a: DataFrame, a_id: str, a_text: str, b: DataFrame | None = None,
                    b_id: str | None = None, b_text: str | None = None,
                    t: float = THRESHOLD, reps_a: DataFrame | None = None) -> DataFrame:
    """Similar pairs ``(id_a, id_b, ratio)`` between representatives of
    distinct normalised values. ``b=None``: within ``a`` (later id first);
    rows that merely repeat a value map to it via :func:`distinct_texts`
    (pass its ``reps`` as ``reps_a`` when already computed). Every pair is
    found (lossless blocking) and verified exactly."""
    if b is None:
        ra, rb = (reps_a if reps_a is not None else distinct_texts(a, a_id, a_text)[0]), None
    elif reps_a is None:
        ra, rb = distinct_texts_two(a, a_id, a_text, b, b_id or a_id, b_text or a_text)
    else:
        ra, rb = reps_a, distinct_texts(b, b_id or a_id, b_text or a_text)[0]
    cand = candidate_pairs(ra, rb, t).select("id_a", "id_b")
    other = ra if rb is None else rb
    texts_a = ra.select(F.col("id").alias("id_a"), F.col("norm").alias("norm_a"), character_counts(F.col("norm")).alias("count_a"))
    texts_b = other.select(F.col("id").alias("id_b"), F.col("norm").alias("norm_b"), character_counts(F.col("norm")).alias("count_b"))
    scored = cand.join(texts_a, "id_a").join(texts_b, "id_b").where(can_reach(F.col("count_a"), F.col("count_b"), t)) \
        .withColumn("ratio", make_ratio_udf(t)("norm_a", "norm_b")).where(F.col("ratio") >= t) \
        .select("id_a", "id_b", "ratio")
    if rb is not None:
        scored = scored.unionByName(equal_pairs(ra, rb).withColumn("ratio", F.lit(1.0)))
    return scored


def accept_in_order(reps: DataFrame, edges: DataFrame) -> DataFrame:
    """Accept-as-you-go over distinct values (M6): in id order, a value is
    rejected when an *accepted* earlier value is similar to it.

    ``edges`` holds ``(id_a, id_b)`` with ``id_a > id_b``. The sequential
    result is the lexicographically first maximal independent set; it is
    computed in rounds: an undecided value with an accepted earlier neighbour
    is rejected, one whose earlier neighbours are all decided (none accepted)
    is accepted. Each round joins the edge set with the states and aggregates
    per value; the state is checkpointed to the reliable checkpoint folder so
    lineage stays one round deep. Output: ``id``, ``accepted``, ``rejected_by``
    (smallest accepted earlier neighbour).
    """
    from quarry.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(reps.sparkSession)
    e = edges.select("id_a", "id_b").distinct().checkpoint(eager=True)
    id_type = reps.schema["id"].dataType
    # values without any edge are accepted outright; only the others iterate
    touched = e.select(F.col("id_a").alias("id")).union(e.select(F.col("id_b").alias("id"))).distinct()
    state = touched.withColumn("s", F.lit("U")).withColumn("by", F.lit(None).cast(id_type)) \
        .checkpoint(eager=True)
    while True:  # each round decides the smallest undecided id at least
        if state.where(F.col("s") == "U").isEmpty():
            break
        nb = e.join(state.select(F.col("id").alias("id_b"), F.col("s").alias("sb")), "id_b")
        summary = nb.groupBy("id_a").agg(
            F.min(F.when(F.col("sb") == "A", F.col("id_b"))).alias("acc_by"),
            F.max(F.when(F.col("sb") == "U", F.lit(1)).otherwise(F.lit(0))).alias("has_u"))
        nxt = state.join(summary.withColumnRenamed("id_a", "id"), "id", "left")
        s_new = (F.when(F.col("s") != "U", F.col("s"))
                 .when(F.col("acc_by").isNotNull(), F.lit("R"))
                 .when(F.coalesce(F.col("has_u"), F.lit(0)) == 0, F.lit("A"))
                 .otherwise(F.lit("U")))
        by_new = F.when((F.col("s") == "U") & F.col("acc_by").isNotNull(), F.col("acc_by")).otherwise(F.col("by"))
        state = nxt.select("id", s_new.alias("s"), by_new.alias("by")).checkpoint(eager=True)
    decided = reps.select("id").join(state, "id", "left")
    return decided.select("id", F.coalesce(F.col("s") == "A", F.lit(True)).alias("accepted"),
                          F.col("by").alias("rejected_by"))


def dedupe_in_order(df: DataFrame, id_col: str, text_col: str, t: float = THRESHOLD) -> DataFrame:
    """M6 end to end on one table: ``(id_col, accepted, rejected_by)``.

    A row repeating an earlier value is rejected by the value's first holder
    when that holder is accepted, else by whoever rejected the holder; the
    first holder takes the value's decision.
    """
    reps, members = distinct_texts(df, id_col, text_col)
    edges = near_duplicates(df, id_col, text_col, t=t, reps_a=reps).select("id_a", "id_b")
    decided = accept_in_order(reps, edges)
    j = members.join(decided.withColumnRenamed("id", "rep"), "rep")
    is_rep = F.col("id") == F.col("rep")
    return j.select(F.col("id").alias(id_col),
                    (is_rep & F.col("accepted")).alias("accepted"),
                    F.when(is_rep, F.col("rejected_by"))
                    .when(F.col("accepted"), F.col("rep")).otherwise(F.col("rejected_by")).alias("rejected_by"))
