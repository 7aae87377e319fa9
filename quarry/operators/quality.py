"""Table-quality operators (inventory D1, D2, D4-D23; D3 is in similarity.py).

Each takes DataFrames and column names and returns a DataFrame of findings
(or a one-row summary). Rules run as column expressions in one pass; checks
that relate rows run as grouped aggregates or equi-joins, never as windows
over an unbounded group: a key holding a third of the table is reduced by the
partial aggregate before any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.expr import numeric_or_text, round_half_up, starts_with_word, statement_count, statement_mask
from quarry.operators.compare import EPS, tolerant_agreement
from quarry.operators.scan import MAX_BLOCKS, ordered_scan
from quarry.session import written_table


def _list(x: str | Sequence[str] | None) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


# --------------------------------------------------------------------- D1 keys

def key_audit(df: DataFrame, keys: str | Sequence[str], name: str = "n") -> DataFrame:
    """Primary-key audit: key values held by more than one row, and NULL keys.

    Output: key columns, ``n`` (rows holding the value), ``problem``
    (``duplicate`` or ``null key``). One partial + final aggregate.
    """
    keys = _list(keys)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return g.where((F.col(name) > 1) | any_null).withColumn(
        "problem", F.when(any_null, F.lit("null key")).otherwise(F.lit("duplicate")))


# --------------------------------------------------------------------- D2 duplicate text

def text_key(c: str | Column) -> Column:
    """Digest of the case- and space-insensitive text: the shuffle carries 32
    bytes per row instead of the document."""
    col = F.col(c) if isinstance(c, str) else c
    return F.unhex(F.sha2(F.lower(F.trim(col)), 256))


def duplicate_text(df: DataFrame, id_col: str, text_col: str, holder: str = "first",
                   n_blocks: int | None = MAX_BLOCKS) -> DataFrame:
    """Rows whose normalised text was already held by an earlier id.

    ``holder="first"``: name the first (smallest) id with that text; a grouped
    MIN on the digest (duplicated texts only) joined back on the digest. AQE
    broadcasts that table when its measured size is under the threshold and
    otherwise splits a hot digest's partition of the large side.
    ``holder="previous"``: name the previous id in id order (the reference's
    running ``seen`` map), via the blocked ordered scan keyed by the digest, over
    the duplicated rows only.
    Output: ``id_col``, ``holder_id``.
    """
    keyed = df.select(id_col, text_key(text_col).alias("_tk"))
    if holder == "first":
        firsts = keyed.groupBy("_tk").agg(F.min(id_col).alias("holder_id"), F.count(F.lit(1)).alias("_n"))
        firsts = firsts.where(F.col("_n") > 1).drop("_n")
        # null-safe, so that both sides are exchanged and AQE can split a hot text; null texts are no duplicates
        firsts = firsts.where(F.col("_tk").isNotNull()).withColumnRenamed("_tk", "_fk")
        j = keyed.join(firsts, F.col("_tk").eqNullSafe(F.col("_fk")), "inner")
        return j.where(F.col(id_col) != F.col("holder_id")).select(id_col, "holder_id")
    if holder == "previous":
        several = keyed.groupBy(F.col("_tk").alias("_fk")).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > 1) & F.col("_fk").isNotNull())
        # null-safe as above; written once, as the scan counts, samples and orders it
        cand = written_table(keyed.join(several, F.col("_tk").eqNullSafe(F.col("_fk"))).select(id_col, "_tk"), "duplicates")
        sc = ordered_scan(cand, ["_tk"], [id_col], lag_cols=[id_col], n_blocks=n_blocks, row_number=None)
        return sc.where(F.col(f"prev_{id_col}").isNotNull()).select(
            id_col, F.col(f"prev_{id_col}").alias("holder_id"))
    raise ValueError(holder)


# --------------------------------------------------------------------- D4-D6 presence, domain, cardinality

def required(df: DataFrame, id_cols: str | Sequence[str], fields: Sequence[str],
             empty_is_missing: bool = True) -> DataFrame:
    """Records missing required fields (NULL, or blank text when
    ``empty_is_missing``). Output: ids, ``missing`` (field names, in order)."""
    types = dict(df.dtypes)

    def absent(f: str) -> Column:
        c = F.col(f)
        if empty_is_missing and types.get(f) == "string":
            return c.isNull() | (F.trim(c) == "")
        return c.isNull()

    missing = F.filter(F.array(*[F.when(absent(f), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    return df.select(*_list(id_cols), missing.alias("missing")).where(F.size("missing") > 0)


def domain(df: DataFrame, col: str, allowed: Sequence, keep: Sequence[str] = ()) -> DataFrame:
    """Rows whose value is outside the allowed set (NULL is outside)."""
    ok = F.coalesce(F.col(col).isin(list(allowed)), F.lit(False))
    return df.where(~ok).select(*keep, col)


def cardinality(parent: DataFrame, parent_key: str, child: DataFrame, child_key: str,
                lo: int, hi: int, name: str = "n_children") -> DataFrame:
    """Parents whose number of children is outside ``[lo, hi]`` (0 included).

    Child counts are a partial + final aggregate (one row per key) joined to
    the parents with a left join; no per-parent collection of children.
    """
    counts = child.groupBy(F.col(child_key).alias("_ck")).agg(F.count(F.lit(1)).alias(name))
    j = parent.select(parent_key).join(counts, F.col(parent_key) == F.col("_ck"), "left")
    n = F.coalesce(F.col(name), F.lit(0)).cast("bigint")
    return j.select(parent_key, n.alias(name)).where(~F.col(name).between(lo, hi))


# --------------------------------------------------------------------- D7-D12 result comparison

def canonical(df: DataFrame, digits: int = 6, numeric_text: bool = False) -> DataFrame:
    """Canonical form of every column: numbers rounded to ``digits`` (half away
    from zero), text trimmed; with ``numeric_text`` a text that parses as a
    number compares equal to that number (tagged string ``n:``/``s:``)."""
    out = []
    for name, t in df.dtypes:
        c = F.col(f"`{name}`")
        if t in ("double", "float") or t.startswith("decimal"):
            out.append(round_half_up(c, digits, 9).alias(name))
        elif t == "string":
            out.append((numeric_or_text(c, digits) if numeric_text else F.trim(c)).alias(name))
        else:
            out.append(c.alias(name))
    return df.select(*out)


def canonical_parts(c: str | Column, digits: int = 6) -> Column:
    """Canonical cell (D9) as ``struct(kind, num, txt)``: ``kind`` is ``null``,
    ``num`` (text that parses as a number, rounded half away from zero) or
    ``text`` (trimmed). Keeps numbers as numbers, so no engine-specific
    rendering of doubles enters a comparison."""
    x = (F.col(c) if isinstance(c, str) else c).cast("string")
    as_num = x.try_cast("double")
    kind = F.when(x.isNull(), "null").when(as_num.isNotNull(), "num").otherwise("text")
    return F.struct(kind.alias("kind"), round_half_up(as_num, digits, 9).alias("num"),
                    F.when(x.isNotNull() & as_num.isNull(), F.trim(x)).alias("txt"))


def table_diff(a: DataFrame, b: DataFrame, canonicalize: bool = False) -> DataFrame:
    """Multiset difference of two tables with the same columns.

    One shuffle: tag rows +1 / -1, group by every column (GROUP BY treats NULLs
    as equal, matching "NULL equals NULL" in result comparison), keep groups
    whose signed count is not zero. ``delta > 0``: the row occurs more often in
    ``a``. Duplicated rows collapse in the partial aggregate before the shuffle.
    """
    if canonicalize:
        a, b = canonical(a), canonical(b)
    cols = a.columns
    tagged = a.select(*cols, F.lit(1).alias("_d")).unionByName(b.select(*cols, F.lit(-1).alias("_d")))
    return tagged.groupBy(*cols).agg(F.sum("_d").cast("bigint").alias("delta")).where(F.col("delta") != 0)


def tables_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: ``equal`` (multiset equality) and the counts of differing rows."""
    d = table_diff(a, b)
    return d.agg(F.coalesce(F.sum(F.when(F.col("delta") > 0, F.col("delta"))), F.lit(0)).alias("only_a"),
                 F.coalesce(F.sum(F.when(F.col("delta") < 0, -F.col("delta"))), F.lit(0)).alias("only_b")) \
        .withColumn("equal", (F.col("only_a") == 0) & (F.col("only_b") == 0))


def ordered_diff(a: DataFrame, b: DataFrame, ordinal: str, cols: Sequence[str]) -> DataFrame:
    """Position-wise comparison of two ordered results.

    Full outer join on the ordinal; a position differs when either side is
    missing or any column differs NULL-safely. Output: ``ordinal``, ``side``
    (``both``/``only_a``/``only_b``) and ``is_first`` (the first mismatch).
    """
    x = a.select(F.col(ordinal).alias("_o"), *[F.col(c).alias(f"a_{c}") for c in cols], F.lit(1).alias("_ina"))
    y = b.select(F.col(ordinal).alias("_o"), *[F.col(c).alias(f"b_{c}") for c in cols], F.lit(1).alias("_inb"))
    j = x.join(y, "_o", "full_outer")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    side = F.when(F.col("_ina").isNull(), "only_b").when(F.col("_inb").isNull(), "only_a").otherwise("both")
    bad = j.where(F.col("_ina").isNull() | F.col("_inb").isNull() | ~same).select(
        F.col("_o").alias(ordinal), side.alias("side"))
    first = bad.select(F.min(ordinal)).scalar()
    return bad.withColumn("is_first", F.col(ordinal) == first)


def tolerant_diff(a: DataFrame, b: DataFrame, key: str | Sequence[str], cols: Sequence[str],
                  eps: float = 1e-6) -> DataFrame:
    """Keyed comparison with an absolute tolerance (D10): NULL equals only
    NULL, numbers are equal when ``|x - y| < eps``. Output: key, ``column``,
    ``a``, ``b`` for each differing cell, and ``column = '<row>'`` when a key
    is on one side only."""
    keys = _list(key)
    x = a.select(*keys, *[F.col(c).cast("double").alias(f"a_{c}") for c in cols], F.lit(1).alias("_ina"))
    y = b.select(*keys, *[F.col(c).cast("double").alias(f"b_{c}") for c in cols], F.lit(1).alias("_inb"))
    j = x.join(y, keys, "full_outer")
    cells = []
    for c in cols:
        va, vb = F.col(f"a_{c}"), F.col(f"b_{c}")
        differ = F.when(va.isNull() & vb.isNull(), False).when(va.isNull() | vb.isNull(), True) \
            .otherwise(F.abs(va - vb) >= eps)
        cells.append(F.when(differ, F.struct(F.lit(c).alias("column"), va.alias("a"), vb.alias("b"))))
    cells_arr = F.filter(F.array(*cells), lambda s: s.isNotNull())
    row_missing = F.when(F.col("_ina").isNull() | F.col("_inb").isNull(),
                         F.array(F.struct(F.lit("<row>").alias("column"), F.lit(None).cast("double").alias("a"),
                                          F.lit(None).cast("double").alias("b"))))
    out = j.select(*keys, F.explode(F.coalesce(row_missing, cells_arr)).alias("_c"))
    return out.select(*keys, "_c.column", "_c.a", "_c.b")


def json_shape(c: str | Column) -> Column:
    """Lower-cased member names of a JSON object, in order, comma-joined."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.transform(F.json_object_keys(col), lambda k: F.lower(k)), ",")


def shape_audit(df: DataFrame, json_col: str, expected: Sequence[str]) -> DataFrame:
    """Group rows by the observed member-name shape of a JSON column (D11):
    ``shape``, ``n`` rows, ``matches`` (names equal ``expected``, case-
    insensitive, in order). A row that is not a JSON object has shape NULL."""
    exp = ",".join(x.lower() for x in expected)
    g = df.groupBy(json_shape(json_col).alias("shape")).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("matches", F.coalesce(F.col("shape") == exp, F.lit(False)))


def same_columns(a: DataFrame, b: DataFrame) -> bool:
    """Schema precondition of D7/D8: same column names, case-insensitive, in order."""
    return [c.lower() for c in a.columns] == [c.lower() for c in b.columns]


def row_count_check(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both row counts from one aggregate over a tagged union."""
    u = a.select(F.lit(1).alias("_s")).unionByName(b.select(F.lit(2).alias("_s")))
    agg = u.agg(F.count_if(F.col("_s") == 1).alias("n_a"), F.count_if(F.col("_s") == 2).alias("n_b"))
    return agg.withColumn("equal", F.col("n_a") == F.col("n_b")) \
        .withColumn("both_nonempty", (F.col("n_a") > 0) & (F.col("n_b") > 0))


# --------------------------------------------------------------------- D13-D16 per-row structure

def arity(df: DataFrame, array_col: Column, expected: int, keep: Sequence[str]) -> DataFrame:
    """Rows whose positional array length differs from the declared width."""
    return df.select(*keep, F.size(array_col).alias("width")).where(F.col("width") != expected)


def not_null_audit(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL count per column in one pass (D14), long format: ``column``, ``n_null``."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("n_null"))
                      for i, c in enumerate(cols)])
    return wide.select(F.inline(pairs))


def type_audit(df: DataFrame, col: Column, type_name: str, keep: Sequence[str]) -> DataFrame:
    """Values that do not fit the declared type (D15): present but not castable."""
    return df.select(*keep, col.alias("value")).where(
        F.col("value").isNotNull() & F.col("value").try_cast(type_name).isNull())


def id_matches_source(df: DataFrame, id_expr: Column, source_expr: Column, keep: Sequence[str]) -> DataFrame:
    """Records whose declared id differs from the id derived from their source
    (D16, e.g. file stem or URL path)."""
    return df.select(*keep, id_expr.alias("declared"), source_expr.alias("derived")) \
        .where(~F.col("declared").eqNullSafe(F.col("derived")))


# --------------------------------------------------------------------- D17, D20-D23 rule screens

def first_failure(df: DataFrame, rules: Sequence[tuple[str, Column]], reason: str = "reason") -> DataFrame:
    """Ordered rules, first failing rule names the reason, NULL = clean.
    ``rules`` are ``(reason, fails_condition)``; one projection, no shuffle."""
    expr = F.coalesce(*[F.when(cond, F.lit(name)) for name, cond in rules]) if rules else F.lit(None)
    return df.withColumn(reason, expr.cast("string"))


def statement_rules(text: str, starts: Sequence[str] = ("select", "with"),
                    banned: Sequence[str] = ()) -> list[tuple[str, Column]]:
    """The start, single-statement and banned-word rules of a statement screen
    (D20), for :func:`first_failure`. Separators and words inside quotes and
    comments do not count; one closing separator is allowed. NULL text is empty."""
    c = F.coalesce(F.col(text), F.lit(""))
    rules = [("empty", statement_count(c) == 0), ("more than one statement", statement_count(c) > 1),
             ("wrong start", ~starts_with_word(c, starts))]
    if banned:
        rules.append(("banned word", statement_mask(c).rlike(r"(?i)\b(?:" + "|".join(banned) + r")\b")))
    return rules


def text_screen(df: DataFrame, text_col: str, patterns: Mapping[str, str | tuple[str, str]]) -> DataFrame:
    """Count of rows matching each named pattern (D20), one aggregate pass.
    A pattern may come as ``(regex, literal)`` where every match contains the
    literal: the substring test runs first and spares the regex on most rows.
    Output long: ``rule``, ``hits``."""
    def hit(p):
        if isinstance(p, tuple):
            return F.col(text_col).contains(p[1]) & F.col(text_col).rlike(p[0])
        return F.col(text_col).rlike(p)
    agg = df.agg(*[F.count_if(hit(p)).alias(f"_r{i}") for i, p in enumerate(patterns.values())])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"_r{i}").alias("hits"))
                      for i, n in enumerate(patterns)])
    return agg.select(F.inline(pairs))


def mentions(df: DataFrame, text_col: str, terms: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Terms (case-insensitive) that do not occur in the text (D21); rows with
    at least one missing term."""
    low = F.lower(F.col(text_col))
    missing = F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: ~F.contains(low, F.lower(t)))
    return df.select(*keep, missing.alias("missing")).where(F.size("missing") > 0)


def unique_members(df: DataFrame, array_col: Column, keep: Sequence[str]) -> DataFrame:
    """Rows whose array repeats a member ignoring case."""
    arr = array_col
    return df.select(*keep, F.size(arr).alias("members"),
                     F.size(F.array_distinct(F.transform(arr, lambda x: F.lower(x)))).alias("distinct_members")) \
        .where(F.col("members") != F.col("distinct_members"))


def flag_consistency(df: DataFrame, flag: Column, evidence: Column, keep: Sequence[str]) -> DataFrame:
    """Declared flag against evidence in the text (D23): rows where they
    disagree, with ``flag`` and ``evidence``."""
    return df.select(*keep, flag.cast("boolean").alias("flag"), evidence.alias("evidence")) \
        .where(~F.col("flag").eqNullSafe(F.col("evidence")))


# --------------------------------------------------------------------- D18, D19 determinism and agreement

def result_digest(df: DataFrame) -> DataFrame:
    """Order-insensitive digest of a result: row count and the exact sum of
    64-bit row hashes (DECIMAL, no overflow). Two equal multisets give equal
    digests; a different multiset collides only with negligible probability."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(h), F.lit(0)).cast("string").alias("digest"))


def reorder(df: DataFrame, seed: int, partitions: int) -> DataFrame:
    """Same rows, another arrival order: hash-ordered and repartitioned."""
    return df.repartition(partitions, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.lit(seed))) \
        .sortWithinPartitions(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns]))


def order_stability(query: Callable[..., DataFrame], inputs: Sequence[DataFrame],
                    seeds: Sequence[int] = (0, 1, 2, 3, 4, 5)) -> DataFrame:
    """Run ``query(*inputs)`` on reordered inputs, one run per seed.

    Output: ``seed``, ``rows``, ``digest``; the result is stable when all
    digests agree. Passing is evidence, not proof (Spark offers no insertion
    order to permute); for a top-k, :func:`quarry.operators.relational.tie_audit`
    is exact.
    """
    # a different partition count per seed changes the arrival order; the
    # counts follow the session's shuffle sizing, so a large input is never
    # squeezed into a handful of tasks
    base = int(inputs[0].sparkSession.conf.get("spark.sql.shuffle.partitions", "200")) if inputs else 1
    runs = []
    for s in seeds:
        shuffled = [reorder(x, s, base + s) for x in inputs]
        runs.append(result_digest(query(*shuffled)).withColumn("seed", F.lit(s)))
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return out.select("seed", "rows", "digest")


def agreement(a: DataFrame, b: DataFrame, eps: float = EPS) -> DataFrame:
    """Do two independent answers coincide (D19)? Column names (case-
    insensitive, in order) and rows paired with a tolerance: numbers and
    numeric text within ``eps``, other text trimmed. One row."""
    return tolerant_agreement(a, b, eps)
