"""Tolerant comparison of results (inventory D7-D10, D19).

Two results agree when their rows can be paired so that every pair of cells is
equal: NULL equals only NULL; two numbers, or texts that parse as numbers, are
equal when they differ by less than ``eps``; other texts are compared trimmed.

Being within a tolerance is not transitive, so rows cannot be grouped by a
rounded value (0.4999995 and 0.5000005 round apart at any digit). Instead:

1. Equal rows cancel: one grouped, signed count over both sides (as the exact
   multiset difference). Only what is left goes on.
2. The numbers left in each column are sorted in blocks (:func:`plan_blocks`, so neither
   a column nor a hot value is one task) and cut into *islands* wherever two
   neighbours are ``eps`` or more apart. Numbers of different islands are never
   equal.
3. Rows with the same texts and the same islands are a class. Where every island
   of it is narrower than ``eps`` all its rows are equal, and the class is settled
   by its two counts.
4. A class with a wider island (a chain of noise) is paired by rank: its rows in
   order of the numbers in such islands, the k-th of one side with the k-th of the other, and compared cell by
   cell. With one such column and equal counts that finds a pairing if there is
   one; with more it may miss one and then reports the rows as different.

No step compares all pairs. A number above ``eps * 2**54`` is further than ``eps``
from any other double, so it is compared exactly, as are NaN (equal to NaN) and the
infinities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.scan import BLK, BROADCAST_POINTS, ROWS_PER_BLOCK, ordered_scan, plan_blocks
from quarry.session import written_table

EPS = 1e-6
_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean")


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _number(c: Column, dtype: str) -> Column:
    if dtype in _NUMERIC or dtype.startswith("decimal"):
        return c.cast("double")
    text = c.cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))  # which strips


def _near(x: Column, eps: float) -> Column:
    return F.abs(x) < eps * 2.0 ** 54


def _key(c: Column, x: Column, eps: float) -> Column:
    text = F.concat(F.lit("t:"), _stripped(c.cast("string")))
    return (F.when(c.isNull(), "null").when(x.isNull(), text).when(_near(x, eps), "#")
            .otherwise(F.concat(F.lit("x:"), x.cast("string"))))


def _num(x: Column, eps: float) -> Column:
    return F.when(_near(x, eps), x + F.lit(0.0))  # + 0.0: -0.0 is 0.0


def cell(c: Column, dtype: str, eps: float = EPS) -> Column:
    """``struct(key, num)``: ``num`` is set for a number that is compared within
    ``eps`` (``key`` is then ``#``); ``key`` holds everything compared exactly."""
    x = _number(c, dtype)
    return F.struct(_key(c, x, eps).alias("key"), _num(x, eps).alias("num"))


def cells_equal(a: Column, b: Column, eps: float = EPS) -> Column:
    """Whether two :func:`cell` values are equal."""
    return (a["key"] == b["key"]) & ((a["key"] != "#") | (F.abs(a["num"] - b["num"]) < eps))


def _cells(df: DataFrame, eps: float) -> list[Column]:
    return [cell(F.col(f"`{c}`"), t, eps) for c, t in df.dtypes]


def _named(letter: str, n: int) -> list[str]:
    return [f"{letter}{i}" for i in range(n)]


def _rows(df: DataFrame, sign: int, eps: float) -> DataFrame:
    """``k0``... and ``x0``..., the key and number of each cell as plain columns (grouping by arrays of doubles
    is slow), and ``sign``. Numbers are parsed in a select of their own, once a cell."""
    parsed = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)],
                       *[_number(F.col(f"`{c}`"), t).alias(f"v{i}") for i, (c, t) in enumerate(df.dtypes)])
    return parsed.select(*[_key(F.col(f"c{i}"), F.col(f"v{i}"), eps).alias(f"k{i}") for i in range(len(df.columns))],
                         *[_num(F.col(f"v{i}"), eps).alias(f"x{i}") for i in range(len(df.columns))], F.lit(sign).alias("sign"))


def same_shape(a: DataFrame, b: DataFrame) -> bool:
    """Equal column names, ignoring case, in order."""
    return [c.lower() for c in a.columns] == [c.lower() for c in b.columns]


def _islands(left: DataFrame, n: int, eps: float, rows_per_block: int = ROWS_PER_BLOCK) -> tuple[DataFrame, DataFrame]:
    """``id, pos, island`` of the numbers, and the ``pos, island`` that are ``eps`` wide or wider.

    The numbers are sorted once. Inside a block (:func:`plan_blocks`) islands are counted from its first number, and
    a table of one row a block says what goes before.
    """
    long = left.select("id", F.posexplode(F.array(*_named("x", n))).alias("pos", "value")).where(F.col("value").isNotNull())
    planned = plan_blocks(long, ["pos"], ["value", "id"], rows_per_block)
    placed = planned.place(long) if planned else long.withColumn(BLK, F.lit(0))
    order = Window.partitionBy("pos", BLK).orderBy("value", "id")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = F.coalesce(F.col("value") - F.lag("value").over(order) >= eps, F.lit(False))
    inside = (placed.select("id", "pos", BLK, "value", starts.alias("starts"))
              .select("id", "pos", BLK, "value", F.sum(F.col("starts").cast("long")).over(running).alias("run"),
                      F.max(F.when(F.col("starts"), F.col("value"))).over(running).alias("since")))
    inside = written_table(inside, "islands")
    blocks = inside.groupBy("pos", BLK).agg(F.min("value").alias("low"), F.max("value").alias("high"), F.max("run").alias("runs"), F.max("since").alias("last"))
    by_block = Window.partitionBy("pos").orderBy(BLK)
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.col("low") - F.lag("high").over(by_block) >= eps, F.lit(True))
    blocks = blocks.withColumn("opens", opens).withColumn("held", F.coalesce("last", F.when(F.col("opens"), F.col("low"))))
    new = F.col("opens").cast("long")
    blocks = blocks.select(
        F.col("pos").alias("_pos"), F.col(BLK).alias("_block"),
        (F.coalesce(F.sum(F.col("runs") + new).over(before), F.lit(0)) + new).alias("earlier"),
        F.when(F.col("opens"), F.col("low")).otherwise(F.max("held").over(before)).alias("open_since"))
    few = planned is None or planned.total <= BROADCAST_POINTS
    numbered = inside.join(F.broadcast(blocks) if few else blocks, (F.col("pos") == F.col("_pos")) & (F.col(BLK) == F.col("_block"))).select(
        "id", "pos", (F.col("run") + F.col("earlier")).alias("island"),
        (F.col("value") - F.coalesce("since", "open_since") >= eps).alias("far"))
    return numbered.select("id", "pos", "island"), numbered.where("far").select("pos", "island").distinct()


def _by_rank(rows: DataFrame, eps: float) -> DataFrame:
    """Differences inside classes with a wide island: rows in order, paired by rank."""
    each = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.abs("delta").cast("int")))).withColumn("side", F.col("delta") > 0)
    ranked = ordered_scan(each, ["keys", "islands", "side"], ["chain", "id", "copy"], row_number="rank").select("keys", "islands", "side", "rank", "nums")
    ranked = written_table(ranked, "ranked")
    mine, other = (ranked.where(F.col("side") == s).select("keys", "islands", "rank", F.col("nums").alias(n)) for s, n in ((True, "na"), (False, "nb")))
    pairs = mine.join(other, ["keys", "islands", "rank"], "full_outer")
    equal = F.forall(F.zip_with("na", "nb", lambda x, y: F.coalesce(F.abs(x - y) < eps, x.isNull() & y.isNull())), lambda same: same)
    bad = pairs.where(~F.coalesce(equal, F.lit(False)))
    return bad.select(F.explode(F.filter(F.array(
        F.when(F.col("na").isNotNull(), F.struct(F.lit("a").alias("side"), F.lit(1).cast("bigint").alias("n"), "keys", F.col("na").alias("nums"))),
        F.when(F.col("nb").isNotNull(), F.struct(F.lit("b").alias("side"), F.lit(1).cast("bigint").alias("n"), "keys", F.col("nb").alias("nums")))),
        lambda x: x.isNotNull())).alias("x")).select("x.*")


def tolerant_rows(a: DataFrame, b: DataFrame, eps: float = EPS) -> DataFrame:
    """Rows of one side without a partner on the other: ``side`` (``a``/``b``),
    ``n`` (how many), ``keys`` and ``nums`` (the cells, by position).

    Columns are compared by position and may differ in type. Repeated rows count.
    Empty tables: no rows.
    """
    n = len(a.columns)
    k, x, i = _named("k", n), _named("x", n), _named("i", n)
    both = _rows(a, 1, eps).unionByName(_rows(b, -1, eps))
    left = written_table(both.groupBy(*k, *x).agg(F.sum("sign").alias("delta")).where("delta <> 0")
                         .withColumn("id", F.monotonically_increasing_id()), "left")
    numbered, wide = _islands(left, n, eps)
    wide = written_table(wide, "wide")
    found = [F.max(F.when(F.col("pos") == at, F.col("island"))).alias(name) for at, name in enumerate(i)]
    rows = left.join(numbered.groupBy("id").agg(*found), "id", "left").withColumns(
        {name: F.coalesce(name, F.lit(0).cast("long")) for name in i})  # 0: not a number
    keys, nums, islands = F.array(*k).alias("keys"), F.array(*x).alias("nums"), F.array(*i).alias("islands")
    chained = None
    if not wide.isEmpty():
        hit = numbered.join(wide, ["pos", "island"], "left_semi").groupBy("id").agg(F.array_sort(F.collect_list("pos")).alias("chain"))
        rows = written_table(rows.join(hit, "id", "left"), "rows")
        # a class is chained as a whole: its rows share their islands
        numbers = F.transform("chain", lambda pos: F.get(F.col("nums"), pos))
        chained = rows.where("chain is not null").select("id", "delta", "chain", keys, nums, islands).withColumn("chain", numbers)
        rows = rows.where("chain is null")
    net = (rows.select(*k, *i, "delta", nums).groupBy(*k, *i)
           .agg(F.sum("delta").alias("net"), F.min(F.when(F.col("delta") > 0, F.col("nums"))).alias("na"),
                F.min(F.when(F.col("delta") < 0, F.col("nums"))).alias("nb")).where("net <> 0"))
    out = net.select(F.when(F.col("net") > 0, "a").otherwise("b").alias("side"), F.abs("net").cast("bigint").alias("n"), keys,
                     F.when(F.col("net") > 0, F.col("na")).otherwise(F.col("nb")).alias("nums"))
    return out if chained is None else out.unionByName(_by_rank(chained, eps))


def tolerant_agreement(a: DataFrame, b: DataFrame, eps: float = EPS) -> DataFrame:
    """One row: ``agree`` and the counts of rows without a partner (D19). Column
    names must match, ignoring case, in order; otherwise the counts are NULL."""
    if not same_shape(a, b):
        return a.sparkSession.createDataFrame([(False, None, None)], "agree boolean, only_a long, only_b long")
    def count(side: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col("n"))), F.lit(0)).cast("bigint")
    out = tolerant_rows(a, b, eps).agg(count("a").alias("only_a"), count("b").alias("only_b"))
    return out.select(((F.col("only_a") == 0) & (F.col("only_b") == 0)).alias("agree"), "only_a", "only_b")


def tolerant_ordered(a: DataFrame, b: DataFrame, ordinal: str, eps: float = EPS) -> DataFrame:
    """Positions at which two ordered results differ (D8 with tolerance): the
    ``ordinal``, ``side`` (``both``/``only_a``/``only_b``) and the 1-based numbers
    of the differing columns. ``ordinal`` must be unique on each side; the other
    columns are compared by position. One full outer join."""
    def side(df: DataFrame, name: str) -> DataFrame:
        rest = df.drop(ordinal)
        return df.select(F.col(ordinal).alias("_o"), F.array(*_cells(rest, eps)).alias(name))
    j = side(a, "x").join(side(b, "y"), "_o", "full_outer")
    bad = F.filter(F.transform(F.zip_with("x", "y", lambda p, q: ~F.coalesce(cells_equal(p, q, eps), F.lit(False))),
                               lambda differs, i: F.when(differs, i + 1)), lambda i: i.isNotNull())
    where = F.when(F.col("x").isNull(), "only_b").when(F.col("y").isNull(), "only_a").otherwise("both")
    return (j.select(F.col("_o").alias(ordinal), where.alias("side"), bad.alias("columns"))
            .where((F.col("side") != "both") | (F.size("columns") > 0)))
