"""Document collections (inventory S1-S4).

The reference reads one JSON document per file, skips unreadable ones, and
turns each document's inline tables (positional rows of text, numbers and
NULLs under a declared column list) into typed tables. Here the same steps
are DataFrame reads: an explicit schema, PERMISSIVE parsing with a corrupt-
record column (bad input is quarantined, not dropped), and typed casts by the
declared type with ``try_cast`` (a value that does not fit becomes NULL and is
reported by the type audit).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.classic.column import Column as ClassicColumn

from quarry.session import written_table

CORRUPT = "_corrupt_record"

# ---- fixed values: the declared column types of an inline table and their Spark types
DECLARED_TYPES = {"INTEGER": "bigint", "REAL": "double", "TEXT": "string"}

COLUMN = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("nullable", T.BooleanType()),
    T.StructField("primaryKey", T.BooleanType()),
])
TABLE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("columns", T.ArrayType(COLUMN)),
    T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))),
])
RESULT = T.StructType([
    T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))),
])
DOCUMENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("contentVersion", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("difficulty", T.StringType()),
    T.StructField("sqlDialect", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("description", T.StringType()),
    T.StructField("orderSensitive", T.BooleanType()),
    T.StructField("tables", T.ArrayType(TABLE)),
    T.StructField("expectedOutput", RESULT),
    T.StructField("solutionQuery", T.StringType()),
    T.StructField("explanation", T.StringType()),
    T.StructField("minAppVersionCode", T.LongType()),
    T.StructField(CORRUPT, T.StringType()),
])


def read_json_collection(spark: SparkSession, path: str, schema: T.StructType = DOCUMENT,
                         multiline: bool = True, glob: str | None = "*.json") -> DataFrame:
    """Collection scan (S1): every matching file, explicit schema (no
    inference pass), PERMISSIVE mode with the corrupt-record column, and the
    source file name from ``_metadata``. Unreadable documents stay as rows
    with ``_corrupt_record`` set (S2) instead of vanishing."""
    if CORRUPT not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    reader = (spark.read.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.json(path)
    return df.withColumn("file_name", F.col("_metadata.file_name"))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) by the corrupt-record column.

    The parsed collection is written below the checkpoint folder first: both
    halves then read one parse, which any executor can reach, and Spark allows
    queries that read only the corrupt-record column of a JSON scan only on a
    saved result.
    """
    parsed = written_table(df, "collection")
    bad = F.col(CORRUPT).isNotNull()
    return parsed.where(~bad).drop(CORRUPT), parsed.where(bad)


_STRICT = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "allowUnquotedFieldNames": "false",
           "allowComments": "false", "allowNumericLeadingZeros": "false", "allowBackslashEscapingAnyCharacter": "false"}


def is_json(text: str | Column) -> Column:
    """Whether a text as a whole is exactly one JSON value (S2); NULL text: false.

    Spark's JSON readers stop after the first complete value, so ``{"a":1} x`` and
    ``{"a":1}{"b":2}`` parse. Here the text is put between ``[`` and ``,"digest"]``, the
    digest being the text's own MD5, and must give an array of two members whose last
    is that digest: trailing text breaks the array, a second value adds a member, and a
    text that closes the bracket itself (``1],[2``) would have to hold its own digest.
    """
    c = F.col(text) if isinstance(text, str) else text
    mark = F.md5(c.cast("binary"))
    whole = F.from_json(F.concat(F.lit("["), c, F.lit(',"'), mark, F.lit('"]')), "array<string>", _STRICT)
    return F.coalesce((F.size(whole) == 2) & (F.element_at(whole, -1) == mark), F.lit(False))


def parse_json_column(df: DataFrame, col: str, schema: str | T.StructType) -> DataFrame:
    """Column-level S1/S2: ``status`` (``ok`` / ``invalid``) and the typed
    struct ``parsed``. Parsing is ``from_json`` in PERMISSIVE mode with a
    corrupt-record field, so malformed text and values of the wrong type are
    flagged rather than silently NULL, and the text as a whole must be one
    value (:func:`is_json`)."""
    st = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_bad = T.StructType(st.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(col), with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    ok = is_json(col) & parsed.isNotNull() & parsed[CORRUPT].isNull()
    return df.withColumn("status", F.when(ok, "ok").otherwise("invalid")) \
        .withColumn("parsed", F.when(ok, F.struct(*[parsed[f.name].alias(f.name) for f in st.fields])))


def json_long_format(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """Nested members -> long format ``(id, key, value)`` (S3): the object is
    read as ``map<string,string>`` and exploded; values stay text for a later
    typed cast."""
    m = F.from_json(F.col(json_col), "map<string,string>")
    return df.select(id_col, F.explode(m).alias("key", "value"))


def inline_tables(docs: DataFrame) -> DataFrame:
    """One row per inline table of every document: ``id, table, columns, rows``."""
    return docs.select("id", F.explode("tables").alias("t")).select(
        "id", F.col("t.name").alias("table"), F.col("t.columns").alias("columns"), F.col("t.rows").alias("rows"))


def typed_cells(tables: DataFrame) -> DataFrame:
    """Positional rows -> typed cells (S3): ``id, table, row_no, col_no,
    column, type, text, as_long, as_double, fits, arity_ok``.

    ``as_long``/``as_double`` are ``try_cast`` by the declared type; ``fits``
    is false for a present value that does not cast; ``arity_ok`` is false
    when the row's length differs from the column list (D13).
    """
    rows = tables.select("id", "table", "columns", F.posexplode("rows").alias("row_no", "row"))
    cells = rows.select("id", "table", "row_no", "columns",
                        (F.size("row") == F.size("columns")).alias("arity_ok"),
                        F.posexplode("row").alias("col_no", "text"))
    col = F.element_at(F.col("columns"), F.col("col_no") + 1)
    typ = F.upper(col["type"])
    as_long = F.when(typ == "INTEGER", F.col("text").try_cast("bigint"))
    as_double = F.when(typ == "REAL", F.col("text").try_cast("double"))
    fits = F.col("text").isNull() | (typ == "TEXT") | as_long.isNotNull() | as_double.isNotNull()
    return cells.select("id", "table", "row_no", "col_no", col["name"].alias("column"), typ.alias("type"),
                        "text", as_long.alias("as_long"), as_double.alias("as_double"),
                        (fits & typ.isin(list(DECLARED_TYPES))).alias("fits"), "arity_ok")


def tables_from_json(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """Inline tables of JSON documents kept as text, one row per table: ``id, table,
    columns, rows``. The column list (names, declared types) and the positional rows
    both come with the document; a text that is no JSON value gives no table."""
    schema = T.StructType([T.StructField("tables", T.ArrayType(TABLE))])
    docs = df.where(is_json(json_col)).select(F.col(id_col).alias("id"), F.from_json(F.col(json_col), schema).getField("tables").alias("tables"))
    return inline_tables(docs)


def typed_table(tables: DataFrame, doc_id: str, table: str, columns: Mapping[str, str]) -> DataFrame:
    """One inline table as a typed DataFrame with the given ``{name: TYPE}``
    declaration (names and types known up front, as a query needs them)."""
    t = tables.where((F.col("id") == doc_id) & (F.col("table") == table))
    rows = t.select(F.explode("rows").alias("r"))
    return rows.select(*[F.get(F.col("r"), i).try_cast(DECLARED_TYPES[ty.upper()]).alias(name)
                         for i, (name, ty) in enumerate(columns.items())])


def _file_sha256(spark: SparkSession, path: Column) -> Column:
    """SHA-256 of the file at ``path``, read to its end as a stream by the executor.

    Spark has no function that reads a file, and a ``content`` of ``binaryFile`` is one array (under 2 GB,
    several copies of it in memory). So the JVM's own calls are put together as Catalyst expressions:
    ``DigestUtils.sha256Hex(new AutoCloseInputStream(fs.open(path)))`` with ``fs`` the Hadoop FileSystem of
    the path under this session's settings; memory does not depend on the file's size.
    """
    jvm = spark._jvm
    types = jvm.org.apache.spark.sql.types
    objects = jvm.org.apache.spark.sql.catalyst.expressions.objects
    columns = jvm.org.apache.spark.sql.classic.ExpressionUtils
    load = jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass

    def seq(*items):
        return jvm.PythonUtils.toSeq(list(items))

    def of(name):
        return types.ObjectType(load(name))

    def new(name, *args):
        return objects.NewInstance(load(name), seq(*args), seq(), True, of(name), jvm.scala.Option.empty())

    def call(target, method, result, *args):
        return objects.Invoke(target, method, result, seq(*args), seq(), True, True, True)

    def static(name, method, result, *args):
        return objects.StaticInvoke(load(name), result, method, seq(*args), seq(), True, True, True, jvm.scala.Option.empty())

    settings = jvm.org.apache.spark.util.SerializableConfiguration(spark._jsparkSession.sessionState().newHadoopConf())
    conf = call(jvm.org.apache.spark.sql.catalyst.expressions.Literal(settings, of("org.apache.spark.util.SerializableConfiguration")),
                "value", of("org.apache.hadoop.conf.Configuration"))
    file = new("org.apache.hadoop.fs.Path", call(columns.expression(path._jc), "toString", of("java.lang.String")))
    fs = call(file, "getFileSystem", of("org.apache.hadoop.fs.FileSystem"), conf)
    stream = new("org.apache.commons.io.input.AutoCloseInputStream", call(fs, "open", of("org.apache.hadoop.fs.FSDataInputStream"), file))
    digest = static("org.apache.commons.codec.digest.DigestUtils", "sha256Hex", of("java.lang.String"), stream)
    return ClassicColumn(columns.column(static("org.apache.spark.unsafe.types.UTF8String", "fromString", types.DataType.fromDDL("string"), digest)))


def binary_digests(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Whole-file content scan + SHA-256 (S4): ``path, length, sha256``; ``binaryFile``
    lists the files, their bytes are streamed (:func:`_file_sha256`)."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(path)
    return df.select("path", "length", _file_sha256(spark, F.col("path")).alias("sha256"))
