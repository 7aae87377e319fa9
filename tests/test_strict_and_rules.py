"""Strict JSON, inline tables from text, and statement rules."""

import json

from pyspark.sql import functions as F

from quarry.functions import expr as X
from quarry.operators import quality as q
from quarry.sources import documents as docs


def strict(text):
    def no(_):
        raise ValueError
    try:
        json.loads(text, parse_constant=no)
        return True
    except (ValueError, TypeError):
        return False


def test_is_json(spark):
    texts = ['{"a":1}', '{"a":1} x', '{"a":1}{"b":2}', '{"a":1},{"b":2}', "1],[2", "]", "[", "[]", "{}", "", " ", None, "null", "nul", "1", "01", "-0.5e-3",
             "NaN", "Infinity", "'a'", '"a"', '"a', 'a"', '"a\nb"', '"\\n"', '"\\x"', "{a:1}", '{"a":1,}', "[1,]", "true", "tru", "\n [1, [2, {}]] \t",
             '{"a":{"b":[1,2,{"c":null}]}}', '"é\U0001f600"', "1 2", "1,2", "/* c */ 1", '{"a":1}]', '[{"a":1}', "x" * 1000, '"' + "y" * 100_000 + '"']
    got = {r["i"]: r["ok"] for r in spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", docs.is_json("t").alias("ok")).collect()}
    assert got == {i: strict(t) for i, t in enumerate(texts)}
    out = docs.parse_json_column(spark.createDataFrame([('{"k":1} x',), ('{"k":1}',), ('{"k":"z"}',)], "t string"), "t", "k long")
    assert [(r["status"], r["parsed"] and r["parsed"]["k"]) for r in out.collect()] == [("invalid", None), ("ok", 1), ("invalid", None)]


def test_tables_from_json(spark):
    doc = {"tables": [{"name": "E", "columns": [{"name": "id", "type": "INTEGER"}, {"name": "s", "type": "real"}, {"name": "d", "type": "DATE"}],
                       "rows": [[1, "2.5", "x"], ["one", 3, None], [None], []]}, {"name": "empty", "columns": [], "rows": []}]}
    df = spark.createDataFrame([("a", json.dumps(doc)), ("b", json.dumps(doc) + " x"), ("c", None), ("d", "{}")], "id string, j string")
    cells = docs.typed_cells(docs.tables_from_json(df, "id", "j")).collect()
    got = {(r["id"], r["row_no"], r["column"]): (r["text"], r["as_long"], r["as_double"], r["fits"], r["arity_ok"]) for r in cells}
    assert got == {("a", 0, "id"): ("1", 1, None, True, True), ("a", 0, "s"): ("2.5", None, 2.5, True, True), ("a", 0, "d"): ("x", None, None, False, True),
                   ("a", 1, "id"): ("one", None, None, False, True), ("a", 1, "s"): ("3", None, 3.0, True, True), ("a", 1, "d"): (None, None, None, False, True),
                   ("a", 2, "id"): (None, None, None, True, False)}


def test_split_valid_twice(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id":"a"}')
    (tmp_path / "b.json").write_text('{"id":')
    valid, bad = docs.split_valid(docs.read_json_collection(spark, str(tmp_path)))
    assert [r["id"] for r in valid.collect()] == ["a"] and bad.count() == 1 and valid.count() == 1


def test_statement_rules(spark):
    cases = {"SELECT 1": None, " select 1 ; ": None, "WITH a AS (SELECT ';') SELECT * FROM a;;": None, "SELECT 1; SELECT 2": "more than one statement",
             "": "empty", None: "empty", " ;; ": "empty", "-- SELECT": "empty", "/* ; */ SELECT 'it''s; fine' -- ; drop": None, "DELETE FROM t": "wrong start",
             "selected": "wrong start", 'SELECT "a;b", \'drop\' FROM t': None, "SELECT 1 /* open ; DROP": None, "SELECT 'open ; x": None,
             "SELECT drop FROM t": "banned word", "SELECT '--'; DROP": "more than one statement", "SELECT '" + "a;" * 100_000 + "'": None}
    df = spark.createDataFrame([(i, s) for i, s in enumerate(cases)], "i long, s string")
    out = q.first_failure(df, q.statement_rules("s", banned=["drop"])).collect()
    assert {r["s"]: r["reason"] for r in out} == cases
    assert df.select(F.max(X.statement_count("s"))).first()[0] == 2
