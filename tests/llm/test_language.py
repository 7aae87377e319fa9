"""Language identification: many scripts, long texts only, and the kernel, Nyström map and ridge against their definitions."""

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import language

SCHEMA = "doc_id long, text string, lang string, score double"
START = {"en": 0x61, "ru": 0x430, "el": 0x3B1, "ar": 0x627, "zh": 0x4E00, "ko": 0xAC00, "th": 0xE01, "xx": 0x10330}
SIZE = {"zh": 120, "ko": 90, "th": 40, "xx": 20}


def text_of(lang, r, words=60):
    letters = [chr(START.get(lang, 0xDF) + k) for k in range(SIZE.get(lang, 24))]
    return " ".join("".join(r.choice(letters, r.integers(2, 8))) for _ in range(words))


def test_scripts_and_long_texts(spark):
    """Languages whose letters are rare, and one that has long texts only."""
    r = np.random.default_rng(1)
    rows = [(i, text_of(lang, r), lang, -1.0) for i, lang in enumerate(list(START) * 40)]
    rows += [(1000 + i, text_of("de", r) * 400, "de", 0.0) for i in range(24)]
    rows += [(2000, None, "en", 0.0), (2001, "", "ru", 0.0), (2002, "12 !?", "ko", 0.0), (2003, text_of("th", r), None, 0.0), (0, rows[0][1], rows[0][2], 0.0),
             (2004, "y" * 500_000, "en", 0.0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    learn = F.floor(F.col("doc_id") / 8) % 4 != 1
    model = language.fit(df, learn, per_language=30, landmarks=6)
    assert set(model.languages) == {*START, "de"}
    got = {x.doc_id: x for x in language.predict(df, model).collect()}
    held = [x for x in rows if x[0] // 8 % 4 == 1 and x[0] < 2000]
    for lang in model.languages:
        own = [x for x in held if x[2] == lang]
        assert own and sum(got[x[0]].lang_pred == lang for x in own) >= 0.9 * len(own), lang
    assert {got[i].lang_pred for i in (2000, 2001, 2002)} == {"und"} and got[2003].lang_pred == "th"
    assert len(language.fit(df, learn, per_language=30, landmarks=6, most_landmarks=9).landmarks.norm) == 9


def sets_of(t):
    t = "".join(c.lower() if c.isalpha() else "\0" for c in t)
    return {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}


def test_against_the_definitions(spark):
    r = np.random.default_rng(2)
    langs = ["en", "ru", "zh"]
    rows = [(i, text_of(langs[i % 3], r, 12) + " " + text_of("en", r, 4).upper(), langs[i % 3], 0.0) for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = language.fit(df, F.lit(True), per_language=50, landmarks=4, ridge=0.5)
    sets = [sets_of(t) for _, t, _, _ in rows]

    def kernel(a, b):
        return len(a & b) / np.sqrt(len(a) * len(b))
    order = {x.doc_id: x.r for x in df.select("doc_id", F.row_number().over(language.Window.partitionBy("lang").orderBy(
        F.xxhash64(F.lit(29), "doc_id"), "doc_id")).alias("r")).collect()}
    marks = sorted((i for i in order if order[i] <= 4), key=lambda i: (rows[i][2], order[i]))
    k = np.array([[kernel(sets[i], sets[m]) for m in marks] for i in range(20)])
    values, vectors = np.linalg.eigh(k[marks])
    z = k @ (vectors / np.sqrt(values))
    y = np.array([[1.0 if lang == x else -1.0 for x in sorted(langs)] for _, _, lang, _ in rows])
    zc, yc = z - z.mean(0), y - y.mean(0)
    w = np.linalg.inv(zc.T @ zc + 0.5 * np.eye(len(marks))) @ zc.T @ yc
    out = zc @ w + y.mean(0)
    got = {x.doc_id: x for x in language.predict(df, model).collect()}
    for i in range(20):
        assert got[i].lang_pred == sorted(langs)[out[i].argmax()]
        assert abs(got[i].score - np.clip((out[i].max() + 1) / 2, 0, 1)) < 1e-6


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "abc", None, 0.0), (2, "12", "en", 0.0), (None, "abc", "en", 0.0)], SCHEMA)
    assert language.fit(df, F.lit(True)) is None
    assert {x.lang_pred for x in language.predict(df, None).collect()} == {"und"}
    assert language.predict(df.where("false"), None).count() == 0
