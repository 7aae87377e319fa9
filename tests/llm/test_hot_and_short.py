"""Benchmark items of a few words, and top-k with an id that holds a third of the rows."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import containment, threshold

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def runs(w, k):
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


@pytest.mark.parametrize("bytes_", [containment.MAX_BROADCAST_BYTES, 0])
def test_short_items_inside_long_documents(spark, monkeypatch, bytes_):
    monkeypatch.setattr(containment, "MAX_BROADCAST_BYTES", bytes_)
    docs = [(1, "so then what is the capital of all that we know and love here today"), (2, "What  is\tthe CAPITAL"), (3, "the capital"), (4, "capital"),
            (5, None), (6, ""), (None, "what is the capital"), (7, "one two three four five six seven eight nine ten " * 30), (7, "capital again"),
            (8, "x " * 30_000 + "yes"), (9, "the the the the the the")]
    items = [(10, "what is the capital"), (11, "capital"), (12, "the capital of all"), (13, "THE capital"), (14, "two three four five six seven"), (15, None),
             (16, " "), (None, "capital"), (17, "yes"), (18, "nine ten one"), (19, "the the"), (11, "capital"), (20, "not there at all")]
    got = containment.contaminated(spark.createDataFrame([(i, t, 1.0) for i, t in docs], "doc_id long, text string, common double"),
                                   spark.createDataFrame(items, "item_id long, text string")).collect()
    want = set()
    for i, t in items:
        w = words(t)
        k = min(5, len(w))
        for d in {d for d, _ in docs if d is not None}:
            held = set().union(*[runs(words(x), k) for j, x in docs if j == d]) if k else set()
            if i is not None and k and 100 * len(runs(w, k) & held) >= 80 * len(runs(w, k)):
                want.add((d, i, len(runs(w, k)), len(runs(w, k) & held)))
    assert {tuple(r)[:4] for r in got} == want and len(got) == len(want)
    assert {(1, 10), (2, 10), (1, 13), (3, 13), (7, 11), (8, 17), (7, 18), (9, 19)} <= {w[:2] for w in want}


def test_top_k_with_a_hot_id(spark, monkeypatch):
    """A third of the rows share an id, half of these the vector as well; blocks stay near their bound."""
    monkeypatch.setattr(threshold, "CANDIDATE_BLOCK", 64)
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.normal(size=4)]) for i in range(1, 601)]
    rows += [(100, [float(x) for x in r.normal(size=4)]) for _ in range(150)] + [(100, [2.0, 2.0, 2.0, 2.0])] * 150
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = sorted(map(tuple, threshold.top_k(df, F.col("vec_id") % 100 == 0).collect()))
    ints = [(i, np.floor(1024 * np.array(v)).astype(int)) for i, v in rows]
    matrix = np.array([v for _, v in ints])
    want = []
    for n, (i, q) in enumerate(ints):
        if i % 100 == 0:
            score = matrix @ q
            order = sorted((m for m in range(len(ints)) if m != n), key=lambda m: (-score[m], ints[m][0]))[:10]
            want += [(i, k + 1, ints[m][0], int(score[m])) for k, m in enumerate(order)]
    assert got == sorted(want)


def test_mix_spreads_rows_without_id(spark):
    from quarry.llm import apportion
    df = spark.createDataFrame([(None if i % 3 else i, "w " * (i % 50) + str(i), "ab"[i % 2]) for i in range(3000)], "doc_id long, text string, source string")
    got = apportion.mix_sources(df).collect()
    assert len({(r.source, r["shard"]) for r in got if r.doc_id is None}) > apportion.LEAST_SHARDS
    for s in "ab":
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.02 * own[0].target and all(r.taken <= 2 * r.size for r in own)
    assert sorted(map(str, apportion.mix_sources(df.repartition(5)).collect())) == sorted(map(str, got))
