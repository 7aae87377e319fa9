"""A third of all rows in one group of copies: results equal brute force,
and exact copies never turn into pairs."""

import random

from quarry.operators import similarity as sim
from quarry.operators.quality import duplicate_text

HOT = "The same boilerplate paragraph, copied again and again."


def _rows(n=600, seed=3):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta"]
    out = []
    for i in range(n):
        if i % 3 == 0:
            text = HOT if i % 2 else "  " + HOT.upper() + " "
        else:
            text = " ".join(rng.choice(words) for _ in range(rng.randint(3, 9)))
        out.append((i, text))
    return out


def test_duplicate_text_hot_group(spark):
    data = _rows()
    df = spark.createDataFrame(data, "id long, t string")
    key = {i: t.strip().lower() for i, t in data}
    first, prev, exp_first, exp_prev = {}, {}, set(), set()
    for i, _ in sorted(data):
        k = key[i]
        if k in first:
            exp_first.add((i, first[k]))
            exp_prev.add((i, prev[k]))
        else:
            first[k] = i
        prev[k] = i
    got_first = {tuple(r) for r in duplicate_text(df, "id", "t", holder="first").collect()}
    got_prev = {tuple(r) for r in duplicate_text(df, "id", "t", holder="previous").collect()}
    assert got_first == exp_first
    assert got_prev == exp_prev
    assert len([i for i, _ in data if key[i] == HOT.lower()]) == 200


def test_similarity_collapses_exact_copies(spark):
    data = _rows()
    df = spark.createDataFrame(data, "id long, t string")
    reps, members = sim.distinct_texts(df, "id", "t")
    # 200 copies of one text become one representative, mapped by id -> rep
    hot_ids = [i for i, t in data if t.strip().lower() == HOT.lower()]
    rep_of = {r["id"]: r["rep"] for r in members.collect()}
    assert {rep_of[i] for i in hot_ids} == {min(hot_ids)}
    assert members.count() == len(data)
    # the dedupe accepts the first copy and rejects every other copy by it
    out = {r["id"]: (r["accepted"], r["rejected_by"]) for r in sim.dedupe_in_order(df, "id", "t").collect()}
    assert out[min(hot_ids)][0] is True
    assert all(out[i] == (False, min(hot_ids)) for i in hot_ids if i != min(hot_ids))


def test_cohort_retention_hot_user(spark):
    from collections import Counter

    from pyspark.sql import functions as F

    from quarry.operators.windows import cohort_retention

    rng = random.Random(7)
    data = []
    for i in range(900):
        user = 0 if i % 3 == 0 else rng.randint(1, 40)  # user 0 holds a third of the events
        data.append((user if i % 50 else None, rng.randint(0, 11)))
    df = spark.createDataFrame(data, "u long, p long")
    got = {(r["cohort"], r["offset"]): r["users"] for r in cohort_retention(df, "u", F.col("p")).collect()}
    pairs = {(u, p) for u, p in data if u is not None}
    first = {}
    for u, p in pairs:
        first[u] = min(first.get(u, p), p)
    exp = Counter((first[u], p - first[u]) for u, p in pairs)
    assert got == dict(exp)
