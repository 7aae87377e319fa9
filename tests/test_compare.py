"""Tolerant comparison against pairing by search."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import compare
from quarry.operators.quality import agreement

EPS = 1e-6


def equal(x, y):
    if x is None or y is None:
        return x is None and y is None
    try:
        a, b = float(x), float(y)
        return a == b or abs(a - b) < EPS or (a != a and b != b)
    except ValueError:
        return str(x).strip() == str(y).strip()


def pairable(a, b):
    """Largest pairing of equal rows, by augmenting paths."""
    mate = {}

    def place(i, seen):
        for k, row in enumerate(b):
            if k not in seen and all(map(equal, a[i], row)):
                seen.add(k)
                if k not in mate or place(mate[k], seen):
                    mate[k] = i
                    return True
        return False
    return sum(place(i, set()) for i in range(len(a)))


def counts(spark, a, b, types="t string, x double, y string"):
    row = compare.tolerant_agreement(spark.createDataFrame(a, types), spark.createDataFrame(b, types)).first()
    return row["only_a"], row["only_b"], row["agree"]


def test_noise_text_and_specials(spark):
    a = [("a", 0.3, "1.50"), (" b ", 1e40, None), ("c", float("nan"), "x"), ("c", None, " inf"), ("d", -0.0, "1e3"), ("a", 0.3, "1.5"),
         ("e", 17179869184.0, "12abc"), ("f", 1.0, "1d")]
    b = [("a ", 0.1 + 0.2, "1.5"), ("b", 1e40, None), ("c", float("nan"), "x "), ("c", None, "Infinity"), ("\td", 0.0, " 1000 "), ("a", 0.3, "1.5000000001"),
         ("e", 17179869184.0, "12abc\n"), ("f", 1.0, "1d")]
    assert counts(spark, a, b) == (0, 0, True)
    assert counts(spark, a + [("z", 1.0, None)], b) == (1, 0, False)
    assert counts(spark, [("a", 1.0, "")], [("a", 1.0, None)]) == (1, 1, False)
    assert counts(spark, [("f", 1.0, "1d")], [("f", 1.0, "1")]) == (1, 1, False)
    assert counts(spark, [("e", 1e40, "")], [("e", 1.0000000000000001e40 * (1 + 1e-15), "")]) == (1, 1, False)
    assert counts(spark, [], []) == (0, 0, True)
    assert counts(spark, a, []) == (len(a), 0, False)


@pytest.mark.parametrize("seed", range(4))
def test_random_multisets(spark, seed):
    """Noise, repeats and one column whose values form chains wider than the tolerance."""
    r = random.Random(seed)
    pool = [0.0, 1.0, 2.5, 1e20, None]

    def noisy(v):
        return v if v is None else v + r.choice([0, 1e-7, -1e-7, 3e-8])

    base = [(r.choice("pq"), r.choice(pool), r.choice(["5", "x", None])) for _ in range(40)]
    a = [(t, noisy(x), y) for t, x, y in base] + [("chain", 100 + i * 7e-7, "1") for i in range(6)]
    b = [(f" {t}", noisy(x), y) for t, x, y in base] + [("chain", 100 + i * 7e-7 + 5e-7, "1") for i in range(6)]
    r.shuffle(b)
    assert counts(spark, a, b) == (0, 0, pairable(a, b) == len(a)) == (0, 0, True)
    b[3] = ("other", 1.0, "5")
    got = counts(spark, a, b)
    assert not got[2] and got[0] >= len(a) - pairable(a, b) > 0


def test_rank_pairing_of_a_chain_beside_noise(spark):
    """The chained column decides the order, not the noise in another column."""
    a = [("k", 5 + 1e-8 * i, str(i * 9e-7)) for i in range(8)]
    b = [("k", 5 - 1e-8 * i, str(i * 9e-7 + 2e-7)) for i in range(8)]
    assert counts(spark, a, b) == (0, 0, True)


def test_hot_rows_are_counted_not_paired(spark):
    a = spark.range(30_000).select((F.col("id") % 3 * 0.1 + 0.2).alias("x"))
    b = spark.range(30_000).select((F.col("id") % 3 * 0.1 + 0.1 + 0.1).alias("x"))
    assert tuple(agreement(a, b).first()) == (True, 0, 0)
    assert tuple(agreement(a, b.limit(29_999)).first())[1:] == (1, 0)
    assert tuple(agreement(a, b.toDF("y")).first()) == (False, None, None)
    assert agreement(a.toDF("X"), b).first()["agree"]


def test_ordered(spark):
    a = spark.createDataFrame([(1, 0.3, "a"), (2, 1.0, "b"), (3, None, "c"), (4, 2.0, None)], "pos long, x double, s string")
    b = spark.createDataFrame([(1, "0.30000000000000004", "a "), (2, "1.1", "B"), (3, None, "c"), (5, "1", "")], "pos long, y string, t string")
    got = {r["pos"]: (r["side"], r["columns"]) for r in compare.tolerant_ordered(a, b, "pos").collect()}
    assert got == {2: ("both", [1, 2]), 4: ("only_a", None), 5: ("only_b", None)}


@pytest.mark.parametrize("rows_per_block", [3, 7, 1000])
def test_islands_over_blocks(spark, rows_per_block):
    """Islands that begin, go on and end at block borders; equal values over several blocks."""
    rng = random.Random(rows_per_block)
    x0 = [round(rng.uniform(0, 3), 1) + rng.choice([0, 4e-7, 8e-7, 1.2e-6]) for _ in range(60)] + [5.0] * 20 + [None] * 3
    rows = [(i, v, None if i % 5 == 0 else float(i // 4)) for i, v in enumerate(x0)]
    numbered, wide = compare._islands(spark.createDataFrame(rows, "id long, x0 double, x1 double"), 2, EPS, rows_per_block)
    got, far = {}, {tuple(r) for r in wide.collect()}
    for r in numbered.collect():
        got.setdefault((r["pos"], r["island"]), set()).add(r["id"])
    want, want_far = set(), set()
    for pos in (0, 1):
        now, last, first = [], None, None
        for v, i in sorted((r[1 + pos], r[0]) for r in rows if r[1 + pos] is not None) + [(None, None)]:
            if now and (v is None or v - last >= EPS):
                want.add((pos, frozenset(now)))
                if last - first >= EPS:
                    want_far.add((pos, frozenset(now)))
                now = []
            first = v if not now else first
            now, last = [*now, i], v
    assert {(pos, frozenset(ids)) for (pos, _), ids in got.items()} == want
    assert {(pos, frozenset(got[pos, island])) for pos, island in far} == want_far and want_far


def test_numbers_are_sorted_once(spark, monkeypatch):
    """The split points of the numbers are planned once, whatever the rows of a block."""
    planned = []
    monkeypatch.setattr(compare, "plan_blocks", lambda *a, f=compare.plan_blocks: planned.append(a) or f(*a[:3], 4))
    a = spark.createDataFrame([(float(i), f"{i}.5") for i in range(20)], "x double, y string")
    b = a.select((F.col("x") + 3e-7).alias("x"), "y").where("x < 18")
    assert sorted(r["nums"][0] for r in compare.tolerant_rows(a, b).collect()) == [18.0, 19.0] and len(planned) == 1
