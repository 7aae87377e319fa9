"""Similarity join and accept-as-you-go against brute force."""

import difflib
import random
import re

from conftest import rows
from quarry.operators import similarity as sim


def norm(s):
    return re.sub(r"[^a-z0-9 ]", "", (s or "").lower()).strip()


def brute_pairs(a, b):
    out = set()
    for i, x in a:
        for j, y in b:
            nx, ny = norm(x), norm(y)
            if nx == ny or difflib.SequenceMatcher(None, nx, ny).ratio() >= 0.85:
                out.add((i, j))
    return out


TITLES = [
    (1, "Top Earners per Department"), (2, "top earners per department!"),   # equal after normalising
    (3, "Top Earner per Departments"),                                        # just above 0.85
    (4, "Top Earners by Region"),                                             # below
    (5, "ab"), (6, "ab"), (7, "a"), (8, ""), (9, "  "),                       # very short / empty
    (10, "Rolling Average of Sales"), (11, "Rolling Averages of Sale"), (12, "Running Total of Sales"),
]


def test_title_pairs_two_sided(spark):
    a = spark.createDataFrame(TITLES[:6], "id long, t string")
    b = spark.createDataFrame([(i + 100, t) for i, t in TITLES], "id long, t string")
    got = {(r.id_a, r.id_b) for r in sim.near_duplicates(a, "id", "t", b, "id", "t").collect()}
    ra = {}
    for i, t in TITLES[:6]:
        ra.setdefault(norm(t), i)
    rb = {}
    for i, t in TITLES:
        rb.setdefault(norm(t), i + 100)
    exp = brute_pairs([(i, n) for n, i in ra.items()], [(i, n) for n, i in rb.items()])
    assert got == exp
    assert (1, 103) in got and (1, 104) not in got


def test_random_strings_match_brute_force(spark):
    rnd = random.Random(5)
    base = ["".join(rnd.choice("abc de") for _ in range(rnd.randint(3, 30))) for _ in range(60)]
    items = []
    for i, s in enumerate(base):
        items.append((i, s))
        if i % 2 == 0:  # a mutated near copy
            t = list(s)
            for _ in range(max(1, len(t) // 10)):
                t[rnd.randrange(len(t))] = rnd.choice("abc de")
            items.append((1000 + i, "".join(t)))
    df = spark.createDataFrame(items, "id long, t string")
    got = {(r.id_a, r.id_b) for r in sim.near_duplicates(df, "id", "t").collect()}
    reps = {}
    for i, t in sorted(items):
        reps.setdefault(norm(t), i)
    ids = sorted(reps.values())
    inv = {i: n for n, i in reps.items()}
    exp = set()
    for x in range(len(ids)):
        for y in range(x):
            i, j = ids[x], ids[y]
            if difflib.SequenceMatcher(None, inv[i], inv[j]).ratio() >= 0.85:
                exp.add((i, j))
    assert got == exp


def test_accept_in_order_matches_sequential(spark):
    items = [(1, "alpha beta gamma"), (2, "alpha beta gamm"), (3, "delta epsilon"), (4, "alpha beta gamma"),
             (5, "delta epsilo"), (6, "zeta"), (7, "alpha beta gam")]
    df = spark.createDataFrame(items, "id long, t string")
    got = {r.id: (r.accepted, r.rejected_by) for r in sim.dedupe_in_order(df, "id", "t").collect()}
    accepted, exp = [], {}
    for i, t in items:
        by = next((j for j, n in accepted if n == norm(t) or difflib.SequenceMatcher(None, norm(t), n).ratio() >= 0.85), None)
        if by is None:
            accepted.append((i, norm(t)))
        exp[i] = (by is None, by)
    assert got == exp


def test_blocking_bound_is_integer_exact(spark):
    df = spark.createDataFrame([(10,), (3,), (23,)], "m int")
    out = rows(df.select("m", sim.overlap_bound(df["m"]).alias("c")))
    assert out == [(10, 3), (23, 9), (3, 1)] or sorted(out) == sorted([(10, 3), (23, 9), (3, 1)])


def test_null_texts_stay(spark):
    """Four rows in, four rows out: NULL texts are empty texts, the first accepted, the second rejected by it."""
    df = spark.createDataFrame([(1, "alpha beta"), (2, None), (3, None), (4, "")], "id long, t string")
    got = {r.id: (r.accepted, r.rejected_by) for r in sim.dedupe_in_order(df, "id", "t").collect()}
    assert got == {1: (True, None), 2: (True, None), 3: (False, 2), 4: (False, 2)}
    members = sim.distinct_texts_two(df, "id", "t", df, "id", "t")
    assert [m.count() for m in members] == [2, 2]


def test_pruning_is_lossless_over_lengths(spark):
    """Texts of very different lengths, some on the edge of the length band and of the character bound."""
    rnd = random.Random(11)
    items = []
    for i in range(40):
        s = "".join(rnd.choice("abcdefgh 12") for _ in range(rnd.choice([4, 7, 12, 20, 23, 27, 31, 60, 85, 115, 180])))
        items.append((i, s))
        cut = max(1, len(s) * rnd.choice([1, 5, 13, 14]) // 100)
        items.append((100 + i, s[:-cut]))
        items.append((200 + i, s + s[:cut * 2]))
    df = spark.createDataFrame(items, "id long, t string")
    got = {(r.id_a, r.id_b) for r in sim.near_duplicates(df, "id", "t").collect()}
    reps = {}
    for i, t in sorted(items):
        reps.setdefault(norm(t), i)
    inv = sorted((i, n) for n, i in reps.items())
    exp = {(i, j) for i, x in inv for j, y in inv if i > j and difflib.SequenceMatcher(None, x, y).ratio() >= 0.85}
    assert got == exp and len(exp) > 60


def test_bigrams_of_a_long_text(spark):
    text = ("lorem ipsum dolor " * 6000)[:100_000].strip()
    df = spark.createDataFrame([(1, text, len(text))], "id long, norm string, len int")
    tokens = sim.bigram_tokens(df)
    assert tokens.count() == len(text) - 1 and tokens.select("tok").distinct().count() == len(text) - 1
