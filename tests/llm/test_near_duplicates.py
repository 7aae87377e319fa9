"""Near duplicates: drifted copies, one id with several texts, and the pipeline stage, against brute force over all pairs."""

import random
import re

import pytest

import corpus_pipeline
from quarry.llm import superminhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text, width):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def linked(a, b):
    return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)


def components(rows, width, by_id=True):
    """Smallest id reachable, per row; rows without id or words stand alone."""
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i
    for i, (x, _) in enumerate(rows):
        for k in range(i):
            if x is not None and rows[k][0] is not None and sets[i] and sets[k] and (linked(sets[i], sets[k]) or by_id and rows[k][0] == x):
                root[find(i)] = find(k)
    low = {}
    for i, (x, _) in enumerate(rows):
        if x is not None:
            low[find(i)] = min(low.get(find(i), x), x)
    return [low[find(i)] if x is not None else None for i, (x, _) in enumerate(rows)], [find(i) for i in range(len(rows))]


def drifted(n, seed, words=120, most=16):
    """Copies of one text with 0 to ``most`` words replaced, some edits shared: similarities on both sides of 0.8."""
    r = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    shared = {k: (r.sample(range(words), 4), f"s{k}") for k in range(6)}
    out = []
    for i in range(n):
        own = list(base)
        for at in r.sample(range(words), r.randint(0, most)):
            own[at] = f"x{i}.{at}"
        if r.random() < 0.5:
            places, word = shared[r.randrange(6)]
            for at in places:
                own[at] = word
        out.append((r.randrange(10**6), " ".join(own)))
    return out


@pytest.mark.parametrize("small,settled", [(32, 50), (2, 50), (2, 0)])
def test_a_group_around_the_threshold(spark, monkeypatch, small, settled):
    """Every link counts, whichever way the pairs that remain are found; with ``settled`` 0 one round of centres leaves most to the prefix join."""
    monkeypatch.setattr(superminhash, "SMALL", small)
    monkeypatch.setattr(superminhash, "SETTLED", settled)
    rows = drifted(150, 1) + drifted(60, 2, words=60, most=9) + [(-k, "a b c d e f") for k in range(1, 40)]
    got = {(r.doc_id, r.n_shingles): r.component_id for r in superminhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4), shingle_words=2).collect()}
    want, _ = components(rows, 2)
    assert all(got[(i, len(shingles(t, 2)))] == c for (i, t), c in zip(rows, want))
    sets = [shingles(t, 2) for _, t in rows[:150]]
    near = [len(a & b) / len(a | b) for k, a in enumerate(sets) for b in sets[:k]]
    assert sum(x >= 0.8 for x in near) > 100 < sum(0.7 < x < 0.8 for x in near)


def base(k, n=30):
    return " ".join(f"{k}{i}" for i in range(n))


def test_one_id_with_several_texts(spark):
    a, b = base("a"), base("b")
    rows = [(1, a), (5, a + " z"), (5, b), (7, b + " y"), (9, base("c")), (9, base("d")), (9, base("d")), (11, base("d") + " q"),
            (None, a), (12, None), (12, ""), (13, "one")]
    rows += [(20, base("e"))] * 50 + [(20, base("f"))] * 50 + [(21, base("f") + " t")]
    got = superminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=2).collect()
    want, _ = components(rows, 2)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == sorted(
        (str(i), len(shingles(t, 2)), str(c), i is None or i == c) for (i, t), c in zip(rows, want))
    assert {r.component_id for r in got if r.doc_id == 7} == {1}


def test_stage_keeps_one_text_of_each_group(spark):
    a, b = base("a"), base("b")
    rows = [(1, a), (5, a + " z"), (5, b), (7, b + " y"), (9, base("c")), (9, base("d")), (9, base("d")), (9, base("D")), (None, a), (None, None),
            (12, None), (12, None), (13, ""), (14, base("e")), (14, base("e")), (15, "two words"), (16, "two words")]
    rows += drifted(60, 3)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3)
    out = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    _, group = components(rows, 5, by_id=False)
    named = [(i, t, g) for (i, t), g in zip(rows, group) if i is not None and shingles(t, 5)]
    want = {g: min(i for i, _, h in named if h == g) for _, _, g in named}
    kept = [(i, t) for i, t in out if i is not None and shingles(t, 5)]
    of = {(i, t): g for i, t, g in named}
    assert sorted((of[x], x[0]) for x in kept) == sorted(want.items())
    assert sorted(str(x) for x in out if x[0] is None) == sorted(str(x) for x in rows if x[0] is None)
    assert sorted(str(x) for x in out if x[0] in (12, 13)) == ["(12, None)", "(13, '')"]


def test_components_of_paths_stars_and_rings(spark):
    from quarry.llm.components import connected_components
    r = random.Random(8)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(200 + i, 200 + (i + 1) % 17) for i in range(17)]
    links += [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(60)] + [(5, 5), (9, 8), (9, 8)]
    r.shuffle(links)
    root = {n: n for e in links for n in e}
    for _ in range(len(root)):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {n: c for n, c in root.items() if any(n in e and e[0] != e[1] for e in links)}
    assert {x.node: x.component for x in got} == want and len(got) == len(want)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
