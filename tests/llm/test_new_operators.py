"""Sharding and spelling variants against brute force, with nulls, ties, repeats, long texts and clashing columns."""

import random
import re
import zlib
from collections import Counter

import pytest

from quarry.llm import spelling, splitters

RUN = re.compile("[A-Za-zÀ-ÿ]+")


# ---------------------------------------------------------------- sharding

def shard_rows(n, seed):
    r = random.Random(seed)
    rows = [(i, "é" * r.randint(0, 40) + f" {i}") for i in range(n)]
    rows += [(10_000 + i, "a hot text that a third of all rows hold") for i in range(n // 2)]
    rows += [(20_000 + i, f"pair {i // 2} " + "x" * 20) for i in range(60)]
    return rows + [(None, "no id")] * 3 + [(30_000, None), (30_001, ""), (30_002, "y" * 5_000), (30_003, "twice"), (30_003, "twice")]


@pytest.mark.parametrize("shards", [1, 8])
def test_shards(spark, shards):
    rows = shard_rows(3000, 1)
    df = spark.createDataFrame([(*x, -1, "q", 9) for x in rows], "doc_id long, text string, size int, shard string, slot int").repartition(7)
    got = splitters.shard_documents(df, shards=shards, rows_per_range=50).collect()
    size = {x: len((x[1] or "").encode()) + 1 for x in rows}
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((x[0], size[x], zlib.crc32((x[1] or "").encode())) for x in rows)
    total = sum(len((t or "").encode()) + 1 for _, t in rows)
    held, slots = Counter(), {}
    for r in got:
        held[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert set(held) == set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(abs(b - total / shards) for b in held.values()) <= 5_001 + 0.02 * total / shards
    # equal texts lie together unless they hold more than a shard can take
    text = {x[0]: x[1] or "" for x in rows if x[0] is not None}
    by = {}
    for r in got:
        if r.doc_id is not None:
            by.setdefault(text[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for t, s in by.items() if "hot" not in t)
    if shards == 8:
        assert len(by["a hot text that a third of all rows hold"]) >= 2


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    """With one sampled record a range the first splitters are poor; the result is the same."""
    df = spark.createDataFrame(shard_rows(400, 2), "doc_id long, text string")
    df = df.where("doc_id is not null and doc_id <> 30003")
    want = {tuple(r) for r in splitters.shard_documents(df).collect()}
    rounds = []
    cut = splitters._cuts
    monkeypatch.setattr(splitters, "_cuts", lambda *a: rounds.append(1) or cut(*a).limit(3))
    got = {tuple(r) for r in splitters.shard_documents(df).collect()}
    assert got == want and len(rounds) > 2


def test_shards_of_few_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert splitters.shard_documents(empty).count() == 0
    df = spark.createDataFrame([(1, "a" * 9, "k"), (2, "b" * 9, "k"), (None, None, None)], "doc_id long, text string, size string")
    splitters.write_shards(df, str(tmp_path / "out"), shards=2, rows_per_file=1)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id or 0, r.text, r.size) for r in back.collect()) == [(0, None, None), (1, "a" * 9, "k"), (2, "b" * 9, "k")]
    assert {r.shard for r in back.select("shard").collect()} == {0, 1}


# ---------------------------------------------------------------- spelling

def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def counted(rows, drop_every=None, min_length=6, min_count=5):
    n = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if c >= min_count and len(w) >= min_length}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(n):
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {(w, n[w], len(near[w]), form[w], form[w] and n[form[w]], root(w)) for w in n}


def spelt(seed, words=400):
    r = random.Random(seed)
    base = ["".join(r.choice("abcdeéÿ÷st") for _ in range(r.randint(6, 9))) for _ in range(words // 8)]
    base += ["a" * k for k in range(6, 12)] + ["ab" * 4, "ba" * 4, "abababab"[::-1]]
    out = []
    for k, w in enumerate(base):
        out += [w] * (5 ** r.randint(1, 3))
        for _ in range(7):
            i, x = r.randrange(len(w)), r.choice("abcdeéÿ÷st")
            out += [r.choice([w[:i] + w[i + 1:], w[:i] + x + w[i:], w[:i] + x + w[i + 1:]])] * r.choice([4, 5, 6, 30])
    r.shuffle(out)
    rows = [(i, " ".join(w.upper() if k % 5 == 0 else w for k, w in enumerate(out[i::50]))) for i in range(50)]
    rows += [(None, "nulled nulled nulled nulled nulled"), (60, None), (61, ""), (62, "12 !"), (63, "y" * 20_000 + " " + "z" * 20_000)]
    return rows + [(64, "again " * 3), (64, "again " * 3)] + [(65, ("q" * 3000 + " ") * 5 + ("q" * 3001 + " ") * 30)]


@pytest.mark.parametrize("limit,drop", [(4096, 199), (3, 7), (1, None)])
def test_variants(spark, limit, drop):
    rows = spelt(limit)
    df = spark.createDataFrame([(*x, 5, "w") for x in rows], "doc_id long, text string, n int, word string").repartition(4)
    got = [tuple(r) for r in spelling.spelling_variants(df, drop_every=drop, limit=limit).collect()]
    want = variants(counted(rows, drop))
    assert len(got) == len(want) and set(got) == want
    assert any(w[3] for w in want) and any(w[2] > 1 for w in want)


def test_a_leaf_dealt_out_by_halves(spark):
    """Many words of equal letter counts: found pairs are those of brute force, each once."""
    r = random.Random(9)
    words = {"".join(r.sample("aabbccddeeff", 12)) for _ in range(300)}
    words |= {w[:i] + "x" + w[i:] for w in list(words)[:80] for i in (0, 5, 11)} | {"b" + w[1:] for w in list(words)[:80]}
    n = {w: k + 5 for k, w in enumerate(sorted(words))}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    pairs = [(p.a, p.b) for p in spelling.near_pairs(df, limit=2).collect()]
    want = {frozenset((a, b)) for a in n for b in n if a < b and one_edit(a, b)}
    assert len(pairs) == len(want) and {frozenset(p) for p in pairs} == want


def test_no_words(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(df).count() == 0
