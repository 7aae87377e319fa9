"""The ten operators against brute force, on small tables with nulls, ties, repeats and clashing columns."""

import base64
import hashlib
import math
import os
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import apportion, automaton, chat, containment, ftrl, katz, language, plans, secrets, superminhash, threshold
from quarry.llm.plans import held_out

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def docs(spark):
    r = np.random.default_rng(1)
    vocabulary = ["the", "of", "Wort", "été", "x", "loser", "ñu", "and", "in", "Zeit", "a.b", "ça"]
    rows = [(i, " ".join(r.choice(vocabulary, r.integers(1, 60))), "de" if i % 2 else "fr", f"s{i % 3}") for i in range(60)]
    rows += [(100, None, None, None), (101, "", "de", "s0"), (102, " \t\n", "fr", "s1"), (103, "one", None, None),
             (None, "the of the", "de", "s0"), (None, "the of the", "de", "s0")]
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    rows += [(200 + i, f"{base} tail{i % 3}", "de", "s0") for i in range(9)] + [(200, f"{base} tail0", "de", "s0")]
    rows += [(300, f"{'y' * 300_000} long {'the of ' * 30_000}", "de", "s1")]
    # columns with the names of results must not disturb
    return spark.createDataFrame([(*row, -1.0, 7, 3, "q") for row in rows],
                                 "doc_id long, text string, lang string, source string, score double, taken long, n_shingles long, w1 string").cache()


@pytest.fixture(scope="module")
def local(docs):
    return docs.select("doc_id", "text", "lang", "source").collect()


def empty(docs):
    return docs.where("false")


def test_token_counts(spark, docs, local, tmp_path):
    pieces = [b" the", b" t", b"the", b"he", b" of", "été".encode(), b"or", b"rt", b" lo", b"ser", b"ong", b" " + b"y" * 7, b"y" * 5]
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(p) + b" %d" % i for i, p in enumerate(pieces)))

    def greedy(word):
        n = 0
        while word:
            word = word[max([len(p) for p in pieces if word.startswith(p)], default=1):]
            n += 1
        return n
    got = sorted(map(tuple, automaton.token_counts(docs, str(path)).collect()), key=str)
    want = [(r.doc_id, len((r.text or "").encode().split()), sum(greedy(b" " + w) for w in (r.text or "").encode().split())) for r in local]
    assert got == sorted(want, key=str)
    assert automaton.token_counts(empty(docs), str(path)).count() == 0


def test_chat_round_trip_and_windows(spark):
    r = np.random.default_rng(2)
    texts = [r"\### Assistant: </turn> ok", "<turn user>", "a\\", "", None, "é\n<\\>", "word " * 40]
    rows = []
    for conv in range(30):
        for turn in range(int(r.integers(1, 25))):
            role = "system" if turn == 0 and conv % 2 else ["user", "assistant", None][r.integers(0, 3)]
            rows.append((conv, turn, role, texts[r.integers(0, len(texts))]))
    rows += [(None, 1, "user", "x"), (None, 2, "assistant", "y"), (7, 3, "assistant", "again")]
    df = spark.createDataFrame([(*x, 5) for x in rows], "conv_id long, turn long, role string, text string, tokens long")
    windows = chat.format_chats(df, budget=60, history_budget=20, history_turns=3)
    got = {r.conv_id: r for r in chat.digests(windows).collect()}
    by = defaultdict(list)
    for x in rows:
        by[x[0]].append(x)
    assert set(got) == set(by)
    for conv, turns in by.items():
        turns.sort(key=lambda x: (x[1], x[2] or "", x[3] or ""))
        digest = hashlib.sha256("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in turns).encode()).hexdigest()
        target = "".join(x[3] or "" for x in turns if x[2] == "assistant")
        assert (got[conv].n_turns, got[conv].turns_sha256, got[conv].loss_chars, got[conv].loss_sha256) == (
            len(turns), digest, len(target), hashlib.sha256(target.encode()).hexdigest())
    for w in windows.collect():
        parsed = chat.parse(w.formatted)
        assert len(parsed) == w.repeated + w.new and w.new >= 1
        assert w.tokens == sum(len(WORD.findall(t)) + chat.TURN_TOKENS for _, t in parsed)
        assert w.over_budget == (w.tokens > 60) and (not w.over_budget or w.new == 1)
        if w.window and by[w.conv_id][0][2] == "system":
            assert parsed[0][0] == "system"
    assert chat.digests(chat.format_chats(df.where("false"))).count() == 0


def test_language(spark, docs):
    r = np.random.default_rng(3)
    tongue = {"de": "schön über zeit nicht und wenn", "fr": "été ça voilà être avec pour", "en": "the which thought of with"}
    rows = [(i, " ".join(r.choice(tongue[x].split(), 20)), x) for i in range(240) for x in [list(tongue)[i % 3]]]
    df = spark.createDataFrame(rows + [(900, None, "de"), (901, "12 !!", "fr"), (902, "", None)], "doc_id long, text string, lang string")
    model = language.fit(df, ~held_out("doc_id", 4, 2), per_language=40, landmarks=8)
    got = {r.doc_id: r for r in language.predict(df, model).collect()}
    assert len(got) == 243 and all(got[i].lang_pred == x for i, _, x in rows) and all(0 <= v.score <= 1 for v in got.values())
    assert {got[i].lang_pred for i in (900, 901, 902)} == {"und"}
    assert language.fit(empty(docs), F.lit(True)) is None
    assert language.predict(docs, None).count() == docs.count()


def test_top_k(spark):
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in r.normal(size=5)]) for i in range(150)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5, 0.5]) for i in range(150, 260)] + [(100, [1.0] * 5), (100, rows[100][1])]
    bad = [(400, None), (500, [1.0, None, 1.0, 1.0, 1.0]), (600, [float("nan")] * 5), (700, [float("inf")] + [0.0] * 4), (None, [1.0] * 5)]
    rows += [(800, [0.0] * 5), (801, [1.0, 2.0]), (900, [3.0, 4.0]), (1000, [])]
    df = spark.createDataFrame([(*x, 3) for x in rows + bad], "vec_id long, embedding array<double>, rank int")
    old = threshold.CANDIDATE_BLOCK, threshold.QUERY_BLOCK
    threshold.CANDIDATE_BLOCK, threshold.QUERY_BLOCK = 64, 2
    try:
        got = threshold.top_k(df, F.col("vec_id") % 100 == 0).collect()
    finally:
        threshold.CANDIDATE_BLOCK, threshold.QUERY_BLOCK = old
    ints = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    want = []
    for n, (i, q) in enumerate(ints):
        if i % 100 == 0:
            found = sorted((-sum(map(int.__mul__, q, v)), j) for m, (j, v) in enumerate(ints) if m != n and len(v) == len(q))
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(found[:10])]
    assert sorted(map(tuple, got)) == sorted(want)
    assert threshold.top_k(df.where("false"), F.lit(True)).count() == 0


@pytest.mark.parametrize(("heavy", "bucket"), [(katz.HEAVY, katz.BUCKET), (0, katz.BUCKET), (30, 50)])
def test_katz(spark, docs, local, monkeypatch, heavy, bucket):
    """All keys broadcast; none; some, with many small buckets."""
    monkeypatch.setattr(katz, "BUCKET", bucket)
    learn = ~held_out("doc_id", 5, 1)
    got = katz.score(docs.repartition(5), learn, heavy=heavy, min_count=2).collect()
    tokens = lambda t: [*WORD.findall(lower(t)), None]
    train = [tokens(r.text) for r in local if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 != 1]
    c = Counter(w for t in train for w in t)
    total, distinct = sum(c.values()), len(c)
    p = lambda w: (c.get(w, 0) + 0.5) / (total + 0.5 * (distinct + 1))
    pairs, seen = Counter(), Counter()
    for t in train:
        for h, w in zip(["<s>", *t], t):
            pairs[h, w] += 1
            seen[h] += 1
    factor = katz.discounts(Counter(pairs.values()), 5, 2)
    after = defaultdict(dict)
    for (h, w), n in pairs.items():
        if n >= 2:
            after[h][w] = n * factor.get(n, 1.0)

    def probability(h, w):
        if h not in after:
            return p(w)
        kept = sum(after[h].values())
        below = seen[h] if seen[h] - kept > 1e-9 * seen[h] else seen[h] + 1
        return after[h][w] / below if w in after[h] else (1 - kept / below) / (1 - sum(map(p, after[h]))) * p(w)
    for h in after:
        assert abs(sum(probability(h, w) for w in c) + probability(h, "<other>") - 1) < 1e-9
    want = []
    for r in local:
        t = tokens(r.text)
        want.append((str(r.doc_id), len(t), sum(w in c for w in t), total, sum(math.log10(p(w)) for w in t),
                     sum(math.log10(probability(h, w)) for h, w in zip(["<s>", *t], t))))
    for a, b in zip(sorted((str(g[0]), *g[1:]) for g in got), sorted(want), strict=True):
        assert a[:4] == b[:4] and np.allclose(a[4:], b[4:], rtol=1e-9)
    assert katz.score(empty(docs), learn, heavy=heavy).count() == 0
    alone = katz.score(docs.limit(1), F.lit(False), heavy=heavy).first()
    assert (alone.n_known, alone.train_tokens) == (0, 0)


def test_katz_query_has_pairs_seen_once(spark, docs, local, monkeypatch):
    """The query's model holds every pair, those seen once with the Good-Turing discount of one."""
    monkeypatch.setattr(plans, "read_table", lambda *_: docs)
    got = plans.op5_katz_backoff(spark, "").collect()
    tokens = lambda t: [*WORD.findall(lower(t)), None]
    train = [tokens(r.text) for r in local if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 != 1]
    c = Counter(w for t in train for w in t)
    p = lambda w: (c.get(w, 0) + 0.5) / (sum(c.values()) + 0.5 * (len(c) + 1))
    pairs = Counter(pair for t in train for pair in zip(["<s>", *t], t))
    n = Counter(pairs.values())
    assert n[1]
    common = 6 * n[6] / n[1]
    good = {r: ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) if n[r] and common < 1 else 0 for r in range(1, 6)}
    factor = {r: d if 0 < d < 1 else (r - 0.5) / r for r, d in good.items()}
    after, seen = defaultdict(dict), Counter()
    for (h, w), k in pairs.items():
        after[h][w] = k * factor.get(k, 1.0)
        seen[h] += k

    def probability(h, w):
        if h not in after:
            return p(w)
        kept = sum(after[h].values())
        below = seen[h] if seen[h] - kept > 1e-9 * seen[h] else seen[h] + 1
        return after[h][w] / below if w in after[h] else (1 - kept / below) / (1 - sum(map(p, after[h]))) * p(w)
    for h in after:
        assert abs(sum(probability(h, w) for w in c) + probability(h, "<other>") - 1) < 1e-9
    want = [(str(r.doc_id), sum(math.log10(probability(h, w)) for h, w in zip(["<s>", *t], t))) for r in local for t in [tokens(r.text)]]
    for a, b in zip(sorted((str(r.doc_id), r.score) for r in got), sorted(want), strict=True):
        assert a[0] == b[0] and np.isclose(a[1], b[1], rtol=1e-9)


def test_sainte_lague_by_quotients():
    r = np.random.default_rng(5)
    for _ in range(40):
        votes, seats = r.integers(0, 50, r.integers(1, 12)), int(r.integers(0, 90))
        out, want = apportion.sainte_lague(votes, seats), np.zeros(len(votes), int)
        for _ in range(seats if votes.sum() else 0):
            want[max(range(len(votes)), key=lambda i: (Fraction(int(votes[i]), int(2 * want[i] + 1)), -i))] += 1
        assert out.tolist() == want.tolist()


def test_mix(docs, local):
    got = apportion.mix_sources(docs).collect()
    size = lambda t: len(WORD.findall(t or ""))
    own = Counter()
    for r in local:
        own[r.source] += size(r.text)
    names = sorted(own, key=lambda s: (s is None, s or ""))
    goal = apportion.targets([own[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], Fraction(3, 2) * sum(own.values()), 2)
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == own[r.source] and r.target == float(goal[names.index(r.source)])
        taken[r.source] += r.taken
    assert sum(goal) == Fraction(3, 2) * sum(own.values())
    assert all(abs(taken[s] - g) <= max(64, 0.05 * g) for s, g in zip(names, goal))
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(r.doc_id), size(r.text)) for r in local)
    assert sorted(map(str, apportion.mix_sources(docs.repartition(5)).collect())) == sorted(map(str, got))
    assert apportion.mix_sources(empty(docs)).count() == 0


def test_shards_held_at_their_repeats_deal_the_rest_again(spark):
    r = np.random.default_rng(9)
    for _ in range(60):
        sizes, blocks, most = r.integers(0, 40, r.integers(1, 30)), int(r.integers(0, 120)), int(r.integers(1, 4))
        out = apportion.shard_words(sizes, blocks, 16, most)
        assert (out <= most * sizes).all() and (out >= 0).all() and out.sum() == min(16 * blocks, most * sizes.sum())
        quota = apportion.sainte_lague(sizes, blocks) * 16
        assert (quota > most * sizes).any() or out.tolist() == quota.tolist()
    assert apportion.shard_words(np.full(25, 12), 38, 16, 2).tolist() == [24] * 25
    shard = spark.range(2000).select("id", F.pmod(F.xxhash64(F.lit(~11), "id", F.lit(12).cast("long"), F.xxhash64(F.lit("w " * 12))),
                                                  F.lit(apportion.LEAST_SHARDS)).alias("s")).collect()
    alone = list({x.s: x.id for x in shard}.values())[:25]
    df = spark.createDataFrame([(i, "w " * 12, "a") for i in alone] + [(5000 + i, "w " * 100, "b") for i in range(60)],
                               "doc_id long, text string, source string")
    got = [x for x in apportion.mix_sources(df).collect() if x.source == "a"]
    assert len({x["shard"] for x in got}) == 25 and {x.target for x in got} == {600.0}
    assert 600 - 16 < sum(x.taken for x in got) <= 600 and all(x.taken <= 24 for x in got)


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, docs, local, width):
    got = superminhash.near_duplicates(docs, shingle_words=width).collect()

    def shingles(t):
        w = WORD.findall(lower(t))
        return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    sets = [(r.doc_id, shingles(r.text)) for r in local]
    label = {i: i for i, _ in sets if i is not None}
    changed = True
    while changed:
        changed = False
        for i, a in sets:
            for j, b in sets:
                if None not in (i, j) and a and b and 100 * len(a & b) >= 80 * len(a | b) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    want = [(i, len(s), label.get(i), i is None or label[i] == i) for i, s in sets]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert superminhash.near_duplicates(empty(docs)).count() == 0


def test_superminhash_estimates_similarity():
    r = np.random.default_rng(6)
    x = r.integers(0, 2 ** 63, 1200).astype(np.uint64)
    for n in (40, 1000):
        a, b = x[:n], x[n // 5:n + n // 5]
        sig = superminhash.signatures(np.concatenate([a, b]), np.array([0, n, 2 * n]), 400)
        assert abs((sig[0] == sig[1]).mean() - 4 / 6) < 0.09


def test_toxicity(spark):
    r = np.random.default_rng(7)
    plain = [f"w{i}" for i in range(50)]
    rows = []
    for i in range(600):
        t = list(r.choice(plain, 30))
        if i % 3 == 0:
            t.insert(int(r.integers(0, 30)), "Scum")
        rows.append((i, " ".join(t), int(i % 3 == 0)))
    df = spark.createDataFrame([(i, t, -1.0) for i, t, _ in rows] + [(700, None, 0.0), (701, "", 0.0), (None, "scum", 0.0)],
                               "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(1, None), (2, 5), (0, 0), (None, 1)], "doc_id long, toxic int")
    model = ftrl.fit(df, labels.where(~held_out("doc_id", 4, 2)))
    got = {r.doc_id: r for r in ftrl.score(df, model).collect()}
    aside = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i].predicted == y for i, y in aside) >= 0.97 * len(aside)
    assert got[700].score == got[701].score and len(got) == 603 and all(0 <= g.score <= 1 for g in got.values())
    assert len(model.index) < 1000
    none = ftrl.fit(df, labels.where("false"))
    assert ftrl.score(df, none).count() == 603


def test_toxicity_memory(spark, monkeypatch):
    """A carried text goes to the worker once and rows come back in small batches; the learner reads its weights by block."""
    rows = [(i, f"w{i} " + "fine words here " * 1500 if i % 9 else None, f"t{i}") for i in range(200)] + [(None, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tag string")
    given = []
    kind = type(df)
    monkeypatch.setattr(kind, "mapInArrow", lambda self, run, *a, f=kind.mapInArrow, **b: given.append((self, run)) or f(self, run, *a, **b))
    model = ftrl.learn([(np.arange(50), 1), (np.arange(40, 90), 0)] * 3, 20, l1=0.1)
    got = ftrl.score(df, model, carry=df.columns)
    slim, run = given[0]
    table = slim.toArrow().combine_chunks()
    assert table.nbytes < 1.2 * sum(len(t or "") for _, t, _ in rows)
    parts = list(run(iter(table.to_batches())))
    assert len(parts) > 5 and max(p.num_rows for p in parts) < 60
    back = ftrl.pa.Table.from_batches(parts).column("_row").to_pylist()
    assert [(r["doc_id"], r["text"], r["tag"]) for r in back] == rows
    assert sorted(map(str, got.select("row.*").collect())) == sorted(map(str, df.collect()))
    plain = {r.doc_id: (r.score, r.predicted) for r in ftrl.score(df, model).collect()}
    assert plain == {r.row.doc_id: (r.score, r.predicted) for r in got.collect()}
    other = ftrl.score(df, model, carry=["tag"])  # the text is not among them
    assert other.columns == ["row", "score", "predicted"] and sorted(r.score for r in other.collect()) == sorted(s for s, _ in plain.values())

    tracemalloc.start()
    ftrl.learn([(np.arange(5), 1)], 20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20  # its state alone is 20 MB
    assert 10_000 * ftrl.PIECE * 4 <= 16 << 20  # features of one batch of Spark's rows


def test_toxicity_learns_in_one_task(spark, monkeypatch):
    """Long texts come to the learner in pieces, in a fixed order, and the driver gets the weights alone."""
    r = np.random.default_rng(8)
    rows = [(i, " ".join(f"v{x}" for x in r.integers(0, 300, 40)) + " scum" * (i % 2)) for i in range(80)]
    rows += [(90, None), (91, ""), (92, " ".join(f"long{x}" for x in range(20_000))), (3, rows[3][1]), (3, "another v1 v2")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(93)], "doc_id long, toxic int")
    sent = []
    kind = type(df)
    monkeypatch.setattr(kind, "toArrow", lambda self, f=kind.toArrow: sent.append(f(self)) or sent[-1])
    model = ftrl.fit(df, labels, l1=0.5)
    assert sum(t.nbytes for t in sent) <= 32 * (len(model.index) + 8)
    bits, size = 20, 1 << 20
    texts = [(i, ftrl.words(ftrl.pa.array([t], "string"))) for i, t in rows]
    own = {k: (i, np.unique(np.concatenate([ftrl.features(p, bits)[1] for p in parts]))) for k, (i, parts) in enumerate(texts)}
    turn = {(x.epoch, x.id): x.h for x in spark.range(93).selectExpr("id", "explode(sequence(1, 3)) AS epoch")
            .withColumn("h", F.xxhash64(F.lit(3), "epoch", "id")).collect()}
    order = [(own[k][1], own[k][0] % 2) for e in (1, 2, 3) for k in sorted(own, key=lambda k: (turn[e, own[k][0]], len(own[k][1])))]
    want = ftrl.learn(order, bits, l1=0.5)
    assert len(model.index) > 50 and model.index.tolist() == want.index.tolist()
    assert np.allclose(model.weight, want.weight) and np.isclose(model.bias, want.bias) and model.index.max() < size


def test_secret_spans(spark):
    texts = ["password = abcdefgh1", "é TOKEN:'aaaaaaaa' api_key=short", "secret: token = abcdefgh123", None, "",
             "AKIAABCDEFGHIJKL end AKIAAB", "0" * 31 + " " + "f" * 40, "pwd is password1", "pwd is q8$Zx!w0Lk#1", "Kelvin paſſword=12345678",
             "://u:q8$Zx!w0Lk@host", "password=" + "Z9-x" * 20_000]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[0], "x")], "doc_id long, text string, spans string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secrets.scan(df).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        want = [("assign", m.start(), m.end()) for m in re.finditer(
            r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 8]
        want += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        want += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        assert [s for s in got[i] if s[0] != "guess"] == sorted(want, key=lambda s: (s[1], secrets.KINDS.index(s[0])))
    assert [s[0] for s in got[8]] == ["guess"] and got[7] == [] and [s[0] for s in got[10]] == ["guess"]
    assert secrets.scan(df.where("false")).count() == 0
    clean = secrets.scan(df).where("doc_id = 0").first().redacted
    assert clean == "[SECRET]"


def test_guess_cost_is_the_cheapest_segmentation():
    def brute(value):
        found = secrets.pieces(value)
        def best(end):
            return 0.0 if not end else min([best(end - 1) + secrets.char_cost(value[end - 1])] + [best(a) + c for a, c in found.get(end, [])])
        return best(len(value))
    for value in ["password1", "P@ssword", "qwerty12", "aaaaaaaa", "19991231x", "zxcvsummer", "x7$K"]:
        assert abs(secrets.guess_cost(value) - brute(value)) < 1e-9
    assert secrets.guess_cost("password") < 2 < secrets.guess_cost("xq7Zk2")


def test_contamination(spark, docs, local):
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta iota"), (2, "one"), (3, None), (4, "  "), (5, "the of"),
             (6, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda WRONG words here"), (None, "one"), (7, "ALPHA beta gamma delta epsilon")]
    table = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, common long")

    def runs(t, k):
        w = WORD.findall(lower(t))
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    own = defaultdict(set)
    for r in local:
        if r.doc_id is not None:
            own[r.doc_id].update(*(runs(r.text, k) for k in range(1, 6)))
    want = []
    for i, t in items:
        k = min(5, len(WORD.findall(lower(t))))
        s = runs(t, k) if k else set()  # an item of fewer words is one run of its own width
        if i is not None and s:
            want += [(d, i, len(s), len(s & x)) for d, x in own.items() if 100 * len(s & x) >= 80 * len(s)]
    got = containment.contaminated(docs, table).collect()
    assert sorted(tuple(r)[:4] for r in got) == sorted(want) and want
    assert containment.contaminated(empty(docs), table).count() == 0
    assert containment.contaminated(docs, table.where("false")).count() == 0


def test_katz_model_entries_travel_packed_and_chunks_leave_nothing_behind():
    """A row holds many entries of a bucket; hashing takes little beside the text."""
    import tracemalloc

    import pyarrow as pa

    from quarry.llm.tokens import words
    r = np.random.default_rng(5)
    h, w, v = r.integers(-2**63, 2**63, 5000), r.integers(-2**63, 2**63, 5000), r.random(5000)
    alone = np.arange(5000) % 3 == 0
    key = np.where(alone, h, katz.pair_key(h.view(np.uint64), w.view(np.uint64)).view(np.int64))
    batches = [pa.RecordBatch.from_arrays([pa.array(x[i:i + 1000], mask=m[i:i + 1000]) for x, m in ((h, ~alone & False), (w, alone), (v, ~alone & False), (-v, ~alone & False))],
                                          ["h", "w", "v", "base"]) for i in range(0, 5000, 1000)]
    rows = [row for b in katz._model_rows(8)(batches) for row in b.to_pylist()]
    assert len(rows) == 8 and sorted(row["slot"] for row in rows) == list(range(0, 16, 2))
    found = {}
    for row in rows:
        keys = katz._from_planes(row["keys"], np.uint64)
        assert (katz.bucket_of(keys, 8) * 2 == row["slot"]).all()
        found |= dict(zip(keys.view(np.int64).tolist(), zip(katz._from_planes(row["texts"], float).tolist(), katz._from_planes(row["ns"], float).tolist())))
    assert found == {k: (x, -x) for k, x in zip(key.tolist(), v.tolist())}
    part = next(words(pa.array(["some words " * 300_000]), 4 << 20))
    whole = part.hashes()
    tracemalloc.start()
    again, peak = part.hashes(), tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 << 20 and (again == whole).all() and len(np.unique(whole)) == 2


def test_katz_by_chunks_and_scratch_size(spark, docs):
    """However texts are cut into chunks, scores are the same; what the result reads from scratch is well below its texts."""
    def scored(rows, min_count=1):
        out = katz.score(rows, F.col("doc_id") % 3 != 0, min_count=min_count)
        return out, sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in out.collect())
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    r = np.random.default_rng(6)
    names = np.array([f"w{i:05d}" for i in range(20_000)])
    made = spark.createDataFrame([(i, " ".join(names[r.integers(0, 20_000, 2000)])) for i in range(100)], "doc_id long, text string").repartition(2).cache()
    size = made.agg(F.sum(F.length("text"))).first()[0]
    try:
        wholes = [scored(docs.coalesce(1), 1), scored(docs.coalesce(1), 2), scored(made)]
        spark.conf.set(key, "3")
        cut = [scored(docs.coalesce(1), 1), scored(docs.coalesce(1), 2), scored(made)]
    finally:
        spark.conf.set(key, before)
    for (_, a), (_, b) in zip(wholes, cut, strict=True):
        assert [x[:4] for x in a] == [x[:4] for x in b] and np.allclose([x[4:] for x in a], [x[4:] for x in b], rtol=1e-9)
    files = [f.removeprefix("file:") for f in wholes[2][0].inputFiles()]
    assert files and sum(os.path.getsize(f) for f in files) < 0.7 * size


def test_katz_keys_travel_in_few_bytes():
    """A chunk's keys with their counts: less than 8 bytes each, and all of them."""
    import pyarrow as pa
    r = np.random.default_rng(7)
    texts = [" ".join(f"w{i}" for i in r.zipf(1.3, 500) % 50_000) for _ in range(400)]
    rows = pa.RecordBatch.from_arrays(
        [pa.array([5]), *(pa.array([katz._planes(x)], pa.binary()) for x in (
            np.arange(400) % 4 > 0, np.array([len(t) for t in texts]), np.frombuffer("".join(texts).encode(), np.uint8)))],
        ["at", "learn", "sizes", "texts"])
    sent = [row for b in katz._key_rows(16)([rows]) for row in b.to_pylist()]
    pairs, tokens = Counter(), Counter()
    for i, t in enumerate(texts):
        known = [None, *t.split(), ""]
        pairs.update(dict.fromkeys(zip(known, known[1:]), 0))
        tokens.update(dict.fromkeys(known, 0))
        if i % 4:
            pairs.update(zip(known, known[1:]))
            tokens.update(known)
    for kind, want in ((0, tokens), (1, pairs)):
        mine = [x for x in sent if x["slot"] % 2 == kind]
        n = np.concatenate([katz._from_planes(x["ns"], np.int64) for x in mine])
        assert sorted(n.tolist()) == sorted(want.values())
        keys = np.concatenate([np.cumsum(katz._from_planes(x["keys"], np.uint64), dtype=np.uint64) for x in mine])
        assert len(np.unique(keys)) == len(keys) == len(want)
    assert sum(len(x["keys"]) + len(x["ns"]) for x in sent) < 8 * (len(pairs) + len(tokens))
