"""Conversation repair against a search over all edit sequences."""

import hashlib
import heapq
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from quarry.llm import plans, repair

SCHEMA = "conv_id long, turn long, role string, text string, cost long, audit string"
FULL = re.compile(r"[^\x20\x09-\x0D]")
EMPTY = hashlib.sha256(b"").hexdigest()


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def searched(rows):
    """Cheapest edits of ``(role, text, fault)`` rows, least audit first, by uniform-cost search over audits."""
    allowed = re.compile(r"(s?(ua)*u?)?\Z")
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, initials, out = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", initials):
            return cost, audit, out
        tail = initials[-1:]
        if (i, tail, bool(initials)) in seen:
            continue
        seen.add((i, tail, bool(initials)))

        def go(c, letter, k, role, text):
            more = initials + role[:1]
            if allowed.match(more):
                heapq.heappush(heap, (cost + c, audit + letter, k, more, (*out, (role, text))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, initials, out))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] in ("s", "u", "a"):
                    go(extra, "K", i + 1, role, text)
                for r in ("user", "assistant"):
                    go(2 + extra, "R", i + 1, r, text)
        for r in ("user", "assistant"):
            go(2, "I", i, r, "")


def expected(rows, ids):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    out = {}
    for conv in ids:
        own = sorted(by[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, judged = set(), []
        for _, _, role, text in own:
            full = FULL.findall(text)
            fault = "blank" if not full else "duplicate" if (role, text) in seen else "truncated" if full[-1] not in ".!?" else None
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [r[1] for r in own if r[1] is not None]
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, repaired = searched(judged) if own else (0, "", ())
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                     *(sum(f == k for *_, f in judged) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def table(done, ids):
    return {r[0]: tuple(r)[1:] for r in repair.repair_report(ids, done).collect()}


def made_up(n, seed):
    r = np.random.default_rng(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "umpire", "user", "assistant", "user", "assistant"]
    texts = ["one.", "two!", "three", "", None, " \t", "four?\n", "五。", "six.", "seven ", "eight?", "x" * 50]
    rows = []
    for conv in range(n):
        turn = 0
        for _ in range(int(r.integers(1, 14))):
            turn += int(r.integers(0, 3))
            rows.append((conv, turn if r.random() < 0.95 else None, roles[r.integers(0, len(roles))], texts[r.integers(0, len(texts))]))
    return rows


def test_search_over_audits_on_blocks(spark):
    """The least cheapest audit of any length, whatever the block size."""
    r = np.random.default_rng(5)
    for _ in range(300):
        codes = "".join(r.choice(list("suaoSUAOx"), r.integers(0, 9)))
        rows = [({"s": "system", "u": "user", "a": "assistant", "o": "tool", "x": "user"}[c.lower()], "", "blank" if c == "x" else "truncated" if c.isupper() else None) for c in codes]
        cost, audit, _ = searched(rows)
        assert repair._costs(codes, repair.END_GOAL)[0][0] == cost
        for size in (1, 3, 8):
            parts, goals, goal = [codes[i:i + size] for i in range(0, len(codes), size)], [], repair.END_GOAL
            for part in reversed(parts):
                goals.append(goal)
                cross = repair.crossing(part)
                goal = tuple(min(cross[4 * q + to] + goal[to] for to in range(4)) for q in range(4))
            state, got = 0, ""
            for part, after in zip(parts, reversed(goals)):
                piece, state = repair.least_paths(part, after)[state]
                got += piece
            assert got + repair.END_AUDIT[state] == audit, (codes, size)


@pytest.mark.parametrize("block", [2, 1024])
def test_repair_against_search(spark, block):
    rows = made_up(60, 1) + [(None, 1, "user", "a."), (None, None, "assistant", "b."), (None, 1, "user", "a.")]
    rows += [(500, t, "user" if t % 2 else "assistant", f"text {t}.") for t in range(300)] + [(501, 1, "system", "only.")] * 3
    rows += [(502, None, None, None), (503, 5, "user", "y" * 200_000 + "."), (503, 6, "assistant", "z " * 100_000)]
    df = spark.createDataFrame([(*r, -1, "q") for r in rows], SCHEMA).repartition(5)
    ids = df.select("conv_id")
    plain = [(c, t, " " if a is None else a, " " if b is None else b) for c, t, a, b in rows]
    got, want = table(repair.repair(df, block=block), ids), expected(plain, {r[0] for r in rows})
    assert got == want
    assert table(repair.repair(df.where("false"), block=block), ids) == {c: (0, 0, 0, 0, 0, 0, "", EMPTY) for c in want}


def test_query_over_a_whole_table(spark, tmp_path):
    rows = made_up(150, 2) + [(None, 3, "user", "x.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r[0]: tuple(r)[1:] for r in plans.op13_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == expected(damaged(rows), {r[0] for r in rows})


def test_repaired_turns(spark):
    df = spark.createDataFrame([(1, 1, "assistant", "hi.", 0, ""), (1, 2, "user", "go", 0, "")], SCHEMA)
    turns = [tuple(r) for r in repair.repair(df).turns.orderBy("position").collect()]
    want = searched([("assistant", "hi.", None), ("user", "go", "truncated")])
    assert [t[3:] for t in turns] == list(want[2])
    assert [t[2] for t in turns] == [x for x in want[1] if x != "D"]
