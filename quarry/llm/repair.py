"""Conversation structure repair (operator 13).

A conversation's rows in order of turn (nulls first; then role, text) should have role
initials ``(s?(ua)+)?``. Faults of a row, the first that holds: *blank* (no character but
white space), *duplicate* (role and text seen earlier in the conversation), *truncated* (its
last other character is not one of ``.!?``). Edits: Keep (cost 0), Rerole to user or assistant
(2), Delete (3; blank and duplicate rows must go), Insert an empty user or assistant turn
anywhere (2); a truncated row that stays adds 1. The audit is the initials of the cheapest
edits in order, the ASCII-least of equal cost.

1. *Rows to codes.* Positions come from the ordered scan, which splits long conversations;
   duplicates from the first position of each role and text (an aggregate and a join). A row
   becomes one character: what its initial is, whether it is truncated or must go. Each
   ``BLOCK`` rows of a conversation make one string.
2. *Costs.* Between rows a conversation is in one of four states (nothing yet; after s; after
   u; after a). A block gives the cheapest way from each state to each (4 x 4 sums); from
   the last block backward these give the cost from each state at each block's border.
3. *Ranks.* Inside a block the costs leave the optimal arcs, which are the nodes of the
   ranking: an arc's rank for audits of one letter is its letter; the rank for twice the
   length comes from the pair of its own rank and that of the arc its pointer leads to, the
   pointer then being doubled. The arc of least rank out of a state starts the least path; the
   doubled pointers list it. All four states at a block's start get their path, so blocks are
   ranked independently; the letters out of a state differ, so no tie crosses a border.
4. *Repair.* Blocks in order give the audit; rows streamed in order beside their audit give
   the repaired turns.

Blocks are dealt out by conversation and number, so a long conversation is spread over tasks.
One task puts together its audit (one character a row, part of the result) and streams
its turns for the digest, which is one value of the whole, by nature.

Defined cases: null role or text: one space. Null turns come first. Null id: one conversation.
Equal rows: all but the first are duplicates. Rows of equal turn go by role, then text. Very long
texts are one row. Empty table: empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.chat import _batches, _rows
from quarry.llm.scratch import materialize
from quarry.operators.scan import ordered_scan

BLOCK = 1024
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
LETTERS = "DIKR"
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
END_GOAL = (0, 4, 2, 0)                # cost of ending in each state
END_AUDIT = ("", "II", "I", "")
_FAR = 1 << 50
_ENDS = r"[.!?][\x20\x09-\x0D]*\z"
_FULL = r"[^\x20\x09-\x0D]"


# ------------------------------------------------------------------ one block

@lru_cache(maxsize=64)
def _arcs(code: str) -> tuple[tuple[int, str, int, int], ...]:
    """``(state, letter, next state, cost)`` over one row."""
    out = [(q, "D", q, DELETE) for q in range(4)]
    if code != "x":
        more = TRUNCATED if code.isupper() else 0
        kept = {"s": [(START, SYSTEM)], "u": [(q, USER) for q in (START, SYSTEM, ASSISTANT)], "a": [(USER, ASSISTANT)]}
        out += [(q, "K", to, KEEP + more) for q, to in kept.get(code.lower(), [])]
        out += [(q, "R", to, REROLE + more) for q, to in NEXT.items()]
    return tuple(out)


def _costs(codes: str, goal: tuple[int, ...]) -> list[list[int]]:
    """Cheapest cost from each state before each row, given the costs after the last."""
    layers = [list(goal)]
    for code in reversed(codes):
        after, c = layers[-1], [_FAR] * 4
        for q, _, to, cost in _arcs(code):
            c[q] = min(c[q], cost + after[to])
        c[USER], c[ASSISTANT] = min(c[USER], INSERT + c[ASSISTANT]), min(c[ASSISTANT], INSERT + c[USER])
        layers.append([min(c[START], INSERT + c[USER]), min(c[SYSTEM], INSERT + c[USER]), c[USER], c[ASSISTANT]])
    return layers[::-1]


@lru_cache(maxsize=100_000)
def crossing(codes: str) -> tuple[int, ...]:
    """Cheapest cost over a block from each state (rows) to each state (columns)."""
    units = [tuple(0 if k == q else _FAR for k in range(4)) for q in range(4)]
    columns = [_costs(codes, unit)[0] for unit in units]
    return tuple(min(columns[to][q], _FAR) for q in range(4) for to in range(4))


@lru_cache(maxsize=100_000)
def least_paths(codes: str, goal: tuple[int, ...]) -> tuple[tuple[str, int], ...]:
    """For each state at a block's start: the least cheapest audit over the block, and the state after it."""
    if not codes:
        return tuple(("", q) for q in range(4))
    layers = _costs(codes, goal)
    arcs = [(4 * i + q, LETTERS.index(letter), 4 * i + 4 + to) for i, code in enumerate(codes)
            for q, letter, to, cost in _arcs(code) if cost + layers[i + 1][to] == layers[i][q]]
    arcs += [(4 * i + q, LETTERS.index("I"), 4 * i + to) for i in range(len(codes))
             for q, to in NEXT.items() if INSERT + layers[i][to] == layers[i][q]]
    tail, letter, head = np.array(sorted(arcs)).T
    end = len(tail)  # the arc after an audit's end: before all letters, followed by itself
    rank = np.append(letter + 1, 0)

    def least_out(rank: np.ndarray) -> np.ndarray:
        """The arc of least rank out of each place."""
        first = np.full(4 * len(codes) + 4, end)
        order = np.lexsort((rank[:-1], tail))
        places, at = np.unique(tail[order], return_index=True)
        first[places] = order[at]
        return first

    pointers = [np.append(least_out(rank)[head], end)]
    while 1 << (len(pointers) - 1) < 3 * len(codes):
        _, rank = np.unique(rank * (len(rank) + 1) + rank[pointers[-1]], return_inverse=True)
        pointers.append(pointers[-1][pointers[-1]])
    path = least_out(rank)[:4].reshape(4, 1)
    for jump in reversed(pointers):
        path = np.stack([path, jump[path]], 2).reshape(4, -1)
    out = []
    for own in path:
        own = own[own < end]
        out.append(("".join(LETTERS[x] for x in letter[own]), int(head[own[-1]]) % 4))
    return tuple(out)


# ------------------------------------------------------------------ all blocks

def _crossings(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([crossing(c) for c in batch.column("codes").to_pylist()], pa.list_(pa.int64()))],
                                         [*batch.schema.names, "crossing"])


_GOAL = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("codes", pa.string()), ("goal", pa.list_(pa.int64())), ("cost", pa.int64())])


def _goals(batches):
    """Costs after each block, and before it from the start, from a conversation's last block to its first."""
    def run():
        for conv, blocks in itertools.groupby(_rows(batches, ["conv_id", "block", "codes", "crossing"]), key=itemgetter(0)):
            goal = list(END_GOAL)
            for _, block, codes, cross in blocks:
                before = [min(cross[4 * q + to] + goal[to] for to in range(4)) for q in range(4)]
                yield conv, block, codes, goal, before[START]
                goal = before
    return _batches(run(), _GOAL, lambda r: 4 * len(r[2]) + 64)


_PATH = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("cost", pa.int64()), ("pieces", pa.list_(pa.string())), ("states", pa.list_(pa.int64()))])


def _paths(batches):
    def run():
        for conv, block, codes, goal, cost in _rows(batches, _GOAL.names):
            low = min(goal)
            pieces, states = zip(*least_paths(codes, tuple(g - low for g in goal)))
            yield conv, block, cost, list(pieces), list(states)
    return _batches(run(), _PATH, lambda r: sum(map(len, r[3])) + 64)


def _audits(batches):
    """A conversation's audit from its blocks in order."""
    def run():
        for conv, blocks in itertools.groupby(_rows(batches, _PATH.names), key=itemgetter(0)):
            audit, state, total = [], START, None
            for _, _, cost, pieces, states in blocks:
                total = cost if total is None else total
                audit.append(pieces[state])
                state = states[state]
            yield conv, total, "".join(audit) + END_AUDIT[state]
    return _batches(run(), pa.schema([("conv_id", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]), lambda r: len(r[2]))


_TURN = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """``(edit, role, text)`` of the turns that an audit makes of a conversation's rows."""
    state = START
    for letter in audit:
        role, text = next(rows) if letter != "I" else ("", "")
        if letter == "D":
            continue
        if letter == "K":
            state = SYSTEM if state == START and role[:1] == "s" else NEXT[state]
        else:
            state = NEXT[state]
            role = "user" if state == USER else "assistant"
        yield letter, role, text


def _repaired(batches):
    """Repaired turns from rows in order, each conversation's after its audit (in ``text`` of a row without ``tag``)."""
    def run():
        for conv, rows in itertools.groupby(_rows(batches, ["conv_id", "tag", "role", "text"]), key=itemgetter(0)):
            audit = next(rows)[3]
            for k, (letter, role, text) in enumerate(edited(audit, ((r[2], r[3]) for r in rows))):
                yield conv, k, letter, role, text
    return _batches(run(), _TURN, lambda r: len(r[4]))


def _digests(batches):
    def run():
        for conv, rows in itertools.groupby(_rows(batches, ["conv_id", "role", "text"]), key=itemgetter(0)):
            digest = hashlib.sha256()
            for k, (_, role, text) in enumerate(rows):
                digest.update(f"{chr(10) if k else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
            yield conv, digest.hexdigest()
    return _batches(run(), pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())]), lambda r: 100)


# ------------------------------------------------------------------ operator

@dataclass
class Repair:
    """``report``: a row per conversation; ``turns``: the repaired turns, in order within each partition; ``digests``: their sha256."""

    report: DataFrame
    turns: DataFrame
    digests: DataFrame


def _faults(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, pos, fault, illegal, code`` of every row."""
    initial = F.substring("role", 1, 1)
    flags = turns.select("conv_id", "turn", "role", "text", "row", F.md5(F.col("text").cast("binary")).alias("digest"), initial.alias("initial"),
                         (~F.col("text").rlike(_FULL)).alias("blank"), (~F.col("text").rlike(_ENDS)).alias("open"))
    placed = ordered_scan(flags, "conv_id", ["turn", "role", "text", "row"], lag_cols=["initial"], row_number="pos")
    placed = materialize(placed.select("conv_id", "turn", "role", "digest", "initial", "prev_initial", "blank", "open", "pos"), "placed")
    first = placed.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(F.min("pos").alias("first"))
    # eqNullSafe keeps an exchange on both sides, so that a hot group can be split
    seen = placed.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")))
    fault = F.when(F.col("blank"), "blank").when(F.col("pos") > F.col("first"), "duplicate").when(F.col("open"), "truncated")
    letter = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    return seen.select("conv_id", "turn", "pos", fault.alias("fault"),
                       (F.col("prev_initial").isNotNull() & ~F.concat("prev_initial", "initial").isin("su", "ua", "au")).alias("illegal"),
                       letter.alias("letter")).withColumn(
        "code", F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper("letter")).otherwise(F.col("letter")))


def repair(conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           block: int = BLOCK) -> Repair:
    """Faults, cheapest edits and repaired turns of every conversation."""
    def value(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    turns = materialize(conversations.select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), value(role_col).alias("role"),
        value(text_col).alias("text"), F.monotonically_increasing_id().alias("row")), "turns")
    rows = materialize(_faults(turns), "faults")
    count = [F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")]
    turns_seen = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    faults = rows.groupBy("conv_id").agg(F.coalesce(turns_seen, F.lit(0)).alias("gaps"), *count, F.count_if("illegal").alias("illegal"))

    codes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"]), "")
    number = F.floor((F.col("pos") - 1) / block).cast("long")
    blocks = rows.groupBy("conv_id", number.alias("block")).agg(codes.alias("codes"))
    crossings = blocks.mapInArrow(_crossings, "conv_id long, block long, codes string, crossing array<long>")
    goals = (crossings.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))
             .mapInArrow(_goals, "conv_id long, block long, codes string, goal array<long>, cost long"))
    paths = goals.repartition("conv_id", "block").mapInArrow(_paths, "conv_id long, block long, cost long, pieces array<string>, states array<long>")
    audits = materialize(paths.repartition("conv_id").sortWithinPartitions("conv_id", "block")
                         .mapInArrow(_audits, "conv_id long, cost long, audit string"), "audits")

    none = F.lit(None).cast("long")
    both = (audits.select("conv_id", F.lit(0).alias("tag"), none.alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), none.alias("row"))
            .union(turns.select("conv_id", F.lit(1), "turn", "role", "text", "row")))
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "tag", F.asc_nulls_first("turn"), "role", "text", "row")
    repaired = ordered.mapInArrow(_repaired, "conv_id long, position long, edit string, role string, text string")
    digests = repaired.mapInArrow(_digests, "conv_id long, repaired_sha256 string")
    report = faults.unionByName(audits, allowMissingColumns=True)
    return Repair(_one_row(report), repaired, digests)


def _one_row(parts: DataFrame) -> DataFrame:
    """The parts of each conversation's row put together; null ids meet as well."""
    return parts.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in parts.columns if c != "conv_id"])


def repair_report(ids: DataFrame, done: Repair) -> DataFrame:
    """One row for each id of ``ids`` (``conv_id``), with zeros and empty values for those without rows."""
    parts = (ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
             .unionByName(done.report, allowMissingColumns=True).unionByName(done.digests, allowMissingColumns=True))
    empty = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    order = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return _one_row(parts).select("conv_id", *[F.coalesce(F.col(c), empty.get(c, F.lit(0).cast("long"))).alias(c) for c in order])


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32(``conv_id:turn``) % 20: dropped, emptied, unpunctuated, repeated or given the role user."""
    def text(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    slim = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    new = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return slim.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), new.alias("text"),
                       F.explode(copies).alias("copy")).drop("copy")
