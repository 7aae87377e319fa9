"""Chat formatting in budgeted, turn-aligned windows with a loss mask (operator 2).

A conversation's turns are written ``<turn ROLE>TEXT</turn>`` and a new line. In
roles and texts the characters that can make a control string, ``<``, ``>`` and the
backslash, get a backslash before them, so the output parses in one way only and
every text is got back exactly.

A window holds whole turns within ``budget`` tokens. Running sums of the turns'
tokens choose it: the system turn (a first turn of role ``system``) stays at the
front of every window; then come up to ``history_turns`` turns, of ``history_budget``
tokens at most, of what the window before ended with; then as many new turns as
fit, one at least. A new turn that does not fit beside the repeated ones drops the
oldest of them; a turn that is longer than the budget alone has a window of its own,
whole, marked ``over_budget``. The loss mask holds the text of each new assistant
turn; repeated turns are masked, so each target counts once.

Conversations are dealt out by id, sorted by turn, and streamed: memory holds one
window, whatever the length of a conversation.

Defined cases: null text or role: empty. Turns of equal number are ordered by role,
then text (null first). A null id is a conversation of its own. Repeated rows are
turns of their own. A very long turn is a window of its own, whole. One conversation is
one task by nature (windows depend on all before, the digest is one value), streamed
window by window. Empty table: empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
TURN_TOKENS = 4  # the marks around a turn
_SPECIAL = re.compile(r"[\\<>]")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn ((?:[^\\<>]|\\.)*)>((?:[^\\<>]|\\.)*)</turn>\n", re.S)


def escape(text: str) -> str:
    return _SPECIAL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted window; raises where the text is not one."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"not a turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


class Windows:
    """Turns of one conversation in, finished windows out."""

    def __init__(self, budget: int, history_budget: int, history_turns: int):
        self.budget, self.history_budget, self.history_turns = budget, history_budget, history_turns
        self.system = None
        self.recent: deque = deque(maxlen=history_turns)  # last turns, for the next window's history
        self.kept: list = []   # repeated turns of the open window
        self.new: list = []
        self.total = 0         # running sum of the tokens of all turns so far
        self.number = 0

    def _tokens(self) -> int:
        """Tokens of the open window, by differences of running sums."""
        return sum(t[3] for t in self.kept) + (self.new[-1][4] - self.new[0][4] + self.new[0][3] if self.new else 0)

    def add(self, turn, role: str, text: str, tokens: int) -> Iterator[tuple]:
        self.total += tokens
        item = (turn, role, text, tokens, self.total)
        if self.new and self._tokens() + tokens > self.budget:
            yield self.close()
        if not self.new:
            first = [self.system] if self.system else []
            past = [t for t in self.recent if t is not self.system]
            while past and (self.total - tokens - (past[0][4] - past[0][3]) > self.history_budget
                            or sum(t[3] for t in first) + self.total - (past[0][4] - past[0][3]) > self.budget):
                past.pop(0)
            self.kept = first + past
        self.new.append(item)
        if self.number == 0 and len(self.new) == 1 and self.system is None and self.total == tokens and role == "system":
            self.system = item
        self.recent.append(item)

    def close(self) -> tuple:
        """The open window: number, first and last new turn, repeated turns, tokens, over budget, text, loss spans."""
        out, loss, at = [], [], 0
        for k, (_, role, text, _, _) in enumerate([*self.kept, *self.new]):
            head, body = f"<turn {escape(role)}>", escape(text)
            if k >= len(self.kept) and role == "assistant" and body:
                loss.append({"start": at + len(head), "end": at + len(head) + len(body)})
            out += [head, body, "</turn>\n"]
            at += len(head) + len(body) + 8
        tokens = self._tokens()
        row = (self.number, self.new[0][0], self.new[-1][0], len(self.kept), len(self.new), tokens, tokens > self.budget, "".join(out), loss)
        self.number += 1
        self.new, self.kept = [], []
        return row


_FIELDS = [("conv_id", pa.int64()), ("window", pa.int64()), ("first_turn", pa.int64()), ("last_turn", pa.int64()),
           ("repeated", pa.int64()), ("new", pa.int64()), ("tokens", pa.int64()), ("over_budget", pa.bool_()), ("formatted", pa.string()),
           ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
_SCHEMA = ("conv_id long, window long, first_turn long, last_turn long, repeated long, new long, tokens long, over_budget boolean, "
           "formatted string, loss array<struct<start:long,end:long>>")


def _rows(batches, columns):
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in columns])


def _batches(rows, schema: pa.Schema, characters, limit: int = 8 << 20):
    """Record batches of about ``limit`` characters of output each."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += characters(row) + 100
        if size >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def format_chats(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 budget: int = 512, history_budget: int = 128, history_turns: int = 4) -> DataFrame:
    """One row per window, with its formatted text and the code-point spans of the loss mask."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    slim = turns.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), text.alias("text"),
                        (F.regexp_count(text, F.lit(WORD)) + TURN_TOKENS).cast("long").alias("tokens"))
    ordered = slim.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = pa.schema(_FIELDS)

    def windows(batches):
        current, open_ = object(), None
        for conv, turn, role, body, tokens in _rows(batches, ["conv_id", "turn", "role", "text", "tokens"]):
            if open_ is None or conv != current:
                if open_ is not None:
                    yield (current, *open_.close())
                current, open_ = conv, Windows(budget, history_budget, history_turns)
            for done in open_.add(turn, role, body, tokens):
                yield (conv, *done)
        if open_ is not None:
            yield (current, *open_.close())

    return ordered.mapInArrow(lambda batches: _batches(windows(batches), schema, lambda r: len(r[8])), _SCHEMA)


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from formatted windows: turns and loss texts as counts and digests."""
    ordered = (windows.select("conv_id", "window", "repeated", "formatted", "loss")
               .repartition("conv_id").sortWithinPartitions("conv_id", "window"))
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64())])

    def read(batches):
        current, state = None, None
        for conv, _, repeated, formatted, loss in _rows(batches, ["conv_id", "window", "repeated", "formatted", "loss"]):
            if state is None or conv != current:
                if state is not None:
                    yield result(current, state)
                current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            for role, text in parse(formatted)[repeated:]:
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            for span in loss:
                text = unescape(formatted[span["start"]:span["end"]])
                state[2] += len(text)
                state[3].update(text.encode())
            state[4] += len(formatted)
            state[5] += 1
        if state is not None:
            yield result(current, state)

    def result(conv, s):
        return conv, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4], s[5]

    return ordered.mapInArrow(lambda batches: _batches(read(batches), schema, lambda r: 200),
                              "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                              "formatted_chars long, n_windows long")
