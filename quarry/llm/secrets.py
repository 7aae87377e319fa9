"""Secret scans: fixed patterns, and guess costs of credential values (operator 9).

Three patterns give the base spans, leftmost and non-overlapping per kind:
``assign`` (a credential name, ``:`` or ``=``, a value of 8 or more characters),
``access`` and ``hex``. Beside them, every value in a wider credential context (more
names, ``is``, a bearer header, a password in a URL) gets the cost of guessing it:
the cheapest way to cut it into common words, dates, repeats, keyboard walks and
brute-force characters, as the sum of the pieces' log10 guesses, found by dynamic
programming. A value of ``min_log10_guesses`` or more adds a span of kind ``guess``;
a value that people choose and crackers try first does not. Time is linear in the
value's length.

Positions are code points, ends exclusive. Whole texts are read; texts that cannot
hold any kind are passed over by one linear regular expression on the Arrow column.

Defined cases: null and empty texts have no spans. Null ids are kept. Every row has
a row in the result, repeated rows one each. Texts are read whole, whatever their
length. Spans of one start are listed by kind. Empty table: empty result. Extra
columns are ignored, or carried unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from math import log10

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The three base patterns and the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "guess")

NAMES = r"pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|credentials?"
CONTEXTS = (
    re.compile(rf"""(?:{NAMES})["']?[\x20\t]*(?:[:=]>?|\bis\b)[\x20\t]*["']?([^\s"'<>]{{6,}})""", re.I | re.A),
    re.compile(r"bearer[\x20\t]+([^\s\"'<>]{6,})", re.I | re.A),
    re.compile(r"://[^\s/:@]+:([^\s/@]{6,})@", re.A),
)
POSSIBLE = r"(?i:pass|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential|bearer)|AKIA|[0-9a-f]{32}|://[^\s/:@]+:"

# Words people use in passwords, commonest first.
COMMON = """password qwerty dragon monkey letmein football baseball iloveyou admin welcome login master hello
sunshine princess shadow superman michael batman trustno freedom whatever secret summer winter spring autumn
ginger flower cookie cheese pepper soccer hockey killer jordan thomas robert daniel hunter buster tigger
charlie andrew jessica ashley love test guest user root pass change default changeme example sample dummy
temp demo access starwars computer internet samsung google apple orange banana silver golden purple yellow
black white green blue red the and you for god money lucky angel baby sweet happy magic matrix ninja mustang
maverick phoenix thunder diamond family friend house home school server system data base public private key
token api none null true false xxx abc""".split()
RANK = {w: k + 1 for k, w in enumerate(COMMON)}
LONGEST = max(map(len, COMMON))
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
NEXT = {a + b for row in ROWS for a, b in zip(row, row[1:])} | {b + a for row in ROWS for a, b in zip(row, row[1:])}
PLAIN = str.maketrans("@4301$5!7", "aaeoissit")
DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])"
                  r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d|(?:19|20)\d\d")
STEP_COST = log10(2)  # for each piece: which kind comes next


def char_cost(c: str) -> float:
    return log10(10 if c.isdigit() else 26 if c.isalpha() else 33)


def _runs(value: str, joined) -> list[tuple[int, int]]:
    """Longest runs of 3 or more characters whose neighbours are joined."""
    out, start = [], 0
    for i in range(1, len(value) + 1):
        if i == len(value) or not joined(value[i - 1], value[i]):
            if i - start >= 3:
                out.append((start, i))
            start = i
    return out


def pieces(value: str) -> dict[int, list[tuple[int, float]]]:
    """``end -> (start, log10 guesses)`` of every word, date, repeat and walk in a value."""
    low = value.lower()
    if len(low) != len(value):  # a letter whose lower case is longer
        low = value
    found: dict[int, list[tuple[int, float]]] = {}

    def add(start: int, end: int, guesses: float) -> None:
        found.setdefault(end, []).append((start, log10(guesses) + STEP_COST))

    for form, leet in ((low, 1), (low.translate(PLAIN), 4)):
        for start in range(len(form)):
            for end in range(start + 3, min(len(form), start + LONGEST) + 1):
                rank = RANK.get(form[start:end])
                if rank:
                    cased = 1 if value[start:end] == low[start:end] else 2 if value[start:end] in (
                        low[start:end].upper(), low[start:end].capitalize()) else 1 << (end - start)
                    add(start, end, rank * leet * cased + 1)
    for m in DATE.finditer(value):
        add(m.start(), m.end(), 150 if m.end() - m.start() == 4 else 365 * 150)
    for joined, base in ((lambda a, b: a == b, 40), (lambda a, b: a + b in NEXT, 90)):
        for start, end in _runs(low, joined):
            for k in range(start + 3, end + 1):
                add(start, k, base * (k - start))
            for k in range(start + 1, end - 2):
                add(k, end, base * (end - k))
    return found


def guess_cost(value: str) -> float:
    """log10 of the guesses of the cheapest segmentation."""
    found = pieces(value)
    best = [0.0] * (len(value) + 1)
    for end in range(1, len(value) + 1):
        cost = best[end - 1] + char_cost(value[end - 1])
        for start, own in found.get(end, ()):
            cost = min(cost, best[start] + own)
        best[end] = cost
    return best[-1]


def spans(text: str, min_log10_guesses: float = 10.0) -> list[tuple[int, int, int, float | None]]:
    """``(start, kind index, end, log10 guesses)`` in order of start, then kind."""
    out = [(m.start(), 0, m.end(), None) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), None) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end(), None) for m in HEX.finditer(text)]
    values = {m.span(1): m[1] for context in CONTEXTS for m in context.finditer(text)}
    for (start, end), value in values.items():
        cost = guess_cost(value)
        if cost >= min_log10_guesses:
            out.append((start, 3, end, cost))
    return sorted(out, key=lambda s: s[:3])


def redact(text: str, found: list[tuple[int, int, int, float | None]], mark: str) -> str:
    """The text with every span, overlaps joined, replaced by ``mark``."""
    joined: list[list[int]] = []
    for start, _, end, _ in found:
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    out, at = [], 0
    for start, end in joined:
        out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_log10_guesses: float = 10.0,
         mark: str = "[SECRET]", carry: Sequence[str] | None = None) -> DataFrame:
    """``doc_id, spans, redacted`` per row: spans ``kind, start, end, log10_guesses``; redacted text null where there is no span.

    ``carry`` names columns to pass on, as a struct ``row``, instead of the id.
    """
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("log10_guesses", pa.float64())])

    def run(batches):
        for batch in batches:
            text = batch.column("_text")
            some = pc.fill_null(pc.match_substring_regex(text, POSSIBLE), False).to_numpy(zero_copy_only=False)
            found: list[list] = [[] for _ in range(batch.num_rows)]
            clean: list[str | None] = [None] * batch.num_rows
            for i in some.nonzero()[0]:
                value = text[int(i)].as_py()
                own = spans(value, min_log10_guesses)
                if own:
                    found[i] = [{"kind": KINDS[k], "start": a, "end": b, "log10_guesses": c} for a, k, b, c in own]
                    clean[i] = redact(value, own, mark)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(found, pa.list_(kind)), pa.array(clean, pa.string())],
                                             ["_row", "spans", "redacted"])

    row = F.struct(*carry) if carry else F.struct(F.col(id_col).cast("long").alias("doc_id"))
    slim = docs.select(row.alias("_row"), F.col(text_col).cast("string").alias("_text"))
    out = slim.mapInArrow(run, f"_row {slim.schema['_row'].dataType.simpleString()}, "
                          "spans array<struct<kind:string,start:bigint,end:bigint,log10_guesses:double>>, redacted string")
    return out.withColumnRenamed("_row", "row") if carry else out.select("_row.*", "spans", "redacted")
