"""Column expressions (inventory X1-X16 plus the CASE banding of F3).

Everything here returns a ``Column`` built from ``pyspark.sql.functions``: it
stays inside whole-stage codegen and needs no Python on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------- numbers

def money(c: str | Column, scale: int = 2, precision: int = 18) -> Column:
    """Exact decimal view of a money column: sums then do not depend on the
    order rows arrive in (partitioning, spills, retries)."""
    return col_(c).cast(f"decimal({precision},{scale})")


def to_double(c: str | Column) -> Column:
    return col_(c).cast("double")


def round_half_up(c: str | Column, digits: int, scale: int = 6) -> Column:
    """ROUND on an exact decimal: half away from zero, no binary-half surprises
    (``round(1.005, 2)`` is 1.01). Result is a double; a number beyond the
    decimal's range (no fraction is left there) stays as it is."""
    return F.coalesce(F.round(col_(c).try_cast(f"decimal(38,{scale})"), digits).cast("double"), col_(c).cast("double"))


# --------------------------------------------------------------------- CASE

def band(c: str | Column, thresholds: Sequence[tuple[float, str]], default: str) -> Column:
    """First-match-wins banding over descending lower bounds.

    ``band("depth_m", [(200.0, "deep"), (40.0, "shelf")], "shore")``
    gives half-open bands: ``>= 200``, ``[40, 200)``, else the default. A NULL
    input falls through to the default, as in SQL CASE.
    """
    x = col_(c)
    expr = None
    for lower, label in thresholds:
        expr = F.when(x >= lower, label) if expr is None else expr.when(x >= lower, label)
    return F.lit(default) if expr is None else expr.otherwise(default)


# --------------------------------------------------------------------- predicates

def like_ci(c: str | Column, pattern: str) -> Column:
    """SQLite LIKE ignores ASCII case: ``ilike``."""
    return col_(c).ilike(pattern)


def in_set(c: str | Column, values: Sequence) -> Column:
    return col_(c).isin(list(values))


def between(c: str | Column, lo, hi) -> Column:
    return col_(c).between(lo, hi)


# --------------------------------------------------------------------- strings

def substr_sql(c: str | Column, start: int, length: int | None = None) -> Column:
    """SUBSTR with SQL start semantics; start 0 is rejected because engines
    disagree on it (SQLite/DuckDB give one character less than Spark)."""
    if start == 0:
        raise ValueError("substr start must be >= 1 or < 0")
    if length is None:
        return col_(c).substr(F.lit(start), F.lit(1 << 30))
    return F.substring(col_(c), start, length)


def normalized_text(c: str | Column) -> Column:
    """Lower-case, drop everything outside ``[a-z0-9 ]`` (a fixed value), trim."""
    return F.trim(F.regexp_replace(F.lower(col_(c)), "[^a-z0-9 ]", ""))


def ci_key(c: str | Column) -> Column:
    """Case- and surrounding-space-insensitive key."""
    return F.lower(F.trim(col_(c)))


def padded_id(prefix: str, n: str | Column, width: int = 3) -> Column:
    """``prefix + zero-padded n`` with a *minimum* width (X10); unlike ``lpad``
    it never truncates a longer number."""
    return F.format_string(f"{prefix}%0{width}d", col_(n))


def contains_ci(text: str | Column, term: str | Column) -> Column:
    """Case-insensitive substring test."""
    t = F.lit(term) if isinstance(term, str) else term
    return F.contains(F.lower(col_(text)), F.lower(t))


def matches(c: str | Column, pattern: str, ignore_case: bool = True, dotall: bool = False) -> Column:
    """Regex classification (X15) with inline flags."""
    flags = ("i" if ignore_case else "") + ("s" if dotall else "")
    return col_(c).rlike(f"(?{flags}){pattern}" if flags else pattern)


def numeric_or_text(c: str | Column, digits: int = 6) -> Column:
    """Numeric coercion of text, else trimmed text (X16), as a canonical string:
    ``'2.50'`` and ``2.5`` give the same value."""
    x = col_(c).cast("string")
    as_num = x.try_cast("double")
    return F.when(as_num.isNotNull(),
                  F.concat(F.lit("n:"), round_half_up(as_num, digits, 9).cast("string"))) \
        .otherwise(F.concat(F.lit("s:"), F.trim(x)))


# ---- fixed value: what a statement's rules do not look into (quoted text, quoted names, comments)
_QUOTED = r"""'[^']*'?|"[^"]*"?|--[^\n]*|/\*(?s:.*?)(?:\*/|\z)"""


def statement_mask(c: str | Column) -> Column:
    """A statement with quoted text, quoted names and comments blanked (D20). A
    doubled quote is two literals side by side; what is not closed runs to the end."""
    return F.regexp_replace(col_(c), _QUOTED, " ")


def statement_count(c: str | Column) -> Column:
    """Statements of a text: its parts between separators that are not blank,
    separators in quotes and comments not counted."""
    return F.size(F.filter(F.split(statement_mask(c), ";"), lambda part: part.rlike(r"\S")))


def starts_with_word(c: str | Column, words: Sequence[str]) -> Column:
    """Whether the first word outside quotes and comments is one of ``words``, ignoring case."""
    return statement_mask(c).rlike(r"(?i)^\s*(?:" + "|".join(words) + r")\b")


# --------------------------------------------------------------------- arrays / JSON / hashing

def first_lower(arr: str | Column, n: int) -> Column:
    """First ``n`` members, lower-cased (X11)."""
    return F.transform(F.slice(col_(arr), 1, n), lambda t: F.lower(t))


def braces_span(c: str | Column) -> Column:
    """First ``{`` to last ``}`` (X13); empty when there is none."""
    return F.regexp_extract(col_(c), r"(?s)\{.*\}", 0)


def sha256_hex(c: str | Column) -> Column:
    """SHA-256 hex digest of the UTF-8 text."""
    return F.sha2(col_(c).cast("string"), 256)


# --------------------------------------------------------------------- dates

def to_day(c: str | Column) -> Column:
    return F.to_date(col_(c))


def month_key(c: str | Column) -> Column:
    """``YYYY-MM`` text month; lexical order is time order."""
    return F.date_format(col_(c), "yyyy-MM")


def weekday_sun0(c: str | Column) -> Column:
    """Weekday with 0 = Sunday (SQLite ``strftime('%w')``)."""
    return F.dayofweek(col_(c)) - 1
