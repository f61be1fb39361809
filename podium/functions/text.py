"""Text and token expressions used by record extraction."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _u(unicode: bool) -> str:
    # Python's re treats \s and \d as Unicode classes; Java needs (?U) for that.
    return "(?U)" if unicode else ""


def starts_with(line: ColumnOrName, pattern: str = r"^\d", unicode: bool = False) -> Column:
    """Line predicate (B1): the raw line, not stripped, must match ``pattern``."""
    return _c(line).rlike(_u(unicode) + pattern)


def normalize_ws(text: ColumnOrName, ws: str = r"\s", unicode: bool = False) -> Column:
    """Runs of two or more whitespace characters become one space."""
    t = _c(text)
    runs = F.regexp_replace(t, _u(unicode) + ws + "{2,}", " ")
    if not unicode or ws != r"\s":
        return runs
    # Unicode white space is ASCII white space or no ASCII at all: texts without two such characters in a row have no run
    return F.when(t.rlike(r"[\s[^\x00-\x7F]]{2}"), runs).otherwise(t)


# Whitespace sets for stripping: Java's ASCII \s, and the Unicode white space
# that Python's str.strip removes.
ASCII_WS = " \t\n\x0b\x0c\r"
UNICODE_WS = ASCII_WS + "\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + \
    "\u2028\u2029\u202f\u205f\u3000"


def strip_ws(text: ColumnOrName, unicode: bool = False, spaces_only: bool = False) -> Column:
    """Strip both ends: all whitespace (Python ``strip``) or spaces only (SQL ``trim``).

    ``btrim`` with an explicit character set: no regex scan of the whole line.
    """
    if spaces_only:
        return F.trim(_c(text))
    return F.btrim(_c(text), F.lit(UNICODE_WS if unicode else ASCII_WS))


def tokenize(text: ColumnOrName, ws: str = r"\s", unicode: bool = False,
             spaces_only: bool = False) -> Column:
    """Normalise whitespace, strip, split on single spaces."""
    cleaned = strip_ws(normalize_ws(text, ws, unicode), unicode, spaces_only)
    return F.split(cleaned, " ", -1)


def item(arr: ColumnOrName, index: Column | int) -> Column:
    """0-based array item, null when out of range (never raises under ANSI)."""
    return F.get(_c(arr), index if isinstance(index, Column) else F.lit(index))


def split_item(text: ColumnOrName, sep: str, index: int) -> Column:
    """Item ``index`` (0-based) of ``text`` split on the literal ``sep``."""
    return item(F.split(_c(text), r"\Q" + sep + r"\E", -1), index)


def first_pos_in(tokens: ColumnOrName, words: Iterable[str]) -> Column:
    """0-based position of the first token found in ``words``; null when none.

    ``words`` is a bounded, fixed list; Catalyst turns the IN list into a hash set.
    """
    words = list(words)
    t = _c(tokens)
    first_word = F.get(F.filter(t, lambda x: x.isin(words)), F.lit(0))
    # the first dictionary token's first occurrence is the first dictionary position
    return F.array_position(t, first_word).cast("int") - 1


def tail(tokens: ColumnOrName, start: Column | int) -> Column:
    """Tokens from 0-based ``start`` (>= 0) to the end; empty when past the end."""
    t = _c(tokens)
    start = start if isinstance(start, Column) else F.lit(start)
    return F.slice(t, start + 1, F.greatest(F.size(t) - start, F.lit(0)))


def join_range(tokens: ColumnOrName, start: int, end: Column) -> Column:
    """Tokens ``start`` .. ``end-1`` joined by a space; '' when the range is empty."""
    return F.array_join(F.slice(_c(tokens), F.lit(start + 1), F.greatest(end - start, F.lit(0))), " ")


PAREN = r"\((.*?)\)"


def paren_capture(text: ColumnOrName, pattern: str = PAREN) -> Column:
    """First group of ``pattern``; null (not '') when nothing matches."""
    t = _c(text)
    hit = t.rlike(pattern)
    if pattern == PAREN:
        hit = t.contains("(") & hit
    return F.when(hit, F.regexp_extract(t, pattern, 1))


def flag_priority(tokens: ColumnOrName, flags: Iterable[str] = ("Q", "q")) -> Column:
    """The first flag of ``flags`` (in priority order) present among the tokens."""
    t = _c(tokens)
    out = None
    for f in flags:
        cond = F.array_contains(t, f)
        out = F.when(cond, F.lit(f)) if out is None else out.when(cond, F.lit(f))
    return out


def first_in(tokens: ColumnOrName, codes: Iterable[str]) -> Column:
    """First token that is one of ``codes``; null when none.

    Most lines hold none, which the compiled overlap test finds; only the others are
    filtered.  The filter, a higher-order function, also keeps a projection of many fields
    out of whole-stage code: its one method would be too long for the JVM to compile.
    """
    codes = list(codes)
    t = _c(tokens)
    some = F.arrays_overlap(t, F.array(*[F.lit(c) for c in codes]))
    return F.when(some, F.get(F.filter(t, lambda x: x.isin(codes)), F.lit(0)))
