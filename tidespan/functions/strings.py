"""String functions with 0-based positions and -1 for "not found". Positions count characters."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .time import col


def contains(s, part: str) -> Column:
    return F.contains(col(s), F.lit(part))


def equals(s, other, ignore_case=False) -> Column:
    a, b = col(s), F.lit(other) if isinstance(other, str) else other
    return F.lower(a) == F.lower(b) if ignore_case else a == b


def is_match(s, pattern: str, start: int = 0) -> Column:
    """Whether a regular expression occurs at or after `start`."""
    piece = col(s) if start == 0 else F.substring(col(s), start + 1, 2**31 - 1)
    return piece.rlike(pattern)


def _folded(s: Column, part: str, ignore_case: bool):
    return (F.lower(s), part.lower()) if ignore_case else (s, part)


def index_of(s, part: str, start: int = 0, count: int | None = None, ignore_case=False) -> Column:
    """First position of `part` within the `count` characters from `start`."""
    s, part = _folded(col(s), part, ignore_case)
    piece = F.substring(s, start + 1, 2**31 - 1 if count is None else count)
    at = F.instr(piece, F.lit(part))
    return F.when(at > 0, at - 1 + start).otherwise(F.lit(-1))


def last_index_of(s, part: str, start: int | None = None, count: int | None = None, ignore_case=False) -> Column:
    """Last position of `part` within the `count` characters that end at position `start`."""
    s, part = _folded(col(s), part, ignore_case)
    end = F.length(s) if start is None else F.least(F.length(s), F.lit(start + 1))
    first = F.lit(0) if count is None else F.greatest(F.lit(0), end - F.lit(count))
    piece = F.substring(s, first + 1, end - first)
    back = F.instr(F.reverse(piece), F.lit(part[::-1]))
    return F.when(back > 0, first + F.length(piece) - back - len(part) + 1).otherwise(F.lit(-1))


def lower(s) -> Column:
    return F.lower(col(s))


def upper(s) -> Column:
    return F.upper(col(s))


def length(s) -> Column:
    return F.length(col(s))


def substring(s, start: int, count: int | None = None) -> Column:
    return F.substring(col(s), start + 1, 2**31 - 1 if count is None else count)


def split(s, pattern: str) -> Column:
    """Pieces between matches of a regular expression, empty ones included."""
    return F.split(col(s), pattern)


def split_chars(s, chars: str) -> Column:
    """Pieces between any of the given characters, empty ones included."""
    return F.split(col(s), "[" + re.escape(chars) + "]")


def row_hash(*cols) -> Column:
    return F.xxhash64(*[col(c) for c in cols])
