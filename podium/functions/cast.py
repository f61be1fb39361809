"""Casts, numbers, dates and time text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def safe_cast(col, to: str | DataType) -> Column:
    """Cast with bad values to null (``try_cast``; plain ``cast`` raises under ANSI)."""
    return _c(col).try_cast(to)


def same_type_lit(value, like: DataType) -> Column:
    """A literal of the column's own type, so ``coalesce``/``when`` keep one type."""
    return F.lit(value).cast(like)


def dotted_number(col, to: str = "float") -> Column:
    """Remove every '.', then read the digits as a number."""
    return F.regexp_replace(_c(col), r"\.", "").try_cast(to)


def concat_time(time, fraction, default: str = ".000") -> Column:
    """``time`` + ``fraction``, or ``time`` + ``default``; null time stays null."""
    t, f = _c(time), _c(fraction)
    return F.when(f.isNotNull(), F.concat(t, f)).otherwise(F.concat(t, F.lit(default)))


def parse_date_text(col, fmt: str = "d MMM yyyy", strip_prefix: str | None = r"^[A-Z]{3} ") -> Column:
    """Text such as ``SUN 4 AUG 2024`` to DATE; bad text gives null."""
    c = _c(col)
    if strip_prefix:
        c = F.regexp_replace(c, strip_prefix, "")
    return F.try_to_date(c, fmt)


def date_text(col, fmt: str = "dd/MM/yy") -> Column:
    """DATE back to display text (the reference keeps ``dd/MM/yy``)."""
    return F.date_format(_c(col), fmt)
