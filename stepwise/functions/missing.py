"""Comparisons in which a missing value is smaller than every number.

Plain SQL comparison yields NULL when a side is NULL. Record-by-record programs
order a missing value below all others instead; these helpers do that and always
return true or false. Opt-in: nothing else in the library uses this order silently.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return x if isinstance(x, Column) else (F.col(x) if isinstance(x, str) else F.lit(x))


def missing_lt(a, b) -> Column:
    a, b = _col(a), _col(b)
    return F.coalesce(a < b, a.isNull() & b.isNotNull())


def missing_le(a, b) -> Column:
    a, b = _col(a), _col(b)
    return F.coalesce(a <= b, a.isNull())


def missing_gt(a, b) -> Column:
    return missing_lt(b, a)


def missing_ge(a, b) -> Column:
    return missing_le(b, a)


def missing_eq(a, b) -> Column:
    return _col(a).eqNullSafe(_col(b))


def missing_ne(a, b) -> Column:
    return ~missing_eq(a, b)


def is_missing(x) -> Column:
    """NULL, or a blank text. Numbers are blank-free, so the text test is harmless there."""
    x = _col(x)
    return x.isNull() | (F.trim(x.cast("string")) == "")
