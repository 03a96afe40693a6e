"""Scalar helpers, Column in and Column out. Everything stays in JVM expressions."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


# ---- text -----------------------------------------------------------------


def strip(x) -> Column:
    return F.trim(_col(x))


def substr(x, start: int, length: int | None = None) -> Column:
    """From 1-based ``start``; a negative start counts from the end."""
    return F.substring(_col(x), start, 2147483647 if length is None else length)


def scan(x, n: int, delimiters: str = " .<(+&!$*);^-/,%|") -> Column:
    """The n-th word, NULL if there is none; runs of delimiters count as one, negative n
    counts from the right. One anchored match that stops at the word, from either end."""
    if n == 0:
        raise ValueError("words are counted from 1, or from -1 at the right")
    marks = re.escape(delimiters)
    word = f"^[{marks}]*+(?:[^{marks}]++[{marks}]++){{{abs(n) - 1}}}([^{marks}]++)"
    if n > 0:
        return F.nullif(F.regexp_extract(_col(x), word, 1), F.lit(""))
    return F.nullif(F.reverse(F.regexp_extract(F.reverse(_col(x)), word, 1)), F.lit(""))


def catx(delimiter: str, *parts) -> Column:
    """Join trimmed parts with a delimiter, leaving out missing and blank ones."""
    return F.concat_ws(delimiter, *[F.nullif(F.trim(_col(p).cast("string")), F.lit("")) for p in parts])


def cats(*parts) -> Column:
    """Concatenate trimmed parts; a missing part adds nothing."""
    return F.concat(*[F.coalesce(F.trim(_col(p).cast("string")), F.lit("")) for p in parts])


def length(x) -> Column:
    """Length without trailing blanks. A blank text has length 0."""
    return F.length(F.rtrim(_col(x)))


def truncate(x, n: int) -> Column:
    """Fixed maximum text length."""
    return F.substring(_col(x), 1, n)


def pick(index, pool: list) -> Column:
    """Element of a literal pool chosen by an integer index, wrapping around."""
    at = F.pmod(_col(index), F.lit(len(pool))) + 1
    return F.element_at(F.array(*[F.lit(p) for p in pool]), at.cast("int"))


def business_id(prefix: str, *keys, size: int = 6) -> Column:
    """A stable text id from business keys, not from row positions."""
    joined = F.concat_ws("|", *[_col(k).cast("string") for k in keys])
    return F.concat(F.lit(prefix), F.upper(F.substring(F.sha2(joined, 256), 1, size)))


# ---- dates ----------------------------------------------------------------


def today(as_of: dt.date | str | None = None) -> Column:
    """The run date; pass ``as_of`` to make a run repeatable."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def now(as_of: dt.datetime | str | None = None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")


def date_literal(text: str) -> Column:
    """``'01JAN2020'`` style literals."""
    return F.lit(dt.datetime.strptime(text.title(), "%d%b%Y").date().isoformat()).cast("date")


OPEN_END = "9999-12-31"


def days_between(start, end) -> Column:
    return F.datediff(_col(end), _col(start))


def datepart(x) -> Column:
    return F.to_date(_col(x))


def period_key(x) -> Column:
    """``yyyy-MM`` of a date."""
    d = _col(x)
    return F.format_string("%d-%02d", F.year(d), F.month(d))


def _day_number(d: Column) -> Column:
    return F.datediff(d, F.lit("1970-01-01").cast("date"))


def week_start(x, first_day: str = "monday") -> Column:
    """Date of the first day of the week; ``first_day`` is monday or sunday."""
    d = _col(x).cast("date")
    if first_day == "monday":
        return F.trunc(d, "week")
    if first_day == "sunday":
        return F.date_sub(d, F.dayofweek(d) - 1)
    raise ValueError(f"unknown first day {first_day!r}")


_MONTHS = {"month": 1, "qtr": 3, "year": 12}
_TRUNC = {"month": "month", "qtr": "quarter", "year": "year"}


def intck(unit: str, start, end) -> Column:
    """Number of calendar boundaries crossed from ``start`` to ``end`` (Sunday weeks)."""
    a, b = _col(start).cast("date"), _col(end).cast("date")
    if unit == "day":
        return F.datediff(b, a)
    if unit == "week":
        return (F.datediff(week_start(b, "sunday"), week_start(a, "sunday")) / 7).cast("int")
    if unit not in _MONTHS:
        raise ValueError(f"unknown interval {unit!r}")
    years = F.year(b) - F.year(a)
    if unit == "year":
        return years
    if unit == "qtr":
        return years * 4 + F.quarter(b) - F.quarter(a)
    return years * 12 + F.month(b) - F.month(a)


def intnx(unit: str, start, n, align: str = "b") -> Column:
    """Advance ``n`` intervals; align to beginning, middle, end or the same day."""
    d = _col(start).cast("date")
    n = n if isinstance(n, Column) else F.lit(n)
    align = align.lower()[0]
    if align not in "bmes":
        raise ValueError(f"unknown alignment {align!r}")
    if unit == "day":
        return F.date_add(d, n.cast("int"))
    if unit == "week":
        base = d if align == "s" else week_start(d, "sunday")
        shift = {"b": 0, "m": 3, "e": 6, "s": 0}[align]
        return F.date_add(base, (n * 7 + shift).cast("int"))
    if unit not in _MONTHS:
        raise ValueError(f"unknown interval {unit!r}")
    months = (n * _MONTHS[unit]).cast("int")
    if align == "s":
        return F.add_months(d, months)
    begin = F.add_months(F.trunc(d, _TRUNC[unit]), months)
    if align == "b":
        return begin
    finish = F.date_sub(F.add_months(begin, _MONTHS[unit]), 1)
    if align == "e":
        return finish
    return F.date_add(begin, F.floor(F.datediff(finish, begin) / 2).cast("int"))


# ---- conversion -----------------------------------------------------------

# Date patterns of the supported date formats and informats.
DATE_PATTERNS = {
    "mmddyy10": "MM/dd/yyyy",
    "ddmmyy10": "dd/MM/yyyy",
    "yymmdd10": "yyyy-MM-dd",
    "date9": "ddMMMyyyy",
    "mmddyy8": "MM/dd/yy",
    "ddmmyy8": "dd/MM/yy",
    "yymmdd8": "yy-MM-dd",
    "date7": "ddMMMyy",
}
TIME_PATTERNS = {"datetime": "ddMMMyyyy:HH:mm:ss", "time": "HH:mm:ss"}
_FORMAT = re.compile(r"^([a-z]+)(\d*)\.?(\d*)$")


def _split_format(fmt: str) -> tuple[str, int, int]:
    name = fmt.strip().lower().rstrip(".")
    m = _FORMAT.match(f"f{name}" if name[:1].isdigit() else name)  # w.d is the plain number
    if not m:
        raise ValueError(f"unknown format {fmt!r}")
    return m.group(1), int(m.group(2) or 0), int(m.group(3) or 0)


def input_as(x, informat: str) -> Column:
    """Text to value; text that does not fit becomes NULL."""
    text = F.nullif(F.trim(_col(x)), F.lit("."))
    name = informat.strip().lower().rstrip(".")
    # Month names parse in title case only.
    titled = F.initcap(F.regexp_replace(text, r"^(\d+)([A-Za-z]+)(\d+)", "$1 $2 $3"))
    if name in ("date9", "date7"):
        return F.try_to_date(titled, DATE_PATTERNS[name].replace("MMM", " MMM "))
    if name in DATE_PATTERNS:
        return F.try_to_date(text, DATE_PATTERNS[name])
    kind, _, scale = _split_format(name)
    if kind in TIME_PATTERNS:
        return F.try_to_timestamp(titled, F.lit(TIME_PATTERNS[kind].replace("MMM", " MMM ")))
    if kind in ("best", "f", "comma", "dollar"):
        return F.regexp_replace(text, "[$,]", "").try_cast("double")
    if kind == "percent":
        return F.regexp_replace(text, "[%,]", "").try_cast("double") / 100
    raise ValueError(f"unknown informat {informat!r}")


def put_as(x, fmt: str) -> Column:
    """Value to text in one of the common display formats."""
    value = _col(x)
    name = fmt.strip().lower().rstrip(".")
    if name in DATE_PATTERNS:
        return F.upper(F.date_format(value, DATE_PATTERNS[name]))
    kind, width, scale = _split_format(name)
    if kind in TIME_PATTERNS:
        return F.upper(F.date_format(value, TIME_PATTERNS[kind]))
    # Halves go up before the text is made; formatting alone would take them to the even digit.
    rounded = F.round(F.abs(value), scale)
    if kind == "z":
        digits = F.format_number(rounded, scale) if scale else rounded.cast("long").cast("string")
        digits = F.regexp_replace(digits, ",", "")
        return F.when(value < 0, F.concat(F.lit("-"), F.lpad(digits, width - 1, "0"))).otherwise(
            F.lpad(digits, width, "0")
        )
    number = F.format_number(rounded, scale)
    minus = F.when(value < 0, "-").otherwise("")
    if kind == "comma":
        return F.concat(minus, number)
    if kind == "dollar":
        return F.concat(minus, F.lit("$"), number)
    if kind == "percent":
        shown = F.concat(F.format_number(F.round(F.abs(value) * 100, scale), scale), F.lit("%"))
        return F.when(value < 0, F.concat(F.lit("("), shown, F.lit(")"))).otherwise(shown)
    if kind in ("best", "f"):
        return F.concat(minus, F.regexp_replace(number, ",", ""))
    raise ValueError(f"unknown format {fmt!r}")


def yes_no(condition) -> Column:
    """Boolean to 'Y' / 'N'; an unknown condition is 'N'."""
    return F.when(_col(condition), "Y").otherwise("N")
