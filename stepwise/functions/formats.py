"""Value formats: code -> label and range -> label catalogues, and their registry.

Small formats are one CASE. Above ``INLINE_LIMIT`` entries codes are joined, and ranges become an ordered
index: overlapping ranges are cut into segments that do not overlap, each with the label of the first range that
covers it. A cut is a value and a side (0 before the value, 1 after it), so that open and closed ends
sort among each other. An index within Spark's broadcast limit is searched by halving; a larger one is
merged with the distinct values in one global order. Both give the same rows.
"""

from __future__ import annotations

import datetime as dt
import heapq
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepwise.operators.bygroup import neighbours, retain_last
from stepwise.operators.skew import salted_join
from stepwise.session import stored

INLINE_LIMIT = 50
CATALOGUE_LIMIT = 1_000_000


@dataclass(frozen=True)
class Range:
    """``low``/``high`` of None is unbounded; exclusive ends are the ``<`` spellings."""

    low: float | str | None
    high: float | str | None
    label: str
    low_open: bool = False
    high_open: bool = False

    def test(self, value: Column) -> Column:
        cond = value.isNotNull()
        if self.low is not None:
            cond = cond & (value > self.low if self.low_open else value >= self.low)
        if self.high is not None:
            cond = cond & (value < self.high if self.high_open else value <= self.high)
        return cond


@dataclass(frozen=True)
class ValueFormat:
    """Exact values, then ranges in order; ``missing`` labels NULL.

    Without ``other`` an unmatched value is shown as it is.
    """

    name: str
    values: Mapping = field(default_factory=dict)
    ranges: tuple[Range, ...] = ()
    missing: str | None = None
    other: str | None = None

    def label(self, value: Column | str) -> Column:
        """The format as one CASE expression. For formats beyond a few dozen entries use ``put_format``."""
        value = F.col(value) if isinstance(value, str) else value
        chain = None
        for test, text in self._branches(value):
            chain = F.when(test, text) if chain is None else chain.when(test, text)
        return self._fallback(value) if chain is None else chain.otherwise(self._fallback(value))

    def _branches(self, value: Column):
        if self.missing is not None:
            yield value.isNull(), self.missing
        for code, text in self.values.items():
            yield value == code, text
        for r in self.ranges:
            yield r.test(value), r.label

    def _fallback(self, value: Column) -> Column:
        if self.other is None:
            return value.cast("string")
        # OTHER also catches missing values unless they have a label of their own.
        return F.lit(self.other)


def _kind(bounds: Iterable) -> T.DataType:
    """The type in which a format's bounds or codes are compared."""
    known = [b for b in bounds if b is not None]
    for types, kind in (((int, float, Decimal), T.DoubleType()), ((dt.datetime,), T.TimestampType()), ((dt.date,), T.DateType())):
        if known and all(isinstance(b, types) for b in known):
            return kind
    return T.StringType()


def segments(ranges: Iterable[Range], kind: T.DataType) -> list[tuple]:
    """(value, side, label) where a new label starts, ascending; a value of None is before all others.

    Of overlapping ranges the first one given wins; a label of None is a gap.
    """
    plain = (lambda b: float(b)) if isinstance(kind, T.DoubleType) else (lambda b: b) if not isinstance(kind, T.StringType) else str
    starts, ends = [], []
    for order, r in enumerate(ranges):
        low = (0,) if r.low is None else (1, plain(r.low), int(r.low_open))
        high = (2,) if r.high is None else (1, plain(r.high), int(not r.high_open))
        if low < high:
            starts.append((low, order, r.label))
            ends.append((high, order))
    out: list[tuple] = []
    active: list[tuple] = []
    over: set[int] = set()
    starts.sort(key=lambda s: s[:2])
    ends.sort()
    cuts = sorted({s[0] for s in starts} | {e[0] for e in ends if e[0] != (2,)})
    i = j = 0
    for cut in cuts:
        while i < len(starts) and starts[i][0] == cut:
            heapq.heappush(active, starts[i][1:])
            i += 1
        while j < len(ends) and ends[j][0] == cut:
            over.add(ends[j][1])
            j += 1
        while active and active[0][0] in over:
            heapq.heappop(active)
        label = active[0][1] if active else None
        if not out or out[-1][2] != label:
            out.append((*(cut[1:] if len(cut) > 1 else (None, 0)), label))
    return out


def _index_frame(spark: SparkSession, rows: list[tuple], kind: T.DataType) -> DataFrame:
    fields = [T.StructField("__at", kind), T.StructField("__side", T.IntegerType()), T.StructField("__text", T.StringType())]
    return spark.createDataFrame(rows, T.StructType(fields))


def _search_index(df: DataFrame, value: Column, cuts: Column, size: int, out: str) -> DataFrame:
    """Add how many of the ordered ``cuts`` are at most ``value``, by halving; a NULL cut is before all values.

    ``cuts`` is a part of a scalar subquery. As a column it would be copied into every row, and functions with a lambda
    may not hold it, so every step is a column of its own. The generator keeps filters from unfolding the steps.
    """
    held = df.withColumn("__value", value).withColumn(out, F.lit(0))
    for step in [1 << k for k in reversed(range(max(1, size.bit_length())))]:
        ahead = F.col(out) + step
        below = (ahead <= F.size(cuts)) & F.coalesce(F.get(cuts, ahead - 1) <= F.col("__value"), F.lit(True))
        held = held.withColumn(out, F.when(below, ahead).otherwise(F.col(out)))
    return held.select(*df.columns, F.explode(F.array(out)).alias(out))


def label_ranges(df: DataFrame, value: str, index: DataFrame, size: int, out: str, how: str) -> DataFrame:
    """Add the label of the segment that holds the value. ``index`` has __at, __side, __text; NULL values get NULL.

    ``how``: "search" puts the index into one row that every task halves its way through; "merge" sorts
    the distinct values and the segments together and carries labels forward.
    """
    kind = index.schema["__at"].dataType
    if how == "search":
        whole = index.agg(F.sort_array(F.collect_list(F.struct("__at", "__side", "__text"))).alias("all"))
        arrays = [F.col("all").getField(n).alias(n) for n in ("__at", "__side", "__text")]
        # Values alone are searched; a last cut after the value itself is taken back. Only the first cut may be NULL.
        one = whole.select(F.struct(*arrays).alias("one")).scalar()
        held = _search_index(df, F.col(value).cast(kind), one["__at"], size, "__place")
        last = F.col("__place") - 1
        after = F.coalesce((F.get(one["__at"], last) == F.col(value).cast(kind)) & (F.get(one["__side"], last) == 1), F.lit(False))
        label = F.when(F.col(value).isNotNull() & (last >= 0), F.get(one["__text"], F.when(after, last - 1).otherwise(last)))
        return held.withColumn(out, label).drop("__place")
    distinct = df.select(F.col(value).cast(kind).alias("__at")).where("__at IS NOT NULL").distinct()
    both = distinct.select("__at", F.lit(0).alias("__side"), F.lit(True).alias("__asks"), F.lit(None).cast("struct<t:string>").alias("__label"))
    # A label in a struct, so that a gap is a value to carry and not a missing one.
    both = both.unionByName(index.select("__at", "__side", F.lit(False).alias("__asks"), F.struct(F.col("__text").alias("t")).alias("__label")))
    carried = retain_last(stored(both, "format-merge"), None, ["__at", "__side", "__asks"], ["__label"])
    labels = carried.where("__asks").select("__at", F.col("__label.t").alias("__text"))
    asked = df.withColumn("__at", F.col(value).cast(kind))
    return salted_join(asked, labels, "__at", "left", unique_right=True).select(*df.columns, F.col("__text").alias(out))


def _fits(df: DataFrame, size: int, text: int) -> bool:
    """Whether an index of so many segments and label characters stays within Spark's broadcast limit."""
    return 32 * size + 4 * text <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def put_format(df: DataFrame, value: str, fmt: ValueFormat, out: str, how: str | None = None) -> DataFrame:
    """Apply a format of any size: inline CASE when small, else a lookup join and a range index.

    Spark picks the join of the codes. ``how`` ("search" or "merge") overrules the choice for ranges.
    """
    if how is None and len(fmt.values) + len(fmt.ranges) <= INLINE_LIMIT:
        return df.withColumn(out, fmt.label(value))
    labelled, found = df, []
    if fmt.values:
        # Codes keep the type of the format; the column is compared in it, as the inline form does.
        kind = _kind(fmt.values)
        plain = float if isinstance(kind, T.DoubleType) else str if isinstance(kind, T.StringType) else lambda c: c
        schema = T.StructType([T.StructField("__code", kind), T.StructField("__label", T.StringType())])
        lookup = df.sparkSession.createDataFrame([(plain(code), label) for code, label in fmt.values.items()], schema)
        coded = labelled.withColumn("__code", F.col(value).cast(kind))
        labelled = coded.join(lookup, "__code", "left").select(*df.columns, "__label")
        found.append("__label")
    if fmt.ranges:
        kind = _kind(b for r in fmt.ranges for b in (r.low, r.high))
        rows = segments(fmt.ranges, kind)
        fits = _fits(df, len(rows), sum(len(r[2] or "") for r in rows))
        index = _index_frame(df.sparkSession, rows, kind)
        labelled = label_ranges(labelled, value, index, len(rows), "__range", how or ("search" if fits else "merge"))
        found.append("__range")
    rest = ValueFormat(fmt.name, {}, (), fmt.missing, fmt.other)
    return labelled.withColumn(out, F.coalesce(*found, rest.label(value))).drop(*found)


def classify_ranges(
    df: DataFrame, value: str, ranges: DataFrame, out: str, other: str | None = None, missing: str | None = None, how: str | None = None
) -> DataFrame:
    """Label by a range table that lives in storage: low, high (NULL is unbounded), label, and on demand low_open, high_open.

    The table may be of any size and is never collected. Its ranges must not overlap; that is checked.
    """
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in ranges.columns else F.lit(False)
    kind = ranges.schema["low"].dataType
    ends = ranges.select(
        F.struct(F.col("low").alias("__at"), F.when(F.col("low").isNotNull() & flag("low_open"), 1).otherwise(0).alias("__side")).alias("__from"),
        F.struct(F.col("high").cast(kind).alias("__at"), F.when(flag("high_open"), 0).otherwise(1).alias("__side")).alias("__to"),
        F.col("label").alias("__text"),
    )
    ends = ends.where(F.col("__to.__at").isNull() | (F.col("__from") < F.col("__to")))
    flat = ends.select("__from.__at", "__from.__side", "__to", "__text")
    ordered = stored(neighbours(flat, None, ["__at", "__side"], {"__next_at": ("__at", -1), "__next_side": ("__side", -1), "__more": ("__to", -1)}), "format-ranges")
    next_from = F.struct(F.col("__next_at").alias("__at"), F.col("__next_side").alias("__side"))
    has_next = F.col("__next_side").isNotNull()
    crossing = ordered.where(has_next & (F.col("__to.__at").isNull() | (next_from < F.col("__to"))))
    if crossing.limit(1).count():
        raise ValueError("ranges of the table overlap")
    gap = ordered.where(F.col("__to.__at").isNotNull() & ~(has_next & (next_from == F.col("__to"))))
    index = ordered.select("__at", "__side", "__text").unionByName(gap.select("__to.__at", "__to.__side", F.lit(None).cast("string").alias("__text")))
    size, text = index.agg(F.count("*"), F.sum(F.coalesce(F.length("__text"), F.lit(0)))).first()
    labelled = label_ranges(df, value, index, size, "__range", how or ("search" if _fits(df, size, text or 0) else "merge"))
    rest = ValueFormat("table", {}, (), missing, other)
    return labelled.withColumn(out, F.coalesce("__range", rest.label(value))).drop("__range")


def classify(df: DataFrame, value: str, lookup: DataFrame, code: str, label: str, out: str, other: str | None = None) -> DataFrame:
    """Label by a lookup table that lives in storage; Spark picks the join by its size."""
    named = lookup.select(F.col(code).alias("__code"), F.col(label).alias("__label"))
    fallback = F.col(value).cast("string") if other is None else F.lit(other)
    return (
        df.join(named, F.col(value) == F.col("__code"), "left")
        .withColumn(out, F.coalesce("__label", fallback))
        .drop("__code", "__label")
    )


class FormatRegistry:
    """Formats shared by several jobs, by name."""

    def __init__(self, formats: Iterable[ValueFormat] = ()):
        self._formats = {f.name.lower(): f for f in formats}

    def add(self, fmt: ValueFormat) -> None:
        self._formats[fmt.name.lower()] = fmt

    def __getitem__(self, name: str) -> ValueFormat:
        return self._formats[name.lower().rstrip(".")]

    def __contains__(self, name: str) -> bool:
        return name.lower().rstrip(".") in self._formats

    def names(self) -> list[str]:
        return sorted(self._formats)

    def put(self, value: Column | str, name: str) -> Column:
        """One CASE expression, for formats of a few dozen entries."""
        return self[name].label(value)

    def apply(self, df: DataFrame, value: str, name: str, out: str) -> DataFrame:
        """A format of any size."""
        return put_format(df, value, self[name], out)


def load_formats(spark: SparkSession, path: str) -> FormatRegistry:
    """Read an exported catalogue: CSV with FMTNAME, START, END, LABEL, TYPE.

    TYPE is C for text and N for numbers; LOW, HIGH, OTHER and ``.`` are keywords.
    A catalogue is small reference data; one above ``CATALOGUE_LIMIT`` rows is refused
    rather than pulled to the driver (join it with ``classify`` instead).
    """
    names = ["fmtname", "start", "end", "label", "type"]
    frame = spark.read.option("header", True).csv(path)
    return registry_from(frame.select(*[F.col(c).alias(c.lower()) for c in frame.columns]).select(*names))


def registry_from(catalogue: DataFrame) -> FormatRegistry:
    """Registry of a catalogue table, after a check of its size."""
    rows = catalogue.limit(CATALOGUE_LIMIT + 1).collect()
    if len(rows) > CATALOGUE_LIMIT:
        raise ValueError("format catalogue too large for the driver; join it with classify()")
    return build_formats(rows)


def build_formats(rows: Iterable) -> FormatRegistry:
    parts: dict[str, dict] = {}
    for row in rows:
        fmt = parts.setdefault(row["fmtname"], {"values": {}, "ranges": [], "missing": None, "other": None})
        numeric = (row["type"] or "C").upper() == "N"
        start, end = (row["start"] or "").strip(), (row["end"] or "").strip()
        if start.upper() in ("OTHER", "**OTHER**"):
            fmt["other"] = row["label"]
        elif numeric and start == ".":
            fmt["missing"] = row["label"]
        elif end and end != start or start.upper() == "LOW":
            bounds = [None if b.upper() in ("LOW", "HIGH") else float(b) if numeric else b for b in (start, end)]
            fmt["ranges"].append(Range(bounds[0], bounds[1], row["label"]))
        else:
            fmt["values"][float(start) if numeric else start] = row["label"]
    return FormatRegistry(
        ValueFormat(name, p["values"], tuple(p["ranges"]), p["missing"], p["other"]) for name, p in parts.items()
    )
