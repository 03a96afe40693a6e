"""Text lines to typed rows, keeping the lines that do not fit."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepwise.functions.scalars import input_as


@dataclass(frozen=True)
class Field:
    """``kind`` is text, number, or an informat name such as ``mmddyy10``.

    ``start`` and ``width`` place the field in a fixed-width line (counted from 1).
    ``words`` lets a text value of a blank-separated line consist of several words.
    """

    name: str
    kind: str = "text"
    start: int | None = None
    width: int | None = None
    length: int | None = None
    words: bool = False


@dataclass(frozen=True)
class LineSpec:
    """``delimiter`` None splits on runs of blanks. Quoted values may hold delimiters.

    Values of several words take what the values around them leave. Between two such values
    stands at least one number or date, whose form tells where the first ends.
    """

    fields: Sequence[Field]
    delimiter: str | None = None
    quote: str = '"'
    comment: tuple[str, ...] = field(default=("*", "/*"))

    def __post_init__(self) -> None:
        if not self.wordy:
            return
        if self.fixed or self.delimiter is not None or any(f.kind != "text" for f in self.fields if f.words):
            raise ValueError("values of several words are text fields of blank-separated lines")
        for run in self.runs()[1:-1]:
            if all(f.kind == "text" for f in run):
                raise ValueError("two values of several words need a number or date between them")

    @property
    def fixed(self) -> bool:
        return any(f.start is not None for f in self.fields)

    @property
    def wordy(self) -> bool:
        return any(f.words for f in self.fields)

    def runs(self) -> list[list[Field]]:
        """The single-word fields before, between and after the fields of several words."""
        out: list[list[Field]] = [[]]
        for f in self.fields:
            if f.words:
                out.append([])
            else:
                out[-1].append(f)
        return out


def _blank_tokens(line: Column, quote: str) -> Column:
    found = F.regexp_extract_all(line, F.lit(f"({quote}[^{quote}]*{quote}|[^\\s{quote}]\\S*)"), F.lit(1))
    return F.transform(found, lambda t: F.regexp_replace(t, f"^{quote}(.*){quote}$", "$1"))


def _csv_tokens(line: Column, spec: LineSpec) -> Column:
    """The values of one delimited line; the struct's ``__bad`` holds a line that does not fit."""
    names = [f"__t{i}" for i in range(len(spec.fields))]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "__bad"]])
    options = {
        "sep": spec.delimiter, "quote": spec.quote, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad",
        "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
    }
    return F.from_csv(line, schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)


def _once(df: DataFrame, struct: Column) -> DataFrame:
    """Add a struct's fields as columns through a generator. The optimizer copies a plain
    expression into every filter and column that uses it; a generator it leaves alone, so
    each line is taken apart once."""
    return df.select("*", F.inline(F.array(struct)))


def _typed(raw: Column, f: Field) -> Column:
    if f.kind == "text":
        text = F.nullif(F.nullif(raw, F.lit(".")), F.lit(""))
        return F.substring(text, 1, f.length) if f.length else text
    if f.kind == "number":
        return F.nullif(raw, F.lit(".")).try_cast("double")
    return input_as(raw, f.kind)


def _place_words(parsed: DataFrame, spec: LineSpec) -> tuple[DataFrame, list[Column], Column]:
    """Values of lines with fields of several words: the frame, a column per field, why a line does not fit.

    The fields before the first and after the last such value count from the ends of the line. A
    run of fields between two of them stands where its numbers and dates read as such; its first
    possible place (going right) and its last one (going left) must be the same, else the line
    can be read in several ways. All searches are over the words of one line.
    """
    runs = spec.runs()
    token = lambda at: F.get(F.col("__t"), at)
    size = F.size("__t")

    def fits(run: list[Field]):
        def at(p: Column) -> Column:
            ok = F.lit(True)
            for k, f in enumerate(run):
                if f.kind != "text":
                    ok = ok & ((token(p + k) == ".") | _typed(token(p + k), f).isNotNull())
            return F.coalesce(ok, F.lit(False))

        return at

    def between(after: Column | None, before: Column | None):
        return lambda p: p > after if before is None else p < before

    for j, run in enumerate(runs[1:-1], 1):
        last = size - len(run)
        places = F.when(last >= 0, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), fits(run)))
        parsed = _once(parsed, F.struct(places.alias(f"__p{j}")))
    # Words before the earliest place of a run, words up to the latest: at least one each.
    low, high = F.lit(len(runs[0])), size - len(runs[-1])
    for j, run in enumerate(runs[1:-1], 1):
        first = F.array_min(F.filter(F.col(f"__p{j}"), between(low, None)))
        parsed = _once(parsed, F.struct(first.alias(f"__a{j}")))
        low = F.col(f"__a{j}") + len(run)
    for j, run in reversed(list(enumerate(runs[1:-1], 1))):
        final = F.array_max(F.filter(F.col(f"__p{j}"), between(None, high - len(run))))
        parsed = _once(parsed, F.struct(final.alias(f"__b{j}")))
        high = F.col(f"__b{j}")
    starts = [F.lit(0), *[F.col(f"__a{j}") for j in range(1, len(runs) - 1)], size - len(runs[-1])]
    raws = []
    for j, run in enumerate(runs):
        if j:
            begin = starts[j - 1] + len(runs[j - 1])
            raws.append(F.array_join(F.slice("__t", begin + 1, F.greatest(starts[j] - begin, F.lit(0))), " "))
        raws += [token(starts[j] + k) for k in range(len(run))]
    n = len(spec.fields)
    why = F.when(size < n, F.concat(F.lit(f"expected at least {n} values, found "), size.cast("string")))
    for j, run in enumerate(runs[1:-1], 1):
        typed = ", ".join(f.name for f in run if f.kind != "text")
        a, b = F.col(f"__a{j}"), F.col(f"__b{j}")
        why = why.when(a.isNull() | b.isNull() | (a > b), F.lit(f"no place for {typed}"))
        why = why.when(a < b, F.lit(f"several places for {typed}"))
    return parsed, raws, why


def parse_lines(lines: DataFrame, spec: LineSpec, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split lines of text into typed columns: ``(rows, rejects)``.

    Blank and comment lines are skipped. A line with the wrong number of values or with
    a value that does not read as its type goes to ``rejects`` with the reason. A single
    ``.`` is a missing value; blanks inside a value of several words become one. Both results are plain filters over one parsed projection.
    """
    trimmed = F.trim(F.col(value))
    kept = lines.filter(trimmed != "")
    for mark in spec.comment:
        kept = kept.filter(~trimmed.startswith(mark))
    n = len(spec.fields)
    if spec.fixed:
        parsed = kept.select("*", F.array(*[F.trim(F.substring(F.col(value), f.start, f.width)) for f in spec.fields]).alias("__t"))
        raws = [F.get(F.col("__t"), F.lit(i)) for i in range(n)]
        too_short = F.length(F.rtrim(F.col(value))) < min(f.start for f in spec.fields)
        width = F.when(too_short, F.lit("line too short"))
    else:
        if spec.delimiter is None:
            parsed = _once(kept, F.struct(_blank_tokens(trimmed, spec.quote).alias("__t")))
        if spec.wordy:
            parsed, raws, width = _place_words(parsed, spec)
        elif spec.delimiter is None:
            raws, found = [F.get(F.col("__t"), F.lit(i)) for i in range(n)], F.size("__t")
            misfit = found != n
        else:
            parsed = _once(kept, _csv_tokens(F.col(value), spec))
            raws, misfit = [F.col(f"__t{i}") for i in range(n)], F.col("__bad").isNotNull()
            # Counted for misfits only: delimiters outside quotes, plus one.
            bare = F.regexp_replace(F.col(value), f"{spec.quote}[^{spec.quote}]*{spec.quote}", "")
            found = F.length(bare) - F.length(F.replace(bare, F.lit(spec.delimiter), F.lit(""))) + 1
        if not spec.wordy:
            width = F.when(misfit, F.concat(F.lit(f"expected {n} values, found "), found.cast("string")))
    cols = [_typed(r, f).alias(f"__v{i}") for i, (r, f) in enumerate(zip(raws, spec.fields))]
    typed = parsed.select("*", *cols)
    bad = [
        F.when(F.col(f"__v{i}").isNull() & raws[i].isNotNull() & ~raws[i].isin("", "."), F.lit(f"{f.name} is not a valid {f.kind}"))
        for i, f in enumerate(spec.fields)
        if f.kind != "text"
    ]
    reason = F.coalesce(width, F.nullif(F.concat_ws("; ", *bad), F.lit("")) if bad else F.lit(None).cast("string"))
    judged = typed.withColumn("__reason", reason)
    extra = [c for c in lines.columns if c != value]
    rows = judged.filter(F.col("__reason").isNull()).select(
        *extra, *[F.col(f"__v{i}").alias(f.name) for i, f in enumerate(spec.fields)]
    )
    rejects = judged.filter(F.col("__reason").isNotNull()).select(*lines.columns, F.col("__reason").alias("reason"))
    return rows, rejects


def infer_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Turn double columns that hold only whole numbers into int, or bigint if they are large.

    One aggregate over the columns decides; nothing else is read on the driver.
    """
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)] if cols is None else list(cols)
    if not cols:
        return df
    aggs = []
    for c in cols:
        v = F.col(c)
        aggs += [F.bool_and(v == F.floor(v)).alias(f"{c}__whole"), F.max(F.abs(v)).alias(f"{c}__max")]
    seen = df.agg(*aggs).first()
    kinds = {}
    for c in cols:
        if seen[f"{c}__whole"] and seen[f"{c}__max"] < 2**53:
            kinds[c] = "int" if seen[f"{c}__max"] < 2**31 else "bigint"
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])
