"""Row-local operators: conditionals, arrays over columns, row generation, routing."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepwise.functions.missing import is_missing
from stepwise.operators.ordering import as_list


def _cond(c: Column | str) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def _value(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def keep(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def drop(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def replace(df: DataFrame, **exprs: Column) -> DataFrame:
    """Overwrite columns in place, keeping their position."""
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def subset(df: DataFrame, condition: Column | str) -> DataFrame:
    """Keep rows whose condition is true."""
    return df.filter(_cond(condition))


def delete_where(df: DataFrame, condition: Column | str) -> DataFrame:
    """Drop rows whose condition is true; rows where it is unknown stay."""
    return df.filter(~F.coalesce(_cond(condition), F.lit(False)))


def case_of(branches: Sequence[tuple[Column | str, object]], default=None) -> Column:
    """First true branch wins; NULL when none does and there is no default."""
    chain = None
    for cond, value in branches:
        chain = F.when(_cond(cond), _value(value)) if chain is None else chain.when(_cond(cond), _value(value))
    if chain is None:
        return _value(default)
    return chain if default is None else chain.otherwise(_value(default))


def case_block(
    df: DataFrame,
    branches: Sequence[tuple[Column | str, Mapping[str, object]]],
    default: Mapping[str, object] | None = None,
) -> DataFrame:
    """IF / ELSE IF chain whose branches set several columns at once.

    The branch number is computed once; each column is then a lookup on it. A column
    a branch does not set keeps its previous value (NULL if it is new).
    """
    default = default or {}
    index = case_of([(c, i) for i, (c, _) in enumerate(branches)], -1)
    tagged = df.withColumn("__branch", index)
    names = list(dict.fromkeys(n for _, sets in [*branches, (None, default)] for n in sets))
    new = []
    for name in names:
        old = F.col(name) if name in df.columns else F.lit(None)
        cases = [(F.col("__branch") == i, sets[name]) for i, (_, sets) in enumerate(branches) if name in sets]
        if name in default:
            cases.append((F.col("__branch") == -1, default[name]))
        chain = None
        for cond, value in cases:
            chain = F.when(cond, _value(value)) if chain is None else chain.when(cond, _value(value))
        new.append(chain.otherwise(old).alias(name))
    return tagged.select(*[c for c in df.columns if c not in names], *new)


def case_last(rules: Sequence[tuple[Column | str, object]], start) -> Column:
    """Independent IFs on one column: a later true rule overrides an earlier one."""
    value = _value(start)
    for cond, new in rules:
        value = F.when(_cond(cond), _value(new)).otherwise(value)
    return value


def select_when(value: Column | str, groups: Mapping, otherwise=None) -> Column:
    """SELECT / WHEN with value lists: ``{result: [values]}``."""
    value = F.col(value) if isinstance(value, str) else value
    return case_of([(value.isin(*v) if isinstance(v, (list, tuple, set)) else value == v, k) for k, v in groups.items()], otherwise)


def between(value, low, high) -> Column:
    """``low <= value <= high``; false when anything is missing."""
    return F.coalesce(_value(value).between(_value(low), _value(high)), F.lit(False))


def flag(condition: Column | str, yes="Y", no="N") -> Column:
    return F.when(_cond(condition), yes).otherwise(no)


def as_int(condition: Column | str) -> Column:
    """A comparison used as a number: 1 or 0, 0 when unknown."""
    return F.coalesce(_cond(condition).cast("int"), F.lit(0))


def array_map(df: DataFrame, cols: Sequence[str], fn: Callable[[Column], Column], out: Sequence[str] | None = None) -> DataFrame:
    """The same expression over a list of columns, in a single projection."""
    out = list(out or cols)
    new = dict(zip(out, [fn(F.col(c)) for c in cols]))
    kept = [new.pop(c).alias(c) if c in new else F.col(c) for c in df.columns]
    return df.select(*kept, *[e.alias(n) for n, e in new.items()])


def missing_reasons(cols: Sequence[str], text: str = "{} is missing") -> Column:
    """Names of the missing ones among ``cols``, joined with ``'; '`` ('' if none)."""
    return F.concat_ws("; ", *[F.when(is_missing(c), F.lit(text.format(c))) for c in cols])


def collect_missing(df: DataFrame, cols: Sequence[str], reason: str = "edit_reason", flag_: str = "edit_flag") -> DataFrame:
    out = df.withColumn(reason, missing_reasons(cols))
    return out.withColumn(flag_, (F.col(reason) != "").cast("int"))


def melt_array(df: DataFrame, cols: Sequence[str], out: str, skip_missing: bool = True, index: str | None = None) -> DataFrame:
    """One output row per listed column, in list order."""
    values = F.array(*[F.col(c) for c in cols])
    exploded = df.select("*", F.posexplode(values).alias("__pos", out))
    if skip_missing:
        exploded = exploded.filter(~is_missing(F.col(out)))
    if index:
        exploded = exploded.withColumn(index, F.col("__pos") + 1)
    return exploded.drop("__pos")


def expand(df: DataFrame, low, high, out: str) -> DataFrame:
    """``DO out = low TO high; OUTPUT``: no rows when low > high."""
    low, high = [x if isinstance(x, Column) else (F.col(x) if isinstance(x, str) else F.lit(x)) for x in (low, high)]
    steps = F.when(low <= high, F.sequence(low.cast("long"), high.cast("long")))
    return df.select("*", F.explode(steps).alias(out))


def iterate(
    df: DataFrame,
    n: Column | int,
    state: Mapping[str, Column | str | float],
    step: Callable[[dict[str, Column], Column], Mapping[str, Column]],
    index: str = "step",
) -> DataFrame:
    """A recurrence inside a loop: one row per iteration with the state after it.

    ``step`` gets the current state columns and the iteration number. The fold runs
    inside one row, so iterations never shuffle. State values are doubles.
    """
    names = list(state)
    fields = T.StructType([T.StructField(index, T.IntegerType())] + [T.StructField(k, T.DoubleType()) for k in names])

    def pack(i: Column, values: Mapping[str, Column]) -> Column:
        cols = [i.cast("int").alias(index)]
        cols += [values[k].cast("double").alias(k) for k in names]
        return F.struct(*cols).cast(fields)

    def merge(acc: Column, i: Column) -> Column:
        last = F.element_at(acc, -1)
        new = dict({k: last[k] for k in names})
        new.update(step({k: last[k] for k in names}, i))
        return F.concat(acc, F.array(pack(i, new)))

    first = {k: v if isinstance(v, Column) else (F.col(v) if isinstance(v, str) else F.lit(v)) for k, v in state.items()}
    count = n if isinstance(n, Column) else F.lit(n)
    steps = F.when(count >= 1, F.sequence(F.lit(1), count.cast("int"))).otherwise(F.array().cast("array<int>"))
    kind = T.ArrayType(fields)
    trail = F.aggregate(steps, F.array(pack(F.lit(0), first)).cast(kind), lambda a, i: merge(a, i).cast(kind))
    rows = df.select("*", F.explode(F.slice(trail, F.lit(2), F.greatest(count, F.lit(0)).cast("int"))).alias("__s"))
    kept = [c for c in df.columns if c not in names and c != index]
    return rows.select(*kept, *[F.col(f"__s.{c}").alias(c) for c in [index, *names]])


def route(
    df: DataFrame,
    rules: Sequence[tuple[str, Column | str]],
    default: str | None = None,
    tee: Sequence[str] | str | None = None,
) -> dict[str, DataFrame]:
    """Send every row to one of several outputs, and to each ``tee`` output as well.

    The first true rule picks the output, ``default`` takes the rest. A row routed to
    an output that is also a tee is written there twice, as two OUTPUT statements would.
    """
    tagged = route_tagged(df, rules, default, tee)
    names = list(dict.fromkeys([n for n, _ in rules] + as_list(default) + as_list(tee)))
    return {n: tagged.filter(F.col("__target") == n).drop("__target") for n in names}


def route_stored(
    df: DataFrame,
    rules: Sequence[tuple[str, Column | str]],
    path: str,
    default: str | None = None,
    tee: Sequence[str] | str | None = None,
) -> dict[str, DataFrame]:
    """``route`` through one pass over the input: rows are written once, by target folder.

    Reading an output then opens its folder only. ``path`` lies in storage all executors share;
    what stood there is replaced. An output without rows is an empty frame.
    """
    tagged = route_tagged(df, rules, default, tee)
    tagged.write.mode("overwrite").partitionBy("__target").parquet(path)
    back = df.sparkSession.read.schema(tagged.schema).parquet(path)
    names = list(dict.fromkeys([n for n, _ in rules] + as_list(default) + as_list(tee)))
    return {n: back.filter(F.col("__target") == n).drop("__target") for n in names}


def route_tagged(df, rules, default=None, tee=None, column: str = "__target") -> DataFrame:
    """The routed rows of all outputs in one frame with their target name."""
    chosen = case_of([(c, n) for n, c in rules], default)
    targets = F.array(chosen, *[F.lit(t) for t in as_list(tee)])
    return df.select("*", F.explode(F.array_compact(targets)).alias(column))


def apply_rules(df: DataFrame, rules: Sequence[Mapping[str, object]]) -> DataFrame:
    """Rules as data: ``{"condition": sql, out1: value, ...}``; the first match sets its outputs."""
    return case_block(df, [(str(r["condition"]), {k: v for k, v in r.items() if k != "condition"}) for r in rules])


def run_sql(spark, sql: str, inputs: Mapping[str, DataFrame] | None = None, **params) -> DataFrame:
    """A parameterised SQL step. Values are bound as parameters, never spliced into the text."""
    return spark.sql(sql, args=params, **dict(inputs or {}))
