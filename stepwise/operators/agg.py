"""Class-based summaries, frequency tables, cross-tabulations, transposes, totals."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepwise.operators.bygroup import retain_sum, row_index
from stepwise.operators.ordering import as_list, sort_columns
from stepwise.operators.skew import heavy_keys
from stepwise.session import stored

STATS = {
    "n": F.count,
    "nmiss": lambda v: F.count(F.when(F.col(v).isNull(), 1)),
    "mean": F.avg,
    "std": F.stddev_samp,
    "var": F.var_samp,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "range": lambda v: F.max(v) - F.min(v),
}


def _drop_missing_class(df: DataFrame, class_: Sequence[str], missing: bool) -> DataFrame:
    if missing:
        return df
    for c in class_:
        df = df.filter(F.col(c).isNotNull())
    return df


def means(
    df: DataFrame,
    class_: Sequence[str] | str,
    var: Sequence[str] | str,
    stats: Sequence[str] = ("n", "mean", "std", "min", "max"),
    missing: bool = False,
) -> DataFrame:
    """Statistics per class combination, named ``<var>_<stat>``.

    Rows with a missing class value are left out unless ``missing`` is set. ``median``
    is exact and never gathers a group, see ``exact_quantiles``; with it all statistics of
    number columns come out of the one pass over counted values. Decimals, whose sums
    must stay exact, and long integers beside doubles are aggregated in a scan of their own.
    """
    class_, var = as_list(class_), as_list(var)
    rows = _drop_missing_class(df, class_, missing)
    names = [f"{v}_{s}" for v in var for s in stats]
    plain = [s for s in stats if s != "median"]
    aggs = [STATS[s](v).alias(f"{v}_{s}") for v in var for s in plain]
    mids = {f"{v}_median": (v, 0.5) for v in var} if "median" in stats else {}
    if not mids:
        return rows.groupBy(*class_).agg(*aggs).select(*class_, *names)
    value = _stack_type(rows, var)
    if value is None:
        base = rows.groupBy(*class_).agg(*(aggs or [F.count(F.lit(1)).alias("__n")]))
        middle = exact_quantiles(rows, class_, mids)
        if not class_:
            return base.select("*", *[middle.select(m).scalar().alias(m) for m in mids]).select(*names)
        return _null_safe_left(base, middle, class_).select(*class_, *names)
    kinds = {f.name: f.dataType for f in rows.agg(*aggs).schema.fields} if aggs else {}
    placed = _placed_values(rows, class_, var, value)
    out = [_counted(s, i).cast(kinds[f"{v}_{s}"]).alias(f"{v}_{s}") for i, v in enumerate(var) for s in plain]
    return placed.groupBy(*class_).agg(*out, *_quantile_parts(var, mids)).select(
        *class_, *[F.col(f"{v}_{s}") if s != "median" else _interpolated(f"{v}_median") for v in var for s in stats]
    )


def _stack_type(rows: DataFrame, var: Sequence[str]) -> str | None:
    """The type in which all variables fit one column without loss, or None."""
    kinds = {rows.schema[v].dataType.typeName() for v in var}
    if kinds <= {"byte", "short", "integer", "long"}:
        return "bigint"
    return "double" if kinds <= {"byte", "short", "integer", "float", "double"} else None


def _counted(stat: str, i: int) -> Column:
    """Statistic of variable ``i`` over counted values (``__value`` occurs ``__c`` times)."""
    own, v, c = F.col("__var") == i, F.col("__value"), F.col("__c")
    n = F.sum(F.when(own & v.isNotNull(), c).otherwise(0))
    spread = F.sum(F.when(own, c * F.pow(v - F.try_divide(F.col("__sum").cast("double"), F.col("__n")), F.lit(2.0))))
    return {
        "n": lambda: n,
        "nmiss": lambda: F.sum(F.when(own & v.isNull(), c).otherwise(0)),
        "sum": lambda: F.sum(F.when(own, v * c)),
        "mean": lambda: F.try_divide(F.sum(F.when(own, v * c)).cast("double"), n),
        "min": lambda: F.min(F.when(own, v)),
        "max": lambda: F.max(F.when(own, v)),
        "range": lambda: F.max(F.when(own, v)) - F.min(F.when(own, v)),
        "var": lambda: F.when(n > 1, spread / (n - 1)),
        "std": lambda: F.when(n > 1, F.sqrt(spread / (n - 1))),
    }[stat]()


def _null_safe_left(a: DataFrame, b: DataFrame, keys: Sequence[str], profile: DataFrame | None = None) -> DataFrame:
    from stepwise.operators.skew import salted_join

    return salted_join(a, b, keys, "left", null_safe=True, profile_left=profile, unique_right=True)


def _placed_values(rows: DataFrame, class_: Sequence[str], var: Sequence[str], value: str) -> DataFrame:
    """Counted values of all variables with their place in the order: one scan, one cumulative pass.

    Variables are stacked into (class, ``__var``, ``__value``, ``__c``), missing values included.
    ``__upto`` is the number of values at or before this one, ``__n`` and ``__sum`` are the number
    and the sum of all. Heavy (class, variable) groups are cut into chunks along the values.
    """
    by = [*class_, "__var"]
    stack = F.array(*[F.struct(F.lit(i).alias("__var"), F.col(v).cast(value).alias("__value")) for i, v in enumerate(var)])
    stacked = rows.select(*class_, F.inline(stack))
    counts = stacked.groupBy(*by, "__value").agg(F.count(F.lit(1)).alias("__c"))
    known = F.when(F.col("__value").isNotNull(), F.col("__c")).otherwise(0)
    whole = {"__n": F.sum(known), "__sum": F.sum(F.col("__value") * F.col("__c"))}
    # Rows of a group bound its distinct values and are cheaper to count.
    if heavy_keys(stacked, by) is None:
        w = Window.partitionBy(*by)
        upto = F.sum(known).over(w.orderBy("__value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return counts.select("*", upto.alias("__upto"), *[e.over(w).alias(n) for n, e in whole.items()])
    counts = stored(counts, "value-counts")
    upto = retain_sum(counts, by, ["__value"], {"__upto": known}, "__var")
    sizes = counts.groupBy(*by).agg(*[e.alias(n) for n, e in whole.items()])
    return _null_safe_left(upto, sizes, by, counts)


def _holds(rank: Column) -> Column:
    """Whether this value stands at the 0-based ``rank`` of its group."""
    return (F.col("__upto") - F.col("__c") <= rank) & (rank < F.col("__upto")) & F.col("__value").isNotNull()


def _quantile_parts(var: Sequence[str], wanted: Mapping[str, tuple[str, float]]) -> list[Column]:
    """Aggregates over placed values: for every result its two neighbours in the order and its position."""
    parts = []
    for out, (v, q) in wanted.items():
        own, pos = F.col("__var") == list(var).index(v), (F.col("__n") - 1) * F.lit(float(q))
        parts += [
            F.max(F.when(own & _holds(F.floor(pos)), F.col("__value"))).cast("double").alias(f"__lo_{out}"),
            F.max(F.when(own & _holds(F.ceil(pos)), F.col("__value"))).cast("double").alias(f"__hi_{out}"),
            F.max(F.when(own, pos)).alias(f"__pos_{out}"),
        ]
    return parts


def _interpolated(out: str) -> Column:
    lo, hi, pos = F.col(f"__lo_{out}"), F.col(f"__hi_{out}"), F.col(f"__pos_{out}")
    return (lo + (hi - lo) * (pos - F.floor(pos))).alias(out)


def exact_quantiles(df: DataFrame, class_: Sequence[str] | str, wanted: Mapping[str, tuple[str, float]]) -> DataFrame:
    """Exact interpolated quantiles per class, ``{result: (variable, q)}``, from one scan.

    Values are counted first, then counts are accumulated along the value axis, for all
    variables at once. The built-in exact percentile keeps every distinct value of a group
    in one buffer, which a heavy class would overflow. Missing values do not count; a class
    with no other value of a variable gets NULL.
    """
    class_ = as_list(class_)
    var = list(dict.fromkeys(v for v, _ in wanted.values()))
    placed = _placed_values(df, class_, var, _stack_type(df, var) or "double")
    return placed.groupBy(*class_).agg(*_quantile_parts(var, wanted)).select(*class_, *[_interpolated(out) for out in wanted])


def exact_quantile(df: DataFrame, class_: Sequence[str], var: str, q: float, out: str) -> DataFrame:
    """One exact quantile per class that has a value, see ``exact_quantiles``."""
    return exact_quantiles(df.filter(F.col(var).isNotNull()), class_, {out: (var, q)})


def summary(
    df: DataFrame,
    class_: Sequence[str],
    var: Sequence[str] | str,
    stats: Sequence[str] = ("n", "sum", "mean", "min", "max"),
    missing: bool = False,
) -> DataFrame:
    """All class subsets with ``_TYPE_`` and ``_FREQ_``.

    ``_TYPE_`` has the bit of a class variable set when it is part of the row, the
    leftmost class variable being the highest bit. Rows are first reduced to one per
    class combination; only that result is expanded into the 2^n subsets.
    """
    class_, var = as_list(class_), as_list(var)
    unknown = [s for s in stats if s not in ("n", "nmiss", "sum", "mean", "min", "max", "std")]
    if unknown:
        raise ValueError(f"summary cannot combine {unknown} over class subsets")
    rows = _drop_missing_class(df, class_, missing)
    parts = [F.count(F.lit(1)).alias("__f")]
    for v in var:
        parts += [
            F.count(v).alias(f"__n_{v}"),
            F.sum(v).alias(f"__s_{v}"),
            F.min(v).alias(f"__lo_{v}"),
            F.max(v).alias(f"__hi_{v}"),
        ]
        if "std" in stats:
            parts += [F.avg(v).alias(f"__m_{v}"), (F.var_pop(v) * F.count(v)).alias(f"__q_{v}")]
    base = rows.groupBy(*class_).agg(*parts)
    out = []
    for v in var:
        n, s = F.sum(f"__n_{v}"), F.sum(f"__s_{v}")
        made = {
            "n": n,
            "nmiss": F.sum("__f") - n,
            "sum": s,
            "mean": F.try_divide(s, n),
            "min": F.min(f"__lo_{v}"),
            "max": F.max(f"__hi_{v}"),
        }
        if "std" in stats:
            # Squared deviations inside the combinations plus those between their means.
            weight = F.col(f"__n_{v}").cast("double")
            m = F.sum(F.col(f"__m_{v}") * weight) / n
            between = F.sum(F.col(f"__m_{v}") * F.col(f"__m_{v}") * weight) - n * m * m
            made["std"] = F.when(n > 1, F.sqrt(F.greatest(F.sum(f"__q_{v}") + between, F.lit(0.0)) / (n - 1)))
        out += [made[st].alias(f"{v}_{st}") for st in stats]
    full = (1 << len(class_)) - 1
    type_ = (F.lit(full).cast("long") - F.grouping_id()).cast("int")
    return base.cube(*class_).agg(type_.alias("_TYPE_"), F.sum("__f").alias("_FREQ_"), *out)


def freq(df: DataFrame, col: str, missing: bool = False, weight: str | None = None) -> DataFrame:
    """One-way frequencies with percent and cumulative figures, in value order."""
    rows = df if missing else df.filter(F.col(col).isNotNull())
    # Stored once: the total, the cumulative figures and their skew check all read it.
    counts = stored(rows.groupBy(col).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("count")), "freq")
    total = counts.select(F.sum("count")).scalar()
    running = retain_sum(counts, None, [col], {"cum_count": "count"})
    return running.select(
        col,
        "count",
        (F.col("count") * 100.0 / total).alias("percent"),
        "cum_count",
        (F.col("cum_count") * 100.0 / total).alias("cum_percent"),
    )


def crosstab_freq(
    df: DataFrame, a: str, b: str, nocol: bool = False, norow: bool = False, nopercent: bool = False
) -> DataFrame:
    """Two-way frequencies, long form: count, percent, row and column percent."""
    cells = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))
    # Margins and total come from the same aggregate, whose shuffle Spark uses again.
    out = cells
    if not norow:
        rows = cells.groupBy(a).agg(F.sum("count").alias("__row"))
        out = out.join(rows, a).withColumn("row_pct", F.col("count") * 100.0 / F.col("__row")).drop("__row")
    if not nocol:
        cols = cells.groupBy(b).agg(F.sum("count").alias("__col"))
        out = out.join(cols, b).withColumn("col_pct", F.col("count") * 100.0 / F.col("__col")).drop("__col")
    if not nopercent:
        out = out.withColumn("percent", F.col("count") * 100.0 / cells.select(F.sum("count")).scalar())
    order = [a, b, "count"] + [c for c in ("percent", "row_pct", "col_pct") if c in out.columns]
    return out.select(*order)


def tabulate(
    df: DataFrame,
    rows: Sequence[str] | str,
    cols: str,
    var: str,
    stats: Sequence[str] = ("sum", "mean"),
    values: Sequence | None = None,
    total: str | None = None,
) -> DataFrame:
    """Row classes by column class, one column per (value, statistic).

    Pass ``values`` to fix the column set and save the job that looks it up. With
    ``total`` a grand row of that label is added.
    """
    rows = as_list(rows)
    if total is None:
        return _pivot_stats(df.groupBy(*rows), cols, var, stats, values)
    # Reduced first, then every combination counts once for its row and once for the total.
    base = df.groupBy(*rows, cols).agg(
        F.sum(var).alias("sum"), F.count(var).alias("n"), F.min(var).alias("min"), F.max(var).alias("max")
    )
    again = {
        "sum": F.sum("sum"), "n": F.sum("n"), "min": F.min("min"), "max": F.max("max"), "mean": F.try_divide(F.sum("sum"), F.sum("n")),
    }
    unknown = [st for st in stats if st not in again]
    if unknown:
        raise ValueError(f"tabulate cannot total {unknown}")
    own = F.struct(*[F.col(r).alias(r) for r in rows])
    grand = F.struct(*[F.lit(total if i == 0 else None).cast(df.schema[r].dataType).alias(r) for i, r in enumerate(rows)])
    both = base.select(F.explode(F.array(own, grand)).alias("__row"), cols, "sum", "n", "min", "max").select("__row.*", cols, "sum", "n", "min", "max")
    grouped = both.groupBy(*rows)
    pivoted = grouped.pivot(cols, list(values)) if values is not None else grouped.pivot(cols)
    return pivoted.agg(*[again[st].alias(st) for st in stats])


def _pivot_stats(grouped, cols, var, stats, values):
    pivoted = grouped.pivot(cols, list(values)) if values is not None else grouped.pivot(cols)
    return pivoted.agg(*[STATS[s](var).alias(s) for s in stats]) if len(stats) > 1 else pivoted.agg(
        STATS[stats[0]](var).alias(stats[0])
    )


def transpose_wide(
    df: DataFrame,
    by: Sequence[str] | str,
    id_: str,
    var: str,
    values: Sequence | None = None,
    prefix: str = "",
    on_duplicate: str = "error",
) -> DataFrame:
    """Long to wide: one column per value of ``id_``.

    A second value for the same cell raises while the query runs, unless
    ``on_duplicate="max"`` asks for the larger one.
    """
    by = as_list(by)
    pivoted = df.groupBy(*by).pivot(id_, list(values)) if values is not None else df.groupBy(*by).pivot(id_)
    cell = F.max(var)
    if on_duplicate == "error":
        cell = F.when(
            F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"more than one {var} for one {id_} in a BY group"))
        ).otherwise(cell)
    wide = pivoted.agg(cell)
    return wide.withColumnsRenamed({c: f"{prefix}{c}" for c in wide.columns if c not in by}) if prefix else wide


def transpose_long(df: DataFrame, by: Sequence[str] | str, vars_: Sequence[str], name: str = "_NAME_", value: str = "COL1") -> DataFrame:
    """Wide to long: one row per listed column."""
    return df.unpivot(as_list(by), list(vars_), name, value)


def with_total(
    df: DataFrame,
    by: str,
    sums: Mapping[str, Column | str],
    count: str | None = None,
    ratios: Mapping[str, Callable[[], Column]] | None = None,
    label: str = "TOTAL",
) -> DataFrame:
    """Grouped sums plus one grand total row, from a single scan.

    Ratios are computed after the sums, so the total row has the ratio of totals.
    """
    aggs = [F.sum(e).alias(n) for n, e in sums.items()]
    if count:
        aggs.insert(0, F.count(F.lit(1)).alias(count))
    base = df.groupBy(by).agg(*aggs)
    names = ([count] if count else []) + list(sums)
    both = base.groupingSets([[F.col(by)], []], F.col(by)).agg(
        F.grouping_id().alias("__g"), *[F.sum(n).alias(n) for n in names]
    )
    out = both.select(F.when(F.col("__g") == 1, label).otherwise(F.col(by)).alias(by), *names)
    for n, make in (ratios or {}).items():
        out = out.withColumn(n, make())
    return out


def share_of_total(df: DataFrame, value: str, out: str = "pct_of_total", by: Sequence[str] | None = None) -> DataFrame:
    """Percent of the total of ``value``; the total is a scalar subquery, not a window.

    ``df`` is read twice; pass a stored or base table when it is costly to compute.
    """
    if by:
        totals = df.groupBy(*by).agg(F.sum(value).alias("__total"))
        return (
            df.join(totals, list(by), "left")
            .withColumn(out, F.try_divide(F.lit(100.0) * F.col(value), F.col("__total")))
            .drop("__total")
        )
    total = df.select(F.sum(value)).scalar()
    return df.withColumn(out, F.try_divide(F.lit(100.0) * F.col(value), total))


def top_n_other(
    df: DataFrame, col: str, n: int, weight: Column | None = None, other: str = "Other", out: str | None = None
) -> DataFrame:
    """Keep the ``n`` heaviest categories and call the rest ``other``.

    The ranking is one aggregate; its top ``n`` rows are joined back.
    """
    if n > 10_000:
        raise ValueError("top_n_other is meant for a short list of categories")
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    top = df.groupBy(col).agg(size.alias("__w")).filter(F.col(col).isNotNull()).orderBy(F.desc("__w"), F.asc(col)).limit(n)
    top = top.select(F.col(col).alias("__top"))
    joined = df.join(F.broadcast(top), F.col(col) == F.col("__top"), "left")
    return joined.withColumn(out or col, F.coalesce(F.col("__top").cast("string"), F.lit(other))).drop("__top")


def two_level(df: DataFrame, inner: Sequence[str], value: Column, outer: Sequence[str] = (), inner_name: str = "total") -> DataFrame:
    """Average, peak and number of inner totals, e.g. the average week and the peak week."""
    totals = df.groupBy(*outer, *inner).agg(F.sum(value).alias(inner_name))
    peak = F.max(F.struct(F.col(inner_name), *[F.col(c) for c in inner]))
    return totals.groupBy(*outer).agg(
        F.avg(inner_name).alias("avg_total"),
        F.count(F.lit(1)).alias("n_groups"),
        peak.alias("__peak"),
    ).select(
        *outer, "avg_total", "n_groups",
        F.col(f"__peak.{inner_name}").alias("peak_total"),
        *[F.col(f"__peak.{c}").alias(f"peak_{c}") for c in inner],
    )


def category_score(
    df: DataFrame, member: str, category: str, weight: str, dedupe_category: bool = False, scale: float = 1.0
) -> DataFrame:
    """Distinct categories and the sum of their weights per member.

    Weights repeat when a category comes from several rows, unless ``dedupe_category``.
    """
    rows = df.select(member, category, weight).distinct() if dedupe_category else df
    scored = rows.groupBy(member).agg(
        F.countDistinct(category).alias("category_count"), F.sum(weight).alias("raw_score")
    )
    return scored.filter(F.col("category_count") > 0).withColumn("adjusted_score", F.col("raw_score") * F.lit(scale))


def fail_rate(df: DataFrame, flag: str) -> DataFrame:
    """Counts of valid (0) and failed (1) rows and the failed share."""
    out = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(F.col(flag) == 0, 1)).alias("valid"),
        F.count(F.when(F.col(flag) == 1, 1)).alias("failed"),
    )
    return out.withColumn("fail_rate", F.try_divide(F.col("failed"), F.col("total")))


def accumulate(df: DataFrame, by: Sequence[str] | str, sums: Mapping[str, str]) -> DataFrame:
    """Accumulate over a BY group and output once at its last row: a plain aggregate."""
    return df.groupBy(*as_list(by)).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in sums.items()])


def index_window(df: DataFrame, order: Sequence[str], first: int = 1, last: int | None = None) -> DataFrame:
    """Rows ``first`` to ``last`` (both counted from 1) of the ordered table.

    A short leading range is a top-k; a later or longer one numbers the rows in
    parallel and filters, so no single task holds the range.
    """
    if last is not None and last <= 10_000:
        ordered = df.orderBy(*sort_columns(order))
        return ordered.offset(first - 1).limit(max(0, last - first + 1)) if first > 1 else ordered.limit(last)
    numbered = row_index(df, None, order, "__row", 1)
    kept = numbered.filter(F.col("__row") >= first)
    return (kept if last is None else kept.filter(F.col("__row") <= last)).drop("__row")
