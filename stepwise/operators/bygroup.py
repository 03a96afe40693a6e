"""Ordered BY-group operators: first/last rows, running totals, carry-forward, lags.

All of them take ``by`` (the group columns), and ``order`` (order keys inside the
group, ending in a unique tie-breaker). Heavy groups are split, see ``skew``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepwise.functions.missing import missing_gt
from stepwise.operators.ordering import as_list, order_keys, sort_columns
from stepwise.operators.skew import CHUNK, heavy_keys, salted_join, split_groups, with_halo

Expr = Column | str | int | float


def _expr(value: Expr) -> Column:
    """A column name or Column as itself, a number as a literal."""
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def by_flags(
    df: DataFrame,
    by: Sequence[str] | str,
    order: Sequence[str] | str,
    first: str = "first_{}",
    last: str = "last_{}",
    profile: DataFrame | None = None,
) -> DataFrame:
    """Add ``first_x`` / ``last_x`` booleans for every BY variable ``x``.

    ``first_x`` marks the first row of the group formed by the BY variables up to
    and including ``x``. One sort on the full BY list serves all flags: a flag is set
    where any of those variables differs from the neighbouring row.
    """
    by = as_list(by)
    head, rest = by[:1], by[1:] + ([order] if isinstance(order, str) else list(order))
    split = split_groups(df, head, rest, profile)
    w = split.window()
    columns = []
    for step, name in ((-1, first), (1, last)):
        shift = F.lag if step < 0 else F.lead
        edge = shift(F.lit(1)).over(w).isNull()
        for i, key in enumerate(by):
            if i:
                edge = edge | ~F.col(key).eqNullSafe(shift(key).over(w))
            columns.append(edge.alias(name.format(key)))
    if not split.hot:
        return split.df.select("*", *columns)
    flagged = with_halo(split, 1, 1).select("*", *columns)
    return split.done(flagged.filter(~F.col("__halo")).drop("__halo"))


def keep_first(df: DataFrame, by: Sequence[str] | str, order: Sequence[str] | str, n: int = 1) -> DataFrame:
    """The first ``n`` rows of every group.

    Spark plans ``row_number() <= n`` with a group limit before the shuffle, so a
    heavy group sends at most ``n`` rows per map task.
    """
    w = Window.partitionBy(*as_list(by)).orderBy(*sort_columns(order))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def keep_last(df: DataFrame, by: Sequence[str] | str, order: Sequence[str] | str, n: int = 1) -> DataFrame:
    """The last ``n`` rows of every group."""
    w = Window.partitionBy(*as_list(by)).orderBy(*sort_columns(order, reverse=True))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def group_size(
    df: DataFrame, by: Sequence[str] | str, out: str = "group_size", profile: DataFrame | None = None
) -> DataFrame:
    """Row count of the group on every row.

    With heavy groups the counts are a reduced table that is joined back, which adaptive execution
    splits. ``profile`` is only looked at to find out whether there are any.
    """
    by = as_list(by)
    if heavy_keys(df if profile is None else profile, by) is None:
        return df.withColumn(out, F.count(F.lit(1)).over(Window.partitionBy(*by)))
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias(out))
    return salted_join(df, sizes, by, "left", null_safe=True, unique_left=True, unique_right=True).select(*df.columns, out)


def dup_flag(
    df: DataFrame,
    by: Sequence[str] | str,
    out: str = "dup_flag",
    labels: tuple = ("Y", "N"),
    profile: DataFrame | None = None,
) -> DataFrame:
    """Flag rows whose BY key occurs more than once: not (first and last)."""
    sized = group_size(df, by, "__size", profile)
    return sized.withColumn(out, F.when(F.col("__size") > 1, labels[0]).otherwise(labels[1])).drop("__size")


def retain_sum(
    df: DataFrame,
    by: Sequence[str] | str | None,
    order: Sequence[str] | str,
    sums: Mapping[str, Expr],
    reset_on: str | None = None,
    init: float | int = 0,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Running totals, one or several at once, restarting at each first ``reset_on``.

    Missing increments count as zero. ``reset_on`` names one of the BY variables;
    without it the total runs on over the whole table in BY and ``order`` sequence.
    """
    by = as_list(by)
    if reset_on is not None and reset_on not in by:
        raise ValueError(f"reset_on {reset_on!r} is not one of the BY variables {by}")
    group = by[: by.index(reset_on) + 1] if reset_on else []
    sequence = by[len(group):] + ([order] if isinstance(order, str) else list(order))
    order_keys(order)
    split = split_groups(df, group, sequence, profile)
    w = split.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = {name: F.coalesce(_expr(e), F.lit(0)) for name, e in sums.items()}
    start = F.lit(init)
    if not split.hot:
        return split.df.select(
            "*", *[(F.sum(e).over(w) + start if init else F.sum(e).over(w)).alias(n) for n, e in parts.items()]
        )
    local = split.df.select("*", *[F.sum(e).over(w).alias(n) for n, e in parts.items()])
    totals = split.heavy_rows().groupBy(*split.keys).agg(*[F.sum(e).alias(f"__t_{n}") for n, e in parts.items()])
    before = totals.select(
        *split.keys, *[F.sum(f"__t_{n}").over(split.over_chunks()).alias(f"__o_{n}") for n in parts]
    )
    joined = split.attach(local, before)
    for n in parts:
        total = F.col(n) + F.coalesce(F.col(f"__o_{n}"), F.lit(0))
        joined = joined.withColumn(n, total + start if init else total)
    return split.done(joined.drop(*[f"__o_{n}" for n in parts]))


def row_index(
    df: DataFrame,
    by: Sequence[str] | str | None,
    order: Sequence[str] | str,
    out: str = "row_index",
    start: int = 0,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Position of the row in its group (or in the whole table), from ``start``."""
    by = as_list(by)
    numbered = retain_sum(df, by, order, {out: F.lit(1).cast("long")}, by[-1] if by else None, profile=profile)
    return numbered.withColumn(out, (F.col(out) - 1 + start).cast("long"))


def retain_last(
    df: DataFrame,
    by: Sequence[str] | str | None,
    order: Sequence[str] | str,
    cols: Mapping[str, str] | Sequence[str],
    profile: DataFrame | None = None,
) -> DataFrame:
    """Carry the last non-missing value forward. ``cols`` is ``{out: source}`` or names."""
    by = as_list(by)
    pairs = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}
    split = split_groups(df, by, order, profile)
    w = split.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = {out: F.last(src, ignorenulls=True).over(w) for out, src in pairs.items()}
    local = split.df.select("*", *[c.alias(f"__c_{o}") for o, c in carried.items()])
    if split.hot:
        tails = local.filter(F.col(CHUNK).isNotNull()).withColumn(
            "__rn", F.row_number().over(split.window(reverse=True))
        )
        tails = tails.filter(F.col("__rn") == 1)
        before = tails.select(
            *split.keys,
            *[F.last(f"__c_{o}", ignorenulls=True).over(split.over_chunks()).alias(f"__p_{o}") for o in pairs],
        )
        local = split.attach(local, before)
        for o in pairs:
            local = local.withColumn(f"__c_{o}", F.coalesce(f"__c_{o}", f"__p_{o}")).drop(f"__p_{o}")
    keep = [c for c in df.columns if c not in pairs]
    return local.select(*keep, *[F.col(f"__c_{o}").alias(o) for o in pairs])


def neighbours(
    df: DataFrame,
    by: Sequence[str] | str | None,
    order: Sequence[str] | str,
    cols: Mapping[str, tuple[str, int]],
    profile: DataFrame | None = None,
) -> DataFrame:
    """Values of rows ``n`` steps back (positive) or ahead (negative) in the group.

    ``cols`` is ``{out: (source, n)}``; NULL where the group ends first.
    """
    split = split_groups(df, as_list(by), order, profile)
    w = split.window()
    values = [(F.lag(src, n) if n >= 0 else F.lead(src, -n)).over(w).alias(out) for out, (src, n) in cols.items()]
    if not split.hot:
        return split.df.select("*", *values)
    back = max([n for _, n in cols.values() if n > 0], default=0)
    ahead = max([-n for _, n in cols.values() if n < 0], default=0)
    seen = with_halo(split, back, ahead).select("*", *values)
    return split.done(seen.filter(~F.col("__halo")).drop("__halo"))


def lag_by(df, by, order, cols: Mapping[str, str], n: int = 1, profile=None) -> DataFrame:
    return neighbours(df, by, order, {out: (src, n) for out, src in cols.items()}, profile)


def lead_by(df, by, order, cols: Mapping[str, str], n: int = 1, profile=None) -> DataFrame:
    return neighbours(df, by, order, {out: (src, -n) for out, src in cols.items()}, profile)


def dif_by(df, by, order, cols: Mapping[str, str], n: int = 1, profile=None) -> DataFrame:
    """Difference to the value ``n`` rows earlier in the group."""
    shifted = neighbours(df, by, order, {f"__d_{o}": (s, n) for o, s in cols.items()}, profile)
    return shifted.select("*", *[(F.col(s) - F.col(f"__d_{o}")).alias(o) for o, s in cols.items()]).drop(
        *[f"__d_{o}" for o in cols]
    )


def running_limit(
    df: DataFrame,
    by: Sequence[str] | str,
    order: Sequence[str] | str,
    amount: Expr,
    limit: Expr,
    total: str = "running_total",
    flag: str = "limit_exceeded",
    profile: DataFrame | None = None,
) -> DataFrame:
    """Running total per BY group and a Y/N flag once it passes ``limit``.

    A missing limit is smaller than any total, so it counts as exceeded.
    """
    by = as_list(by)
    out = retain_sum(df, by, order, {total: amount}, by[-1], profile=profile)
    return out.withColumn(flag, F.when(missing_gt(F.col(total), _expr(limit)), "Y").otherwise("N"))
