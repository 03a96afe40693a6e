"""Skew-safe groups: find heavy keys, split them, and join across them.

A window over ``partitionBy(key)`` puts a whole group into one task. That is fine
until one key holds a large share of the table. ``split_groups`` looks for such
keys first (one pruned, map-side combined count), and cuts only those into ordered
chunks. Later steps run their window per (key, chunk) and carry a one-row summary
per chunk across the chunk boundaries, so the result is the same as with the plain
window but no task ever holds a heavy group. Without heavy keys the plain window is
planned and nothing else.

Heavy keys, cut points and chunk summaries are tables, never lists on the driver, and there
is no limit on their number: a key has as many chunks, or salts, as it holds times the
limit. Joins with these tables carry no hint; Spark broadcasts them where they are small.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from stepwise.operators.ordering import as_list, order_keys, order_names, sort_columns
from stepwise.session import hot_rows, stored

SAMPLED_ROWS = 400
#: Sampled rows between two cuts; a chunk's size varies by about one over the root of it.
CUT_SAMPLES = 64
WHOLE_TABLE_SHARE = 16
CHUNK = "__chunk"
GROUP_ROWS = "__group_rows"


def null_safe_equal(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [l.eqNullSafe(r) for l, r in zip(left, right)], F.lit(True))


def heavy_keys(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame | None:
    """Table of the keys with more than ``limit`` rows, or None when there is none.

    It has the key columns and the exact row count ``__group_rows``. A sample that holds
    about ``SAMPLED_ROWS`` rows of a key at the limit finds the candidates, so that a nearly
    unique key is not shuffled just to learn that it has no heavy values; only candidates are
    then counted. A key at the limit escapes half the expected sample with a probability far
    below 1e-20, and would still be processed correctly, in one task.
    """
    limit = hot_rows(df.sparkSession) if limit is None else limit
    keys = list(keys)
    rows = df.select(*keys)
    rate = SAMPLED_ROWS / limit if limit > SAMPLED_ROWS else 1.0
    if keys and rate < 1.0:
        seen = rows.sample(rate, seed=17).groupBy(*keys).agg(F.count(F.lit(1)).alias(GROUP_ROWS))
        seen = seen.filter(F.col(GROUP_ROWS) >= SAMPLED_ROWS // 2)
        if not seen.limit(1).collect():
            return None
        named = _named(stored(seen, "skew-candidates"), keys).drop(GROUP_ROWS)
        rows = rows.join(named, null_safe_equal([F.col(k) for k in keys], [F.col(n) for n in named.columns]), "left_semi")
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(GROUP_ROWS)).filter(F.col(GROUP_ROWS) > limit)
    found = stored(counts, "skew-keys")
    return found if found.limit(1).collect() else None


def _named(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key columns as ``__k0``, ``__k1``, ..., the others as they are."""
    rest = [c for c in table.columns if c not in keys]
    return table.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *rest)


def search_sorted(value: Column, bounds: Column, size: int, before: Callable[[Column], Column] | None = None) -> Column:
    """How many entries of the ordered array ``bounds`` are <= ``value``; 0 for NULL.

    A binary search written as a fold over the halving steps, so a lookup costs log2(size)
    comparisons however many bounds there are. ``before`` tells whether a bound is at or before
    the value where plain comparison is not the array's order.
    """
    steps = [1 << k for k in reversed(range(max(1, size.bit_length())))]
    test = before or (lambda bound: bound <= value)
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda pos, step: F.when((pos + step <= F.size(bounds)) & test(F.get(bounds, pos + step - 1)), pos + step).otherwise(pos),
    )


def at_or_before(bound: Column, values: Sequence[tuple[Column, bool]]) -> Column:
    """Whether a struct ``__o0``, ``__o1``, ... sorts at or before the values, each with its direction (True is descending)."""
    out = F.lit(True)
    for i, (value, desc) in reversed(list(enumerate(values))):
        own = bound[f"__o{i}"]
        less = (own.isNotNull() & value.isNull()) | (own > value) if desc else (own.isNull() & value.isNotNull()) | (own < value)
        out = F.coalesce(less, F.lit(False)) | (own.eqNullSafe(value) & out)
    return out


@dataclass
class Split:
    """``df`` with rows of heavy groups numbered by ordered chunk (NULL elsewhere)."""

    df: DataFrame
    by: list[str]
    order: list[str]
    hot: bool = False
    extra: list[str] = field(default_factory=list)

    @property
    def keys(self) -> list[str]:
        return self.by + ([CHUNK] if self.hot else [])

    def window(self, reverse: bool = False) -> WindowSpec:
        keys = self.keys or [F.lit(0)]
        return Window.partitionBy(*keys).orderBy(*sort_columns(self.order, reverse))

    def heavy_rows(self) -> DataFrame:
        return self.df.filter(F.col(CHUNK).isNotNull())

    def over_chunks(self) -> WindowSpec:
        """All earlier chunks of the same group, one row each."""
        return Window.partitionBy(*(self.by or [F.lit(0)])).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)

    def attach(self, df: DataFrame, summary: DataFrame) -> DataFrame:
        """Left join a summary of one row per (group, chunk); both sides have the join's partitioning already."""
        named = summary.select(
            *[F.col(k).alias(f"__s_{k}") for k in self.keys],
            *[c for c in summary.columns if c not in self.keys],
        )
        cond = null_safe_equal([F.col(k) for k in self.keys], [F.col(f"__s_{k}") for k in self.keys])
        return df.join(named, cond, "left").drop(*[f"__s_{k}" for k in self.keys])

    def done(self, df: DataFrame) -> DataFrame:
        return df.drop(CHUNK, *self.extra) if self.hot else df


def split_groups(
    df: DataFrame,
    by: Sequence[str] | str | None,
    order: Sequence[str] | str,
    profile: DataFrame | None = None,
    spread: bool = True,
) -> Split:
    """Detect heavy BY groups of ``df`` and cut them into chunks along ``order``.

    ``profile`` may be a cheaper frame with the same keys (for instance the table
    before its dimension joins) to take the statistics from. An empty ``by`` means
    the whole table is one group. With ``spread`` a split frame is repartitioned by
    (group, chunk): an input already partitioned by the group would otherwise satisfy
    the window and keep all chunks of a heavy group in one task.
    """
    by = as_list(by)
    keys = order_keys(order)
    order = [order] if isinstance(order, str) else list(order)
    source = df if profile is None else profile
    limit = hot_rows(df.sparkSession)
    if not by:
        # One group that is certain to hold everything: split it sooner, for parallelism.
        limit = max(2, limit // WHOLE_TABLE_SHARE)
    hot = heavy_keys(source, by, limit)
    if hot is None:
        return Split(df, by, order)

    # A sample decides only where the cuts go; every row is still processed. Each group is cut by itself,
    # in the order of all its sort keys, whatever their directions.
    names = order_names(order)
    step = max(1, limit // CUT_SAMPLES)
    sample = source.select(*dict.fromkeys([*by, *names])).filter(F.pmod(F.xxhash64(*names), F.lit(step)) == 0)
    heavy = _named(hot, by).drop(GROUP_ROWS)
    match = null_safe_equal([F.col(k) for k in by], [F.col(n) for n in heavy.columns])
    if by:
        sample = sample.join(heavy, match, "left_semi")
    numbered = sample.withColumn("__rn", F.row_number().over(Window.partitionBy(*(by or [F.lit(0)])).orderBy(*sort_columns(order))))
    cuts = numbered.filter(F.col("__rn") % max(1, limit // step) == 0)
    values = F.struct(*[F.col(n).alias(f"__o{i}") for i, n in enumerate(names)])
    listed = cuts.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("__rn", values.alias("at")))).alias("__cuts"))
    table = stored(_named(listed.withColumn("__cuts", F.transform("__cuts", lambda c: c["at"])), by), "skew-cuts")
    longest = table.agg(F.max(F.size("__cuts"))).first()[0]
    if not longest:
        return Split(df, by, order)
    if by:
        tagged = df.join(table, match, "left").drop(*heavy.columns)
    else:
        tagged = df.withColumn("__cuts", table.select("__cuts").scalar())
    row = [(F.col(name), desc) for name, desc in keys]
    position = search_sorted(values, F.col("__cuts"), longest, lambda cut: at_or_before(cut, row))
    tagged = tagged.withColumn(CHUNK, F.when(F.col("__cuts").isNotNull(), position)).drop("__cuts")
    return Split(tagged.repartition(*by, CHUNK) if spread else tagged, by, order, hot=True)


def with_halo(split: Split, before: int, after: int) -> DataFrame:
    """Rows of a split frame plus copies of the neighbours across chunk borders.

    Copies carry ``__halo = true``; a window per (group, chunk) then sees up to
    ``before`` rows behind and ``after`` rows ahead of every real row.
    """
    out = split.df.withColumn("__halo", F.lit(False))
    for size, backwards in ((before, True), (after, False)):
        if not size or not split.hot:
            continue
        # The rows next to each border, counted away from it.
        near = split.heavy_rows().withColumn("__at", F.row_number().over(split.window(reverse=backwards)))
        near = near.filter(F.col("__at") <= size)
        group = split.by or [F.lit(0)]
        direction = [F.asc(CHUNK), F.desc("__at")] if backwards else [F.desc(CHUNK), F.desc("__at")]
        near = near.withColumn("__idx", F.row_number().over(Window.partitionBy(*group).orderBy(*direction)))
        borders = near.groupBy(*split.by, CHUNK).agg(F.min("__idx").alias("__first"))
        wanted = borders.select(
            *[F.col(k).alias(f"__b_{k}") for k in split.by],
            F.col(CHUNK).alias("__to"),
            F.explode(F.sequence(F.col("__first") - size, F.col("__first") - 1)).alias("__want"),
        ).filter(F.col("__want") >= 1)
        cond = null_safe_equal([F.col(k) for k in split.by], [F.col(f"__b_{k}") for k in split.by]) & (
            F.col("__idx") == F.col("__want")
        )
        copies = (
            near.join(wanted, cond)
            .withColumn(CHUNK, F.col("__to"))
            .withColumn("__halo", F.lit(True))
            .select(*out.columns)
        )
        out = out.unionByName(copies)
    return out


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | str,
    how: str = "inner",
    null_safe: bool = False,
    profile_left: DataFrame | None = None,
    profile_right: DataFrame | None = None,
    unique_left: bool = False,
    unique_right: bool = False,
) -> DataFrame:
    """Equi-join that survives a key with a large share of either side.

    Adaptive execution splits a skewed partition of the side an outer join preserves,
    and of either side of an inner join; the other cases are handled here. Heavy keys of
    a side are looked up where Spark cannot split it, or where a ``profile`` frame (with
    the key columns, cheaper than the side itself) is given. ``unique_*`` says a side has
    one row per key. Without heavy keys this is the plain join.

    With some, it is one join on the keys and a salt: rows of a heavy key are spread on one side, over
    as many values as the key holds times the limit, and repeated once per value on the other; all other
    rows have salt 0. Only rows that stand once may be preserved by an outer join, so unmatched rows of
    a side that is repeated, or of the second side of a full join, are added by an anti join.
    Which keys are split never changes the result, whatever the profile says. Columns of
    ``on`` appear once in the result.
    """
    on = as_list(on)
    if how in ("left_semi", "left_anti"):
        # Only existence counts; the reduced side keeps the join's partitioning.
        right, unique_right = right.select(*on).distinct(), True

    def heavy(side, profile, unique, splittable):
        return None if unique or (splittable and profile is None) else heavy_keys(side if profile is None else profile, on)

    hot_left = heavy(left, profile_left, unique_left, how in ("inner", "left", "left_semi", "left_anti"))
    hot_right = heavy(right, profile_right, unique_right, how in ("inner", "right"))
    hot = [_named(rows, on).withColumn("__side", F.lit(side)) for side, rows in (("l", hot_left), ("r", hot_right)) if rows is not None]
    if not hot:
        return _join_once(left, right, on, how, null_safe)

    # A key that is heavy on both sides is spread on the one that holds more.
    names = [f"__k{i}" for i in range(len(on))]
    top = F.max(F.struct(GROUP_ROWS, F.when(F.col("__side") == "l", 1).otherwise(0).alias("first"), "__side")).alias("top")
    salts = F.ceil(F.col(f"top.{GROUP_ROWS}") / F.lit(hot_rows(left.sparkSession))).cast("int")
    table = reduce(DataFrame.unionByName, hot).groupBy(*names).agg(top).select(*names, "top.__side", salts.alias("__salts"))
    if not null_safe:
        table = table.dropna(subset=names)
    table = stored(table, "skew-salts")
    sides = {r[0] for r in table.select("__side").distinct().collect()}
    if not sides:
        return _join_once(left, right, on, how, null_safe)

    def salted(df, own):
        cond = null_safe_equal([F.col(k) for k in on], [F.col(n) for n in names])
        tagged = df.join(table, cond, "left").drop(*names)
        # From the row's own values, so that a recomputed task repeats its salts.
        one = F.pmod(F.xxhash64(*df.columns), F.col("__salts").cast("long")).cast("int")
        every = F.sequence(F.lit(0), F.col("__salts") - 1)
        values = F.when(F.col("__side").isNull(), F.array(F.lit(0))).when(F.col("__side") == own, F.array(one)).otherwise(every)
        return tagged.withColumn("__salt", F.explode(values)).drop("__side", "__salts")

    def once(kind):
        return _join_once(salted(left, "l"), salted(right, "r"), [*on, "__salt"], kind, null_safe).drop("__salt")

    def unmatched(side, other):
        """Rows of a side whose key the other one lacks, in the columns of the result."""
        alone = _join_once(side, other.select(*on).distinct(), on, "left_anti", null_safe)
        fields = {f.name: f.dataType for f in other.schema.fields if f.name not in on}
        empty = [F.lit(None).cast(kind).alias(name) for name, kind in fields.items()]
        return alone.select("*", *empty).select(*on, *[c for c in [*left.columns, *right.columns] if c not in on])

    if how in ("inner", "left_semi", "left_anti"):
        return once(how)
    repeated = {"left": "r", "right": "l"}.get(how)
    if repeated and repeated not in sides:
        return once(how)
    out = once("inner")
    if how in ("left", "full", "outer"):
        out = out.unionByName(unmatched(left, right))
    if how in ("right", "full", "outer"):
        out = out.unionByName(unmatched(right, left))
    return out


def _join_once(left: DataFrame, right: DataFrame, on: list[str], how: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, on, how)
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in on], *[c for c in right.columns if c not in on]
    )
    cond = null_safe_equal([F.col(k) for k in on], [F.col(f"__r_{k}") for k in on])
    joined = left.join(renamed, cond, how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how in ("right", "full", "outer"):
        keys = [F.coalesce(F.col(k), F.col(f"__r_{k}")).alias(k) for k in on]
    else:
        keys = [F.col(k) for k in on]
    rest = [c for c in left.columns if c not in on] + [c for c in right.columns if c not in on]
    return joined.select(*keys, *rest)
