"""Keyed merges with contribution flags.

A merge brings tables together on BY variables. ``keep`` says which keys survive,
in terms of the tables that contributed (``a``, ``b``). Missing keys match missing
keys. Of a column both tables have, the right one's value is taken wherever the
right table contributed, even when that value is missing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepwise.operators.bygroup import neighbours, retain_last, row_index
from stepwise.operators.ordering import as_list, order_keys, order_names, sort_columns
from stepwise.operators.skew import heavy_keys, salted_join

# Which join answers each contribution condition.
KEEP = {
    None: "full",
    "a or b": "full",
    "a": "left",
    "b": "right",
    "a and b": "inner",
    "a and not b": "left_anti",
    "b and not a": "right_anti",
    "not a and b": "right_anti",
}


def merge_by(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str] | str,
    keep: str | None = None,
    flags: tuple[str, str] | None = None,
    pairing: str = "join",
    order_left: Sequence[str] | None = None,
    order_right: Sequence[str] | None = None,
    overlay: str = "right",
    profile_left: DataFrame | None = None,
    match_missing: bool = True,
) -> DataFrame:
    """Merge two tables. ``flags`` names the two 0/1 contribution columns, if wanted.

    ``pairing="join"`` pairs all rows of a key, right for one-to-many keys.
    ``pairing="sequential"`` pairs row by row in the given orders and repeats the last
    row of the shorter side, which is what a record-by-record merge does.
    ``profile_left`` is a cheaper frame with the BY columns to look for heavy keys in.
    Keys that are never missing may say ``match_missing=False``: the join can then use a
    partitioning its inputs already have.
    """
    by = as_list(by)
    if keep not in KEEP:
        raise ValueError(f"unknown keep condition {keep!r}; use one of {sorted(k for k in KEEP if k)}")
    how = KEEP[keep]
    if how == "left_anti":
        return _with_flags(salted_join(left, right.select(*by), by, "left_anti", match_missing), flags, 1, 0, right, by)
    if how == "right_anti":
        return _with_flags(salted_join(right, left.select(*by), by, "left_anti", match_missing), flags, 0, 1, left, by)
    if pairing == "sequential":
        if not order_left or not order_right:
            raise ValueError("sequential pairing needs order_left and order_right")
        return _sequential(left, right, by, how, flags, list(order_left), list(order_right), overlay)
    if pairing != "join":
        raise ValueError(f"unknown pairing {pairing!r}")

    common = [c for c in left.columns if c in right.columns and c not in by]
    l = left.select(*by, *[F.col(c).alias(f"__l_{c}") if c in common else F.col(c) for c in left.columns if c not in by], F.lit(1).alias("__in_a"))
    r = right.select(*by, *[F.col(c).alias(f"__b_{c}") if c in common else F.col(c) for c in right.columns if c not in by], F.lit(1).alias("__in_b"))
    joined = salted_join(l, r, by, how, match_missing, profile_left=profile_left)
    return _shape(joined, left, right, by, common, flags, overlay)


def _shape(joined, left, right, by, common, flags, overlay) -> DataFrame:
    if overlay == "right":
        pick = {c: F.when(F.col("__in_b") == 1, F.col(f"__b_{c}")).otherwise(F.col(f"__l_{c}")) for c in common}
    elif overlay == "left":
        pick = {c: F.when(F.col("__in_a") == 1, F.col(f"__l_{c}")).otherwise(F.col(f"__b_{c}")) for c in common}
    else:
        raise ValueError(f"unknown overlay {overlay!r}")
    cols = [pick[c].alias(c) if c in common else F.col(c) for c in left.columns]
    cols += [F.col(c) for c in right.columns if c not in left.columns]
    if flags:
        cols += [F.coalesce(F.col(m), F.lit(0)).alias(n) for m, n in zip(("__in_a", "__in_b"), flags)]
    return joined.select(*cols)


def _with_flags(df, flags, a, b, other, by) -> DataFrame:
    """Anti forms: the absent table's own columns are missing."""
    fields = {f.name: f.dataType for f in other.schema.fields if f.name not in df.columns}
    df = df.select("*", *[F.lit(None).cast(t).alias(n) for n, t in fields.items()])
    return df.select("*", F.lit(a).alias(flags[0]), F.lit(b).alias(flags[1])) if flags else df


def _sequential(left, right, by, how, flags, order_left, order_right, overlay) -> DataFrame:
    """Row-by-row pairing in one pass: both sides are stacked and shuffled by the keys once.

    Rows are numbered per key and side. In the order of key, number and side, the last row seen
    of each side is carried along, so that the shorter side's last row is repeated; the last row of
    a number is the pair. Heavy keys are numbered and carried in chunks.
    """
    common = [c for c in left.columns if c in right.columns and c not in by]
    sides = ((left, order_left, "__a", 0), (right, order_right, "__b", 1))
    stacked, sort = None, ["__side"]
    for frame, order, name, side in sides:
        rest = F.struct(F.lit(1).alias("__in"), *[F.col(c) for c in frame.columns if c not in by]).alias(name)
        keys = [F.col(n).alias(f"__s{side}_{i}") for i, n in enumerate(order_names(order))]
        sort += [f"__s{side}_{i}" + (" desc" if desc else "") for i, (_, desc) in enumerate(order_keys(order))]
        part = frame.select(*by, F.lit(side).alias("__side"), *keys, rest)
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    pair = ["__rn", "__side"]
    if heavy_keys(stacked, by) is None:
        numbered = stacked.repartition(*by) if by else stacked
        numbered = numbered.withColumn("__rn", F.row_number().over(Window.partitionBy(*by, "__side").orderBy(*sort_columns(sort))))
        whole = Window.partitionBy(*by).orderBy(*pair)
        seen = whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        carried = numbered.select(
            *by, *pair, *[F.last(c, ignorenulls=True).over(seen).alias(c) for c in ("__a", "__b")], F.lead("__rn").over(whole).alias("__next")
        )
    else:
        numbered = row_index(stacked, [*by, "__side"], sort, "__rn", 1).select(*by, *pair, "__a", "__b")
        carried = neighbours(retain_last(numbered, by, pair, ["__a", "__b"]), by, pair, {"__next": ("__rn", -1)})
    pairs = carried.filter(F.col("__next").isNull() | (F.col("__next") != F.col("__rn")))
    needed = {"inner": ("__a", "__b"), "left": ("__a",), "right": ("__b",)}.get(how, ())
    for side in needed:
        pairs = pairs.filter(F.col(side).isNotNull())

    # Of a common column, the side read last for the pair has its say: the left one
    # once the right side has run out, the right one otherwise.
    from_left = F.col("__a").isNotNull() if overlay == "left" else F.col("__side") == 0

    def column(c):
        if c in by:
            return F.col(c)
        if c in common:
            return F.when(from_left, F.col(f"__a.`{c}`")).otherwise(F.col(f"__b.`{c}`")).alias(c)
        return F.col(f"__a.`{c}`" if c in left.columns else f"__b.`{c}`").alias(c)

    names = [column(c) for c in [*left.columns, *[c for c in right.columns if c not in left.columns]]]
    if flags:
        names += [F.col(side).isNotNull().cast("int").alias(flag) for side, flag in zip(("__a", "__b"), flags)]
    return pairs.select(*names)


def merge_many(
    tables: Sequence[DataFrame],
    by: Sequence[str] | str,
    keep: Callable[..., Column] | None = None,
    flags: Sequence[str] | None = None,
    unique: bool | Sequence[bool] = False,
) -> DataFrame:
    """Merge any number of tables; ``keep`` gets one boolean Column per table.

    Later tables overlay earlier ones. ``merge_many([a, b, c], "id", lambda a, b, c: a & ~c)``.
    ``unique`` says which tables have one row per key: they are stacked and reduced in one shuffle,
    and a key that does repeat there is an error. The others are joined, each row with all of its key.
    """
    by = as_list(by)
    single = [unique] * len(tables) if isinstance(unique, bool) else list(unique)
    names = [f"__t{i}" for i in range(len(tables))]
    held = [t.select(*by, F.struct(F.lit(1).alias("__in"), *[F.col(c) for c in t.columns if c not in by]).alias(n)) for t, n in zip(tables, names)]
    stacked = [(n, h) for n, h, one in zip(names, held, single) if one]
    out = None
    if stacked:
        union = stacked[0][1]
        for _, other in stacked[1:]:
            union = union.unionByName(other, allowMissingColumns=True)
        reduced = [F.first(n, ignorenulls=True).alias(n) for n, _ in stacked]
        most = F.greatest(*[F.count(n) for n, _ in stacked], F.lit(1))
        out = union.groupBy(*by).agg(*reduced, most.alias("__most"))
        out = out.filter(F.when(F.col("__most") > 1, F.raise_error(F.lit("a table said to have unique keys repeats one"))).otherwise(True)).drop("__most")
    for frame in (h for h, one in zip(held, single) if not one):
        out = frame if out is None else merge_by(out, frame, by)
    present = [F.col(n).isNotNull() for n in names]
    if keep is not None:
        out = out.filter(keep(*present))
    columns = list(dict.fromkeys(c for t in tables for c in t.columns))

    def column(c):
        if c in by:
            return F.col(c)
        value = None
        for n, here, table in zip(names, present, tables):  # the last one that contributed, even with a missing value
            if c in table.columns:
                value = F.when(here, F.col(f"{n}.`{c}`")) if value is None else F.when(here, F.col(f"{n}.`{c}`")).otherwise(value)
        return value.alias(c)

    marks = [p.cast("int").alias(f) for p, f in zip(present, flags)] if flags else []
    return out.select(*[column(c) for c in columns], *marks)
