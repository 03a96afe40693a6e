"""Sorting, limits, unions and row differences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepwise.operators.ordering import as_list, sort_columns
from stepwise.operators.skew import salted_join


def sort_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Global sort, missing values smallest. Only for results: no operator needs sorted input."""
    return df.orderBy(*sort_columns(keys))


def top_k(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    return df.orderBy(*sort_columns(order)).limit(k)


def concat(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, columns matched by name."""
    return reduce(DataFrame.unionByName, tables)


def count_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    return reduce(
        DataFrame.unionByName,
        [t.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, t in tables.items()],
    )


def diff(a: DataFrame, b: DataFrame, keys: Sequence[str] | str, tolerance: float | None = None) -> DataFrame:
    """Rows that differ between two tables with unique keys.

    Gives the keys, ``change`` (added, removed, changed) and the names of the changed
    columns. Numbers within ``tolerance`` count as equal.
    """
    keys = as_list(keys)
    values = [c for c in a.columns if c not in keys and c in b.columns]
    left = a.select(*keys, F.struct(*[F.col(c) for c in values], F.lit(1).alias("__x")).alias("__a"))
    right = b.select(*keys, F.struct(*[F.col(c) for c in values], F.lit(1).alias("__x")).alias("__b"))
    joined = salted_join(left, right, keys, "full", null_safe=True, unique_left=True, unique_right=True)
    numeric = {f.name for f in a.schema.fields if f.dataType.typeName() in ("double", "float", "integer", "long", "decimal", "short", "byte")}

    def same(c: str) -> Column:
        x, y = F.col(f"__a.{c}"), F.col(f"__b.{c}")
        exact = x.eqNullSafe(y)
        if tolerance is not None and c in numeric:
            return exact | F.coalesce(F.abs(x - y) <= tolerance, F.lit(False))
        return exact

    changed = F.concat_ws(",", *[F.when(~same(c), F.lit(c)) for c in values]) if values else F.lit("")
    kind = F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed").when(changed != "", "changed")
    out = joined.select(*keys, kind.alias("change"), F.when(kind == "changed", changed).alias("columns"))
    return out.filter(F.col("change").isNotNull())


def diff_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Multiset difference both ways for tables without a key, with its side and count."""
    cols = a.columns
    both = a.select(*cols, F.lit(1).alias("__s")).unionByName(b.select(*cols, F.lit(-1).alias("__s")))
    net = both.groupBy(*cols).agg(F.sum("__s").alias("__net")).filter(F.col("__net") != 0)
    return net.select(
        *cols, F.when(F.col("__net") > 0, "only_a").otherwise("only_b").alias("side"), F.abs("__net").alias("copies")
    )
