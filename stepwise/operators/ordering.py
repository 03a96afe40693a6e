"""Order specifications.

A DataFrame has no row order, so every order-dependent operator takes an explicit
list of order keys that ends in a unique tie-breaker. A key is a column name,
optionally followed by ``" desc"``. Missing values sort as the smallest value,
which is Spark's default (first ascending, last descending).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_keys(order: Sequence[str] | str) -> list[tuple[str, bool]]:
    """``["ts desc", "id"]`` -> ``[("ts", True), ("id", False)]``."""
    keys = [order] if isinstance(order, str) else list(order or ())
    if not keys:
        raise ValueError("an order-dependent operator needs an explicit order key list")
    out = []
    for key in keys:
        name, _, direction = key.strip().partition(" ")
        direction = direction.strip().lower()
        if direction not in ("", "asc", "desc"):
            raise ValueError(f"unknown sort direction in order key {key!r}")
        out.append((name, direction == "desc"))
    return out


def order_names(order: Sequence[str] | str) -> list[str]:
    return [name for name, _ in order_keys(order)]


def sort_columns(order: Sequence[str] | str, reverse: bool = False) -> list[Column]:
    return [
        F.col(name).desc_nulls_last() if desc != reverse else F.col(name).asc_nulls_first()
        for name, desc in order_keys(order)
    ]


def as_list(names: Sequence[str] | str | None) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)
