"""Registration of runnable queries and the SQL each one must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepwise.sources.readers import read_driver_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Tables of a data folder as attributes; each one is a lazy parquet scan, opened once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        frame = read_driver_table(self.spark, self.folder, name)
        setattr(self, name, frame)
        return frame


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its SQL twin."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return wrap


def money(col: str) -> Column:
    """Exact two-digit money, so that a sum does not depend on the order of addition."""
    return F.col(col).cast("decimal(18,2)")


def dbl(col: Column) -> Column:
    return col.cast("double")
