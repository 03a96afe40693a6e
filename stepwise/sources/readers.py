"""Batch readers and read-time options."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepwise.operators.agg import index_window


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_files(
    spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet", schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """Read parquet, CSV, JSON, ORC or text. Give a schema: inference reads the data twice."""
    if fmt == "csv":
        options = {"header": True, "inferSchema": schema is None, **options}
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_driver_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a folder with one parquet file (or folder) per table."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def jdbc_options(
    url: str,
    query: str,
    key: str | None = None,
    low: int | str | None = None,
    high: int | str | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC read of a subquery, split on ``key`` when bounds are given."""
    options = {"url": url, "dbtable": f"({query}) AS t", "fetchsize": str(fetch_size), **dict(properties or {})}
    if key is not None:
        if low is None or high is None:
            raise ValueError("a partitioned JDBC read needs low and high bounds of the key")
        options |= {
            "partitionColumn": key,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, query: str, **kwargs) -> DataFrame:
    """Push a subquery to the database; ``key``, ``low``, ``high``, ``partitions`` read it in parallel."""
    return spark.read.format("jdbc").options(**jdbc_options(url, query, **kwargs)).load()


def with_options(
    df: DataFrame,
    where: Column | str | None = None,
    keep: Sequence[str] | None = None,
    drop: Sequence[str] | None = None,
    rename: Mapping[str, str] | None = None,
    firstobs: int = 1,
    obs: int | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Read options of a step.

    ``where`` applies before rows are numbered; ``firstobs`` and ``obs`` are the first
    and the *last* row number and need an ``order``; names in ``keep`` and ``drop`` are
    the old ones, as ``rename`` comes last.
    """
    if where is not None:
        df = df.filter(where)
    if firstobs > 1 or obs is not None:
        if not order:
            raise ValueError("firstobs / obs need an order: a DataFrame has no row numbers")
        df = index_window(df, order, firstobs, obs)
    if keep is not None:
        df = df.select(*keep)
    if drop is not None:
        df = df.drop(*drop)
    return df.withColumnsRenamed(dict(rename)) if rename else df


def number_range(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    return spark.range(0, n, numPartitions=partitions)


def contents(df: DataFrame, table: str | None = None, profile: bool = True) -> DataFrame:
    """Column catalogue with a one-pass profile: name, type, position, counts, extremes, text length."""
    fields = df.schema.fields

    def described(i, f):
        return [
            F.lit(table).cast("string").alias("table_name"),
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(i + 1).alias("position"),
            F.lit(f.nullable).alias("nullable"),
        ]

    if not profile:
        rows = [F.struct(*described(i, f)) for i, f in enumerate(fields)]
        return df.sparkSession.range(1).select(F.inline(F.array(*rows)))
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.count(c).alias(f"__c{i}"))
        if isinstance(f.dataType, T.AtomicType):
            aggs += [F.min(c).cast("string").alias(f"__lo{i}"), F.max(c).cast("string").alias(f"__hi{i}")]
        if isinstance(f.dataType, T.StringType):
            aggs.append(F.max(F.length(c)).alias(f"__len{i}"))
    one = df.agg(*aggs)
    none = F.lit(None).cast("string")
    rows = []
    for i, f in enumerate(fields):
        atomic = isinstance(f.dataType, T.AtomicType)
        text = isinstance(f.dataType, T.StringType)
        rows.append(
            F.struct(
                *described(i, f),
                F.col(f"__c{i}").alias("n"),
                (F.col("__n") - F.col(f"__c{i}")).alias("nmiss"),
                (F.col(f"__lo{i}") if atomic else none).alias("min"),
                (F.col(f"__hi{i}") if atomic else none).alias("max"),
                (F.col(f"__len{i}") if text else F.lit(None).cast("int")).alias("max_length"),
            )
        )
    return one.select(F.inline(F.array(*rows)))


def contents_all(spark: SparkSession, database: str, profile: bool = False) -> DataFrame:
    """The catalogue of every table of a database."""
    parts = [contents(spark.read.table(f"{database}.{t.name}"), t.name, profile) for t in spark.catalog.listTables(database)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
