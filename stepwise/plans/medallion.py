"""Audit columns and publishing of pipeline nodes."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepwise.functions.scalars import now


def add_audit(df: DataFrame, source: str, layer: str = "bronze", at=None) -> DataFrame:
    """Ingestion time, source, ingestion date and layer. ``at`` pins the clock."""
    stamp = now(at)
    return df.select(
        "*",
        stamp.alias("bronze_ingestion_timestamp"),
        F.lit(source).alias("bronze_source_file"),
        F.to_date(stamp).alias("bronze_ingestion_date"),
        F.lit(layer).alias("medallion_layer"),
    )


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """An intermediate result by name; Spark inlines it, nothing is stored."""
    df.createOrReplaceTempView(name)
    return df


def publish_table(df: DataFrame, name: str) -> DataFrame:
    """A stored result; readers start from the table, not from the plan behind it."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.read.table(name)


Node = Callable[..., DataFrame]


def define_pipeline(nodes: Mapping[str, tuple[Node, str]], spark: Callable[[], SparkSession]) -> None:
    """Register nodes with Spark's declarative pipelines module, which orders and runs them.

    ``nodes`` is ``{name: (function of the session, "view" | "table")}``. Call it from a
    pipeline definition file; nothing is computed here.
    """
    from pyspark import pipelines as dp

    for name, (make, kind) in nodes.items():
        wrap = dp.temporary_view if kind == "view" else dp.materialized_view

        def run(make=make) -> DataFrame:
            return make(spark())

        wrap(name=name)(run)
