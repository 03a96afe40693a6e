"""Metric views: named measures, evaluated at whatever grain a query asks for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepwise.functions.scalars import week_start


@dataclass(frozen=True)
class Measure:
    expr: Column
    title: str = ""
    comment: str = ""
    kind: str = "number"


@dataclass
class MetricView:
    """Dimensions and measures over a source.

    Ratio and CASE measures are aggregate expressions, so they are always worked out
    from the rows of the requested grain and never averaged from finer results.
    """

    source: DataFrame
    dimensions: Mapping[str, Column]
    measures: Mapping[str, Measure]

    def query(
        self,
        dims: Sequence[str] | Mapping[str, Column] = (),
        measures: Sequence[str] | Mapping[str, str] | None = None,
        where: Column | str | None = None,
        having: Column | str | None = None,
    ) -> DataFrame:
        """``measures`` may rename: ``{out: measure}``. ``having`` filters on the result."""
        wanted = measures or list(self.measures)
        named = dict(wanted) if isinstance(wanted, Mapping) else {m: m for m in wanted}
        unknown = [m for m in named.values() if m not in self.measures]
        if unknown:
            raise ValueError(f"unknown measures {unknown}")
        if isinstance(dims, Mapping):
            grain = [e.alias(n) for n, e in dims.items()]
        else:
            grain = [self.dimensions[d].alias(d) for d in dims]
        rows = self.source if where is None else self.source.filter(where)
        out = rows.groupBy(*grain).agg(*[self.measures[m].expr.alias(n) for n, m in named.items()])
        return out if having is None else out.filter(having)

    def catalogue(self) -> list[tuple[str, str, str, str]]:
        return [(n, m.title, m.comment, m.kind) for n, m in self.measures.items()]


def baseline_status(
    df: DataFrame,
    ts: str,
    amount: Column,
    baseline: float,
    threshold: float,
    first_day: str = "monday",
    names: tuple[str, str, str] = ("week", "claim_count", "weekly_claims"),
) -> DataFrame:
    """Weekly totals against a baseline: ratio, percent over it, ALERT above the threshold."""
    week, n, total = names
    weekly = df.groupBy(week_start(ts, first_day).alias(week)).agg(
        F.count(F.lit(1)).alias(n), F.sum(amount).cast("double").alias(total)
    )
    ratio = F.col(total) / F.lit(float(baseline))
    return weekly.select(
        week,
        n,
        total,
        ratio.alias("ratio"),
        ((ratio - 1) * 100).alias("vs_baseline_pct"),
        F.when(ratio > threshold, "ALERT").otherwise("NORMAL").alias("status"),
    )


def weekly_projection(
    df: DataFrame,
    by: Sequence[str],
    ts: str,
    amount: Column,
    weeks: int = 26,
    ahead: int = 4,
    floor: float = 0.0,
) -> DataFrame:
    """Straight-line projection of weekly totals from the last ``weeks`` weeks, not below ``floor``."""
    weekly = df.groupBy(*by, week_start(ts).alias("week")).agg(F.sum(amount).cast("double").alias("amount"))
    end = df.select(F.max(week_start(ts))).scalar()
    recent = weekly.withColumn("x", (F.datediff(F.col("week"), end) / 7).cast("int")).filter(F.col("x") > -weeks)
    line = recent.groupBy(*by).agg(
        F.regr_slope("amount", "x").alias("slope"), F.regr_intercept("amount", "x").alias("intercept")
    )
    steps = line.select("*", F.explode(F.sequence(F.lit(1), F.lit(ahead))).alias("weeks_ahead"))
    return steps.select(
        *by,
        "weeks_ahead",
        F.date_add(end, F.col("weeks_ahead") * 7).alias("week"),
        F.greatest(F.lit(floor), F.col("intercept") + F.col("slope") * F.col("weeks_ahead")).alias("projected"),
    )
