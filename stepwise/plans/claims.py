"""Claims pipeline: enrichment, daily and weekly summaries, batch analysis, metric views.

Every node is a plain function from DataFrames to a DataFrame, so Spark sees one lazy
plan; see ``medallion`` for how to store or publish a node.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepwise.operators.agg import share_of_total, top_n_other
from stepwise.operators.joins import pick_top_join
from stepwise.operators.metrics import Measure, MetricView, baseline_status
from stepwise.operators.project import case_of
from stepwise.operators.quality import keep_ok
from stepwise.session import stored

# The business thresholds.
BASELINE_WEEKLY = 2_500_000.0
SPIKE_RATIO = 1.25
HIGH_AMOUNT, WATER_HIGH_AMOUNT, MEDIUM_AMOUNT = 10_000, 5_000, 3_000

BRONZE_RULES = {
    "valid_claim_id": "claim_id IS NOT NULL",
    "valid_amount": "claim_amount_usd > 0",
    "valid_date": "claim_date IS NOT NULL",
}
SILVER_RULES = {"positive_amount": "claim_amount_usd > 0", "valid_policy": "policy_id IS NOT NULL"}

POLICY_COLUMNS = ["policyholder_name", "state", "city", "policyholder_lat", "policyholder_lng", "policy_type", "coverage_limit_usd"]
APPLIANCE_COLUMNS = ["model_name", "manufacturer", "category"]


def mean(col: str, cond: Column | None = None) -> Column:
    """Average as sum over count, so that decimal money keeps its full precision."""
    value = F.col(col) if cond is None else F.when(cond, F.col(col))
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def total(col: str, cond: Column | None = None) -> Column:
    value = F.col(col) if cond is None else F.when(cond, F.col(col)).otherwise(0)
    return F.sum(value).cast("double")


def severity(claim_type: Column, amount: Column) -> Column:
    return case_of(
        [
            ((claim_type == "water_damage") & (amount > WATER_HIGH_AMOUNT), "high"),
            (amount > HIGH_AMOUNT, "high"),
            (amount > MEDIUM_AMOUNT, "medium"),
        ],
        "low",
    )


def bronze_claims(raw: DataFrame) -> DataFrame:
    """Claims that meet the bronze rules; ``validate`` with the same rules gives the counts of the others."""
    return keep_ok(raw, BRONZE_RULES)


def enrich_claims(
    claims: DataFrame, policies: DataFrame, appliances: DataFrame, batches: DataFrame, affected_batch
) -> DataFrame:
    """Claims with policyholder, appliance and batch columns, affected flag and severity.

    The policy's state and the derived severity win; the claim's own state is kept as
    ``claim_state``. Rows that fail the silver rules are dropped before the joins, so the
    filters reach the scan.
    """
    good = keep_ok(claims, SILVER_RULES)
    if "state" in good.columns:
        good = good.withColumnRenamed("state", "claim_state")
    good = good.drop("severity")

    def pick(dim, key, cols):
        return dim.select(key, *[c for c in cols if c in dim.columns])

    batch = batches.select("appliance_batch_id", "plant_location", F.col("status").alias("batch_status"))
    return (
        good.join(pick(policies, "policy_id", POLICY_COLUMNS), "policy_id", "left")
        .join(pick(appliances, "appliance_id", APPLIANCE_COLUMNS), "appliance_id", "left")
        .join(batch, "appliance_batch_id", "left")
        .withColumn("is_affected_batch", F.coalesce(F.col("appliance_batch_id") == affected_batch, F.lit(False)))
        .withColumn("severity", severity(F.col("claim_type"), F.col("claim_amount_usd")))
    )


def daily_summary(silver: DataFrame) -> DataFrame:
    return silver.groupBy(F.to_date("claim_date").alias("date"), "state", "claim_type").agg(
        F.count(F.lit(1)).alias("claim_count"), F.sum("claim_amount_usd").alias("claim_amount_usd")
    )


def weekly_summary(
    silver: DataFrame, baseline: float = BASELINE_WEEKLY, threshold: float = SPIKE_RATIO, first_day: str = "monday"
) -> DataFrame:
    return baseline_status(silver, "claim_date", F.col("claim_amount_usd"), baseline, threshold, first_day)


def batch_analysis(silver: DataFrame) -> DataFrame:
    """Claims of the affected batch by state, type, model and plant, with their share."""
    grouped = (
        silver.filter("is_affected_batch")
        .groupBy("state", "claim_type", "model_name", "plant_location")
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            total("claim_amount_usd").alias("total_amount"),
            mean("claim_amount_usd").alias("avg_amount"),
            F.min("claim_date").alias("first_claim_date"),
            F.max("claim_date").alias("last_claim_date"),
        )
    )
    return share_of_total(stored(grouped, "batch-analysis"), "claim_count")


def performance_view(daily: DataFrame, baseline: float = BASELINE_WEEKLY, threshold: float = SPIKE_RATIO) -> MetricView:
    """KPIs over the daily summary.

    ``summary_rows`` counts the daily rows, as the original definition of the claim count
    does; ``claim_count`` adds up the claims behind them.
    """
    amount = total("claim_amount_usd")
    ratio = amount / F.lit(baseline)
    return MetricView(
        daily,
        {"date": F.col("date"), "state": F.col("state"), "claim_type": F.col("claim_type")},
        {
            "total_claims_usd": Measure(amount, "Total claims", "Sum of claim amounts", "currency"),
            "summary_rows": Measure(F.count(F.lit(1)), "Summary rows", "Daily summary rows"),
            "claim_count": Measure(F.sum("claim_count"), "Claim count", "Claims filed"),
            "avg_claim_amount": Measure(mean("claim_amount_usd"), "Average amount", "Mean of the daily rows", "currency"),
            "avg_per_claim": Measure(F.try_divide(amount, F.sum("claim_count")), "Average claim", "Amount per claim", "currency"),
            "baseline_ratio": Measure(ratio, "Baseline ratio", "Amount over the weekly baseline", "ratio"),
            "spike_alert": Measure(F.when(ratio > threshold, 1).otherwise(0), "Spike alert", "1 above the threshold"),
        },
    )


def affected_view(silver: DataFrame) -> MetricView:
    hit = F.col("is_affected_batch")
    affected = total("claim_amount_usd", hit)
    return MetricView(
        silver,
        {"state": F.col("state"), "model_name": F.col("model_name")},
        {
            "affected_claim_count": Measure(F.count_if(hit), "Affected claims"),
            "affected_claims_usd": Measure(affected, "Affected amount", kind="currency"),
            "affected_pct": Measure(F.try_divide(affected, total("claim_amount_usd")), "Affected share", kind="percent"),
            "normal_claim_count": Measure(F.count_if(~hit), "Normal claims"),
            "avg_affected_claim": Measure(mean("claim_amount_usd", hit), "Average affected claim", kind="currency"),
        },
    )


def drill_down(silver: DataFrame, filters: Mapping[str, object], by: str, k: int | None = None) -> DataFrame:
    """One step of a root-cause search: claims by ``by`` under the findings so far."""
    rows = silver
    for name, value in filters.items():
        rows = rows.filter(F.col(name).like(value) if isinstance(value, str) and "%" in value else F.col(name) == value)
    counted = rows.groupBy(by).agg(F.count(F.lit(1)).alias("claim_count"), total("claim_amount_usd").alias("total_amount"))
    return counted if k is None else counted.orderBy(F.desc("claim_count"), F.asc(by)).limit(k)


def driving_batch(silver: DataFrame, batches: DataFrame, model_pattern: str) -> DataFrame:
    """The batch record with the most claims among the models that match a pattern."""
    counts = (
        silver.filter(F.col("model_name").like(model_pattern) & F.col("appliance_batch_id").isNotNull())
        .groupBy("appliance_batch_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return pick_top_join(batches, counts, "appliance_batch_id", ["n desc", "appliance_batch_id"])


def flow_counts(silver: DataFrame, n: int = 10) -> DataFrame:
    """Type -> model -> batch flows; long tails become "Other"."""
    # One pass shrinks the claims to their distinct flows; ranking and relabelling work on those.
    flows = silver.groupBy("claim_type", "model_name", F.col("appliance_batch_id").cast("string").alias("batch")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("claim_amount_usd").alias("amount")
    )
    flows = stored(flows, "flows")
    named = top_n_other(flows, "model_name", n, F.col("n"), "Other models")
    named = top_n_other(named, "batch", n, F.col("n"), "Other batches")
    return named.groupBy("claim_type", "model_name", "batch").agg(
        F.sum("n").alias("claim_count"), total("amount").alias("claim_amount")
    )


def city_table(silver: DataFrame) -> DataFrame:
    return silver.groupBy("city", "state").agg(
        F.countDistinct("claim_id").alias("claims"), total("claim_amount_usd").alias("claim_amount")
    )


def affected_split(silver: DataFrame, by: str) -> DataFrame:
    """Affected against normal claims by one dimension."""
    source = F.when(F.col("is_affected_batch"), "Affected batch").otherwise("Normal claims")
    return silver.groupBy(by, source.alias("source")).agg(
        F.count(F.lit(1)).alias("claims"), total("claim_amount_usd").alias("claim_amount"), mean("claim_amount_usd").alias("avg_amount")
    )


def kpis(silver: DataFrame) -> DataFrame:
    return silver.agg(
        total("claim_amount_usd").alias("claims_usd"),
        F.count(F.lit(1)).alias("claim_count"),
        total("claim_amount_usd", F.col("claim_type") == "water_damage").alias("water_damage_usd"),
        F.countDistinct("policy_id").alias("active_policies"),
    )
