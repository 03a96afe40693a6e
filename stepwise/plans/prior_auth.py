"""Prior authorisation: coverage on the service date, benefit limits, decision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepwise.functions.scalars import period_key
from stepwise.operators.joins import ELIGIBLE, span_status
from stepwise.operators.project import case_block, case_of, route

WITHIN = "WITHIN_LIMITS"


def coverage(requests: DataFrame, eligibility: DataFrame) -> DataFrame:
    pending = requests.filter("request_status = 'PENDING'").withColumn("coverage_period", period_key("service_date"))
    rows = pending.join(eligibility, "member_id", "left")
    status = span_status(F.col("service_date"), F.col("effective_date"), F.col("termination_date"))
    return rows.withColumn("eligibility_status", status)


def benefit_check(covered: DataFrame, limits: DataFrame, used: DataFrame) -> DataFrame:
    """Limits of the plan's service and what the member has used in the period."""
    rows = (
        covered.filter(F.col("eligibility_status") == ELIGIBLE)
        .join(limits, ["plan_id", "service_code"])
        .join(used, ["member_id", "coverage_period"], "left")
    )
    return rows.withColumn(
        "benefit_limit_status",
        case_of(
            [
                ("visits_used_ytd >= visits_allowed_per_year", "VISIT_LIMIT_EXCEEDED"),
                ("dollars_used_ytd >= dollar_limit_per_year", "DOLLAR_LIMIT_EXCEEDED"),
            ],
            WITHIN,
        ),
    )


def decide(checked: DataFrame) -> DataFrame:
    """Decision and reason. The decision time is set after the row is written, so it stays missing."""
    rows = case_block(
        checked,
        [
            (
                (F.col("eligibility_status") == ELIGIBLE) & (F.col("benefit_limit_status") == WITHIN),
                {"decision": "APPROVED", "denial_reason": ""},
            ),
            (F.col("eligibility_status") != ELIGIBLE, {"decision": "DENIED", "denial_reason": F.col("eligibility_status")}),
        ],
        {"decision": "DENIED", "denial_reason": F.col("benefit_limit_status")},
    )
    return rows.withColumn("decision_date", F.lit(None).cast("date")).withColumn(
        "decision_timestamp", F.lit(None).cast("timestamp")
    )


def prior_authorisation(requests: DataFrame, eligibility: DataFrame, limits: DataFrame, used: DataFrame) -> DataFrame:
    return decide(benefit_check(coverage(requests, eligibility), limits, used))


def outputs(decided: DataFrame) -> dict[str, DataFrame]:
    return route(decided, [("pa_decisions", "decision = 'APPROVED'")], "pa_denials")


def summary(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("decision").agg(
        F.count(F.lit(1)).alias("request_count"), F.sum("estimated_cost").cast("double").alias("total_cost")
    )
