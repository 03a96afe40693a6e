"""Claims adjudication: eligibility, network, duplicates, running limit, decision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepwise.functions.formats import ValueFormat
from stepwise.operators.bygroup import dup_flag, running_limit
from stepwise.operators.merge import merge_by
from stepwise.operators.project import between, case_block

# Diagnosis categories.
DIAGNOSIS = ValueFormat(
    "diagcat", {"E11": "DIABETES", "I10": "HYPERTENSION", "J45": "ASTHMA", "M54": "BACK_PAIN"}, other="OTHER"
)

# Reasons of a decision.
NOT_ELIGIBLE = "MEMBER NOT ELIGIBLE ON SERVICE DATE"
DUPLICATE = "DUPLICATE CLAIM"
OUT_OF_NETWORK = "OUT OF NETWORK - MANUAL REVIEW"
OVER_LIMIT = "ANNUAL BENEFIT LIMIT EXCEEDED"


def eligibility(claims: DataFrame, members: DataFrame) -> DataFrame:
    """Y when the service date lies in the member's span; unknown members are N."""
    joined = merge_by(claims, members.select("member_id", "eff_date", "term_date"), "member_id", "a", profile_left=claims)
    inside = between(F.col("service_date"), F.col("eff_date"), F.col("term_date"))
    return joined.withColumn("elig_flag", F.when(inside, "Y").otherwise("N"))


def adjudicate(
    claims: DataFrame,
    members: DataFrame,
    providers: DataFrame,
    plans: DataFrame,
    diagnosis: ValueFormat = DIAGNOSIS,
) -> DataFrame:
    """One decided row per claim. ``claims`` also serves as the cheap source of key statistics."""
    rows = eligibility(claims, members)
    rows = rows.join(providers.select("provider_id", "network_status", "specialty"), "provider_id", "left")
    rows = dup_flag(rows, ["member_id", "provider_id", "service_date", "proc_code"], profile=claims)
    rows = merge_by(rows, plans, "plan_id", "a", profile_left=claims)
    rows = running_limit(
        rows, "member_id", ["service_date", "claim_id"], "billed_amount", "annual_limit",
        total="ytd_paid", flag="limit_exceeded", profile=claims,
    )
    rows = rows.withColumn("diag_category", diagnosis.label("diag_code"))
    denied = {"adj_status": "DENIED"}
    return case_block(
        rows,
        [
            (F.col("elig_flag") == "N", {**denied, "deny_reason": NOT_ELIGIBLE}),
            (F.col("dup_flag") == "Y", {**denied, "deny_reason": DUPLICATE}),
            (F.col("network_status") == "OUTOFNETWORK", {"adj_status": "PENDED", "deny_reason": OUT_OF_NETWORK}),
            (F.col("limit_exceeded") == "Y", {**denied, "deny_reason": OVER_LIMIT}),
        ],
        {
            "adj_status": "APPROVED",
            "deny_reason": "",
            "paid_amount": (F.col("billed_amount") - F.col("copay")).cast("double"),
        },
    )


def summary(adjudicated: DataFrame) -> DataFrame:
    return adjudicated.groupBy("adj_status").agg(
        F.count(F.lit(1)).alias("claim_count"), F.sum("billed_amount").cast("double").alias("total_billed")
    )
