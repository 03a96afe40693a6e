"""Claim intake: edits, eligibility, risk score, pricing, duplicates, routing, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepwise.functions.missing import is_missing
from stepwise.functions.scalars import catx, cats, date_literal, substr, today
from stepwise.operators.agg import category_score, with_total
from stepwise.operators.joins import one_match, prior_within
from stepwise.operators.project import case_last, melt_array, missing_reasons, route_tagged

REQUIRED = ["member_id", "provider_npi", "claim_date", "diag_code1", "procedure_code"]
DIAGNOSES = [f"diag_code{i}" for i in range(1, 6)]
MAX_BILLED = 1_000_000
HIGH_DOLLAR = 50_000
DUPLICATE_DAYS = 7


def edit_claims(raw: DataFrame, as_of=None) -> DataFrame:
    """Add ``edit_flag`` and ``edit_reason``. A missing billed amount counts as not positive."""
    date, billed = F.col("claim_date"), F.col("billed_amount")
    bad_date = (date < date_literal("01JAN2020")) | (date > today(as_of))
    bad_amount = F.coalesce((billed <= 0) | (billed > MAX_BILLED), F.lit(True))
    reason = catx(
        "; ",
        missing_reasons(REQUIRED),
        F.when(bad_date, "Invalid claim_date"),
        F.when(bad_amount, "Invalid billed_amount"),
    )
    # The flag comes from the conditions, not from the text, so that filters on it stay cheap.
    failed = bad_amount | F.coalesce(bad_date, F.lit(False))
    for name in REQUIRED:
        failed = failed | is_missing(name)
    return raw.select("*", reason.alias("edit_reason"), failed.cast("int").alias("edit_flag"))


def eligible_claims(edited: DataFrame, eligibility: DataFrame) -> DataFrame:
    """Valid claims with each eligibility span of the member."""
    joined = edited.filter("edit_flag = 0").join(eligibility, "member_id", "left")
    flag = F.coalesce(F.col("claim_date").between(F.col("coverage_start_date"), F.col("coverage_end_date")), F.lit(False))
    out = joined.withColumn("eligibility_flag", flag.cast("int"))
    reason = F.when(F.col("eligibility_flag") == 0, "Member not eligible on date of service").otherwise(F.col("edit_reason"))
    return out.withColumn("edit_reason_updated", reason)


def member_risk(eligible: DataFrame, weights: DataFrame, model: str = "V28", dedupe_category: bool = False) -> DataFrame:
    """Risk score per member from the distinct claim diagnoses of a model version."""
    codes = melt_array(eligible, DIAGNOSES, "diagnosis_code").select("claim_id", "member_id", "diagnosis_code")
    codes = codes.withColumn("icd10_code", substr("diagnosis_code", 1, 5))
    used = weights.filter(F.col("model_version") == model).select("icd10_code", "hcc_category", "hcc_description", "coefficient")
    found = codes.join(used, "icd10_code").select(
        "claim_id", "member_id", "diagnosis_code", "hcc_category", "hcc_description", "coefficient"
    )
    return category_score(found.distinct(), "member_id", "hcc_category", "coefficient", dedupe_category).withColumnsRenamed(
        {"category_count": "hcc_count", "raw_score": "raw_raf_score", "adjusted_score": "adjusted_raf_score"}
    )


def price_claims(eligible: DataFrame, risk: DataFrame, fees: DataFrame) -> DataFrame:
    """Lesser of billed and scheduled amount for eligible claims."""
    fee = fees.select(
        F.col("cpt_code").alias("procedure_code"), F.col("region_code").alias("provider_region"),
        F.col("allowed_amount").alias("fee_schedule_allowed"),
    )
    rows = (
        eligible.filter("eligibility_flag = 1")
        .join(risk.select("member_id", "adjusted_raf_score"), "member_id", "left")
        .join(fee, ["procedure_code", "provider_region"], "left")
    )
    # Not lesser: the schedule's amount, missing when the code is not in it.
    lesser = F.when(F.col("billed_amount") < F.col("fee_schedule_allowed"), F.col("billed_amount")).otherwise(
        F.col("fee_schedule_allowed")
    )
    return rows.withColumn("calculated_allowed_amount", lesser).withColumn(
        "high_dollar_flag", F.coalesce((F.col("calculated_allowed_amount") > HIGH_DOLLAR).cast("int"), F.lit(0))
    )


def decide(priced: DataFrame) -> DataFrame:
    """Duplicate search, then independent rules of which the last true one sets the status."""
    rows = prior_within(
        priced, ["member_id", "provider_npi", "procedure_code"], "claim_date", "claim_id", DUPLICATE_DAYS,
        prior_id="prior_claim_id", prior_day="prior_claim_date",
    )
    # A claim under several spans or fees counts once.
    rows = one_match(rows, "claim_id", ["prior_claim_date", "prior_claim_id", "coverage_start_date", "coverage_end_date", "plan_id"])
    high, dup = F.col("high_dollar_flag") == 1, F.col("duplicate_flag") == 1
    unlisted = F.col("fee_schedule_allowed").isNull()
    rows = rows.withColumn(
        "adjudication_status",
        case_last([(high, "PENDING_REVIEW"), (dup, "DUPLICATE"), (unlisted, "PENDING_REVIEW")], "APPROVED"),
    )
    rows = rows.withColumn(
        "final_edit_reason",
        catx(
            "; ",
            F.when(high, "High dollar claim (>$50K)"),
            F.when(dup, cats(F.lit("Duplicate of claim "), F.col("prior_claim_id"))),
            F.when(unlisted, "Procedure code not in fee schedule"),
        ),
    )
    paid = F.when(F.col("adjudication_status") == "APPROVED", F.col("calculated_allowed_amount")).otherwise(0)
    return rows.withColumn("payment_amount", paid)


ROUTES = [("adjudicated_claims", "adjudication_status = 'APPROVED'"), ("medical_review_queue", "adjudication_status = 'PENDING_REVIEW'")]


def route_claims(decided: DataFrame) -> DataFrame:
    """Rows of the three outputs with their ``target``; the audit log takes every row once more."""
    return route_tagged(decided, ROUTES, "claims_audit_log", "claims_audit_log", "target")


def payment_summary(adjudicated: DataFrame) -> DataFrame:
    return with_total(
        adjudicated,
        "adjudication_status",
        {"total_billed": "billed_amount", "total_allowed": "calculated_allowed_amount", "total_payment": "payment_amount"},
        "claim_count",
        {"payment_rate": lambda: F.try_divide(F.col("total_payment").cast("double"), F.col("total_billed").cast("double"))},
    )
