"""The end-to-end jobs on small tables with hand-worked results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stepwise.functions.formats import Range, ValueFormat
from stepwise.operators.project import select_when
from stepwise.plans import adjudication, claims, intake, prior_auth, sales
from stepwise.plans.medallion import add_audit, define_pipeline, publish_table, publish_view
from stepwise.sources.lines import Field, LineSpec, infer_numeric, parse_lines

MEMBERS = """
anna  gold  02/10/2024 11/20/2024 06/06/1991
boris gold  01/01/2024 12/31/2024 10/10/1958
cleo  tin   05/05/2024 05/05/2024 01/31/2003
"""
PROVIDERS = """
north 70 SURGERY INNETWORK
south 71 DENTAL  OUTOFNETWORK
"""
PLANS = """
gold 2024 600 15 0
tin  2024 90  10 50
"""
CLAIMS = """
a1 anna  north 02/10/2024 E11 s1 100.00 gold
a2 anna  north 11/20/2024 Z99 s2 400.00 gold
a3 anna  north 11/21/2024 I10 s1 20.00  gold
b1 boris north 03/03/2024 J45 s1 300.00 gold
b2 boris north 03/04/2024 J45 s1 300.00 gold
b3 boris north 03/05/2024 M54 s1 0.50   gold
b4 boris south 03/06/2024 M54 s3 10.00  gold
b5 boris north 04/01/2024 I10 s4 40.00  gold
b6 boris north 04/01/2024 I10 s4 41.00  gold
c1 cleo  south 05/05/2024 E11 s1 80.00  tin
d1 dora  north 05/05/2024 E11 s1 50.00  tin
"""


def table(spark, text, *fields):
    lines = spark.createDataFrame([(x,) for x in text.splitlines()], "value string")
    rows, rejects = parse_lines(lines, LineSpec([Field(*f) for f in fields]))
    assert rejects.count() == 0
    return infer_numeric(rows)


def adjudication_inputs(spark):
    text, date, number = "text", "mmddyy10", "number"
    members = table(spark, MEMBERS, ("member_id", text), ("plan_id", text), ("eff_date", date), ("term_date", date), ("dob", date))
    providers = table(spark, PROVIDERS, ("provider_id", text), ("npi", text), ("specialty", text), ("network_status", text))
    plans = table(spark, PLANS, ("plan_id", text), ("benefit_year", number), ("annual_limit", number), ("copay", number), ("deductible", number))
    rows = table(
        spark, CLAIMS, ("claim_id", text), ("member_id", text), ("provider_id", text), ("service_date", date), ("diag_code", text),
        ("proc_code", text), ("billed_amount", number), ("plan_id", text),
    )
    return rows, members, providers, plans


def test_adjudication_golden(spark, skew_mode):
    claims_in, members, providers, plans = adjudication_inputs(spark)
    assert dict(plans.dtypes)["annual_limit"] == "int" and dict(claims_in.dtypes)["service_date"] == "date"
    out = adjudication.adjudicate(claims_in.withColumn("billed_amount", F.col("billed_amount").cast("double")), members, providers, plans)
    got = {
        r.claim_id: (r.elig_flag, r.dup_flag, r.network_status, r.limit_exceeded, r.adj_status, r.deny_reason, r.diag_category, r.paid_amount, r.ytd_paid)
        for r in out.collect()
    }
    span, twice, network, limit = (
        "MEMBER NOT ELIGIBLE ON SERVICE DATE", "DUPLICATE CLAIM", "OUT OF NETWORK - MANUAL REVIEW", "ANNUAL BENEFIT LIMIT EXCEEDED",
    )
    inside, outside = "INNETWORK", "OUTOFNETWORK"
    assert got == {
        "a1": ("Y", "N", inside, "N", "APPROVED", "", "DIABETES", 85.0, 100.0),  # first day of the span
        "a2": ("Y", "N", inside, "N", "APPROVED", "", "OTHER", 385.0, 500.0),  # last day
        "a3": ("N", "N", inside, "N", "DENIED", span, "HYPERTENSION", None, 520.0),  # the day after
        "b1": ("Y", "N", inside, "N", "APPROVED", "", "ASTHMA", 285.0, 300.0),
        "b2": ("Y", "N", inside, "N", "APPROVED", "", "ASTHMA", 285.0, 600.0),  # reaches the limit
        "b3": ("Y", "N", inside, "Y", "DENIED", limit, "BACK_PAIN", None, 600.5),  # passes it
        "b4": ("Y", "N", outside, "Y", "PENDED", network, "BACK_PAIN", None, 610.5),
        "b5": ("Y", "Y", inside, "Y", "DENIED", twice, "HYPERTENSION", None, 650.5),
        "b6": ("Y", "Y", inside, "Y", "DENIED", twice, "HYPERTENSION", None, 691.5),
        "c1": ("Y", "N", outside, "N", "PENDED", network, "DIABETES", None, 80.0),  # a span of one day
        "d1": ("N", "N", inside, "N", "DENIED", span, "DIABETES", None, 50.0),  # nobody knows dora
    }
    summary = {r.adj_status: (r.claim_count, r.total_billed) for r in adjudication.summary(out).collect()}
    assert summary == {"APPROVED": (4, 1100.0), "DENIED": (5, 151.5), "PENDED": (2, 90.0)}


def d(text):
    return dt.date.fromisoformat(text)


def test_intake(spark, skew_mode):
    raw = spark.createDataFrame(
        [
            ("A1", "m1", "n1", "EAST", d("2024-03-01"), "D1000X", None, "p1", 100.0),
            ("A2", "m1", "n1", "EAST", d("2024-03-08"), "D1000X", "D2", "p1", 100.0),  # 7 days after A1
            ("A3", "m1", "n1", "EAST", d("2024-03-16"), "D1000X", None, "p1", 100.0),  # 8 days after A2
            ("A4", "m1", "n1", "EAST", d("2024-03-18"), "D1000X", None, "p1", 100.0),  # two days after A3 only
            ("A5", "m1", None, "EAST", d("2024-03-01"), None, None, "p1", 100.0),
            ("A6", "m1", "n1", "EAST", d("2030-01-01"), "D1000", None, "p1", 0.0),
            ("A7", "m1", "n1", "EAST", d("2024-03-01"), "D1000", None, "p9", 100.0),  # not in the schedule
            ("A8", "m1", "n1", "EAST", d("2024-03-01"), "D1000", None, "p2", 90000.0),  # high dollar
            ("A9", "m2", "n1", "EAST", d("2024-03-01"), "D1000", None, "p1", 100.0),  # span is over
            ("B1", "m1", "n2", "EAST", d("2024-03-05"), "D1000", None, "p1", 100.0),
            ("B2", "m1", "n2", "EAST", d("2024-03-06"), "D1000", None, "p1", 100.0),
            ("B3", "m1", "n2", "EAST", d("2024-03-07"), "D1000", None, "p1", 1000001.0),
            ("B4", "m1", "n2", "EAST", d("2024-03-08"), "D1000", None, "p1", 30.0),  # two priors
        ],
        "claim_id string, member_id string, provider_npi string, provider_region string, claim_date date, diag_code1 string, "
        "diag_code2 string, procedure_code string, billed_amount double",
    )
    for i in (3, 4, 5):
        raw = raw.withColumn(f"diag_code{i}", F.lit(None).cast("string"))
    eligibility = spark.createDataFrame(
        [("m1", "PL", d("2024-01-01"), d("2024-12-31"), "G"), ("m2", "PL", d("2023-01-01"), d("2023-12-31"), "G")],
        "member_id string, plan_id string, coverage_start_date date, coverage_end_date date, benefit_tier string",
    )
    weights = spark.createDataFrame(
        [("D1000", "H1", "one", 0.5, "V28"), ("D1000", "H9", "old", 9.0, "V24"), ("D2", "H2", "two", 0.25, "V28")],
        "icd10_code string, hcc_category string, hcc_description string, coefficient double, model_version string",
    )
    fees = spark.createDataFrame([("p1", "EAST", 60.0), ("p2", "EAST", 80000.0)], "cpt_code string, region_code string, allowed_amount double")

    edited = intake.edit_claims(raw, "2025-01-01")
    reasons = {r.claim_id: r.edit_reason for r in edited.filter("edit_flag = 1").collect()}
    assert reasons == {
        "A5": "provider_npi is missing; diag_code1 is missing",
        "A6": "Invalid claim_date; Invalid billed_amount",
        "B3": "Invalid billed_amount",
    }
    eligible = intake.eligible_claims(edited, eligibility)
    risk = intake.member_risk(eligible, weights)
    assert [tuple(r) for r in risk.filter("member_id = 'm1'").select("hcc_count", "raw_raf_score").collect()] == [(2, 9 * 0.5 + 0.25)]
    once = intake.member_risk(eligible, weights, dedupe_category=True)
    assert once.filter("member_id = 'm1'").first().raw_raf_score == 0.75

    decided = intake.decide(intake.price_claims(eligible, risk, fees))
    got = {r.claim_id: (r.adjudication_status, r.final_edit_reason, r.payment_amount) for r in decided.collect()}
    assert got == {
        "A1": ("APPROVED", "", 60.0),
        "A2": ("DUPLICATE", "Duplicate of claimA1", 0.0),
        "A3": ("APPROVED", "", 60.0),
        "A4": ("DUPLICATE", "Duplicate of claimA3", 0.0),
        "A7": ("PENDING_REVIEW", "Procedure code not in fee schedule", 0.0),
        "A8": ("PENDING_REVIEW", "High dollar claim (>$50K)", 0.0),
        "B1": ("APPROVED", "", 60.0),
        "B2": ("DUPLICATE", "Duplicate of claimB1", 0.0),
        "B4": ("DUPLICATE", "Duplicate of claimB1", 0.0),
    }
    routed = [(r.target, r.claim_id) for r in intake.route_claims(decided).select("target", "claim_id").collect()]
    assert routed.count(("claims_audit_log", "A2")) == 2 and routed.count(("claims_audit_log", "A1")) == 1
    assert ("adjudicated_claims", "A1") in routed and ("medical_review_queue", "A7") in routed
    totals = {r.adjudication_status: (r.claim_count, r.total_payment) for r in intake.payment_summary(decided).collect()}
    assert totals["TOTAL"] == (9, 180.0) and totals["APPROVED"] == (3, 180.0)


def test_intake_overlapping_spans_count_once(spark):
    priced = spark.createDataFrame(
        [("A", "m", "n", d("2024-01-01"), "p", 0, 5.0, 5.0, d("2024-01-01"), d("2024-02-01"), x) for x in ("P1", "P2")],
        "claim_id string, member_id string, provider_npi string, claim_date date, procedure_code string, high_dollar_flag int, "
        "fee_schedule_allowed double, calculated_allowed_amount double, coverage_start_date date, coverage_end_date date, plan_id string",
    )
    assert [r.plan_id for r in intake.decide(priced).collect()] == ["P1"]


def test_prior_authorisation(spark):
    requests = spark.createDataFrame(
        [(1, "m1", "PENDING", "s1", d("2024-03-05"), 10.0), (2, "m1", "DONE", "s1", d("2024-03-05"), 10.0), (3, "m2", "PENDING", "s1", d("2024-03-05"), 20.0),
         (4, "m3", "PENDING", "s1", d("2024-03-05"), 30.0), (5, "m4", "PENDING", "s1", d("2024-03-05"), 40.0), (6, "m5", "PENDING", "s1", d("2024-03-05"), 50.0)],
        "request_id int, member_id string, request_status string, service_code string, service_date date, estimated_cost double",
    )
    eligibility = spark.createDataFrame(
        [("m1", "A", "F", d("2024-01-01"), None), ("m2", "A", "F", d("2024-01-01"), d("2024-12-31")), ("m3", "A", "F", d("2024-04-01"), None),
         ("m4", "A", "F", d("2023-01-01"), d("2023-12-31"))],
        "member_id string, plan_id string, coverage_type string, effective_date date, termination_date date",
    )
    limits = spark.createDataFrame([("A", "s1", "cat", 3, 100.0)], "plan_id string, service_code string, service_category string, visits_allowed_per_year int, dollar_limit_per_year double")
    used = spark.createDataFrame([("m1", "2024-03", 1, 100.0), ("m2", "2024-02", 9, 900.0)], "member_id string, coverage_period string, visits_used_ytd int, dollars_used_ytd double")
    status = {r.request_id: r.eligibility_status for r in prior_auth.coverage(requests, eligibility).collect()}
    assert status == {1: "ELIGIBLE", 3: "ELIGIBLE", 4: "NOT_YET_EFFECTIVE", 5: "COVERAGE_TERMINATED", 6: "NOT_FOUND"}
    decided = prior_auth.prior_authorisation(requests, eligibility, limits, used)
    got = {r.request_id: (r.decision, r.denial_reason, r.decision_date) for r in decided.collect()}
    assert got == {1: ("DENIED", "DOLLAR_LIMIT_EXCEEDED", None), 3: ("APPROVED", "", None)}
    parts = prior_auth.outputs(decided)
    assert parts["pa_decisions"].count() == 1 and parts["pa_denials"].count() == 1
    assert [tuple(r) for r in prior_auth.summary(parts["pa_decisions"]).collect()] == [("APPROVED", 1, 20.0)]


def test_sales_boundaries(spark):
    customers = spark.createDataFrame(
        [(i, n, "e") for i, n in [(1, " Acme "), (2, "B"), (3, "C"), (4, "D"), (5, None), (6, "no orders")]], "CustomerID int, CompanyName string, EmailAddress string"
    )
    as_of = d("2024-12-31")
    orders = spark.createDataFrame(
        [(10 + i, i, as_of - dt.timedelta(days=days), float(total)) for i, days, total in
         [(1, 90, 10000), (2, 91, 9999.99), (3, 180, 5000), (4, 181, 4999.99), (5, 1, 1)]],
        "SalesOrderID int, CustomerID int, OrderDate date, TotalDue double",
    )
    rows = sales.classify(
        sales.customer_metrics(sales.clean_customers(customers), sales.prepare_orders(orders, as_of), ["CompanyName", "EmailAddress"]), as_of
    )
    got = {r.CustomerID: (r.CompanyName, r.value_tier, r.churn_risk, r.OrderCount) for r in rows.collect()}
    assert got == {1: ("Acme", "High", "Low", 1), 2: ("B", "Medium", "Medium", 1), 3: ("C", "Medium", "Medium", 1), 4: ("D", "Low", "High", 1)}
    assert sum(r.customer_count for r in sales.statistics(rows).collect()) == 4
    checks = {r.check: r.passed for r in sales.table_expectations(rows, sales.statistics(rows)).collect()}
    assert len(checks) == 6 and all(checks.values())
    twice = sales.table_expectations(rows.unionByName(rows), sales.statistics(rows))
    assert {r.check for r in twice.collect() if not r.passed} == {"one_row_per_customer", "counts_match_detail"}
    flags = {r.SalesOrderID: r.recent_order for r in sales.prepare_orders(orders, as_of).collect()}
    assert flags[11] == "Y" and flags[12] == "N"


def claims_inputs(spark):
    policies = spark.createDataFrame([("P1", "Ann", "IL", "Chicago"), ("P2", "Bob", "OH", "Cleveland")], "policy_id string, policyholder_name string, state string, city string")
    appliances = spark.createDataFrame([("AP1", "CleanMax 1", "CM", "dishwasher"), ("AP2", "Oven", "OV", "oven")], "appliance_id string, model_name string, manufacturer string, category string")
    # The second batch id occurs twice, so claims on it fan out.
    batches = spark.createDataFrame([("B1", "Rockford", "recalled"), ("B2", "X", "ok"), ("B2", "Y", "ok")], "appliance_batch_id string, plant_location string, status string")
    rows = spark.createDataFrame(
        [("C1", "P1", "AP1", "B1", "2024-01-07 10:00:00", "water_damage", 6000.0, "ZZ", "low"), ("C2", "P1", None, None, "2024-01-08 10:00:00", "fire", 10001.0, "ZZ", "low"),
         ("C3", "P2", "AP2", "B2", "2024-01-08 11:00:00", "theft", 3001.0, "ZZ", "low"), ("C4", "P9", "AP1", "B1", "2024-01-09 11:00:00", "wind", 3000.0, "ZZ", "low"),
         ("C5", None, "AP1", "B1", "2024-01-09 11:00:00", "wind", 50.0, "ZZ", "low"), ("C6", "P1", "AP1", "B1", "2024-01-09 11:00:00", "wind", 0.0, "ZZ", "low")],
        "claim_id string, policy_id string, appliance_id string, appliance_batch_id string, claim_date string, claim_type string, claim_amount_usd double, state string, severity string",
    )
    return rows, policies, appliances, batches


def test_claims_enrichment(spark):
    silver = claims.enrich_claims(*claims_inputs(spark), "B1")
    assert len(silver.columns) == len(set(silver.columns))
    rows = [(r.claim_id, r.state, r.claim_state, r.severity, r.is_affected_batch) for r in silver.orderBy("claim_id", "plant_location").collect()]
    assert rows == [
        ("C1", "IL", "ZZ", "high", True), ("C2", "IL", "ZZ", "high", False), ("C3", "OH", "ZZ", "medium", False),
        ("C3", "OH", "ZZ", "medium", False), ("C4", None, "ZZ", "low", True),
    ]
    weekly = {str(r.week): (r.claim_count, r.weekly_claims, r.status) for r in claims.weekly_summary(silver, 5000.0).collect()}
    assert weekly == {"2024-01-01": (1, 6000.0, "NORMAL"), "2024-01-08": (4, 19003.0, "ALERT")}
    edge = claims.weekly_summary(silver.filter("claim_id = 'C1'"), 4800.0).first()
    assert edge.ratio == 1.25 and edge.status == "NORMAL"
    share = claims.batch_analysis(silver)
    assert sum(r.pct_of_total for r in share.collect()) == 100.0
    assert claims.driving_batch(silver, claims_inputs(spark)[3], "%CleanMax%").first().plant_location == "Rockford"
    view = claims.affected_view(silver)
    by_state = view.query(["state"], ["affected_claim_count", "affected_pct"], having="affected_claim_count > 0").collect()
    assert {r.state: (r.affected_claim_count, r.affected_pct) for r in by_state} == {"IL": (1, 6000 / 16001), None: (1, 1.0)}
    with pytest.raises(ValueError):
        view.query(["state"], ["nope"])


def test_small_programs(spark):
    cars = spark.createDataFrame(
        [("Audi", "A", "Europe", 30000.0, 4), ("Kia", "B", "Asia", 30000.5, None), ("Volvo", "C", "Europe", 30001.0, 5), ("Zzz", "D", "USA", None, 8)],
        "Make string, Model string, Origin string, MSRP double, Cylinders int",
    )
    msrp = ValueFormat("msrp", ranges=(Range(None, 30000, "Budget"), Range(30001, 50000, "Mid-Range")), missing="none")
    cyl = ValueFormat("cyl", {4: "4 Cylinders - Compact", 8: "8 Cylinders - Performance"}, missing="N/A")
    origin = select_when("Make", {"South Korea": ["Hyundai", "Kia"], "Germany": ["Audi", "BMW"], "Sweden": ["Saab", "Volvo"]}, "")
    got = [tuple(r) for r in cars.select("Model", msrp.label("MSRP"), cyl.label("Cylinders"), origin).orderBy("Model").collect()]
    assert got == [
        ("A", "Budget", "4 Cylinders - Compact", "Germany"), ("B", "30000.5", "N/A", "South Korea"), ("C", "Mid-Range", "5", "Sweden"), ("D", "none", "8 Cylinders - Performance", ""),
    ]


def test_medallion(spark, tmp_path):
    df = add_audit(spark.range(3), "claims.txt", at="2024-09-21 14:30:45.123456")
    row = df.first()
    assert str(row.bronze_ingestion_date) == "2024-09-21" and row.medallion_layer == "bronze" and row.bronze_source_file == "claims.txt"
    publish_view(df, "bronze_view")
    assert spark.table("bronze_view").count() == 3
    spark.sql("DROP TABLE IF EXISTS audit_copy")
    assert publish_table(df.select("id"), "audit_copy").count() == 3
    spark.sql("DROP TABLE audit_copy")


def test_pipeline_definition(spark, monkeypatch):
    from pyspark import pipelines as dp

    made = {}

    def recorder(kind):
        return lambda name: lambda fn: made.update({name: (kind, fn)})

    monkeypatch.setattr(dp, "temporary_view", recorder("view"))
    monkeypatch.setattr(dp, "materialized_view", recorder("table"))
    define_pipeline({"silver": (lambda s: s.range(2), "view"), "gold": (lambda s: s.range(3), "table")}, lambda: spark)
    assert {n: (kind, fn().count()) for n, (kind, fn) in made.items()} == {"silver": ("view", 2), "gold": ("table", 3)}
