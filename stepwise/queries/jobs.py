"""The end-to-end jobs on driver tables.

Events play claims and requests (user = member, type = procedure, the ``k`` in the
props = provider), customers the members and their spans, suppliers the providers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stepwise.functions.formats import Range, ValueFormat
from stepwise.operators.project import as_int, case_of, keep
from stepwise.operators.quality import validate
from stepwise.plans import adjudication, intake, prior_auth, sales
from stepwise.queries.base import money, query

AS_OF = "2001-12-31"

# ---- adjudication ---------------------------------------------------------

KIND = ValueFormat("kind", {"click": "MOUSE", "view": "SCREEN", "purchase": "MONEY"}, other="OTHER")


def _k():
    return F.get_json_object("props", "$.k").cast("bigint")


def _members(t):
    start = F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey") - 5)
    return t.customer.select(
        F.col("c_custkey").alias("member_id"), start.alias("eff_date"), F.date_add(start, F.floor(F.abs("c_acctbal") / 250).cast("int")).alias("term_date"),
        "c_mktsegment",
    )


def adjudicated(t):
    plans = t.customer.groupBy(F.col("c_mktsegment").alias("plan_id")).agg(
        (F.sum(F.when(F.col("c_acctbal") > 9000, 1).otherwise(0)) * 100).cast("decimal(18,2)").alias("annual_limit"),
        F.lit(5).alias("copay"), F.lit(500).alias("deductible"),
    )
    plan_of = t.customer.select(F.col("c_custkey").alias("member_id"), F.col("c_mktsegment").alias("plan_id"))
    claims = t.events.select(
        F.col("event_id").alias("claim_id"), F.col("user_id").alias("member_id"), _k().alias("provider_id"), F.to_date("ts").alias("service_date"),
        F.col("event_type").alias("diag_code"), F.col("event_type").alias("proc_code"), money("value").alias("billed_amount"),
    ).join(plan_of, "member_id", "left")
    providers = t.supplier.select(
        F.col("s_suppkey").alias("provider_id"), F.when(F.col("s_acctbal") < 3000, "OUTOFNETWORK").otherwise("INNETWORK").alias("network_status"),
        F.col("s_name").alias("specialty"),
    )
    return adjudication.adjudicate(claims, _members(t), providers, plans, KIND)


_ADJ = """
    WITH m AS (SELECT c_custkey AS member_id, c_mktsegment AS plan_id, DATE '2024-01-01' + CAST(c_nationkey - 5 AS INTEGER) AS lo,
        DATE '2024-01-01' + CAST(c_nationkey - 5 + CAST(floor(abs(c_acctbal) / 250) AS INTEGER) AS INTEGER) AS hi FROM customer),
    pl AS (SELECT c_mktsegment AS plan_id, CAST(count(*) FILTER (c_acctbal > 9000) * 100 AS DECIMAL(18,2)) AS annual_limit FROM customer GROUP BY 1),
    e AS (SELECT event_id AS claim_id, user_id AS member_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS provider_id, CAST(ts AS DATE) AS d,
        event_type, CAST(value AS DECIMAL(18,2)) AS billed FROM events),
    c AS (SELECT e.*, m.plan_id, lo, hi, CASE WHEN s_acctbal < 3000 THEN 'OUTOFNETWORK' WHEN s_acctbal IS NOT NULL THEN 'INNETWORK' END AS network_status,
        annual_limit, count(*) OVER (PARTITION BY e.member_id, provider_id, d, event_type) AS copies,
        sum(billed) OVER (PARTITION BY e.member_id ORDER BY d, claim_id ROWS UNBOUNDED PRECEDING) AS ytd
      FROM e LEFT JOIN m ON e.member_id = m.member_id LEFT JOIN supplier ON provider_id = s_suppkey LEFT JOIN pl ON m.plan_id = pl.plan_id),
    f AS (SELECT *, CASE WHEN coalesce(d BETWEEN lo AND hi, FALSE) THEN 'Y' ELSE 'N' END AS elig_flag, CASE WHEN copies > 1 THEN 'Y' ELSE 'N' END AS dup_flag,
        CASE WHEN annual_limit IS NULL OR ytd > annual_limit THEN 'Y' ELSE 'N' END AS limit_exceeded FROM c),
    a AS (SELECT *, CASE WHEN elig_flag = 'N' OR dup_flag = 'Y' THEN 'DENIED' WHEN network_status = 'OUTOFNETWORK' THEN 'PENDED'
        WHEN limit_exceeded = 'Y' THEN 'DENIED' ELSE 'APPROVED' END AS adj_status,
      CASE WHEN elig_flag = 'N' THEN 'MEMBER NOT ELIGIBLE ON SERVICE DATE' WHEN dup_flag = 'Y' THEN 'DUPLICATE CLAIM'
        WHEN network_status = 'OUTOFNETWORK' THEN 'OUT OF NETWORK - MANUAL REVIEW' WHEN limit_exceeded = 'Y' THEN 'ANNUAL BENEFIT LIMIT EXCEEDED'
        ELSE '' END AS deny_reason FROM f)
"""


@query(
    "adjudication",
    _ADJ
    + """SELECT claim_id, elig_flag, dup_flag, network_status, CAST(ytd AS DOUBLE) AS ytd_paid, limit_exceeded, adj_status, deny_reason,
      CASE event_type WHEN 'click' THEN 'MOUSE' WHEN 'view' THEN 'SCREEN' WHEN 'purchase' THEN 'MONEY' ELSE 'OTHER' END AS diag_category,
      CASE WHEN adj_status = 'APPROVED' THEN CAST(billed - 5 AS DOUBLE) END AS paid_amount FROM a""",
)
def adjudication_rows(t):
    return adjudicated(t).select(
        "claim_id", "elig_flag", "dup_flag", "network_status", F.col("ytd_paid").cast("double").alias("ytd_paid"), "limit_exceeded", "adj_status",
        "deny_reason", "diag_category", "paid_amount",
    )


@query(
    "adjudication_summary",
    _ADJ + "SELECT adj_status, count(*) AS claim_count, CAST(sum(billed) AS DOUBLE) AS total_billed FROM a GROUP BY 1",
)
def adjudication_summary(t):
    return adjudication.summary(adjudicated(t))


# ---- claim intake ---------------------------------------------------------


def intake_decided(t):
    region = F.element_at(F.array(F.lit("EAST"), F.lit("WEST"), F.lit("NORTH")), (F.pmod(_k(), F.lit(3)) + 1).cast("int"))
    raw = t.events.select(
        F.col("event_id").alias("claim_id"),
        F.col("user_id").alias("member_id"),
        F.when(_k() < 97, _k()).alias("provider_npi"),
        region.alias("provider_region"),
        F.to_date("ts").alias("claim_date"),
        F.when(F.col("value") < 200, F.concat(F.lit("D"), F.lpad(_k().cast("string"), 3, "0"), F.lit("XYZ"))).alias("diag_code1"),
        F.when(F.col("event_type") == "view", F.lit("D011")).alias("diag_code2"),
        F.when(F.col("event_type") == "click", F.lit("D012")).alias("diag_code3"),
        F.lit(None).cast("string").alias("diag_code4"),
        F.lit(" ").alias("diag_code5"),
        F.col("event_type").alias("procedure_code"),
        (money("value") * 600).cast("decimal(18,2)").alias("billed_amount"),
    )
    span = _members(t).select(
        "member_id", F.col("c_mktsegment").alias("plan_id"), F.col("eff_date").alias("coverage_start_date"), F.col("term_date").alias("coverage_end_date"),
        F.lit("GOLD").alias("benefit_tier"),
    )
    # Diagnosis codes D001 to D050 are the part sizes; a code's first five characters match.
    weights = t.part.groupBy("p_size").agg(F.count(F.lit(1)).alias("n")).select(
        F.concat(F.lit("D"), F.lpad(F.col("p_size").cast("string"), 3, "0"), F.lit("X")).alias("icd10_code"),
        F.floor(F.col("p_size") / 5).cast("string").alias("hcc_category"), F.lit("size group").alias("hcc_description"),
        (F.col("n") / 1000).cast("decimal(12,3)").alias("coefficient"), F.lit("V28").alias("model_version"),
    )
    fees = t.events.filter("event_type <> 'signup'").groupBy("event_type", region.alias("region_code")).agg(
        (F.max(money("value")) * 300).cast("decimal(18,2)").alias("allowed_amount")
    ).withColumnRenamed("event_type", "cpt_code")
    eligible = intake.eligible_claims(intake.edit_claims(raw, "2024-01-28"), span)
    risk = intake.member_risk(eligible, weights)
    return intake.edit_claims(raw, "2024-01-28"), intake.decide(intake.price_claims(eligible, risk, fees)), risk


_INTAKE = """
    WITH k AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
    raw AS (SELECT event_id AS claim_id, user_id AS member_id, CASE WHEN k < 97 THEN k END AS npi, ['EAST', 'WEST', 'NORTH'][k % 3 + 1] AS region,
        CAST(ts AS DATE) AS d, CASE WHEN value < 200 THEN 'D' || lpad(CAST(k AS VARCHAR), 3, '0') || 'XYZ' END AS c1,
        CASE WHEN event_type = 'view' THEN 'D011' END AS c2, CASE WHEN event_type = 'click' THEN 'D012' END AS c3, event_type AS proc,
        CAST(CAST(value AS DECIMAL(18,2)) * 600 AS DECIMAL(18,2)) AS billed FROM k),
    edited AS (SELECT *, concat_ws('; ', CASE WHEN npi IS NULL THEN 'provider_npi is missing' END, CASE WHEN c1 IS NULL THEN 'diag_code1 is missing' END,
        CASE WHEN d > DATE '2024-01-28' THEN 'Invalid claim_date' END) AS reason FROM raw),
    elig AS (SELECT e.* FROM edited e JOIN customer ON member_id = c_custkey WHERE reason = ''
        AND d BETWEEN DATE '2024-01-01' + CAST(c_nationkey - 5 AS INTEGER)
          AND DATE '2024-01-01' + CAST(c_nationkey - 5 + CAST(floor(abs(c_acctbal) / 250) AS INTEGER) AS INTEGER)),
    codes AS (SELECT claim_id, member_id, c1 AS code FROM edited WHERE reason = '' UNION ALL SELECT claim_id, member_id, c2 FROM edited WHERE reason = '' AND c2 IS NOT NULL
        UNION ALL SELECT claim_id, member_id, c3 FROM edited WHERE reason = '' AND c3 IS NOT NULL),
    wt AS (SELECT 'D' || lpad(CAST(p_size AS VARCHAR), 3, '0') || 'X' AS icd, CAST(CAST(floor(p_size / 5) AS INTEGER) AS VARCHAR) AS cat,
        CAST(count(*) / 1000 AS DECIMAL(12,3)) AS w FROM part GROUP BY p_size),
    raf AS (SELECT member_id, count(DISTINCT cat) AS hcc_count, CAST(sum(w) AS DOUBLE) AS raw FROM (SELECT DISTINCT claim_id, member_id, code, cat, w
        FROM codes JOIN wt ON substr(code, 1, 5) = icd) GROUP BY 1),
    fee AS (SELECT event_type AS proc, ['EAST', 'WEST', 'NORTH'][k % 3 + 1] AS region, CAST(max(CAST(value AS DECIMAL(18,2))) * 300 AS DECIMAL(18,2)) AS allowed
        FROM k WHERE event_type <> 'signup' GROUP BY 1, 2),
    priced AS (SELECT e.*, allowed, CASE WHEN billed < allowed THEN billed ELSE allowed END AS calc FROM elig e LEFT JOIN fee f ON e.proc = f.proc AND e.region = f.region),
    dup AS (SELECT a.claim_id, min_by(b.claim_id, struct_pack(x := b.d, y := b.claim_id)) AS prior FROM priced a LEFT JOIN priced b ON a.member_id = b.member_id
        AND a.npi = b.npi AND a.proc = b.proc AND a.claim_id <> b.claim_id AND a.d - b.d <= 7 AND b.d < a.d GROUP BY 1),
    dec AS (SELECT p.*, prior, CASE WHEN allowed IS NULL THEN 'PENDING_REVIEW' WHEN prior IS NOT NULL THEN 'DUPLICATE' WHEN calc > 50000 THEN 'PENDING_REVIEW'
        ELSE 'APPROVED' END AS status, concat_ws('; ', CASE WHEN calc > 50000 THEN 'High dollar claim (>$50K)' END,
        CASE WHEN prior IS NOT NULL THEN 'Duplicate of claim' || prior END, CASE WHEN allowed IS NULL THEN 'Procedure code not in fee schedule' END) AS why
      FROM priced p JOIN dup USING (claim_id)),
    paid AS (SELECT *, CASE WHEN status = 'APPROVED' THEN calc ELSE 0 END AS pay FROM dec)
"""


@query("intake_edits", _INTAKE + "SELECT claim_id, reason AS edit_reason, CAST(reason <> '' AS INTEGER) AS edit_flag FROM edited")
def intake_edits(t):
    return intake_decided(t)[0].select("claim_id", "edit_reason", "edit_flag")


@query("intake_risk", _INTAKE + "SELECT member_id, hcc_count, raw AS raw_raf_score FROM raf")
def intake_risk(t):
    return intake_decided(t)[2].select("member_id", "hcc_count", F.col("raw_raf_score").cast("double").alias("raw_raf_score"))


@query(
    "intake",
    _INTAKE
    + """SELECT CASE status WHEN 'APPROVED' THEN 'adjudicated_claims' WHEN 'PENDING_REVIEW' THEN 'medical_review_queue' ELSE 'claims_audit_log' END AS target,
      claim_id, status AS adjudication_status, why AS final_edit_reason, CAST(pay AS DOUBLE) AS payment_amount FROM paid
    UNION ALL SELECT 'claims_audit_log', claim_id, status, why, CAST(pay AS DOUBLE) FROM paid""",
)
def intake_routes(t):
    out = intake.route_claims(intake_decided(t)[1])
    return out.select(
        "target", "claim_id", "adjudication_status", "final_edit_reason", F.col("payment_amount").cast("double").alias("payment_amount")
    )


@query(
    "intake_summary",
    _INTAKE
    + """SELECT coalesce(status, 'TOTAL') AS adjudication_status, count(*) AS claim_count, CAST(sum(billed) AS DOUBLE) AS total_billed,
      CAST(sum(calc) AS DOUBLE) AS total_allowed, CAST(sum(pay) AS DOUBLE) AS total_payment, CAST(sum(pay) AS DOUBLE) / CAST(sum(billed) AS DOUBLE) AS payment_rate
    FROM paid GROUP BY ROLLUP (status)""",
)
def intake_summary(t):
    out = intake.payment_summary(intake_decided(t)[1])
    return out.select(
        "adjudication_status", "claim_count", *[F.col(c).cast("double").alias(c) for c in ("total_billed", "total_allowed", "total_payment")], "payment_rate"
    )


# ---- prior authorisation --------------------------------------------------


def prior_decided(t):
    requests = t.events.select(
        F.col("event_id").alias("request_id"), F.col("user_id").alias("member_id"),
        F.when(F.col("event_type") == "error", "CLOSED").otherwise("PENDING").alias("request_status"), F.col("event_type").alias("service_code"),
        F.to_date("ts").alias("service_date"), money("value").alias("estimated_cost"),
    )
    members = _members(t)
    eligibility = members.select(
        "member_id", F.col("c_mktsegment").alias("plan_id"), F.lit("FULL").alias("coverage_type"), F.col("eff_date").alias("effective_date"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("term_date")).alias("termination_date"),
    )
    limits = t.customer.filter("c_mktsegment <> 'MACHINERY'").groupBy(F.col("c_mktsegment").alias("plan_id")).agg(
        F.lit(None).cast("string").alias("service_category"), F.lit(60).cast("bigint").alias("visits_allowed_per_year"),
        (F.count_if(F.col("c_acctbal") > 0) * 5).alias("dollar_limit_per_year"),
    )
    codes = t.events.select(F.col("event_type").alias("service_code")).distinct()
    # Each plan covers each service of the catalogue.
    limits = limits.withColumn("service_code", F.explode(F.array(*[F.lit(c) for c in ("click", "view", "purchase", "signup")]))).join(codes, "service_code")
    used = t.events.groupBy(F.col("user_id").alias("member_id"), F.date_format("ts", "yyyy-MM").alias("coverage_period")).agg(
        F.count(F.lit(1)).alias("visits_used_ytd"), F.sum(money("value")).alias("dollars_used_ytd")
    )
    return prior_auth.prior_authorisation(requests, eligibility, limits, used)


_PRIOR = """
    WITH m AS (SELECT c_custkey AS member_id, c_mktsegment AS plan_id, DATE '2024-01-01' + CAST(c_nationkey - 5 AS INTEGER) AS lo,
        CASE WHEN c_mktsegment <> 'BUILDING' THEN DATE '2024-01-01' + CAST(c_nationkey - 5 + CAST(floor(abs(c_acctbal) / 250) AS INTEGER) AS INTEGER) END AS hi FROM customer),
    l AS (SELECT c_mktsegment AS plan_id, count(*) FILTER (c_acctbal > 0) * 5 AS dollars FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1),
    u AS (SELECT user_id AS member_id, strftime(ts, '%Y-%m') AS p, count(*) AS visits, sum(CAST(value AS DECIMAL(18,2))) AS spent FROM events GROUP BY 1, 2),
    c AS (SELECT e.event_id AS request_id, e.value, CASE WHEN visits >= 60 THEN 'VISIT_LIMIT_EXCEEDED' WHEN spent >= dollars THEN 'DOLLAR_LIMIT_EXCEEDED'
        ELSE 'WITHIN_LIMITS' END AS limits FROM events e JOIN m ON e.user_id = m.member_id JOIN l ON m.plan_id = l.plan_id
        LEFT JOIN u ON u.member_id = e.user_id AND u.p = strftime(e.ts, '%Y-%m')
      WHERE e.event_type <> 'error' AND CAST(e.ts AS DATE) BETWEEN lo AND coalesce(hi, DATE '9999-12-31')),
    d AS (SELECT request_id, value, limits, CASE WHEN limits = 'WITHIN_LIMITS' THEN 'APPROVED' ELSE 'DENIED' END AS decision FROM c)
"""


@query(
    "prior_auth",
    _PRIOR + "SELECT request_id, limits AS benefit_limit_status, decision, CASE WHEN decision = 'APPROVED' THEN '' ELSE limits END AS denial_reason FROM d",
)
def prior_auth_rows(t):
    return prior_decided(t).select("request_id", "benefit_limit_status", "decision", "denial_reason")


@query(
    "prior_auth_summary",
    _PRIOR + "SELECT decision, count(*) AS request_count, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_cost FROM d GROUP BY 1",
)
def prior_auth_summary(t):
    return prior_auth.summary(prior_decided(t))


# ---- customer sales -------------------------------------------------------


def _sales(t):
    customers = t.customer.select(
        F.col("c_custkey").alias("CustomerID"), F.concat(F.lit(" "), F.nullif(F.col("c_name"), F.lit("Customer#000000001"))).alias("CompanyName"),
        F.col("c_mktsegment").alias("EmailAddress"),
    )
    orders = t.orders.select(
        F.col("o_orderkey").alias("SalesOrderID"), F.col("o_custkey").alias("CustomerID"), F.to_date("o_orderdate").alias("OrderDate"),
        (money("o_totalprice") / 100).cast("decimal(18,4)").alias("TotalDue"),
    )
    return sales.clean_customers(customers), sales.prepare_orders(orders, AS_OF)


def sales_classified(t):
    customers, orders = _sales(t)
    return sales.classify(sales.customer_metrics(customers, orders, ["CompanyName", "EmailAddress"]), AS_OF)


def _level_of(value: str, compare: str, limits) -> str:
    """SQL of a level by falling limits; the lowest level has none."""
    steps = " ".join(f"WHEN {value} {compare} {limit} THEN '{level}'" for limit, level in zip(limits, sales.LEVELS))
    return f"CASE {steps} ELSE '{sales.LEVELS[-1]}' END"


_DAY = "DATE '2001-12-31'"
_SALES = f"""
    WITH m AS (SELECT c_custkey AS CustomerID, c_name AS CompanyName, c_mktsegment AS EmailAddress, count(o_orderkey) AS OrderCount,
        CAST(sum(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,4))) AS DOUBLE) AS TotalRevenue,
        min(CAST(o_orderdate AS DATE)) AS FirstOrderDate, max(CAST(o_orderdate AS DATE)) AS LastOrderDate
      FROM customer LEFT JOIN orders ON c_custkey = o_custkey WHERE c_name <> 'Customer#000000001' GROUP BY 1, 2, 3 HAVING count(o_orderkey) > 0),
    k AS (SELECT *, TotalRevenue / OrderCount AS AvgOrderValue, {_level_of("TotalRevenue", ">=", (sales.HIGH_REVENUE, sales.MEDIUM_REVENUE))} AS value_tier,
        CAST({_DAY} - LastOrderDate AS INTEGER) AS days_since_last_order, CAST(LastOrderDate - FirstOrderDate AS INTEGER) AS customer_lifetime_days,
        {_level_of(f"{_DAY} - LastOrderDate", ">", (sales.HIGH_CHURN_DAYS, sales.MEDIUM_CHURN_DAYS))} AS churn_risk FROM m)
"""


@query("customer_value", _SALES + "SELECT * FROM k")
def customer_value(t):
    return sales_classified(t)


@query(
    "customer_stats",
    _SALES
    + """SELECT value_tier, churn_risk, count(*) AS customer_count, CAST(sum(CAST(TotalRevenue AS DECIMAL(28,6))) AS DOUBLE) AS tier_revenue,
      CAST(sum(CAST(TotalRevenue AS DECIMAL(28,6))) AS DOUBLE) / count(*) AS avg_customer_revenue, round(avg(OrderCount), 6) AS avg_orders_per_customer FROM k GROUP BY 1, 2""",
)
def customer_stats(t):
    return sales.statistics(sales_classified(t)).withColumn("avg_orders_per_customer", F.round("avg_orders_per_customer", 6))


@query(
    "sales_orders",
    """
    SELECT o_orderkey AS SalesOrderID, CAST(DATE '2001-12-31' - CAST(o_orderdate AS DATE) AS INTEGER) AS days_since_order,
      CASE WHEN DATE '2001-12-31' - CAST(o_orderdate AS DATE) <= 90 THEN 'Y' ELSE 'N' END AS recent_order, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders
    """,
)
def sales_orders(t):
    return _sales(t)[1].select("SalesOrderID", "days_since_order", "recent_order", "order_year")


@query(
    "sales_checks",
    _SALES
    + "SELECT 'tier_known' AS \"check\", CAST(0 AS BIGINT) AS violations, count(*) AS rows, TRUE AS passed FROM k "
    + "".join(
        f"UNION ALL SELECT '{n}', {v}, count(*), {v} = 0 FROM k "
        for n, v in [
            ("risk_known", "0"), ("days_not_negative", "count(*) FILTER (days_since_last_order < 0)"), ("lifetime_not_negative", "0"), ("tier_matches_revenue", "0"),
            ("orders_present", "0"), ("revenue_positive", "0"), ("order_value_reasonable", "count(*) FILTER (AvgOrderValue < 10)"), ("dates_ordered", "0"),
        ]
    ),
)
def sales_checks(t):
    return validate(sales_classified(t), sales.classified_rules())


@query(
    "sales_order_checks",
    """
    WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders), n AS (SELECT count(*) AS rows FROM o),
    c AS (SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_name <> 'Customer#000000001'), m AS (SELECT count(*) AS rows FROM c),
    bad AS (SELECT 'SalesOrderID_positive' AS "check", (SELECT count(*) FROM o WHERE o_orderkey <= 0) AS violations, rows FROM n
      UNION ALL SELECT 'TotalDue_positive', (SELECT count(*) FROM o WHERE v <= 0), rows FROM n
      UNION ALL SELECT 'not_in_future', (SELECT count(*) FROM o WHERE d > DATE '2001-12-31'), rows FROM n
      UNION ALL SELECT 'year_in_range', (SELECT count(*) FROM o WHERE NOT year(d) BETWEEN 1994 AND 2001), rows FROM n
      UNION ALL SELECT 'CustomerID_positive', (SELECT count(*) FROM c WHERE c_custkey <= 0), rows FROM m
      UNION ALL SELECT 'CompanyName_present', (SELECT count(*) FROM c WHERE c_name = ''), rows FROM m
      UNION ALL SELECT 'EmailAddress_present', (SELECT count(*) FROM c WHERE c_mktsegment = ''), rows FROM m)
    SELECT "check", violations, rows, violations = 0 AS passed FROM bad
    """,
)
def sales_order_checks(t):
    """Expectations on orders and customers, with a first year that parts the test orders."""
    customers, orders = _sales(t)
    return validate(orders, sales.order_rules(AS_OF, first_year=1994)).unionByName(validate(customers, sales.customer_rules()))


@query(
    "sales_table_checks",
    _SALES
    + """, s AS (SELECT count(*) AS n, sum(TotalRevenue) AS r FROM k GROUP BY value_tier, churn_risk),
    c AS (SELECT count(*) AS n, count(*) - count(DISTINCT CustomerID) AS u FROM k),
    o AS (SELECT 'customers_present' AS "check", 'observed > 0' AS condition, CAST(n AS DOUBLE) AS observed, n > 0 AS passed FROM c
      UNION ALL SELECT 'one_row_per_customer', 'observed = 0', CAST(u AS DOUBLE), u = 0 FROM c
      UNION ALL SELECT 'classes_at_most', 'observed <= 9', CAST(count(*) AS DOUBLE), count(*) <= 9 FROM s
      UNION ALL SELECT 'counts_match_detail', 'observed = 0', CAST(sum(s.n) - (SELECT n FROM c) AS DOUBLE), sum(s.n) = (SELECT n FROM c) FROM s
      UNION ALL SELECT 'smallest_class', 'observed > 0', CAST(min(n) AS DOUBLE), min(n) > 0 FROM s
      UNION ALL SELECT 'smallest_revenue', 'observed > 0', min(r), min(r) > 0 FROM s)
    SELECT "check", condition, round(observed, 2) AS observed, passed FROM o
    """,
)
def sales_table_checks(t):
    """Expectations on the customer table and its statistics as wholes."""
    classified = sales_classified(t)
    return sales.table_expectations(classified, sales.statistics(classified)).withColumn("observed", F.round("observed", 2))


# ---- small sample programs ------------------------------------------------

PRICE_CLASS = ValueFormat(
    "msrp", ranges=(Range(None, 920, "Budget"), Range(921, 950, "Mid-Range"), Range(951, 980, "Premium"), Range(981, None, "Luxury"))
)
SIZE_CLASS = ValueFormat("cyl", {4: "4 - Compact", 6: "6 - Midsize", 8: "8 - Performance"}, missing="N/A")


@query(
    "catalogue_formats",
    """
    SELECT p_partkey, p_name, CASE WHEN p_retailprice <= 920 THEN 'Budget' WHEN p_retailprice BETWEEN 921 AND 950 THEN 'Mid-Range'
      WHEN p_retailprice BETWEEN 951 AND 980 THEN 'Premium' WHEN p_retailprice >= 981 THEN 'Luxury' ELSE CAST(p_retailprice AS VARCHAR) END AS price_class,
      CASE WHEN p_size > 45 THEN 'N/A' WHEN p_size = 4 THEN '4 - Compact' WHEN p_size = 6 THEN '6 - Midsize' WHEN p_size = 8 THEN '8 - Performance'
        ELSE CAST(p_size AS VARCHAR) END AS size_class FROM part
    """,
)
def catalogue_formats(t):
    """Unmatched values are shown as they are."""
    rows = keep(t.part, ["p_partkey", "p_name", "p_retailprice", "p_size"])
    return rows.select(
        "p_partkey", "p_name", PRICE_CLASS.label("p_retailprice").alias("price_class"),
        SIZE_CLASS.label(F.when(F.col("p_size") <= 45, F.col("p_size"))).alias("size_class"),
    )


@query(
    "classified_lines",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_extendedprice < 5000 THEN 'Minor' WHEN l_extendedprice < 25000 THEN 'Moderate' ELSE 'Major' END AS severity,
      CAST(l_extendedprice > 50000 AS INTEGER) AS high_value_flag, CAST(quarter(l_shipdate) AS INTEGER) AS fiscal_quarter FROM lineitem
    """,
)
def classified_lines(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        case_of([("l_extendedprice < 5000", "Minor"), ("l_extendedprice < 25000", "Moderate")], "Major").alias("severity"),
        as_int("l_extendedprice > 50000").alias("high_value_flag"), F.quarter("l_shipdate").alias("fiscal_quarter"),
    )
