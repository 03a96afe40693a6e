"""Claims pipeline queries. Line items play the claims, see ``bind``.

policy = customer, appliance = part, batch = supplier, claim date = ship date,
claim type = return flag, amount = extended price.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stepwise.operators.metrics import baseline_status, weekly_projection
from stepwise.operators.agg import two_level
from stepwise.plans import claims as job
from stepwise.queries.base import money, query

BASELINE = 11_000_000.0
LINE_BASELINE = 8_500_000.0
BATCH_PLANT = "Supplier#000000003"


def bind(t):
    """Driver tables in the shape of the claims job's inputs."""
    kind = F.when(F.col("l_returnflag") == "R", "water_damage").when(F.col("l_returnflag") == "A", "fire").otherwise("other")
    claims = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        F.format_string("CLM-%d-%d", "l_orderkey", "l_linenumber").alias("claim_id"),
        F.col("o_custkey").alias("policy_id"),
        F.col("l_partkey").alias("appliance_id"),
        F.col("l_suppkey").alias("appliance_batch_id"),
        F.to_date("l_shipdate").alias("claim_date"),
        kind.alias("claim_type"),
        money("l_extendedprice").alias("claim_amount_usd"),
        F.col("l_linestatus").alias("state"),
    )
    nations = t.nation.select("n_nationkey", "n_name")
    policies = t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("policy_id"),
        F.col("c_name").alias("policyholder_name"),
        F.col("n_name").alias("state"),
        F.col("c_mktsegment").alias("city"),
    )
    appliances = t.part.select(
        F.col("p_partkey").alias("appliance_id"), F.col("p_name").alias("model_name"), F.col("p_brand").alias("manufacturer"),
        F.col("p_type").alias("category"),
    )
    batches = t.supplier.select(
        F.col("s_suppkey").alias("appliance_batch_id"), F.col("s_name").alias("plant_location"),
        F.when(F.col("s_acctbal") < 0, "recalled").otherwise("normal").alias("status"), "s_acctbal",
    )
    return claims, policies, appliances, batches


def silver(t):
    claims, policies, appliances, batches = bind(t)
    # The affected batch is named by its plant; its id is a scalar subquery.
    affected = batches.filter(F.col("plant_location") == BATCH_PLANT).select(F.max("appliance_batch_id")).scalar()
    return job.enrich_claims(claims, policies, appliances, batches, affected)


@query(
    "claims_bronze",
    """
    SELECT printf('CLM-%d-%d', l_orderkey, l_linenumber) AS claim_id, CAST(l_shipdate AS DATE) AS claim_date,
      CAST(l_extendedprice AS DECIMAL(18,2)) - 20000 AS claim_amount_usd FROM lineitem WHERE CAST(l_extendedprice AS DECIMAL(18,2)) > 20000
    """,
)
def claims_bronze(t):
    """Amounts less 20,000, so that the amount rule drops rows."""
    raw = bind(t)[0].withColumn("claim_amount_usd", (F.col("claim_amount_usd") - 20_000).cast("decimal(18,2)"))
    return job.bronze_claims(raw).select("claim_id", "claim_date", F.col("claim_amount_usd").cast("decimal(19,2)").alias("claim_amount_usd"))


SILVER = f"""
    WITH claims AS (
      SELECT printf('CLM-%d-%d', l_orderkey, l_linenumber) AS claim_id, o_custkey AS policy_id, l_partkey AS appliance_id,
        l_suppkey AS appliance_batch_id, CAST(l_shipdate AS DATE) AS claim_date,
        CASE l_returnflag WHEN 'R' THEN 'water_damage' WHEN 'A' THEN 'fire' ELSE 'other' END AS claim_type,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS amt, l_linestatus AS claim_state
      FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey),
    silver AS (
      SELECT c.*, n_name AS state, c_mktsegment AS city, c_name AS policyholder_name, p_name AS model_name, p_brand AS manufacturer,
        s_name AS plant_location, CASE WHEN s_acctbal < 0 THEN 'recalled' ELSE 'normal' END AS batch_status,
        coalesce(s_name = '{BATCH_PLANT}', FALSE) AS hit,
        CASE WHEN claim_type = 'water_damage' AND amt > 5000 THEN 'high' WHEN amt > 10000 THEN 'high'
             WHEN amt > 3000 THEN 'medium' ELSE 'low' END AS severity
      FROM claims c LEFT JOIN customer ON policy_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN part ON appliance_id = p_partkey LEFT JOIN supplier ON appliance_batch_id = s_suppkey
      WHERE amt > 0 AND policy_id IS NOT NULL)
"""

_WEEKLY = """
    WITH w AS (SELECT {week} AS week, count(*) AS claim_count,
        CAST(sum(CAST({amount} AS DECIMAL(18,2))) AS DOUBLE) AS weekly_claims FROM {table} GROUP BY 1)
    SELECT week, claim_count, weekly_claims, weekly_claims / CAST({base} AS DOUBLE) AS ratio,
      (weekly_claims / CAST({base} AS DOUBLE) - 1) * 100 AS vs_baseline_pct,
      CASE WHEN weekly_claims / CAST({base} AS DOUBLE) > 1.25 THEN 'ALERT' ELSE 'NORMAL' END AS status FROM w
"""


@query(
    "weekly_status",
    _WEEKLY.format(week="CAST(date_trunc('week', o_orderdate) AS DATE)", amount="o_totalprice", table="orders", base=BASELINE),
)
def weekly_status(t):
    return baseline_status(t.orders, "o_orderdate", money("o_totalprice"), BASELINE, job.SPIKE_RATIO)


@query(
    "weekly_status_sunday",
    _WEEKLY.format(
        week="CAST(date_trunc('week', CAST(o_orderdate AS DATE) + INTERVAL 1 DAY) AS DATE) - 1",
        amount="o_totalprice", table="orders", base=BASELINE,
    ),
)
def weekly_status_sunday(t):
    return baseline_status(t.orders, "o_orderdate", money("o_totalprice"), BASELINE, job.SPIKE_RATIO, "sunday")


@query(
    "weekly_vs_baseline",
    f"""
    SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS weekly_total,
      CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) - CAST({BASELINE} AS DOUBLE) AS vs_baseline,
      round((CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) - CAST({BASELINE} AS DOUBLE)) / CAST({BASELINE} AS DOUBLE) * 100, 1) AS pct_vs_baseline
    FROM orders WHERE o_orderdate >= DATE '2001-01-01' GROUP BY 1
    """,
)
def weekly_vs_baseline(t):
    """Recent weeks only; the date filter reaches the scan."""
    weekly = t.orders.filter("o_orderdate >= TIMESTAMP_NTZ '2001-01-01'").groupBy(F.to_date(F.date_trunc("week", "o_orderdate")).alias("week")).agg(
        F.sum(money("o_totalprice")).cast("double").alias("weekly_total")
    )
    over = F.col("weekly_total") - BASELINE
    return weekly.select("week", "weekly_total", over.alias("vs_baseline"), F.round(over / BASELINE * 100, 1).alias("pct_vs_baseline"))


@query(
    "enriched_claims",
    SILVER
    + """
    SELECT claim_id, claim_date, CAST(amt AS DOUBLE) AS amount, claim_type, claim_state, state, city, policyholder_name, model_name,
      manufacturer, plant_location, batch_status, hit AS is_affected_batch, severity FROM silver
    """,
)
def enriched_claims(t):
    return silver(t).select(
        "claim_id", "claim_date", F.col("claim_amount_usd").cast("double").alias("amount"), "claim_type", "claim_state", "state",
        "city", "policyholder_name", "model_name", "manufacturer", "plant_location", "batch_status", "is_affected_batch", "severity",
    )


@query(
    "daily_summary",
    SILVER
    + """
    SELECT claim_date AS date, state, claim_type, count(*) AS claim_count, CAST(sum(amt) AS DOUBLE) AS claim_amount_usd
    FROM silver GROUP BY 1, 2, 3
    """,
)
def daily_summary(t):
    return job.daily_summary(silver(t)).withColumn("claim_amount_usd", F.col("claim_amount_usd").cast("double"))


@query(
    "weekly_summary",
    SILVER
    + f"""
    , w AS (SELECT CAST(date_trunc('week', claim_date) AS DATE) AS week, count(*) AS claim_count, CAST(sum(amt) AS DOUBLE) AS weekly_claims
            FROM silver GROUP BY 1)
    SELECT week, claim_count, weekly_claims, weekly_claims / CAST({LINE_BASELINE} AS DOUBLE) AS ratio,
      (weekly_claims / CAST({LINE_BASELINE} AS DOUBLE) - 1) * 100 AS vs_baseline_pct,
      CASE WHEN weekly_claims / CAST({LINE_BASELINE} AS DOUBLE) > 1.25 THEN 'ALERT' ELSE 'NORMAL' END AS status FROM w
    """,
)
def weekly_summary(t):
    return job.weekly_summary(silver(t), LINE_BASELINE)


@query(
    "batch_analysis",
    SILVER
    + """
    , b AS (SELECT state, claim_type, model_name, plant_location, count(*) AS claim_count, CAST(sum(amt) AS DOUBLE) AS total_amount,
        CAST(sum(amt) AS DOUBLE) / count(*) AS avg_amount, min(claim_date) AS first_claim_date, max(claim_date) AS last_claim_date
        FROM silver WHERE hit GROUP BY 1, 2, 3, 4)
    SELECT *, CAST(100 AS DOUBLE) * claim_count / sum(claim_count) OVER () AS pct_of_total FROM b
    """,
)
def batch_analysis(t):
    return job.batch_analysis(silver(t))


@query(
    "mv_performance",
    SILVER
    + f"""
    , daily AS (SELECT claim_date AS date, state, claim_type, count(*) AS claim_count, sum(amt) AS amount FROM silver GROUP BY 1, 2, 3)
    SELECT CAST(date_trunc('week', date) AS DATE) AS week, CAST(sum(amount) AS DOUBLE) AS total_claims,
      CAST(sum(amount) AS DOUBLE) / CAST({LINE_BASELINE} AS DOUBLE) AS vs_baseline,
      CASE WHEN CAST(sum(amount) AS DOUBLE) / CAST({LINE_BASELINE} AS DOUBLE) > 1.25 THEN 1 ELSE 0 END AS alert_flag,
      count(*) AS summary_rows, CAST(sum(claim_count) AS BIGINT) AS claim_count,
      CAST(sum(amount) AS DOUBLE) / count(*) AS avg_claim_amount,
      CAST(sum(amount) AS DOUBLE) / CAST(sum(claim_count) AS BIGINT) AS avg_per_claim
    FROM daily GROUP BY 1
    """,
)
def mv_performance(t):
    view = job.performance_view(job.daily_summary(silver(t)), LINE_BASELINE)
    names = {
        "total_claims": "total_claims_usd", "vs_baseline": "baseline_ratio", "alert_flag": "spike_alert", "summary_rows": "summary_rows",
        "claim_count": "claim_count", "avg_claim_amount": "avg_claim_amount", "avg_per_claim": "avg_per_claim",
    }
    return view.query({"week": F.trunc("date", "week")}, names)


@query(
    "mv_affected",
    SILVER
    + """
    SELECT state, count(*) FILTER (hit) AS affected_claims, CAST(sum(CASE WHEN hit THEN amt ELSE 0 END) AS DOUBLE) AS affected_amount,
      CAST(sum(CASE WHEN hit THEN amt ELSE 0 END) AS DOUBLE) / CAST(sum(amt) AS DOUBLE) AS pct_of_total,
      count(*) FILTER (NOT hit) AS normal_claims, CAST(sum(amt) FILTER (hit) AS DOUBLE) / count(*) FILTER (hit) AS avg_affected
    FROM silver GROUP BY 1 HAVING count(*) FILTER (hit) > 0
    """,
)
def mv_affected(t):
    return job.affected_view(silver(t)).query(
        ["state"],
        {
            "affected_claims": "affected_claim_count", "affected_amount": "affected_claims_usd", "pct_of_total": "affected_pct",
            "normal_claims": "normal_claim_count", "avg_affected": "avg_affected_claim",
        },
        having="affected_claims > 0",
    )


@query(
    "drilldown",
    SILVER
    + """
    SELECT plant_location, count(*) AS claim_count, CAST(sum(amt) AS DOUBLE) AS total_amount
    FROM silver WHERE claim_type = 'water_damage' AND model_name LIKE '%ring%' GROUP BY 1
    """,
)
def drilldown(t):
    return job.drill_down(silver(t), {"claim_type": "water_damage", "model_name": "%ring%"}, "plant_location")


@query(
    "top_pick_join",
    SILVER
    + """
    , top AS (SELECT appliance_batch_id FROM silver WHERE model_name LIKE '%ring%' AND appliance_batch_id IS NOT NULL
              GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT s_suppkey AS appliance_batch_id, s_name AS plant_location, CASE WHEN s_acctbal < 0 THEN 'recalled' ELSE 'normal' END AS status,
      s_acctbal FROM supplier WHERE s_suppkey IN (SELECT appliance_batch_id FROM top)
    """,
)
def top_pick_join(t):
    return job.driving_batch(silver(t), bind(t)[3], "%ring%")


@query(
    "flow_counts",
    SILVER
    + """
    , m AS (SELECT model_name FROM silver WHERE model_name IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10),
      b AS (SELECT CAST(appliance_batch_id AS VARCHAR) AS batch FROM silver WHERE appliance_batch_id IS NOT NULL GROUP BY 1
            ORDER BY count(*) DESC, 1 LIMIT 10)
    SELECT claim_type, coalesce(m.model_name, 'Other models') AS model_name, coalesce(b.batch, 'Other batches') AS batch,
      count(*) AS claim_count, CAST(sum(amt) AS DOUBLE) AS claim_amount
    FROM silver s LEFT JOIN m ON s.model_name = m.model_name LEFT JOIN b ON CAST(s.appliance_batch_id AS VARCHAR) = b.batch
    GROUP BY 1, 2, 3
    """,
)
def flow_counts(t):
    return job.flow_counts(silver(t))


@query(
    "city_table",
    SILVER + "SELECT city, state, count(DISTINCT claim_id) AS claims, CAST(sum(amt) AS DOUBLE) AS claim_amount FROM silver GROUP BY 1, 2",
)
def city_table(t):
    return job.city_table(silver(t))


@query(
    "affected_split",
    SILVER
    + """
    SELECT claim_type, CASE WHEN hit THEN 'Affected batch' ELSE 'Normal claims' END AS source, count(*) AS claims,
      CAST(sum(amt) AS DOUBLE) AS claim_amount, CAST(sum(amt) AS DOUBLE) / count(*) AS avg_amount FROM silver GROUP BY 1, 2
    """,
)
def affected_split(t):
    return job.affected_split(silver(t), "claim_type")


@query(
    "dashboard_kpis",
    SILVER
    + """
    SELECT CAST(sum(amt) AS DOUBLE) AS claims_usd, count(*) AS claim_count,
      CAST(sum(CASE WHEN claim_type = 'water_damage' THEN amt ELSE 0 END) AS DOUBLE) AS water_damage_usd,
      count(DISTINCT policy_id) AS active_policies FROM silver
    """,
)
def dashboard_kpis(t):
    return job.kpis(silver(t))


@query(
    "projection",
    """
    WITH w AS (SELECT l_returnflag AS flag, CAST(date_trunc('week', l_shipdate) AS DATE) AS week,
                 CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM lineitem GROUP BY 1, 2),
      m AS (SELECT max(week) AS m FROM w),
      x AS (SELECT flag, amount, CAST((week - m) // 7 AS INTEGER) AS x FROM w, m),
      l AS (SELECT flag, regr_slope(amount, x) AS a, regr_intercept(amount, x) AS b FROM x WHERE x > -26 GROUP BY 1)
    SELECT flag, h AS weeks_ahead, CAST(m + 7 * h AS DATE) AS week, round(greatest(0, b + a * h), 2) AS projected
    FROM l, m, (SELECT unnest([1, 2, 3, 4]) AS h)
    """,
)
def projection(t):
    rows = t.lineitem.select(F.col("l_returnflag").alias("flag"), "l_shipdate", "l_extendedprice")
    out = weekly_projection(rows, ["flag"], "l_shipdate", money("l_extendedprice"))
    return out.withColumn("projected", F.round("projected", 2))


@query(
    "two_level",
    """
    WITH w AS (SELECT o_orderpriority, CAST(date_trunc('week', o_orderdate) AS DATE) AS week,
                 CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1, 2)
    SELECT o_orderpriority, round(avg(total), 4) AS avg_total, count(*) AS n_groups, max(total) AS peak_total,
      max_by(week, struct_pack(a := total, b := week)) AS peak_week FROM w GROUP BY 1
    """,
)
def two_levels(t):
    rows = t.orders.withColumn("week", F.to_date(F.date_trunc("week", "o_orderdate")))
    out = two_level(rows, ["week"], money("o_totalprice"), ["o_orderpriority"])
    return out.select(
        "o_orderpriority", F.round(F.col("avg_total").cast("double"), 4).alias("avg_total"), "n_groups",
        F.col("peak_total").cast("double").alias("peak_total"), "peak_week",
    )
