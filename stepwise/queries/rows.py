"""Row-local operators on orders, line items and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepwise.functions.missing import is_missing, missing_eq, missing_ge, missing_gt, missing_le, missing_lt
from stepwise.operators import project as pj
from stepwise.queries.base import money, query
from stepwise.session import shared_dir

# Severity limits.
SEVERITY_RULES = [
    {"condition": "amount < 5000", "severity": "Minor", "severity_code": 1},
    {"condition": "amount >= 5000 AND amount < 25000", "severity": "Moderate", "severity_code": 2},
    {"condition": "amount >= 25000", "severity": "Major", "severity_code": 3},
]


@query(
    "rules_table",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice AS amount,
      CASE WHEN l_extendedprice < 5000 THEN 'Minor' WHEN l_extendedprice < 25000 THEN 'Moderate' ELSE 'Major' END AS severity,
      CASE WHEN l_extendedprice < 5000 THEN 1 WHEN l_extendedprice < 25000 THEN 2 ELSE 3 END AS severity_code FROM lineitem
    """,
)
def rules_table(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("amount"))
    return pj.apply_rules(rows, SEVERITY_RULES)


@query(
    "case_severity",
    """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 100000 THEN 'high' WHEN o_totalprice > 300000 THEN 'high'
      WHEN o_totalprice > 150000 THEN 'medium' ELSE 'low' END AS severity,
      CASE WHEN o_totalprice > 400000 THEN 'top' END AS no_else, CAST(o_totalprice > 50000 AS INTEGER) AS high_value_flag,
      CAST(quarter(o_orderdate) AS INTEGER) AS fiscal_quarter FROM orders
    """,
)
def case_severity(t):
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        pj.case_of(
            [((F.col("o_orderpriority") == "1-URGENT") & (price > 100000), "high"), (price > 300000, "high"), (price > 150000, "medium")],
            "low",
        ).alias("severity"),
        pj.case_of([("o_totalprice > 400000", "top")]).alias("no_else"),
        pj.as_int("o_totalprice > 50000").alias("high_value_flag"),
        F.quarter("o_orderdate").alias("fiscal_quarter"),
    )


@query(
    "case_block",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 400000 THEN 'DENIED' WHEN o_orderpriority = '5-LOW' THEN 'PENDED'
        ELSE 'APPROVED' END AS adj_status,
      CASE WHEN o_orderstatus = 'F' AND o_totalprice > 400000 THEN 'LIMIT' WHEN o_orderpriority = '5-LOW' THEN 'REVIEW' ELSE '' END AS reason,
      CASE WHEN (o_orderstatus = 'F' AND o_totalprice > 400000) OR o_orderpriority = '5-LOW' THEN NULL
        ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) - 25 AS DOUBLE) END AS paid FROM orders
    """,
)
def case_block(t):
    out = pj.case_block(
        t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"),
        [
            ("o_orderstatus = 'F' AND o_totalprice > 400000", {"adj_status": "DENIED", "reason": "LIMIT"}),
            ("o_orderpriority = '5-LOW'", {"adj_status": "PENDED", "reason": "REVIEW"}),
        ],
        {"adj_status": "APPROVED", "reason": "", "paid": (money("o_totalprice") - 25).cast("double")},
    )
    return out.select("o_orderkey", "adj_status", "reason", "paid")


@query(
    "case_last",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'OPEN' WHEN o_orderpriority = '1-URGENT' THEN 'URGENT'
      WHEN o_totalprice > 250000 THEN 'BIG' ELSE 'PLAIN' END AS label FROM orders
    """,
)
def case_last(t):
    """Later rules override, so the SQL lists them backwards."""
    rules = [("o_totalprice > 250000", "BIG"), ("o_orderpriority = '1-URGENT'", "URGENT"), ("o_orderstatus = 'O'", "OPEN")]
    return t.orders.select("o_orderkey", pj.case_last(rules, "PLAIN").alias("label"))


@query(
    "select_when",
    """
    SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'compact' WHEN p_type IN ('LARGE') THEN 'large' ELSE '' END AS size_class,
      p_brand AS brand_name FROM part
    """,
)
def select_when(t):
    out = t.part.select(
        "p_partkey", pj.select_when("p_type", {"compact": ["SMALL", "MEDIUM"], "large": ["LARGE"]}, "").alias("size_class"), "p_brand"
    )
    return pj.rename(out, {"p_brand": "brand_name"})


@query(
    "between_flag",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, coalesce(l_extendedprice BETWEEN 10000 AND CASE WHEN l_discount > 0.02 THEN 40000 END, FALSE)
      AS in_band FROM lineitem
    """,
)
def between_flag(t):
    """A missing bound makes the chained comparison false."""
    top = F.when(F.col("l_discount") > 0.02, 40000)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", pj.between(F.col("l_extendedprice"), 10000, top).alias("in_band"))


@query(
    "delete_where",
    """
    SELECT event_id, v FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)
    WHERE NOT coalesce(v < 50, FALSE)
    """,
)
def delete_where(t):
    """Rows whose condition is unknown survive a DELETE."""
    rows = t.events.select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v"))
    return pj.delete_where(rows, "v < 50")


@query(
    "missing_compare",
    """
    WITH e AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS a, CASE WHEN value < 100 THEN value * 2 - 40 END AS b FROM events)
    SELECT event_id, coalesce(a < b, a IS NULL AND b IS NOT NULL) AS lt, coalesce(a <= b, a IS NULL) AS le,
      coalesce(a > b, b IS NULL AND a IS NOT NULL) AS gt, coalesce(a >= b, b IS NULL) AS ge, a IS NOT DISTINCT FROM b AS eq,
      a IS NULL AS miss FROM e
    """,
)
def missing_compare(t):
    e = t.events.select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("a"),
        F.when(F.col("value") < 100, F.col("value") * 2 - 40).alias("b"),
    )
    return e.select(
        "event_id", missing_lt("a", "b").alias("lt"), missing_le("a", "b").alias("le"), missing_gt("a", "b").alias("gt"),
        missing_ge("a", "b").alias("ge"), missing_eq("a", "b").alias("eq"), is_missing("a").alias("miss"),
    )


@query(
    "array_map",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity / l_extendedprice AS qty_norm, l_discount / l_extendedprice AS disc_norm,
      l_tax / l_extendedprice AS tax_norm FROM lineitem
    """,
)
def array_map(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    out = pj.array_map(
        rows, ["l_quantity", "l_discount", "l_tax"], lambda c: F.try_divide(c, F.col("l_extendedprice")), ["qty_norm", "disc_norm", "tax_norm"]
    )
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "qty_norm", "disc_norm", "tax_norm")


@query(
    "melt_array",
    """
    WITH p AS (SELECT p_partkey, nullif(p_type, 'SMALL') AS c1, p_brand AS c2, CASE WHEN p_size > 25 THEN p_name END AS c3 FROM part)
    SELECT * FROM (SELECT p_partkey, 1 AS pos, c1 AS code FROM p UNION ALL SELECT p_partkey, 2, c2 FROM p UNION ALL SELECT p_partkey, 3, c3 FROM p)
    WHERE code IS NOT NULL
    """,
)
def melt_array(t):
    p = t.part.select(
        "p_partkey", F.nullif(F.col("p_type"), F.lit("SMALL")).alias("c1"), F.col("p_brand").alias("c2"),
        F.when(F.col("p_size") > 25, F.col("p_name")).alias("c3"),
    )
    return pj.melt_array(p, ["c1", "c2", "c3"], "code", index="pos").select("p_partkey", "pos", "code")


@query(
    "expand_seq",
    "SELECT p_partkey, i FROM part, unnest(range(1, CAST(p_size AS BIGINT) + 1)) AS u(i)",
)
def expand_seq(t):
    return pj.expand(t.part.select("p_partkey", "p_size"), 1, "p_size", "i").select("p_partkey", "i")


@query(
    "amortise",
    """
    WITH RECURSIVE a(p_partkey, year, interest, principal) AS (
      SELECT p_partkey, 1, p_retailprice * CAST(0.0625 AS DOUBLE), p_retailprice + p_retailprice * CAST(0.0625 AS DOUBLE) FROM part
      UNION ALL
      SELECT p_partkey, year + 1, principal * CAST(0.0625 AS DOUBLE), principal + principal * CAST(0.0625 AS DOUBLE) FROM a WHERE year < 10)
    SELECT p_partkey, CAST(year AS INTEGER) AS year, interest, principal FROM a
    """,
)
def amortise(t):
    """A recurrence per row: each year's interest is added to the principal."""

    def step(s, i):
        interest = s["principal"] * 0.0625
        return {"interest": interest, "principal": s["principal"] + interest}

    rows = t.part.select("p_partkey", F.col("p_retailprice").alias("price"))
    return pj.iterate(rows, 10, {"interest": 0.0, "principal": "price"}, step, "year").drop("price")


@query(
    "route_outputs",
    """
    WITH r AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'paid' WHEN o_totalprice > 300000 THEN 'review' ELSE 'audit' END AS target
               FROM orders)
    SELECT target, o_orderkey FROM r UNION ALL SELECT 'audit', o_orderkey FROM r
    """,
)
def route_outputs(t):
    """Rows of the default output are written to the audit output twice; the orders are read once."""
    rules = [("paid", "o_orderstatus = 'F'"), ("review", "o_totalprice > 300000")]
    parts = pj.route_stored(t.orders, rules, shared_dir(t.spark, "routes"), default="audit", tee="audit")
    out = None
    for name, df in parts.items():
        named = df.select(F.lit(name).alias("target"), "o_orderkey")
        out = named if out is None else out.unionByName(named)
    return out


@query(
    "collect_missing",
    """
    WITH p AS (SELECT p_partkey, nullif(p_type, 'PROMO') AS p_type, CASE WHEN p_size > 10 THEN p_brand END AS p_brand,
                 CASE WHEN p_size > 40 THEN ' ' ELSE p_name END AS p_name FROM part)
    SELECT p_partkey, concat_ws('; ', CASE WHEN p_type IS NULL THEN 'p_type is missing' END, CASE WHEN p_brand IS NULL THEN 'p_brand is missing' END,
      CASE WHEN trim(p_name) = '' THEN 'p_name is missing' END) AS edit_reason,
      CAST(p_type IS NULL OR p_brand IS NULL OR trim(p_name) = '' AS INTEGER) AS edit_flag FROM p
    """,
)
def collect_missing(t):
    p = t.part.select(
        "p_partkey", F.nullif(F.col("p_type"), F.lit("PROMO")).alias("p_type"),
        F.when(F.col("p_size") > 10, F.col("p_brand")).alias("p_brand"),
        F.when(F.col("p_size") > 40, " ").otherwise(F.col("p_name")).alias("p_name"),
    )
    return pj.collect_missing(p, ["p_type", "p_brand", "p_name"]).select("p_partkey", "edit_reason", "edit_flag")


@query(
    "sql_params",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate <= DATE '1998-12-31' AND o_orderpriority LIKE '1-%'",
)
def sql_params(t):
    return pj.run_sql(
        t.spark,
        "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderdate BETWEEN :start AND :end AND o_orderpriority LIKE :prio",
        {"orders": t.orders}, start="1997-01-01", end="1998-12-31", prio="1-%",
    )


@query(
    "alias_reuse",
    """
    SELECT l_returnflag, total, n, total / n AS per_line, CASE WHEN total / n > 38000 THEN 1 ELSE 0 END AS high
    FROM (SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n FROM lineitem GROUP BY 1)
    """,
)
def alias_reuse(t):
    """A select item may use an alias defined before it, also over aggregates."""
    return pj.run_sql(
        t.spark,
        """SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n,
                  total / n AS per_line, CASE WHEN per_line > 38000 THEN 1 ELSE 0 END AS high
           FROM {lines} GROUP BY l_returnflag""",
        {"lines": t.lineitem},
    )


@query(
    "replace_column",
    "SELECT p_partkey, upper(trim(p_name)) AS p_name, substr(p_brand, 1, 5) AS p_brand FROM part",
)
def replace_column(t):
    p = pj.keep(t.part, ["p_partkey", "p_name", "p_brand"])
    return pj.replace(p, p_name=F.upper(F.trim("p_name")), p_brand=F.substring("p_brand", 1, 5))
