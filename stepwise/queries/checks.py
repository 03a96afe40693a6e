"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepwise.operators import quality as ql
from stepwise.queries.base import query
from stepwise.session import shared_dir
from stepwise.streaming import streams as st

RULES = {
    "valid_amount": "value > 1",
    "known_type": "kind IN ('click', 'view', 'purchase', 'signup')",
    "small": "value < 250",
}


def _events(t):
    """Errors get a missing kind, so that one rule is unknown rather than false."""
    return t.events.select("event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("kind"), "value")


_E = "WITH e AS (SELECT event_id, nullif(event_type, 'error') AS kind, value FROM events) "


@query(
    "expect_warn",
    "SELECT event_id, nullif(event_type, 'error') AS kind, value FROM events",
)
def expect_warn(t):
    """All rows stay; the violation counters fill while the result is read."""
    return ql.expect(_events(t), RULES)[0]


@query(
    "expect_warn_counts",
    _E
    + """, c AS (SELECT count(*) AS n, count(*) FILTER (NOT value > 1) AS a, count(*) FILTER (kind IS NULL) AS b, count(*) FILTER (NOT value < 250) AS c FROM e)
    SELECT 'valid_amount' AS "check", a AS violations, n AS rows, a = 0 AS passed FROM c
    UNION ALL SELECT 'known_type', b, n, b = 0 FROM c UNION ALL SELECT 'small', c, n, c = 0 FROM c""",
)
def expect_warn_counts(t):
    """The outcomes of the warning rules as rows, over the frame that they let through."""
    return ql.validate(ql.expect(_events(t), RULES)[0], RULES)


@query(
    "expect_log",
    _E
    + """, c AS (SELECT 'stream' AS run, event_id * 7919 % 2 AS batch, * FROM e UNION ALL SELECT 'table', 0, * FROM e),
      k AS (SELECT run, batch, count(*) AS rows, count(*) FILTER (NOT value > 1) AS a, count(*) FILTER (kind IS NULL) AS b,
        count(*) FILTER (NOT value < 250) AS c FROM c GROUP BY 1, 2)
    SELECT run, batch, 'valid_amount' AS "check", a AS violations, rows, a = 0 AS passed FROM k
    UNION ALL SELECT run, batch, 'known_type', b, rows, b = 0 FROM k UNION ALL SELECT run, batch, 'small', c, rows, c = 0 FROM k""",
)
def expect_log(t):
    """Rule outcomes of a stored table and of two micro-batches, as the writes themselves counted them."""
    root, rows = shared_dir(t.spark, "checked"), _events(t)
    ql.write_checked(rows, RULES, f"{root}/table", f"{root}/log", "table")
    for wave in range(2):
        rows.where(f"pmod(event_id * 7919, 2) = {wave}").write.mode("append").parquet(f"{root}/feed")
        stream = st.stream_files(t.spark, f"{root}/feed", "parquet", rows.schema)
        st.write_checked_stream(stream, RULES, f"{root}/good", f"{root}/log", f"{root}/checkpoint", "stream", drop=True).awaitTermination()
    return ql.read_log(t.spark, f"{root}/log")


@query("expect_drop", _E + "SELECT * FROM e WHERE value > 1 AND kind IS NOT NULL AND value < 250")
def expect_drop(t):
    return ql.expect_or_drop(_events(t), RULES)[0]


@query("expect_fail", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def expect_fail(t):
    """No row violates, so the guarded query goes through."""
    return ql.expect_or_fail(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), {"positive": "l_quantity > 0"})


@query(
    "quarantine",
    _E
    + """SELECT event_id, concat_ws('; ', CASE WHEN NOT value > 1 THEN 'valid_amount' END, CASE WHEN kind IS NULL THEN 'known_type' END,
      CASE WHEN NOT value < 250 THEN 'small' END) AS edit_reason FROM e WHERE NOT (value > 1 AND kind IS NOT NULL AND value < 250)""",
)
def quarantine(t):
    return ql.quarantine(_events(t), RULES)[1].select("event_id", "edit_reason")


@query(
    "validate_report",
    _E
    + """, c AS (SELECT count(*) AS n, count(*) FILTER (NOT value > 1) AS a, count(*) FILTER (kind IS NULL) AS b, count(*) FILTER (NOT value < 250) AS c,
      count(*) FILTER (event_id IS NULL) AS d FROM e)
    SELECT 'valid_amount' AS "check", a AS violations, n AS rows, a = 0 AS passed FROM c UNION ALL SELECT 'known_type', b, n, b = 0 FROM c
    UNION ALL SELECT 'small', c, n, c = 0 FROM c UNION ALL SELECT 'has_id', d, n, d = 0 FROM c""",
)
def validate_report(t):
    return ql.validate(_events(t), {**RULES, "has_id": "event_id IS NOT NULL"})


@query(
    "table_checks",
    """
    WITH c AS (SELECT count(*) AS n, count(DISTINCT o_orderkey) - count(*) AS u, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS s,
      count(DISTINCT o_orderstatus) AS k FROM orders)
    SELECT 'not_empty' AS "check", 'observed > 0' AS condition, CAST(n AS DOUBLE) AS observed, n > 0 AS passed FROM c
    UNION ALL SELECT 'unique_id', 'observed = 0', CAST(u AS DOUBLE), u = 0 FROM c
    UNION ALL SELECT 'revenue', 'observed >= 1000000', s, s >= 1000000 FROM c
    UNION ALL SELECT 'few_states', 'observed <= 2', CAST(k AS DOUBLE), k <= 2 FROM c
    """,
)
def table_checks(t):
    return ql.table_checks(
        t.orders,
        {
            "not_empty": (F.count(F.lit(1)), "observed > 0"),
            "unique_id": (F.countDistinct("o_orderkey") - F.count(F.lit(1)), "observed = 0"),
            "revenue": (F.sum(F.col("o_totalprice").cast("decimal(18,2)")), "observed >= 1000000"),
            "few_states": (F.countDistinct("o_orderstatus"), "observed <= 2"),
        },
    )


@query(
    "parity_report",
    """
    WITH a AS (SELECT count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(28,4))) AS DOUBLE) AS s FROM orders),
      b AS (SELECT count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(28,4))) AS DOUBLE) AS s FROM orders WHERE o_totalprice > 1500)
    SELECT 'row_count' AS "check", CAST(a.n AS DOUBLE) AS value_a, CAST(b.n AS DOUBLE) AS value_b, a.n = b.n AS passed FROM a, b
    UNION ALL SELECT 'schema_differences', 0, 0, TRUE
    UNION ALL SELECT 'checksum_match', 1, CAST(a.n = b.n AS INTEGER), a.n = b.n FROM a, b
    UNION ALL SELECT 'sum_o_totalprice', a.s, b.s, abs(a.s - b.s) <= CAST(0.01 AS DOUBLE) * abs(a.s) FROM a, b
    """,
)
def parity_report(t):
    """A copy that lost its smallest orders: sums agree within one percent, counts do not."""
    return ql.parity(t.orders, t.orders.filter("o_totalprice > 1500"), ["o_totalprice"], 0.01)


@query(
    "key_duplicates",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def key_duplicates(t):
    return ql.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "fk_check",
    """
    SELECT l_suppkey, count(*) AS child_rows FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1
    """,
)
def fk_check(t):
    return ql.unresolved(t.lineitem, t.supplier.filter("s_acctbal > 0"), "l_suppkey", "s_suppkey")


@query(
    "reconcile",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, abs(p + x - round(p * CAST(1.05 AS DECIMAL(4,2)), 2)) < 0.01 AS reconciles
    FROM (SELECT *, round(p * CAST(l_tax AS DECIMAL(4,2)), 2) AS x FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(14,2)) AS p FROM lineitem))
    """,
)
def reconcile(t):
    rows = t.lineitem.withColumn("p", F.col("l_extendedprice").cast("decimal(14,2)"))
    rows = rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "p", F.round(F.col("p") * F.col("l_tax").cast("decimal(4,2)"), 2).alias("x"),
        F.round(F.col("p") * F.lit("1.05").cast("decimal(4,2)"), 2).alias("total"),
    )
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", ql.reconciles(["p", "x"], "total").alias("reconciles"))
