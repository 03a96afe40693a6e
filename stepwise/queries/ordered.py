"""BY-group queries on orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepwise.operators import bygroup as bg
from stepwise.queries.base import money, query
from stepwise.sources.readers import with_options


def _orders(t):
    return t.orders.select(
        "o_custkey", F.to_date("o_orderdate").alias("o_date"), "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"
    )


@query(
    "first_flags",
    """
    WITH e AS (SELECT event_id, user_id, event_type,
        row_number() OVER (PARTITION BY user_id ORDER BY event_type, ts, event_id) AS a,
        row_number() OVER (PARTITION BY user_id ORDER BY event_type DESC, ts DESC, event_id DESC) AS b,
        row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS c,
        row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS d
      FROM events)
    SELECT event_id, user_id, event_type, a = 1 AS first_user_id, b = 1 AS last_user_id,
           c = 1 AS first_event_type, d = 1 AS last_event_type FROM e
    """,
)
def first_flags(t):
    out = bg.by_flags(t.events.select("event_id", "user_id", "event_type", "ts"), ["user_id", "event_type"], ["ts", "event_id"])
    return out.drop("ts")


@query(
    "keep_first",
    """
    SELECT user_id, event_type, event_id, ts, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1
    """,
)
def keep_first(t):
    return bg.keep_first(
        t.events.select("user_id", "event_type", "event_id", "ts", "value"), ["user_id", "event_type"], ["ts", "event_id"]
    )


@query(
    "keep_last",
    """
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_date, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    """,
)
def keep_last(t):
    return bg.keep_last(_orders(t).select("o_custkey", "o_orderkey", "o_date", "o_totalprice"), "o_custkey", ["o_date", "o_orderkey"])


@query(
    "latest_turn",
    """
    SELECT conv_id, role, turn, text FROM conversations
    QUALIFY row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC) = 1
    """,
)
def latest_turn(t):
    return bg.keep_last(t.conversations.select("conv_id", "role", "turn", "text"), ["conv_id", "role"], ["turn"])


@query(
    "dup_flag",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 THEN 'Y' ELSE 'N' END AS dup_flag
    FROM lineitem
    """,
)
def dup_flag(t):
    return bg.dup_flag(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ["l_orderkey", "l_linenumber"])


@query(
    "group_size",
    """
    SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey) AS group_size,
      row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS row_index
    FROM orders
    """,
)
def group_size(t):
    out = bg.row_index(_orders(t).select("o_orderkey", "o_custkey", "o_date"), "o_custkey", ["o_date", "o_orderkey"])
    return bg.group_size(out, "o_custkey", profile=t.orders.select("o_custkey")).select(
        "o_orderkey", "o_custkey", "group_size", "row_index"
    )


@query(
    "running_sum",
    """
    SELECT o_custkey, o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER
      (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS ytd
    FROM orders
    """,
)
def running_sum(t):
    out = bg.retain_sum(_orders(t), "o_custkey", ["o_date", "o_orderkey"], {"ytd": money("o_totalprice")}, "o_custkey")
    return out.select("o_custkey", "o_orderkey", F.col("ytd").cast("double").alias("ytd"))


@query(
    "running_multi",
    """
    SELECT o_custkey, o_orderstatus, o_orderkey,
      CAST(sum(CASE WHEN o_totalprice > 100000 THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) OVER w AS DOUBLE) AS big_total,
      count(*) OVER w AS n_orders
    FROM orders
    WINDOW w AS (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)
    """,
)
def running_multi(t):
    big = F.when(F.col("o_totalprice") > 100000, money("o_totalprice"))
    out = bg.retain_sum(
        _orders(t), ["o_custkey", "o_orderstatus"], ["o_date", "o_orderkey"],
        {"big_total": big, "n_orders": F.lit(1).cast("long")}, "o_orderstatus",
    )
    return out.select("o_custkey", "o_orderstatus", "o_orderkey", F.col("big_total").cast("double").alias("big_total"), "n_orders")


@query(
    "running_table",
    """
    SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER
      (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS table_total FROM orders
    """,
)
def running_table(t):
    """No reset: one running total over the whole table, computed in ordered chunks."""
    rows = _orders(t).select("o_date", "o_orderkey", "o_totalprice")
    out = bg.retain_sum(rows, None, ["o_date", "o_orderkey"], {"table_total": money("o_totalprice")})
    return out.select("o_orderkey", F.col("table_total").cast("double").alias("table_total"))


@query(
    "running_limit",
    """
    WITH r AS (SELECT o.o_custkey, o.o_orderkey, CASE WHEN c.c_acctbal > 0 THEN c.c_acctbal * 300 END AS annual_limit,
      CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) OVER
        (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, o.o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total
      FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)
    SELECT o_custkey, o_orderkey, running_total,
      CASE WHEN annual_limit IS NULL OR running_total > annual_limit THEN 'Y' ELSE 'N' END AS limit_exceeded FROM r
    """,
)
def running_limit(t):
    limits = t.customer.select(
        F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") * 300).alias("annual_limit")
    )
    base = _orders(t).select("o_custkey", "o_date", "o_orderkey", "o_totalprice")
    rows = base.join(limits, "o_custkey", "left")
    out = bg.running_limit(
        rows, "o_custkey", ["o_date", "o_orderkey"], money("o_totalprice"), F.col("annual_limit"), profile=base
    )
    return out.select("o_custkey", "o_orderkey", F.col("running_total").cast("double").alias("running_total"), "limit_exceeded")


@query(
    "carry_forward",
    """
    SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
      OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_purchase
    FROM events
    """,
)
def carry_forward(t):
    rows = t.events.select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("purchase")
    )
    out = bg.retain_last(rows, "user_id", ["ts", "event_id"], {"last_purchase": "purchase"})
    return out.select("event_id", "user_id", "last_purchase")


@query(
    "lag_dif",
    """
    SELECT o_custkey, o_orderkey, lag(o_orderkey) OVER w AS prev_order, lag(o_orderkey, 2) OVER w AS prev_order2,
      lead(o_orderkey) OVER w AS next_order, date_diff('day', lag(CAST(o_orderdate AS DATE)) OVER w, CAST(o_orderdate AS DATE))::INTEGER AS gap_days
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
    """,
)
def lag_dif(t):
    out = bg.neighbours(
        _orders(t).select("o_custkey", "o_orderkey", "o_date"), "o_custkey", ["o_date", "o_orderkey"],
        {"prev_order": ("o_orderkey", 1), "prev_order2": ("o_orderkey", 2), "next_order": ("o_orderkey", -1), "prev_date": ("o_date", 1)},
    )
    return out.select(
        "o_custkey", "o_orderkey", "prev_order", "prev_order2", "next_order", F.datediff("o_date", "prev_date").alias("gap_days")
    )


@query(
    "dif_by",
    """
    SELECT conv_id, turn, length(text) - lag(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS growth
    FROM conversations
    """,
)
def dif_by(t):
    rows = t.conversations.select("conv_id", "turn", F.length("text").cast("long").alias("len"))
    return bg.dif_by(rows, "conv_id", ["turn"], {"growth": "len"}).select("conv_id", "turn", "growth")


@query(
    "obs_range",
    """
    SELECT o_orderkey AS order_id, o_totalprice FROM (
      SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders WHERE o_totalprice > 1000)
    WHERE rn >= 100
    """,
)
def obs_range(t):
    """FIRSTOBS without OBS: numbering in parallel, then a filter."""
    return with_options(
        t.orders, where="o_totalprice > 1000", firstobs=100, order=["o_orderdate", "o_orderkey"],
        keep=["o_orderkey", "o_totalprice"], rename={"o_orderkey": "order_id"},
    )


@query(
    "obs_top",
    """
    SELECT o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders WHERE o_orderstatus = 'F')
    WHERE rn BETWEEN 100 AND 200
    """,
)
def obs_top(t):
    return with_options(
        t.orders, where="o_orderstatus = 'F'", firstobs=100, obs=200, order=["o_totalprice desc", "o_orderkey"],
        keep=["o_orderkey", "o_totalprice"],
    )
