"""Keyed merges. Documents and their labels, and users' events and orders, leave rows on both sides."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepwise.operators.merge import merge_by, merge_many
from stepwise.queries.base import query


def _docs(t):
    return t.documents.select("doc_id", "source", "n_chars")


def _labels(t):
    """All labels under twice their id, so that some have no document."""
    return t.labels.select((F.col("doc_id") * 2).alias("doc_id"), "quality", "toxic")


_FULL = """
    SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, d.source, d.n_chars, l.quality, l.toxic{flags}
    FROM documents d {join} JOIN (SELECT doc_id * 2 AS doc_id, quality, toxic FROM labels) l ON d.doc_id = l.doc_id {where}
"""


def _sql(join, where="", flags=""):
    return _FULL.format(join=join, where=where, flags=flags)


@query("merge_left", _sql("LEFT"))
def merge_left(t):
    return merge_by(_docs(t), _labels(t), "doc_id", "a")


@query("merge_right", _sql("RIGHT"))
def merge_right(t):
    return merge_by(_docs(t), _labels(t), "doc_id", "b")


@query("merge_inner", _sql("INNER"))
def merge_inner(t):
    return merge_by(_docs(t), _labels(t), "doc_id", "a and b")


@query("merge_full", _sql("FULL"))
def merge_full(t):
    return merge_by(_docs(t), _labels(t), "doc_id", "a or b")


@query("merge_anti", _sql("LEFT", "WHERE l.doc_id IS NULL"))
def merge_anti(t):
    return merge_by(_docs(t), _labels(t), "doc_id", "a and not b")


@query("merge_right_anti", _sql("RIGHT", "WHERE d.doc_id IS NULL"))
def merge_right_anti(t):
    return merge_by(_docs(t), _labels(t), "doc_id", "not a and b")


@query(
    "merge_flags",
    _sql(
        "FULL",
        flags=", CASE WHEN d.doc_id IS NULL THEN 0 ELSE 1 END AS in_docs, CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 END AS in_labels",
    ),
)
def merge_flags(t):
    return merge_by(_docs(t), _labels(t), "doc_id", None, ("in_docs", "in_labels"))


def _suppliers(t):
    return t.supplier.filter("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("nation")).agg(
        F.count(F.lit(1)).alias("parties"), F.max("s_acctbal").alias("best"), F.min("s_suppkey").alias("first_supplier")
    )


@query(
    "merge_overlay",
    """
    WITH a AS (SELECT c_nationkey AS nation, count(*) AS parties, max(c_acctbal) AS best, min(c_custkey) AS first_customer
                 FROM customer GROUP BY 1),
         b AS (SELECT (s_nationkey * 7) % 30 AS nation, count(*) AS parties, CASE WHEN max(s_acctbal) > 9000 THEN max(s_acctbal) END AS best,
                 min(s_suppkey) AS first_supplier FROM supplier GROUP BY 1)
    SELECT coalesce(a.nation, b.nation) AS nation, CASE WHEN b.nation IS NOT NULL THEN b.parties ELSE a.parties END AS parties,
      CASE WHEN b.nation IS NOT NULL THEN b.best ELSE a.best END AS best, first_customer, first_supplier
    FROM a FULL JOIN b ON a.nation = b.nation
    """,
)
def merge_overlay(t):
    """A matched NULL on the right overwrites the left value."""
    left = t.customer.groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.count(F.lit(1)).alias("parties"), F.max("c_acctbal").alias("best"), F.min("c_custkey").alias("first_customer")
    )
    top = F.max("s_acctbal")
    right = t.supplier.groupBy((F.col("s_nationkey") * 7 % 30).alias("nation")).agg(
        F.count(F.lit(1)).alias("parties"), F.when(top > 9000, top).alias("best"), F.min("s_suppkey").alias("first_supplier")
    )
    return merge_by(left, right, "nation")


@query(
    "merge_missing_keys",
    """
    WITH a AS (SELECT nullif(event_type, 'error') AS kind, count(*) AS n_events FROM events GROUP BY 1),
         b AS (SELECT CASE WHEN value > 100 THEN NULL ELSE event_type END AS kind, max(value) AS top FROM events GROUP BY 1)
    SELECT coalesce(a.kind, b.kind) AS kind, n_events, top FROM a FULL JOIN b ON a.kind IS NOT DISTINCT FROM b.kind
    """,
)
def merge_missing_keys(t):
    """A missing key on one side meets the missing key on the other."""
    a = t.events.groupBy(F.nullif(F.col("event_type"), F.lit("error")).alias("kind")).agg(F.count(F.lit(1)).alias("n_events"))
    b = t.events.groupBy(F.when(F.col("value") <= 100, F.col("event_type")).alias("kind")).agg(F.max("value").alias("top"))
    return merge_by(a, b, "kind")


@query(
    "merge_three",
    """
    WITH a AS (SELECT o_custkey AS k, count(*) AS n_orders FROM orders GROUP BY 1),
         b AS (SELECT user_id AS k, count(*) AS n_events FROM events GROUP BY 1),
         c AS (SELECT c_custkey + 40 AS k, c_acctbal FROM customer)
    SELECT coalesce(a.k, b.k, c.k) AS k, n_orders, n_events, c_acctbal,
      CASE WHEN a.k IS NULL THEN 0 ELSE 1 END AS in_a, CASE WHEN b.k IS NULL THEN 0 ELSE 1 END AS in_b,
      CASE WHEN c.k IS NULL THEN 0 ELSE 1 END AS in_c
    FROM a FULL JOIN b ON a.k = b.k FULL JOIN c ON c.k = coalesce(a.k, b.k)
    WHERE (a.k IS NOT NULL AND b.k IS NULL) OR c.k IS NOT NULL
    """,
)
def merge_three(t):
    a = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n_orders"))
    b = t.events.groupBy(F.col("user_id").alias("k")).agg(F.count(F.lit(1)).alias("n_events"))
    c = t.customer.select((F.col("c_custkey") + 40).cast("long").alias("k"), "c_acctbal")
    return merge_many([a, b, c], "k", lambda x, y, z: (x & ~y) | z, ["in_a", "in_b", "in_c"], unique=True)


@query(
    "merge_five",
    """
    WITH a AS (SELECT o_custkey AS k, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1),
         b AS (SELECT user_id AS k, count(*) AS n FROM events GROUP BY 1),
         c AS (SELECT c_custkey + 40 AS k, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS top FROM customer),
         d AS (SELECT s_suppkey AS k, s_name AS name FROM supplier),
         e AS (SELECT l_suppkey AS k, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT k, CASE WHEN e.k IS NOT NULL THEN e.n WHEN b.k IS NOT NULL THEN b.n ELSE a.n END AS n,
      CASE WHEN c.k IS NOT NULL THEN c.top ELSE a.top END AS top, name
    FROM a FULL JOIN b USING (k) FULL JOIN c USING (k) FULL JOIN d USING (k) FULL JOIN e USING (k)
    WHERE a.k IS NOT NULL OR e.k IS NULL
    """,
)
def merge_five(t):
    """Five tables in one stacked shuffle; later ones overlay, also with missing values."""
    a = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))
    b = t.events.groupBy(F.col("user_id").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    c = t.customer.select((F.col("c_custkey") + 40).cast("long").alias("k"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("top"))
    d = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    e = t.lineitem.groupBy(F.col("l_suppkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return merge_many([a, b, c, d, e], "k", lambda a, b, c, d, e: a | ~e, unique=True)


@query(
    "merge_sequential",
    """
    WITH o AS (SELECT o_custkey AS k, o_orderkey, o_totalprice AS amount,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn,
                 count(*) OVER (PARTITION BY o_custkey) AS n FROM orders),
         e AS (SELECT user_id AS k, event_id, value AS amount,
                 row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
                 count(*) OVER (PARTITION BY user_id) AS n FROM events),
         p AS (SELECT o.k, o_orderkey, event_id, CASE WHEN e.k IS NULL OR o.rn > e.n THEN o.amount ELSE e.amount END AS amount
                 FROM o LEFT JOIN (SELECT k, max(rn) AS m FROM e GROUP BY k) s ON o.k = s.k
                 LEFT JOIN e ON o.k = e.k AND e.rn = least(o.rn, s.m)
               UNION ALL
               SELECT e.k, o_orderkey, event_id, e.amount
                 FROM e LEFT JOIN (SELECT k, max(rn) AS m FROM o GROUP BY k) s ON e.k = s.k
                 LEFT JOIN o ON o.k = e.k AND o.rn = s.m WHERE e.rn > coalesce(s.m, 0))
    SELECT k, amount, o_orderkey, event_id FROM p
    """,
)
def merge_sequential(t):
    """Many-to-many keys pair row by row; the shorter side repeats its last row."""
    o = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("amount"), "o_orderkey", "o_orderdate")
    e = t.events.select(F.col("user_id").alias("k"), F.col("value").alias("amount"), "event_id", "ts")
    out = merge_by(
        o, e, "k", None, pairing="sequential", order_left=["o_orderdate", "o_orderkey"], order_right=["ts", "event_id"]
    )
    return out.select("k", "amount", "o_orderkey", "event_id")
