"""Interval, band, near-duplicate and lookup joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepwise.operators import joins as jn
from stepwise.operators import sortset as ss
from stepwise.queries.base import query

SPANS = """
    spans AS (SELECT c_custkey AS k, c_mktsegment AS plan, DATE '1996-01-01' + CAST(c_nationkey * 30 AS INTEGER) AS lo,
        CASE WHEN c_acctbal > 0 THEN DATE '1996-01-01' + CAST(c_nationkey * 30 + CAST(floor(c_acctbal / 5) AS INTEGER) AS INTEGER) END AS hi FROM customer
      UNION ALL
      SELECT c_custkey, 'LATE', DATE '2000-01-01', DATE '2000-12-31' FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
"""
STATUS = """CASE WHEN d BETWEEN lo AND coalesce(hi, DATE '9999-12-31') THEN 'ELIGIBLE' WHEN d < lo THEN 'NOT_YET_EFFECTIVE'
      WHEN d > hi THEN 'COVERAGE_TERMINATED' ELSE 'NOT_FOUND' END"""


def _spans(t):
    start = F.date_add(F.lit("1996-01-01").cast("date"), F.col("c_nationkey") * 30)
    first = t.customer.select(
        F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("plan"), start.alias("lo"),
        F.when(F.col("c_acctbal") > 0, F.date_add(start, F.floor(F.col("c_acctbal") / 5).cast("int"))).alias("hi"),
    )
    late = t.customer.filter("c_mktsegment IN ('BUILDING', 'MACHINERY')").select(
        F.col("c_custkey").alias("k"), F.lit("LATE").alias("plan"), F.lit("2000-01-01").cast("date").alias("lo"),
        F.lit("2000-12-31").cast("date").alias("hi"),
    )
    return first.unionByName(late)


def _dated(t):
    return t.orders.select("o_orderkey", F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("d"))


@query(
    "span_status",
    f"""
    WITH {SPANS}, o AS (SELECT o_orderkey, o_custkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders)
    SELECT o_orderkey, o.k, d, plan, lo, hi, {STATUS} AS span_status FROM o LEFT JOIN spans ON o.k = spans.k
    """,
)
def span_status(t):
    return jn.span_join(_dated(t), _spans(t), "k", "d", "lo", "hi")


@query(
    "span_best",
    f"""
    WITH {SPANS}, o AS (SELECT o_orderkey, o_custkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders),
      j AS (SELECT o_orderkey, o.k, d, plan, lo, hi, {STATUS} AS span_status FROM o LEFT JOIN spans ON o.k = spans.k)
    SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY CASE span_status WHEN 'ELIGIBLE' THEN 0
      WHEN 'COVERAGE_TERMINATED' THEN 1 WHEN 'NOT_YET_EFFECTIVE' THEN 2 ELSE 3 END, lo DESC NULLS LAST, hi DESC NULLS LAST, plan NULLS FIRST) = 1
    """,
)
def span_best(t):
    return jn.span_join(_dated(t), _spans(t), "k", "d", "lo", "hi", best_by=["o_orderkey"])


BANDS = [("low", 900.0, 925.5), ("mid", 925.5, 960.0), ("high", 970.0, 990.0), ("top", 990.0, 1000.0)]


@query(
    "band_assign",
    """
    SELECT p_partkey, p_retailprice, CASE WHEN p_retailprice >= 900 AND p_retailprice < 925.5 THEN 'low'
      WHEN p_retailprice >= 925.5 AND p_retailprice < 960 THEN 'mid' WHEN p_retailprice >= 970 AND p_retailprice < 990 THEN 'high'
      WHEN p_retailprice >= 990 AND p_retailprice < 1000 THEN 'top' END AS band FROM part
    """,
)
def band_assign(t):
    return jn.band_assign(t.part.select("p_partkey", "p_retailprice"), BANDS, "p_retailprice", "band")


@query(
    "band_join",
    """
    WITH w AS (SELECT s_nationkey AS nk, s_suppkey, abs(s_acctbal) + 1 AS weight FROM supplier),
      b AS (SELECT nk, s_suppkey, round(10000 * (sum(weight) OVER (PARTITION BY nk ORDER BY s_suppkey) - weight) / sum(weight) OVER (PARTITION BY nk)) AS lo,
              round(10000 * sum(weight) OVER (PARTITION BY nk ORDER BY s_suppkey) / sum(weight) OVER (PARTITION BY nk)) AS hi FROM w)
    SELECT c_custkey, c_nationkey, s_suppkey FROM customer LEFT JOIN b ON c_nationkey = nk AND c_acctbal >= lo AND c_acctbal < hi
    """,
)
def band_join(t):
    """Suppliers of a nation share out its customers by weight bands kept in a table."""
    weights = t.supplier.select(F.col("s_nationkey").alias("c_nationkey"), "s_suppkey", (F.abs("s_acctbal") + 1).alias("weight"))
    bands = jn.bands_from_table(weights, ["c_nationkey"], "s_suppkey", "weight").select(
        "c_nationkey", "s_suppkey", F.round(F.col("band_low") * 10000).alias("lo"), F.round(F.col("band_high") * 10000).alias("hi")
    )
    rows = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    return jn.band_join(rows, bands, "c_acctbal", "lo", "hi", within="c_nationkey").select("c_custkey", "c_nationkey", "s_suppkey")


@query(
    "near_dup",
    """
    WITH e AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS d FROM events)
    SELECT a.event_id, a.user_id, a.event_type, a.d, min_by(b.event_id, struct_pack(x := b.d, y := b.event_id)) AS prior_id,
      min(b.d) AS prior_day, CAST(count(b.event_id) > 0 AS INTEGER) AS duplicate_flag
    FROM e a LEFT JOIN e b ON a.user_id = b.user_id AND a.event_type = b.event_type AND a.event_id <> b.event_id
      AND a.d - b.d <= 7 AND b.d < a.d GROUP BY 1, 2, 3, 4
    """,
)
def near_dup(t):
    rows = t.events.select("event_id", "user_id", "event_type", F.to_date("ts").alias("d"))
    return jn.prior_within(rows, ["user_id", "event_type"], "d", "event_id", 7)


@query(
    "nearest_prior",
    """
    WITH e AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS d,
        lag(CAST(ts AS DATE)) OVER w AS pd, lag(event_id) OVER w AS pi FROM events
        WINDOW w AS (PARTITION BY user_id, event_type ORDER BY CAST(ts AS DATE), event_id))
    SELECT event_id, user_id, event_type, d, CASE WHEN d - pd <= 2 THEN pi END AS prior_id, CASE WHEN d - pd <= 2 THEN pd END AS prior_day,
      CAST(coalesce(d - pd <= 2, FALSE) AS INTEGER) AS duplicate_flag FROM e
    """,
)
def nearest_prior(t):
    rows = t.events.select("event_id", "user_id", "event_type", F.to_date("ts").alias("d"))
    return jn.nearest_prior(rows, ["user_id", "event_type"], "d", "event_id", 2)


@query(
    "prefix_join",
    """
    SELECT p_partkey, p_brand, n_nationkey, n_regionkey FROM part JOIN nation
      ON 'NATION_' || regexp_extract(p_brand, '([0-9]+)$', 1) = n_name
    """,
)
def prefix_join(t):
    """Join on a key derived from part of a code."""
    key = F.concat(F.lit("NATION_"), F.regexp_extract("p_brand", "([0-9]+)$", 1))
    return jn.on_expression(t.part.select("p_partkey", "p_brand"), t.nation, key, "n_name").drop("n_name")


@query("cross_small", "SELECT p_partkey, r_regionkey, r_name FROM part CROSS JOIN region")
def cross_small(t):
    return jn.cross_small(t.part.select("p_partkey"), t.region)


@query(
    "index_pick",
    """
    WITH pool AS (SELECT s_suppkey, s_name, row_number() OVER (ORDER BY s_suppkey) - 1 AS i, count(*) OVER () AS n FROM supplier)
    SELECT p_partkey, s_suppkey, s_name FROM part JOIN pool ON (p_partkey * 7 + p_size) % n = i
    """,
)
def index_pick(t):
    return jn.index_pick(
        t.part.select("p_partkey", "p_size"), t.supplier, F.col("p_partkey") * 7 + F.col("p_size"), ["s_suppkey"], ["s_suppkey", "s_name"]
    ).drop("p_size")


@query(
    "index_pick_within",
    """
    WITH pool AS (SELECT s_nationkey, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS i,
                    count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier)
    SELECT c_custkey, c_nationkey, s_suppkey FROM customer LEFT JOIN pool ON c_nationkey = s_nationkey AND c_custkey % n = i
    """,
)
def index_pick_within(t):
    pool = t.supplier.select(F.col("s_nationkey").alias("c_nationkey"), "s_suppkey")
    return jn.index_pick(
        t.customer.select("c_custkey", "c_nationkey"), pool, F.col("c_custkey"), ["s_suppkey"], ["s_suppkey"], within="c_nationkey"
    )


@query(
    "semi_orders",
    "SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 49)",
)
def semi_orders(t):
    return jn.covered(t.orders.select("o_orderkey", "o_custkey"), t.lineitem.filter("l_quantity >= 49"), {"o_orderkey": "l_orderkey"})


@query("anti_orders", "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def anti_orders(t):
    return jn.orphans(t.orders.select("o_orderkey", "o_custkey"), t.lineitem, {"o_orderkey": "l_orderkey"})


@query(
    "enrich_lines",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, p_brand, p_type, s_name, s_nationkey FROM lineitem
      LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
    """,
)
def enrich_lines(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    out = jn.enrich(lines, t.part.withColumnRenamed("p_partkey", "l_partkey"), "l_partkey", ["p_brand", "p_type"])
    out = jn.enrich(out, t.supplier.withColumnRenamed("s_suppkey", "l_suppkey"), "l_suppkey", ["s_name", "s_nationkey"])
    return out.drop("l_suppkey")


@query(
    "multi_key_join",
    """
    WITH best AS (SELECT o_custkey, o_orderpriority, max(o_totalprice) AS top FROM orders GROUP BY 1, 2)
    SELECT o.o_orderkey, top FROM orders o JOIN best b ON o.o_custkey = b.o_custkey AND o.o_orderpriority = b.o_orderpriority
      WHERE o_totalprice = top
    """,
)
def multi_key_join(t):
    best = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.max("o_totalprice").alias("top"))
    out = jn.enrich(t.orders, best, ["o_custkey", "o_orderpriority"], how="inner")
    return out.filter("o_totalprice = top").select("o_orderkey", "top")


@query(
    "union_counts",
    """
    SELECT 'orders' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'documents', count(*) FROM documents
    """,
)
def union_counts(t):
    return ss.count_report({n: getattr(t, n) for n in ("orders", "lineitem", "events", "documents")})


@query(
    "union_by_name",
    """
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, 'customer' AS kind FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier
    """,
)
def union_by_name(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.lit("customer").alias("kind"))
    b = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return ss.concat(a, b)


@query("sort_result", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_result(t):
    return ss.sort_by(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice desc", "o_orderkey"])


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_k(t):
    return ss.top_k(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice desc", "o_orderkey"], 25)


@query(
    "diff_keys",
    """
    WITH a AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice < 450000),
      b AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
              o_totalprice + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS o_totalprice FROM orders WHERE o_totalprice > 2000),
      j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.o_orderkey IS NULL AS no_a, b.o_orderkey IS NULL AS no_b,
        concat_ws(',', CASE WHEN a.o_orderstatus IS DISTINCT FROM b.o_orderstatus THEN 'o_orderstatus' END,
          CASE WHEN NOT (abs(a.o_totalprice - b.o_totalprice) <= 0.5) THEN 'o_totalprice' END) AS cols
        FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey)
    SELECT o_orderkey, CASE WHEN no_a THEN 'added' WHEN no_b THEN 'removed' ELSE 'changed' END AS change,
      CASE WHEN NOT no_a AND NOT no_b THEN cols END AS columns FROM j WHERE no_a OR no_b OR cols <> ''
    """,
)
def diff_keys(t):
    a = t.orders.filter("o_totalprice < 450000").select("o_orderkey", "o_orderstatus", "o_totalprice")
    b = t.orders.filter("o_totalprice > 2000").select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        (F.col("o_totalprice") + F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).alias("o_totalprice"),
    )
    return ss.diff(a, b, "o_orderkey", 0.5)


@query(
    "diff_rows",
    """
    WITH a AS (SELECT l_returnflag, l_linestatus, l_linenumber FROM lineitem WHERE l_quantity < 40),
      b AS (SELECT l_returnflag, l_linestatus, l_linenumber FROM lineitem WHERE l_quantity > 5),
      u AS (SELECT *, 1 AS s FROM a UNION ALL SELECT *, -1 FROM b),
      n AS (SELECT l_returnflag, l_linestatus, l_linenumber, sum(s) AS net FROM u GROUP BY 1, 2, 3)
    SELECT l_returnflag, l_linestatus, l_linenumber, CASE WHEN net > 0 THEN 'only_a' ELSE 'only_b' END AS side, CAST(abs(net) AS BIGINT) AS copies
    FROM n WHERE net <> 0
    """,
)
def diff_rows(t):
    cols = ["l_returnflag", "l_linestatus", "l_linenumber"]
    return ss.diff_rows(t.lineitem.filter("l_quantity < 40").select(cols), t.lineitem.filter("l_quantity > 5").select(cols))
