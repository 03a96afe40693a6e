"""Aggregation families on line items, orders and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepwise.operators import agg as ag
from stepwise.operators import quality as ql
from stepwise.queries.base import money, query
from stepwise.session import stored


def _lines(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", money("l_extendedprice").alias("price"))


@query(
    "means_nway",
    """
    SELECT l_returnflag, l_linestatus, count(l_quantity) AS l_quantity_n, count(*) - count(l_quantity) AS l_quantity_nmiss,
      CAST(sum(l_quantity) AS DOUBLE) AS l_quantity_sum, round(avg(l_quantity), 6) AS l_quantity_mean, round(stddev_samp(l_quantity), 6) AS l_quantity_std,
      min(l_quantity) AS l_quantity_min, max(l_quantity) AS l_quantity_max, quantile_cont(l_quantity, 0.5) AS l_quantity_median
    FROM (SELECT nullif(l_returnflag, 'A') AS l_returnflag, l_linestatus, CASE WHEN l_linenumber < 7 THEN l_quantity END AS l_quantity FROM lineitem)
    WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL GROUP BY 1, 2
    """,
)
def means_nway(t):
    """Rows with a missing class value are left out; missing analysis values are counted."""
    rows = t.lineitem.select(
        F.nullif(F.col("l_returnflag"), F.lit("A")).alias("l_returnflag"), "l_linestatus",
        F.when(F.col("l_linenumber") < 7, F.col("l_quantity")).alias("l_quantity"),
    )
    out = ag.means(
        rows, ["l_returnflag", "l_linestatus"], "l_quantity", ["n", "nmiss", "sum", "mean", "std", "min", "max", "median"]
    )
    return out.withColumn("l_quantity_mean", F.round("l_quantity_mean", 6)).withColumn("l_quantity_std", F.round("l_quantity_std", 6))


@query(
    "means_two_medians",
    """
    SELECT l_returnflag, count(l_quantity) AS l_quantity_n, CAST(sum(l_quantity) AS DOUBLE) AS l_quantity_sum, max(l_quantity) AS l_quantity_max,
      quantile_cont(l_quantity, 0.5) AS l_quantity_median, count(disc) AS disc_n, round(sum(disc), 6) AS disc_sum, max(disc) AS disc_max,
      quantile_cont(disc, 0.5) AS disc_median
    FROM (SELECT nullif(l_returnflag, 'A') AS l_returnflag, l_quantity, nullif(l_discount, 0) AS disc FROM lineitem) GROUP BY 1
    """,
)
def means_two_medians(t):
    """Two exact medians and their other statistics from one scan, with a missing class."""
    rows = t.lineitem.select(
        F.nullif(F.col("l_returnflag"), F.lit("A")).alias("l_returnflag"), "l_quantity", F.nullif(F.col("l_discount"), F.lit(0)).alias("disc")
    )
    out = ag.means(rows, "l_returnflag", ["l_quantity", "disc"], ["n", "sum", "max", "median"], missing=True)
    return out.withColumn("disc_sum", F.round("disc_sum", 6))


@query(
    "quantiles",
    """
    SELECT o_orderstatus, round(quantile_cont(o_totalprice, 0.05), 4) AS price_low, round(quantile_cont(o_totalprice, 0.95), 4) AS price_high,
      quantile_cont(o_custkey, 0.25) AS key_low
    FROM orders GROUP BY 1
    """,
)
def quantiles(t):
    """Three quantiles of two columns in one cumulative pass."""
    out = ag.exact_quantiles(
        t.orders, "o_orderstatus",
        {"price_low": ("o_totalprice", 0.05), "price_high": ("o_totalprice", 0.95), "key_low": ("o_custkey", 0.25)},
    )
    return out.withColumn("price_low", F.round("price_low", 4)).withColumn("price_high", F.round("price_high", 4))


@query(
    "exact_median",
    "SELECT o_orderpriority, median(o_totalprice) AS mid FROM orders GROUP BY 1",
)
def exact_median(t):
    return ag.exact_quantile(t.orders, ["o_orderpriority"], "o_totalprice", 0.5, "mid")


@query(
    "summary_types",
    """
    SELECT l_returnflag, l_linestatus, l_linenumber,
      CAST(7 - grouping_id(l_returnflag, l_linestatus, l_linenumber) AS INTEGER) AS _TYPE_, count(*) AS _FREQ_,
      count(price) AS price_n, CAST(sum(price) AS DOUBLE) AS price_sum, CAST(sum(price) AS DOUBLE) / count(*) AS price_mean,
      CAST(min(price) AS DOUBLE) AS price_min, CAST(max(price) AS DOUBLE) AS price_max, round(stddev_samp(price), 3) AS price_std
    FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem)
    GROUP BY CUBE (l_returnflag, l_linestatus, l_linenumber)
    """,
)
def summary_types(t):
    out = ag.summary(
        _lines(t), ["l_returnflag", "l_linestatus", "l_linenumber"], "price", ["n", "nmiss", "sum", "min", "max", "std"]
    )
    return out.select(
        "l_returnflag", "l_linestatus", "l_linenumber", "_TYPE_", "_FREQ_", "price_n",
        F.col("price_sum").cast("double").alias("price_sum"), (F.col("price_sum").cast("double") / F.col("price_n")).alias("price_mean"),
        F.col("price_min").cast("double").alias("price_min"), F.col("price_max").cast("double").alias("price_max"),
        F.round(F.col("price_std").cast("double"), 3).alias("price_std"),
    )


@query(
    "freq_one",
    """
    WITH f AS (SELECT l_linenumber, count(*) AS count FROM lineitem GROUP BY 1)
    SELECT l_linenumber, count, count * CAST(100 AS DOUBLE) / sum(count) OVER () AS percent,
      CAST(sum(count) OVER (ORDER BY l_linenumber) AS BIGINT) AS cum_count,
      CAST(sum(count) OVER (ORDER BY l_linenumber) AS BIGINT) * CAST(100 AS DOUBLE) / sum(count) OVER () AS cum_percent FROM f
    """,
)
def freq_one(t):
    return ag.freq(t.lineitem, "l_linenumber")


@query(
    "freq_two",
    """
    WITH f AS (SELECT o_orderstatus, o_orderpriority, count(*) AS count FROM orders GROUP BY 1, 2)
    SELECT o_orderstatus, o_orderpriority, count, count * CAST(100 AS DOUBLE) / sum(count) OVER () AS percent,
      count * CAST(100 AS DOUBLE) / sum(count) OVER (PARTITION BY o_orderstatus) AS row_pct,
      count * CAST(100 AS DOUBLE) / sum(count) OVER (PARTITION BY o_orderpriority) AS col_pct FROM f
    """,
)
def freq_two(t):
    return ag.crosstab_freq(t.orders, "o_orderstatus", "o_orderpriority")


@query(
    "freq_nocol_nopct",
    """
    WITH f AS (SELECT lang, source, count(*) AS count FROM documents GROUP BY 1, 2)
    SELECT lang, source, count, count * CAST(100 AS DOUBLE) / sum(count) OVER (PARTITION BY lang) AS row_pct FROM f
    """,
)
def freq_nocol_nopct(t):
    return ag.crosstab_freq(t.documents, "lang", "source", nocol=True, nopercent=True)


@query(
    "tabulate",
    """
    WITH x AS (SELECT l_linestatus AS st, l_returnflag, CAST(l_extendedprice AS DECIMAL(18,2)) AS p FROM lineitem)
    SELECT coalesce(st, 'ALL') AS l_linestatus, {cells} FROM x GROUP BY GROUPING SETS ((st), ())
    """.format(
        cells=", ".join(
            f"CAST(sum(p) FILTER (l_returnflag = '{v}') AS DOUBLE) AS \"{v}_sum\", CAST(sum(p) FILTER (l_returnflag = '{v}') AS DOUBLE) / "
            f"count(p) FILTER (l_returnflag = '{v}') AS \"{v}_mean\""
            for v in "ANR"
        )
    ),
)
def tabulate(t):
    flags = ["A", "N", "R"]
    out = ag.tabulate(_lines(t), "l_linestatus", "l_returnflag", "price", ["sum", "n"], flags, "ALL")
    cols = []
    for v in flags:
        total = F.col(f"{v}_sum").cast("double")
        cols += [total.alias(f"{v}_sum"), (total / F.col(f"{v}_n")).alias(f"{v}_mean")]
    return out.select("l_linestatus", *cols)


@query(
    "transpose_wide",
    """
    SELECT o_custkey, {cells} FROM orders GROUP BY 1
    """.format(cells=", ".join(f"count(*) FILTER (o_orderpriority LIKE '{i}-%') AS p_{i}" for i in range(1, 6))).replace(
        "count(*)", "nullif(count(*)"
    ).replace(") AS p_", "), 0) AS p_"),
)
def transpose_wide(t):
    """One row per customer, one column per priority; a duplicate cell would raise."""
    counts = t.orders.groupBy("o_custkey", F.substring("o_orderpriority", 1, 1).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return ag.transpose_wide(counts, "o_custkey", "id", "n", ["1", "2", "3", "4", "5"], prefix="p_")


@query(
    "transpose_long",
    """
    SELECT p_partkey, 'p_size' AS _NAME_, CAST(p_size AS DOUBLE) AS COL1 FROM part
    UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part
    """,
)
def transpose_long(t):
    return ag.transpose_long(t.part.withColumn("p_size", F.col("p_size").cast("double")), "p_partkey", ["p_size", "p_retailprice"])


@query(
    "with_total",
    """
    SELECT coalesce(o_orderstatus, 'TOTAL') AS o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS billed,
      CAST(sum(CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS paid,
      CAST(sum(CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE)
        / CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS rate
    FROM orders GROUP BY ROLLUP (o_orderstatus)
    """,
)
def with_total(t):
    paid = F.when(F.col("o_orderpriority") != "5-LOW", money("o_totalprice")).otherwise(0)
    out = ag.with_total(
        t.orders, "o_orderstatus", {"billed": money("o_totalprice"), "paid": paid}, "n",
        {"rate": lambda: F.col("paid").cast("double") / F.col("billed").cast("double")},
    )
    return out.withColumn("billed", F.col("billed").cast("double")).withColumn("paid", F.col("paid").cast("double"))


@query(
    "having_count",
    "SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderpriority) AS kinds FROM orders GROUP BY 1 HAVING count(*) > 12",
)
def having_count(t):
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderpriority").alias("kinds")).filter("n > 12")


@query(
    "cond_agg",
    """
    SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS closed, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN
      CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS open_total, min(o_totalprice) AS lo, max(o_totalprice) AS hi
    FROM orders GROUP BY 1
    """,
)
def cond_agg(t):
    return t.orders.groupBy("o_orderpriority").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("closed"),
        F.sum(F.when(F.col("o_orderstatus") == "O", money("o_totalprice")).otherwise(0)).cast("double").alias("open_total"),
        F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"),
    )


@query(
    "share_of_total",
    """
    SELECT r_name, n_name, n, CAST(100 AS DOUBLE) * n / sum(n) OVER () AS pct_of_total, CAST(100 AS DOUBLE) * n / sum(n) OVER (PARTITION BY r_name) AS pct_of_region
    FROM (SELECT r_name, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)
    """,
)
def share_of_total(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    n = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("n"))
    n = stored(n, "shares")
    return ag.share_of_total(ag.share_of_total(n, "n"), "n", "pct_of_region", ["r_name"])


@query(
    "top_n_other",
    """
    WITH top AS (SELECT p_brand FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5)
    SELECT coalesce(top.p_brand, 'Other') AS brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
      LEFT JOIN top ON part.p_brand = top.p_brand GROUP BY 1
    """,
)
def top_n_other(t):
    rows = t.lineitem.select("l_partkey").join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return ag.top_n_other(rows, "p_brand", 5, out="brand").groupBy("brand").agg(F.count(F.lit(1)).alias("n"))


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(t):
    return t.lineitem.select("l_suppkey", "l_returnflag").distinct()


@query(
    "raf_score",
    """
    WITH w AS (SELECT DISTINCT o_custkey AS member_id, l_suppkey AS claim, p_type AS category, CAST(p_size AS DECIMAL(9,3)) / 1000 AS d
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
      s AS (SELECT member_id, count(DISTINCT category) AS category_count, round(CAST(sum(CAST(d AS DECIMAL(12,3))) AS DOUBLE), 3) AS raw_score FROM w GROUP BY 1)
    SELECT *, raw_score * CAST(1.25 AS DOUBLE) AS adjusted_score FROM s
    """,
)
def raf_score(t):
    rows = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_custkey").alias("member_id"), F.col("l_suppkey").alias("claim"), F.col("p_type").alias("category"),
            (F.col("p_size") / 1000).cast("decimal(12,3)").alias("weight"),
        )
        .distinct()
    )
    out = ag.category_score(rows, "member_id", "category", "weight")
    raw = F.round(F.col("raw_score").cast("double"), 3)
    return out.select("member_id", "category_count", raw.alias("raw_score"), (raw * 1.25).alias("adjusted_score"))


@query(
    "accumulate",
    """
    SELECT o_custkey, o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1, 2
    """,
)
def accumulate(t):
    rows = t.orders.withColumn("amount", money("o_totalprice"))
    return ag.accumulate(rows, ["o_custkey", "o_orderstatus"], {"total": "amount"}).withColumn("total", F.col("total").cast("double"))


@query(
    "fail_rate",
    """
    SELECT count(*) AS total, count(*) FILTER (NOT bad) AS valid, count(*) FILTER (bad) AS failed, count(*) FILTER (bad) / count(*) AS fail_rate
    FROM (SELECT value < 5 OR event_type = 'error' AS bad FROM events)
    """,
)
def fail_rate(t):
    return ag.fail_rate(t.events.withColumn("edit_flag", ((F.col("value") < 5) | (F.col("event_type") == "error")).cast("int")), "edit_flag")


@query(
    "distribution",
    """
    SELECT event_type, count, share, CASE event_type WHEN 'click' THEN CAST(25 AS DOUBLE) WHEN 'view' THEN CAST(20 AS DOUBLE) END AS target_pct,
      abs(share - CASE event_type WHEN 'click' THEN CAST(25 AS DOUBLE) WHEN 'view' THEN CAST(20 AS DOUBLE) END) AS deviation
    FROM (SELECT event_type, count(*) AS count, count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER () AS share FROM events GROUP BY 1)
    """.replace("SELECT event_type, count, share,", "SELECT event_type, count, share AS share_pct,"),
)
def distribution(t):
    return ql.distribution(t.events, "event_type", {"click": 25, "view": 20})
