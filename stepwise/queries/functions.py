"""Scalar functions, value formats and text parsing on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepwise.functions import formats as fm
from stepwise.functions import scalars as sc
from stepwise.queries.base import query
from stepwise.sources import lines as ln
from stepwise.session import shared_dir
from stepwise.sources.readers import contents, read_files

PRIORITY = fm.ValueFormat("prio", {"1-URGENT": "Urgent", "2-HIGH": "High", "5-LOW": "Low"})
PRIORITY_OTHER = fm.ValueFormat("prioo", {"1-URGENT": "Urgent", "2-HIGH": "High"}, missing="None", other="OTHER")
PRICE = fm.ValueFormat(
    "price",
    ranges=(
        fm.Range(None, 30000, "Budget"), fm.Range(30001, 50000, "Mid-Range"), fm.Range(50001, 100000, "Premium", high_open=True),
        fm.Range(100001, None, "Luxury", low_open=True),
    ),
    missing="N/A",
)


@query(
    "format_exact",
    """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' WHEN '5-LOW' THEN 'Low' ELSE o_orderpriority END AS label,
      CASE WHEN p IS NULL THEN 'None' WHEN p = '1-URGENT' THEN 'Urgent' WHEN p = '2-HIGH' THEN 'High' ELSE 'OTHER' END AS label_other
    FROM (SELECT *, nullif(o_orderpriority, '3-MEDIUM') AS p FROM orders)
    """,
)
def format_exact(t):
    return t.orders.select(
        "o_orderkey", PRIORITY.label("o_orderpriority").alias("label"),
        PRIORITY_OTHER.label(F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM"))).alias("label_other"),
    )


@query(
    "format_range",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN x IS NULL THEN 'N/A' WHEN x <= 30000 THEN 'Budget' WHEN x >= 30001 AND x <= 50000 THEN 'Mid-Range'
      WHEN x >= 50001 AND x < 100000 THEN 'Premium' WHEN x > 100001 THEN 'Luxury' ELSE 'between' END AS label
    FROM (SELECT *, CASE WHEN l_tax < 0.07 THEN l_extendedprice END AS x FROM lineitem)
    """,
)
def format_range(t):
    """Values that fall between two ranges match none of them."""
    x = F.when(F.col("l_tax") < 0.07, F.col("l_extendedprice"))
    fmt = fm.ValueFormat("price", ranges=PRICE.ranges, missing="N/A", other="between")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", fmt.label(x).alias("label"))


@query(
    "format_lookup",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, coalesce(s_name, 'unknown') AS supplier FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 0
    """,
)
def format_lookup(t):
    """A catalogue kept in a table: a join instead of a CASE."""
    return fm.classify(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey"), "l_suppkey", t.supplier.filter("s_acctbal > 0"), "s_suppkey", "s_name",
        "supplier", "unknown",
    )


@query(
    "format_registry",
    """
    SELECT c_custkey, n_name AS nation, CASE WHEN c_acctbal < 0 THEN 'Owing' WHEN c_acctbal <= 5000 THEN 'Normal' ELSE 'Rich' END AS balance
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    """,
)
def format_registry(t):
    """Formats built from catalogue rows; the nation list is read from its table."""
    catalogue = t.nation.select(
        F.lit("nation").alias("fmtname"), F.col("n_nationkey").cast("string").alias("start"), F.lit("").alias("end"),
        F.col("n_name").alias("label"), F.lit("N").alias("type"),
    )
    names = fm.registry_from(catalogue)
    names.add(fm.ValueFormat("balance", ranges=(fm.Range(None, 0, "Owing", high_open=True), fm.Range(0, 5000, "Normal")), other="Rich"))
    return t.customer.select("c_custkey", names.put("c_nationkey", "nation").alias("nation"), names.put("c_acctbal", "balance").alias("balance"))


@query(
    "put_formats",
    """
    SELECT o_orderkey, lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS z2, '$' || format('{:,.2f}', o_totalprice) AS dollar,
      upper(strftime(o_orderdate, '%d%b%Y')) AS date9, strftime(o_orderdate, '%m/%d/%Y') AS mmddyy, strftime(o_orderdate, '%Y-%m-%d') AS yymmdd,
      year(o_orderdate) || '-' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS period FROM orders
    """,
)
def put_formats(t):
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", sc.put_as(F.month(d), "z2.").alias("z2"), sc.put_as("o_totalprice", "dollar12.2").alias("dollar"),
        sc.put_as(d, "date9.").alias("date9"), sc.put_as(d, "mmddyy10.").alias("mmddyy"), sc.put_as(d, "yymmdd10.").alias("yymmdd"),
        sc.period_key(d).alias("period"),
    )


@query(
    "input_formats",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS us_date, CAST(o_orderdate AS DATE) AS iso_date,
      CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS amount, CAST(o_orderdate AS DATE) AS d9 FROM orders
    """,
)
def input_formats(t):
    """Text made from the table is read back; text that does not fit becomes missing."""
    d = F.to_date("o_orderdate")
    text = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("13/45/"), F.year(d))).otherwise(F.date_format(d, "MM/dd/yyyy")).alias("us"),
        F.date_format(d, "yyyy-MM-dd").alias("iso"),
        F.when(F.col("o_orderpriority") == "5-LOW", ".").otherwise(F.concat(F.lit("$"), F.format_number("o_totalprice", 2))).alias("money"),
        F.upper(F.date_format(d, "ddMMMyyyy")).alias("nine"),
    )
    return text.select(
        "o_orderkey", sc.input_as("us", "mmddyy10.").alias("us_date"), sc.input_as("iso", "yymmdd10.").alias("iso_date"),
        sc.input_as("money", "dollar12.2").alias("amount"), sc.input_as("nine", "date9.").alias("d9"),
    )


@query(
    "intck",
    """
    WITH x AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(floor(o_totalprice / 700) AS INTEGER) - 300 AS b FROM orders)
    SELECT o_orderkey, CAST(b - a AS INTEGER) AS days, CAST((CAST(date_trunc('week', b + 1) AS DATE) - CAST(date_trunc('week', a + 1) AS DATE)) // 7 AS INTEGER) AS weeks, CAST(date_diff('month', a, b) AS INTEGER) AS months,
      CAST(date_diff('quarter', a, b) AS INTEGER) AS quarters, CAST(date_diff('year', a, b) AS INTEGER) AS years FROM x
    """,
)
def intck(t):
    a = F.to_date("o_orderdate")
    rows = t.orders.select("o_orderkey", a.alias("a"), F.date_sub(F.date_add(a, F.floor(F.col("o_totalprice") / 700).cast("int")), 300).alias("b"))
    names = {"days": "day", "weeks": "week", "months": "month", "quarters": "qtr", "years": "year"}
    return rows.select("o_orderkey", *[sc.intck(u, "a", "b").alias(n) for n, u in names.items()])


@query(
    "intnx",
    """
    WITH x AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
    SELECT o_orderkey, CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE) AS next_month, CAST(date_trunc('month', d) + INTERVAL 2 MONTH AS DATE) - 1 AS next_month_end,
      CAST(date_trunc('quarter', d) - INTERVAL 3 MONTH AS DATE) AS last_qtr, CAST(date_trunc('year', d) + INTERVAL 1 YEAR AS DATE) - 1 AS year_end,
      CAST(date_trunc('week', d + 1) AS DATE) - 1 AS week_begin, CAST(date_trunc('week', d + 1) AS DATE) - 1 + 6 + 14 AS week2_end,
      CAST(d - INTERVAL 13 MONTH AS DATE) AS same_day, d + 10 AS plus10,
      CAST(date_trunc('month', d) AS DATE) + CAST(floor((last_day(d) - CAST(date_trunc('month', d) AS DATE)) / 2) AS INTEGER) AS mid_month FROM x
    """,
)
def intnx(t):
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", sc.intnx("month", d, 1).alias("next_month"), sc.intnx("month", d, 1, "e").alias("next_month_end"),
        sc.intnx("qtr", d, -1).alias("last_qtr"), sc.intnx("year", d, 0, "e").alias("year_end"), sc.intnx("week", d, 0).alias("week_begin"),
        sc.intnx("week", d, 2, "e").alias("week2_end"), sc.intnx("month", d, -13, "s").alias("same_day"), sc.intnx("day", d, 10).alias("plus10"),
        sc.intnx("month", d, 0, "m").alias("mid_month"),
    )


@query(
    "string_fns",
    """
    SELECT doc_id, trim(source, ' ') AS stripped, substr(text, 3, 8) AS sub, upper(lang) AS up, length(rtrim(text, ' ')) AS len,
      concat_ws('-', nullif(trim(lang, ' '), ''), nullif(trim(source, ' '), '')) AS cx, trim(lang, ' ') || coalesce(trim(nullif(source, 'src1'), ' '), '') AS cs,
      list_filter(regexp_split_to_array(text, '[ .<(+&!$*);^/,%|-]'), lambda x: x <> '')[2] AS word2,
      list_filter(regexp_split_to_array(text, '[ .<(+&!$*);^/,%|-]'), lambda x: x <> '')[-1] AS last_word FROM documents
    """,
)
def string_fns(t):
    """Whole texts, split at the default word delimiters."""
    return t.documents.select(
        "doc_id", sc.strip("source").alias("stripped"), sc.substr("text", 3, 8).alias("sub"), F.upper("lang").alias("up"),
        sc.length("text").cast("long").alias("len"), sc.catx("-", "lang", "source").alias("cx"),
        sc.cats("lang", F.nullif(F.col("source"), F.lit("src1"))).alias("cs"), sc.scan("text", 2).alias("word2"),
        sc.scan("text", -1).alias("last_word"),
    )


@query(
    "date_fns",
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(quarter(o_orderdate) AS INTEGER) AS q,
      CAST(date_trunc('week', o_orderdate) AS DATE) AS monday, CAST(DATE '2001-12-31' - CAST(o_orderdate AS DATE) AS INTEGER) AS age,
      CAST(o_orderdate AS DATE) >= DATE '2000-01-01' AS recent FROM orders
    """,
)
def date_fns(t):
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.year(d).alias("y"), F.month(d).alias("m"), F.quarter(d).alias("q"), sc.week_start(d).alias("monday"),
        sc.days_between(d, sc.today("2001-12-31")).alias("age"), (sc.datepart("o_orderdate") >= sc.date_literal("01JAN2000")).alias("recent"),
    )


@query(
    "number_fns",
    """
    SELECT c_custkey, abs(c_acctbal) AS a, CAST(floor(c_acctbal) AS BIGINT) AS f, round(c_acctbal, 1) AS r, sqrt(abs(c_acctbal)) AS s,
      CASE ((c_nationkey % 3) + 3) % 3 WHEN 0 THEN 'red' WHEN 1 THEN 'green' ELSE 'blue' END AS colour,
      'CUS-' || upper(substr(sha256(c_custkey || '|' || c_mktsegment), 1, 6)) AS business_id, printf('POL-%06d', c_custkey) AS pol FROM customer
    """,
)
def number_fns(t):
    return t.customer.select(
        "c_custkey", F.abs("c_acctbal").alias("a"), F.floor("c_acctbal").alias("f"), F.round("c_acctbal", 1).alias("r"),
        F.sqrt(F.abs("c_acctbal")).alias("s"), sc.pick("c_nationkey", ["red", "green", "blue"]).alias("colour"),
        sc.business_id("CUS-", "c_custkey", "c_mktsegment").alias("business_id"), F.format_string("POL-%06d", "c_custkey").alias("pol"),
    )


SPEC = ln.LineSpec(
    [ln.Field("event_id", "number"), ln.Field("kind", "text", length=5), ln.Field("day", "mmddyy10"), ln.Field("value", "number"), ln.Field("props")],
    delimiter=",",
    quote="'",
)


def _event_lines(t):
    """Delimited text files made from the events."""
    path = shared_dir(t.spark, "lines")
    _as_text(t).write.text(path)
    return read_files(t.spark, path, "text")


def _as_text(t):
    day = F.date_format("ts", "MM/dd/yyyy")
    kind = F.when(F.col("event_type") == "error", ".").otherwise(F.concat(F.lit("'"), F.col("event_type"), F.lit(", x'")))
    value = F.when(F.col("value") > 300, "n/a").otherwise(F.format_string("%.2f", "value"))
    tail = F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.concat(F.lit(","), F.get_json_object("props", "$.k")))
    return t.events.select(F.concat_ws(",", F.col("event_id").cast("string"), kind, day, value).alias("a"), tail.alias("b")).select(
        F.concat("a", "b").alias("value")
    )


_PARSE = """
    WITH e AS (SELECT CAST(event_id AS DOUBLE) AS event_id, CASE WHEN event_type <> 'error' THEN substr(event_type || ', x', 1, 5) END AS kind,
      CAST(ts AS DATE) AS day, value, json_extract_string(props, '$.k') AS props, event_type FROM events)
"""


@query("parse_lines", _PARSE + "SELECT event_id, kind, day, value, props FROM e WHERE event_type <> 'view' AND value <= 300")
def parse_lines(t):
    """Delimited lines with quoted values, missing markers, dates; lines that do not fit are rejected."""
    return ln.parse_lines(_event_lines(t), SPEC)[0]


@query(
    "parse_rejects",
    _PARSE
    + "SELECT CASE WHEN event_type = 'view' THEN 'expected 5 values, found 4' ELSE 'value is not a valid number' END AS reason, count(*) AS n "
    "FROM e WHERE event_type = 'view' OR value > 300 GROUP BY 1",
)
def parse_rejects(t):
    return ln.parse_lines(_event_lines(t), SPEC)[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


WORDS = ln.LineSpec(
    [
        ln.Field("order_id", "number"), ln.Field("priority", words=True), ln.Field("day", "mmddyy10"), ln.Field("note", words=True),
        ln.Field("price", "number"),
    ]
)

_WORDS = """
    WITH o AS (SELECT CAST(o_orderkey AS DOUBLE) AS order_id, o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS day, o_custkey,
      CASE o_orderstatus WHEN 'P' THEN 'partly shipped order' WHEN 'O' THEN 'open' END AS note, o_totalprice AS price,
      CASE WHEN o_custkey % 7 = 0 THEN 'expected at least 5 values, found ' || (2 + len(string_split(o_orderpriority, ' ')))
        WHEN o_custkey % 50 = 1 THEN 'several places for day' WHEN o_custkey % 50 = 2 THEN 'no place for day'
        WHEN o_totalprice > 400000 THEN 'price is not a valid number' END AS reason FROM orders)
"""


def _word_lines(t):
    """Blank-separated order lines as files: values of several words, dates in notes, missing and broken values."""
    note = F.when(F.col("o_orderstatus") == "P", "partly  shipped order").when(F.col("o_orderstatus") == "O", "open").otherwise(".")
    note = F.when(F.col("o_custkey") % 50 == 1, F.concat(note, F.lit(" due 01/02/1999 noon"))).otherwise(note)
    day = F.when(F.col("o_custkey") % 50 == 2, "undated").otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    price = F.when(F.col("o_totalprice") > 400000, "n/a").otherwise(F.format_string("%.2f", "o_totalprice"))
    head = F.concat_ws(" ", F.col("o_orderkey").cast("string"), "o_orderpriority")
    short = F.concat_ws(" ", head, F.date_format("o_orderdate", "MM/dd/yyyy"))
    path = shared_dir(t.spark, "word-lines")
    t.orders.select(F.when(F.col("o_custkey") % 7 == 0, short).otherwise(F.concat_ws("   ", head, day, note, price)).alias("value")).write.text(path)
    return read_files(t.spark, path, "text")


@query("parse_words", _WORDS + "SELECT order_id, priority, day, note, price FROM o WHERE reason IS NULL")
def parse_words(t):
    """Two values of several words with a date between them, a number at either end."""
    return ln.parse_lines(_word_lines(t), WORDS)[0]


@query("parse_words_rejects", _WORDS + "SELECT reason, count(*) AS n FROM o WHERE reason IS NOT NULL GROUP BY 1")
def parse_words_rejects(t):
    return ln.parse_lines(_word_lines(t), WORDS)[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


FIXED = ln.LineSpec([ln.Field("p_partkey", "number", 1, 8), ln.Field("p_name", "text", 9, 20), ln.Field("p_retailprice", "number", 29, 10)])


@query("parse_fixed", "SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_retailprice FROM part")
def parse_fixed(t):
    """Fixed-width lines; whole-number columns are then narrowed."""
    lines = t.part.select(F.format_string("%-8d%-20s%10.2f", "p_partkey", "p_name", "p_retailprice").alias("value"))
    return ln.infer_numeric(ln.parse_lines(lines, FIXED)[0])


@query(
    "contents",
    """
    SELECT 'c_custkey' AS name, 'bigint' AS type, count(c_custkey) AS n, count(*) - count(c_custkey) AS nmiss, CAST(min(c_custkey) AS VARCHAR) AS min,
      CAST(max(c_custkey) AS VARCHAR) AS max, CAST(NULL AS INTEGER) AS max_length FROM customer
    UNION ALL SELECT 'c_name', 'string', count(c_name), count(*) - count(c_name), min(c_name), max(c_name), CAST(max(length(c_name)) AS INTEGER) FROM customer
    UNION ALL SELECT 'c_nationkey', 'int', count(c_nationkey), 0, CAST(min(c_nationkey) AS VARCHAR), CAST(max(c_nationkey) AS VARCHAR), NULL FROM customer
    UNION ALL SELECT 'c_acctbal', 'double', count(c_acctbal), 0, CAST(min(c_acctbal) AS VARCHAR), CAST(max(c_acctbal) AS VARCHAR), NULL FROM customer
    UNION ALL SELECT 'c_mktsegment', 'string', count(c_mktsegment), 0, min(c_mktsegment), max(c_mktsegment), CAST(max(length(c_mktsegment)) AS INTEGER) FROM customer
    """,
)
def contents_customer(t):
    return contents(t.customer, "customer").select("name", "type", "n", "nmiss", "min", "max", "max_length")


@query(
    "input_datetime",
    """
    SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS at, CAST(o_orderdate AS DATE) AS short_day,
      round(o_totalprice, 2) AS plain FROM orders
    """,
)
def input_datetime(t):
    """Text as a program would read it: day and time in one, two-digit years, plain numbers."""
    at = F.to_timestamp("o_orderdate") + F.make_dt_interval(secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)"))
    rows = t.orders.select(
        "o_orderkey", sc.put_as(at, "datetime20.").alias("a"), sc.put_as(F.to_date("o_orderdate"), "mmddyy8.").alias("b"),
        F.round("o_totalprice", 2).cast("decimal(18,2)").cast("string").alias("c"),
    )
    return rows.select(
        "o_orderkey", sc.input_as("a", "datetime20.").cast("timestamp_ntz").alias("at"),
        F.when(sc.input_as("b", "mmddyy8.") > "2050-01-01", F.add_months(sc.input_as("b", "mmddyy8."), -1200)).otherwise(sc.input_as("b", "mmddyy8.")).alias("short_day"),
        sc.input_as("c", "12.2").alias("plain"),
    )


@query(
    "format_big",
    """
    SELECT p_partkey, CASE WHEN p_size <= 60 THEN 'size ' || p_size ELSE 'other' END AS size_label,
      CASE WHEN p_partkey % 100 < 90 THEN 'code ' || (p_partkey % 100) ELSE 'other' END AS code_label FROM part
    """,
)
def format_big(t):
    """More codes than fit an inline CASE, numeric ones against an integer column."""
    sizes = fm.ValueFormat("size", {float(i): f"size {i}" for i in range(61)}, (), None, "other")
    codes = fm.ValueFormat("code", {i: f"code {i}" for i in range(90)}, (), None, "other")
    rows = t.part.select("p_partkey", "p_size", (F.col("p_partkey") % 100).alias("code"))
    return fm.put_format(fm.put_format(rows, "p_size", sizes, "size_label"), "code", codes, "code_label").select("p_partkey", "size_label", "code_label")


_BANDS_SQL = """
    SELECT l_orderkey, l_linenumber, CASE WHEN x IS NULL THEN 'N/A' WHEN x > 100000 THEN 'top'
      WHEN i % 2 = 0 AND x >= 10 * i AND x < 10 * i + 8 THEN 'band ' || i WHEN i % 2 = 1 AND x > 10 * i AND x <= 10 * i + 8 THEN 'band ' || i
      ELSE 'between' END AS label
    FROM (SELECT l_orderkey, l_linenumber, x, CAST(floor(x / 10) AS INTEGER) AS i
          FROM (SELECT *, CASE WHEN l_tax < 0.07 THEN l_extendedprice END AS x FROM lineitem))
"""


def _banded(t, how):
    """10,000 ranges with open and closed ends in turn, gaps between them, and all values above."""
    bands = [fm.Range(10.0 * i, 10.0 * i + 8, f"band {i}", low_open=i % 2 == 1, high_open=i % 2 == 0) for i in range(10_000)]
    fmt = fm.ValueFormat("bands", ranges=(*bands, fm.Range(100_000, None, "top", low_open=True)), missing="N/A", other="between")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_tax") < 0.07, F.col("l_extendedprice")).alias("x"))
    return fm.put_format(rows, "x", fmt, "label", how).select("l_orderkey", "l_linenumber", "label")


@query("format_ranges_big", _BANDS_SQL)
def format_ranges_big(t):
    return _banded(t, "search")


@query("format_ranges_merged", _BANDS_SQL)
def format_ranges_merged(t):
    """The same rows by the path of an index beyond the broadcast limit."""
    return _banded(t, "merge")


@query(
    "format_range_table",
    """
    SELECT l_orderkey, l_linenumber, coalesce(s_name, 'none') AS label
    FROM lineitem LEFT JOIN supplier ON l_partkey > s_suppkey * 3 AND l_partkey <= s_suppkey * 3 + 2
    """,
)
def format_range_table(t):
    """Ranges from a stored table, as many as it has rows."""
    low = F.col("s_suppkey") * 3
    ranges = t.supplier.select(low.alias("low"), (low + 2).alias("high"), F.lit(True).alias("low_open"), F.col("s_name").alias("label"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return fm.classify_ranges(rows, "l_partkey", ranges, "label", other="none").select("l_orderkey", "l_linenumber", "label")
