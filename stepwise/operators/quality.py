"""Expectations, quarantine, table checks, parity and key checks.

A check whose condition is NULL counts as violated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stepwise.operators.ordering import as_list
from stepwise.operators.sortset import diff

Rules = Mapping[str, str | Column]


def _ok(rule: str | Column) -> Column:
    return F.coalesce(F.expr(rule) if isinstance(rule, str) else rule, F.lit(False))


def violations(df: DataFrame, rules: Rules, name: str | None = None) -> tuple[DataFrame, Observation]:
    """Attach violation counters that fill while the frame is written; no extra job."""
    seen = Observation(name) if name else Observation()
    counters = [F.count(F.lit(1)).alias("rows")]
    counters += [F.count_if(~_ok(rule)).alias(rule_name) for rule_name, rule in rules.items()]
    return df.observe(seen, *counters), seen


def write_checked(
    df: DataFrame, rules: Rules, path: str, log: str, run: str, batch: int = 0, drop: bool = False
) -> None:
    """Write a frame and log how its rules came out, counted by the write itself.

    The log is a table of (check, violations, rows, passed) with a folder per run and batch. A run
    or batch that is repeated replaces its own folders, so nothing counts twice. With ``drop``
    violating rows are counted and left out. Counters stand beside the write: a frame that
    is shuffled before it is observed may be counted again if executors are lost in that stage's rerun.
    """
    observed, seen = violations(df, rules)
    kept = keep_ok(observed, rules) if drop else observed
    kept.write.mode("overwrite").parquet(path)
    found = seen.get
    rows = [(name, found[name], found["rows"], found[name] == 0) for name in rules]
    outcome = df.sparkSession.createDataFrame(rows, "check string, violations bigint, rows bigint, passed boolean")
    outcome.coalesce(1).write.mode("overwrite").parquet(f"{log}/run={run}/batch={batch}")


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """All logged outcomes with their run and batch."""
    schema = "check string, violations bigint, rows bigint, passed boolean, run string, batch bigint"
    return spark.read.schema(schema).parquet(log)


def expect(df: DataFrame, rules: Rules) -> tuple[DataFrame, Observation]:
    """Warn: all rows stay, violations are counted."""
    return violations(df, rules)


def expect_or_drop(df: DataFrame, rules: Rules) -> tuple[DataFrame, Observation]:
    """Drop: violating rows go, counted before they do."""
    observed, seen = violations(df, rules)
    return keep_ok(observed, rules), seen


def expect_or_fail(df: DataFrame, rules: Rules) -> DataFrame:
    """Fail: the query raises on the first violating row."""
    guard = None
    for name, rule in rules.items():
        bad = F.raise_error(F.lit(f"expectation {name} violated"))
        guard = F.when(~_ok(rule), bad) if guard is None else guard.when(~_ok(rule), bad)
    # The guard is always NULL on good rows; filtering on it keeps it from being pruned.
    return df.filter(guard.isNull()) if guard is not None else df


def keep_ok(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that meet every rule. A filter drops unknown conditions by itself, so the
    rules stay bare and reach the scan."""
    for rule in rules.values():
        df = df.filter(rule)
    return df


def tag(df: DataFrame, rules: Rules, reason: str = "edit_reason", flag: str = "edit_flag") -> DataFrame:
    """Names of the violated rules on every row, joined with ``'; '``."""
    out = df.withColumn(reason, F.concat_ws("; ", *[F.when(~_ok(r), F.lit(n)) for n, r in rules.items()]))
    return out.withColumn(flag, (F.col(reason) != "").cast("int"))


def quarantine(df: DataFrame, rules: Rules, reason: str = "edit_reason") -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with their reasons."""
    tagged = tag(df, rules, reason, "__flag")
    good = tagged.filter(F.col("__flag") == 0).drop("__flag", reason)
    return good, tagged.filter(F.col("__flag") == 1).drop("__flag")


def validate(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule with violations and rows, from a single aggregate over the table."""
    one = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(~_ok(r)).alias(f"__v{i}") for i, r in enumerate(rules.values())])
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("check"), F.col(f"__v{i}").alias("violations"), F.col("__rows").alias("rows"))
            for i, n in enumerate(rules)
        ]
    )
    return one.select(F.inline(pairs)).withColumn("passed", F.col("violations") == 0)


def table_checks(df: DataFrame, checks: Mapping[str, tuple[Column, str]]) -> DataFrame:
    """Table-level expectations: ``{name: (aggregate, condition on "observed")}``."""
    one = df.agg(*[agg.cast("double").alias(f"__o{i}") for i, (agg, _) in enumerate(checks.values())])
    rows = F.array(
        *[F.struct(F.lit(n).alias("check"), F.lit(cond).alias("condition"), F.col(f"__o{i}").alias("observed"))
          for i, (n, (_, cond)) in enumerate(checks.items())]
    )
    out = one.select(F.inline(rows))
    passed = F.lit(False)
    for name, (_, cond) in checks.items():
        passed = F.when(F.col("check") == name, F.coalesce(F.expr(cond), F.lit(False))).otherwise(passed)
    return out.withColumn("passed", passed)


def duplicate_keys(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Key values that occur more than once, with their count."""
    keys = as_list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def unresolved(df: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Foreign key values without a parent row and how many rows carry them.

    Keys are counted first, so a heavy key reaches the join as one row.
    """
    used = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("child_rows"))
    return used.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def checksum(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """Order-insensitive aggregate over row hashes."""
    return F.sum(F.xxhash64(*(cols or df.columns)).cast("decimal(38,0)"))


def schema_diff(a: DataFrame, b: DataFrame) -> list[tuple[str, str | None, str | None]]:
    left = {f.name: f.dataType.simpleString() for f in a.schema.fields}
    right = {f.name: f.dataType.simpleString() for f in b.schema.fields}
    return [(n, left.get(n), right.get(n)) for n in dict.fromkeys([*left, *right]) if left.get(n) != right.get(n)]


def parity(
    a: DataFrame, b: DataFrame, sums: Sequence[str] = (), tolerance: float = 0.01, hashed: Sequence[str] | None = None
) -> DataFrame:
    """Comparison report of two tables: row count, schema, checksum, column sums.

    ``tolerance`` is the accepted relative difference of a sum. Each table is read once.
    """
    common = hashed or [c for c in a.columns if c in b.columns]

    def profile(df, side):
        return df.agg(
            F.lit(side).alias("side"),
            F.count(F.lit(1)).alias("n"),
            checksum(df, common).alias("h"),
            *[F.sum(F.col(c).cast("decimal(28,4)")).cast("double").alias(f"s{i}") for i, c in enumerate(sums)],
        )

    # Two one-row profiles, laid side by side.
    stacked = profile(a, "a").unionByName(profile(b, "b"))
    figures = ["n", "h", *[f"s{i}" for i in range(len(sums))]]
    both = stacked.agg(
        *[F.max(F.when(F.col("side") == p, F.col(c))).alias(f"{p}_{c}") for p in ("a", "b") for c in figures]
    )
    n_schema = len(schema_diff(a, b))

    def line(check, x, y, ok):
        return F.struct(
            F.lit(check).alias("check"), x.cast("double").alias("value_a"), y.cast("double").alias("value_b"),
            F.coalesce(ok, F.lit(False)).alias("passed"),
        )

    zero = F.lit(0.0)
    lines = [
        line("row_count", F.col("a_n"), F.col("b_n"), F.col("a_n") == F.col("b_n")),
        line("schema_differences", F.lit(n_schema), zero, F.lit(n_schema == 0)),
        line(
            "checksum_match", F.lit(1.0), F.col("a_h").eqNullSafe(F.col("b_h")).cast("int"), F.col("a_h").eqNullSafe(F.col("b_h"))
        ),
    ]
    for i, c in enumerate(sums):
        x, y = F.col(f"a_s{i}"), F.col(f"b_s{i}")
        lines.append(line(f"sum_{c}", x, y, F.abs(x - y) <= F.lit(tolerance) * F.abs(x)))
    return both.select(F.inline(F.array(*lines)))


def row_parity(a: DataFrame, b: DataFrame, keys: Sequence[str] | str, tolerance: float | None = None) -> DataFrame:
    """The rows behind a failed parity check."""
    return diff(a, b, keys, tolerance)


def distribution(df: DataFrame, col: str, targets: Mapping | None = None) -> DataFrame:
    """Share per category and, given target shares (percent), the deviation from them."""
    # The total is a scalar subquery over the same aggregate, whose shuffle Spark uses again.
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    out = counts.withColumn("share_pct", F.col("count") * 100.0 / counts.select(F.sum("count")).scalar())
    if targets:
        want = None
        for value, pct in targets.items():
            want = F.when(F.col(col) == value, float(pct)) if want is None else want.when(F.col(col) == value, float(pct))
        out = out.withColumn("target_pct", want).withColumn("deviation", F.abs(F.col("share_pct") - F.col("target_pct")))
    return out


def reconciles(parts: Sequence[str], total: str, tolerance: float = 0.01) -> Column:
    """Parts add up to the total."""
    added = F.lit(0)
    for p in parts:
        added = added + F.col(p)
    return F.abs(added - F.col(total)) < tolerance
