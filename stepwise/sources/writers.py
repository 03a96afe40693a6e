"""Writers: tables, appends, exports, partitioned and clustered layouts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stepwise.operators.ordering import as_list


def save_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> int:
    """Overwrite a table and return its row count, counted during the write."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return seen.get["rows"]


def save_files(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> int:
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt).save(path)
    return seen.get["rows"]


def append(base: DataFrame, new: DataFrame, force: bool = False) -> DataFrame:
    """Base rows plus new rows in the base's columns and types.

    Without ``force`` the columns must agree. With it, columns the base does not have
    are dropped, absent ones are missing, and values that do not fit become missing.
    """
    extra = [c for c in new.columns if c not in base.columns]
    absent = [c for c in base.columns if c not in new.columns]
    if (extra or absent) and not force:
        raise ValueError(f"columns differ (extra {extra}, absent {absent}); use force")
    cols = []
    for f in base.schema.fields:
        if f.name in absent:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif new.schema[f.name].dataType == f.dataType:
            cols.append(F.col(f.name))
        else:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return base.unionByName(new.select(*cols))


def evolve(existing: DataFrame, incoming: DataFrame) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """Union under schema change, and the report of what changed.

    Added columns are missing in old rows, dropped ones in new rows. A column of another type
    is reported, never silently cast: its values go to a column of their own, named after the
    column and the new type (``amount_string``), beside the old one.
    """
    report, old = [], {f.name: f.dataType for f in existing.schema.fields}
    new = {f.name: f.dataType for f in incoming.schema.fields}
    for name, kind in new.items():
        if name not in old:
            report.append((name, "added", kind.simpleString()))
        elif old[name] != kind:
            report.append((name, "type_changed", f"{old[name].simpleString()} -> {kind.simpleString()}"))
    report += [(n, "dropped", k.simpleString()) for n, k in old.items() if n not in new]
    clashing = {n: f"{n}_{re.sub('[^a-z0-9]+', '_', new[n].simpleString()).strip('_')}" for n, what, _ in report if what == "type_changed"}
    return existing.unionByName(incoming.withColumnsRenamed(clashing), allowMissingColumns=True), report


def export_csv(df: DataFrame, path: str, delimiter: str = ",") -> None:
    """Parallel CSV export with headers: one part file per task, nothing on the driver."""
    df.write.mode("overwrite").option("header", True).option("sep", delimiter).csv(path)


def write_bronze(df: DataFrame, path: str, date_col: str = "bronze_ingestion_date", mode: str = "append") -> None:
    """Partition folders by date, so reads for a date range skip the rest."""
    df.write.mode(mode).partitionBy(date_col).parquet(path)


def write_clustered(df: DataFrame, path: str, keys: Sequence[str] | str, partitions: int | None = None) -> None:
    """Range layout: files cover disjoint key ranges and row groups skip on min/max."""
    keys = as_list(keys)
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
