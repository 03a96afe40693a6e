"""What several operators of this subpackage need: text columns, sliced batches, files in the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python task holds at once; a longer text is a slice of its own.
SLICE_BYTES = 16 << 20
#: The same where every word takes several numbers.
WORD_SLICE_BYTES = 8 << 20


def text_rows(df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "doc_id") -> DataFrame:
    """The key as a long and the text, null read as empty; other columns are left out."""
    return df.select(F.col(key).cast("long").alias(out), F.coalesce(F.col(text), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one column has about ``limit`` bytes in each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column)
        width = np.asarray(pc.binary_length(values).fill_null(0)).astype(np.int64)
        total = np.cumsum(width)
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, column: str = "text") -> DataFrame:
    """``mapInArrow`` with a function of one slice, for work that takes several numbers per word."""

    def run(batches):
        for part in slices(batches, column, WORD_SLICE_BYTES):
            yield fn(part)

    return df.mapInArrow(run, schema)


def open_out(folder: str, name: str):
    """A new file below a folder of the shared storage. Returns (stream, path).

    The name gets a random part: a repeated task writes another file, and only the one
    whose path reaches the committed manifest is read.
    """
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    path = f"{name}-{uuid.uuid4().hex}"
    return store.open_output_stream(f"{root}/{path}"), path


def open_in(folder: str, path: str):
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    return store.open_input_stream(f"{root}/{path}")


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start+1, ... of every run, one after the other."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - (ends - lengths), lengths)


def partitions_for(df: DataFrame, amount: int, each: int) -> int:
    """Partitions of about ``each`` units, and no fewer than the session's cores."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-amount // each), 1)


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import this package when it is neither installed nor on ``PYTHONPATH``."""
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_stepwise_code", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="stepwise-code-")) / "stepwise_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.glob("stepwise/**/*.py")):
            out.write(file, str(file.relative_to(root)))
    context.addPyFile(str(archive))
    context._stepwise_code = True
