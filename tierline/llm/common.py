"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of text handed to Python at once; texts may be long, so few of them.
ARROW_ROWS = 500

# Bytes of text an operator works on at once inside a task.
SLICE_BYTES = 4 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows per Arrow batch, so that a batch of very long texts
    still fits a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each slice holds about ``limit`` bytes of
    ``column`` at most (one row at least)."""
    start = size = 0
    for i, n in enumerate(lengths(batch.column(column))):
        if size and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def lengths(array: pa.Array) -> list[int]:
    """Bytes of each string; 0 for null."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(array), 0).to_pylist()


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def free_name(name: str, taken: list[str]) -> str:
    """``name``, or with underscores until no column clashes (in any case)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
