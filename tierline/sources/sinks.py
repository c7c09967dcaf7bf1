"""Writers and materialisation.

All writes default to ``overwrite`` so a rerun (or a retried job) replaces
its output instead of appending a second copy.  Spark's file commit protocol
makes each write all-or-nothing with respect to lost executors: tasks are
retried and only committed task output becomes visible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierline.operators.clean import Split, complete_condition
from tierline.session import stage_table as stage_table  # public here as well
from tierline.sources.files import CSV_TEXT


#: Rows per file of a partitioned write, at most.
ROWS_PER_FILE = 5_000_000


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    max_records_per_file: int | None = None,
) -> str:
    """Write Parquet; ``partition_by`` lays out one folder per value so later
    reads that filter on it prune whole folders.

    A partitioned write first brings the rows of a value together with the
    ``rebalance`` hint: without it every task would write a file to every
    folder.  Adaptive execution splits a value with many rows over several
    tasks, so the number of files follows the size of the data.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        max_records_per_file = max_records_per_file or ROWS_PER_FILE
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)
    return path


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    header: bool = True,
    null_value: str = "",
    partition_by: Sequence[str] | None = None,
) -> str:
    """Write CSV with a header row (one file per task).

    Text is kept as it is: spaces at either end stay, quotes are doubled, and
    cells with separators, quotes or line breaks are quoted.  By default NULL
    is an empty cell, as feeds have it, and so reads like the empty string;
    give a ``null_value`` (e.g. a backslash and N) here and to
    :func:`tierline.sources.files.read_csv` to tell them apart.
    """
    writer = df.write.mode(mode).option("header", header)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    for name, value in CSV_TEXT.items():
        writer = writer.option(name, value)
    writer.option("nullValue", null_value).csv(path)
    return path


def write_split(
    df: DataFrame,
    columns: Sequence[str],
    path: str,
    flag: str = "is_complete",
    mode: str = "overwrite",
) -> Split:
    """Write the complete rows and the quarantine (rows with a NULL in any of
    ``columns``) from ONE scan of the input, as ``path/flag=true`` and
    ``path/flag=false``.  Returns both sides, read back."""
    flagged = df.withColumn(flag, complete_condition(columns))
    (
        flagged.write.mode(mode)
        # An earlier run's side that is empty now must not stay.
        .option("partitionOverwriteMode", "static")
        .partitionBy(flag)
        .parquet(path)
    )
    return read_split(df.sparkSession, path, flagged.schema, flag)


def read_split(spark: SparkSession, path: str, schema: StructType, flag: str = "is_complete") -> Split:
    """Both sides of a folder that :func:`write_split` wrote.  Reads the
    folder with a filter on the flag, which prunes to one side's files and
    gives an empty table for a side without any."""
    both = spark.read.schema(schema).parquet(path)
    return Split(both.filter(F.col(flag)).drop(flag), both.filter(~F.col(flag)).drop(flag))


def materialize(
    df: DataFrame,
    name: str,
    kind: str = "view",
    path: str | None = None,
) -> DataFrame:
    """Give ``df`` a name in the catalog and return it re-read by that name.

    * ``view``: a temp view (lazy, recomputed by each reader).
    * ``table``: a replace in one step.  The rows go to a fresh version below
      ``path`` (else a folder of that name in the warehouse folder), and the
      name is then pointed at it: until then, and if the write fails, readers
      get the old rows.  ``df`` may read the table that it replaces.  Cuts
      lineage: readers start from the files.
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        _point_table(df, name, path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}.versions")
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return spark.table(name)


def _point_table(df: DataFrame, name: str, root: str) -> None:
    from tierline.sources.versions import current_path, expire, replace_parquet  # which writes with this module

    spark = df.sparkSession
    replace_parquet(df, root, keep=1_000_000)
    here = current_path(spark, root)
    written = spark.read.parquet(here)
    old = spark.table(name).schema if spark.catalog.tableExists(name) else None
    if old is not None and old.simpleString() == written.schema.simpleString() and _is_external(spark, name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{here}'")  # one step in the catalog
    else:
        # Other columns: the name is gone for a moment, the rows of external
        # tables are not.
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=here, source="parquet")
    spark.catalog.refreshTable(name)
    expire(spark, root)


def _is_external(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "EXTERNAL"
