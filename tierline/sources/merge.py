"""Keyed upsert into a partitioned table.

A batch is merged with the rows of the partitions that it touches, by a key
that determines the partition (e.g. place and hour in a table by date), and
only these partitions are written again.  The table's manifest names, for each
partition folder, the load that holds it; it is replaced together with the
rows by publishing one version (:mod:`tierline.sources.versions`), so readers
see a batch whole or not at all and a failed merge changes nothing.

The manifest has one row per partition value, and is all that the driver
handles.  Rows of a partition are read with partition pruning, de-duplicated by
:func:`tierline.operators.clean.dedupe` (at most one row per key and map task
is shuffled), and written with the ``rebalance`` hint.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierline.operators.clean import dedupe
from tierline.session import stage_table
from tierline.sources.sinks import write_parquet
from tierline.sources.versions import _names, discard, last_number, load_path, new_load, notes_path, publish, versions


class Upserted(NamedTuple):
    version: int
    partitions: list[str]
    untouched: int


def manifest(spark: SparkSession, root: str, number: int | None = None) -> dict[str, str]:
    """Partition folder (``name=value``) -> the load that holds it."""
    found = dict(versions(spark, root))
    if not found:
        return {}
    number = max(found) if number is None else number
    rows = spark.read.json(notes_path(root, found[number]), schema="folder string, load string").collect()
    return {r["folder"]: r["load"] for r in rows}


def read_merged(spark: SparkSession, root: str, schema: StructType, number: int | None = None) -> DataFrame:
    """The table's rows, as of the newest version or one by its number."""
    folders = [f"{load_path(root, load)}/{folder}" for folder, load in manifest(spark, root, number).items()]
    if not folders:
        return spark.createDataFrame([], schema)
    names = schema.fieldNames()
    schema = StructType([*schema.fields, StructField("load", StringType())])
    reader = spark.read.schema(schema).option("basePath", f"{root.rstrip('/')}/data")
    return reader.parquet(*folders).select(*names)


def upsert(
    batch: DataFrame,
    root: str,
    keys: Sequence[str],
    partition_by: str,
    order_by: Sequence[Column | str],
) -> Upserted:
    """Merge ``batch`` into the table at ``root``.

    Of the rows of one key, old and new together, the first by ``order_by``
    stays, so a table built by upserts holds what a rebuild from all batches
    would, in whatever order they come.  ``keys`` must determine
    ``partition_by``: rows of one key in two partitions would both stay.
    Columns are those of the first batch.  An empty batch publishes nothing.
    Raises :class:`tierline.sources.versions.ConflictError`, and publishes
    nothing, if another run has published since this one read the table.
    """
    spark = batch.sparkSession
    based_on = last_number(spark, root)
    before = manifest(spark, root)
    rows = stage_table(batch, "upsert-batch")
    part = F.col(partition_by)
    values = [r[0] for r in rows.select(partition_by).distinct().collect()]
    if not values:
        return Upserted(based_on, [], len(before))
    if before:
        touched = part.isin([v for v in values if v is not None])
        if None in values:
            touched = touched | part.isNull()
        rows = read_merged(spark, root, rows.schema).where(touched).unionByName(rows)
    load = new_load()
    try:
        write_parquet(dedupe(rows, keys, order_by), load_path(root, load), partition_by=[partition_by])
        written = [n for n in _names(spark, load_path(root, load)) if "=" in n]
        after = before | {folder: load for folder in written}
        # One small file of names.
        names = spark.createDataFrame(sorted(after.items()), "folder string, load string")
        names.coalesce(1).write.json(notes_path(root, load))
        number = publish(spark, root, load, after=based_on)
    except Exception:
        discard(spark, root, load)
        raise
    return Upserted(number, written, len(after) - len(written))
