"""Layers laid out by their key, so that steps on that key need no shuffle.

A layer is written once in hash buckets of its key, sorted by it.  Whatever
groups, de-duplicates or joins by that key afterwards (silver to summary to
mart) reads the buckets as they are: the one exchange was paid when the layer
was written.  Layers that are joined have the same number of buckets.

A key with a third of all rows would be one bucket with a third of them.  With
``salt`` its rows are dealt out to that many buckets by another column (e.g.
the hour); groupings by key and salt then need no exchange, and what is left to
merge is a row per key and salt (:func:`salted_summary`).

A name is a view over the newest table; it is replaced in one step, so readers
see the old layer or the new one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.state import Measure, finish, merge, partials
from tierline.sources.versions import load_path, new_load

SALT = "bucket_salt"


def write_bucketed(
    df: DataFrame,
    name: str,
    root: str,
    keys: Sequence[str],
    buckets: int,
    sort: Sequence[str] = (),
    salt: tuple[str, int] | None = None,
) -> DataFrame:
    """Write ``df`` below ``root`` in ``buckets`` buckets of ``keys``, sorted by
    them and ``sort``, and give it ``name``.  ``salt`` (column, number) adds the
    column ``bucket_salt`` to the keys.  Returns the layer, read by its name."""
    spark = df.sparkSession
    keys = list(keys)
    if salt:
        column, n = salt
        df = df.withColumn(SALT, F.pmod(F.xxhash64(column), F.lit(n)).cast("int"))
        keys.append(SALT)
    load = new_load()
    old = _tables(spark, name)
    number = int(old[-1].rpartition("_")[2]) + 1 if old else 1
    table = f"{name}_b_{number:06d}"
    # The exchange: one task, and so one file, per bucket.
    writer = df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys, *sort)
    writer.option("path", load_path(root, load)).saveAsTable(table)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {table}")
    # Readers may still use the layer before this one; older ones go.
    for t in old[:-1]:
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    return spark.table(name)


def _tables(spark: SparkSession, name: str) -> list[str]:
    """Tables made under a name, oldest first."""
    return sorted(t.name for t in spark.catalog.listTables(pattern=f"{name}_b_*") if not t.isTemporary)


def salted_summary(layer: DataFrame, key: str, measures: Mapping[str, Measure]) -> DataFrame:
    """The summary by ``key`` of a layer that was written with a salt: partial
    results per bucket without an exchange, then one of a row per key and salt."""
    return finish(merge(partials(layer, [key, SALT], measures), [key], measures), [key], measures)
