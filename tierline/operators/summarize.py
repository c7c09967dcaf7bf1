"""Grouped aggregates.

Every aggregate here is algebraic (count, sum, min, max, avg, max-of-flag),
so Spark runs it as partial aggregation on the map side and a final merge
after the shuffle: a key holding a third of all rows ships one partial row
per map task, not its rows.  Exact ``count(DISTINCT)`` is planned as a
two-level aggregate (de-duplicate on (group, value) first), which keeps the
same property.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, keys: Sequence[str] | str, name: str = "count") -> DataFrame:
    """Rows per group, with the count column named ``name``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def entity_summary(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Mapping[str, Column],
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per entity: ``aggs`` are aggregate expressions by output name;
    ``derived`` are row-level expressions over the aggregated columns (e.g. a
    roll-up status from flags), added after the aggregate."""
    out = df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in aggs.items()])
    if derived:
        out = out.withColumns(dict(derived))
    return out


def key_profile(df: DataFrame, key: str) -> DataFrame:
    """``total_rows, unique_keys, null_keys`` for one key column, one row."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(F.col(key)).alias("unique_keys"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
    )


def distinct_keys(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Distinct key projection (partial de-duplication before the shuffle)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.select(*keys).distinct()
