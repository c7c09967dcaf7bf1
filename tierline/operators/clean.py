"""Cleaning operators: column / row pruning, coercion, range parsing,
de-duplication and the completeness split.

All are ``DataFrame -> DataFrame`` and compose with ``df.transform``.  Only
:func:`drop_empty_columns` runs a job (one aggregate pass that returns one
small row: a count per column) because the output schema depends on data.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions.parse import coerce_numeric, parse_money_range, parse_range


def drop_unnamed_columns(df: DataFrame, prefix: str = "_c") -> DataFrame:
    """Drop columns whose *name* starts with ``prefix`` (Spark names headerless
    CSV columns ``_c<N>``).  Metadata only, no job."""
    unnamed = [c for c in df.columns if c.startswith(prefix)]
    return df.drop(*unnamed) if unnamed else df


def empty_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Names of the columns that hold no non-NULL value.

    One aggregate job; its result is one row of ``len(columns)`` counts, so
    the driver receives O(columns) numbers whatever the row count.
    """
    cols = list(columns) if columns is not None else df.columns
    if not cols:
        return []
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if counts[f"c{i}"] == 0]


def drop_empty_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop columns whose *values* are all NULL (checked over ``columns``,
    default all)."""
    empty = empty_columns(df, columns)
    return df.drop(*empty) if empty else df


def drop_empty_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which every (``subset``) column is NULL."""
    return df.dropna(how="all", subset=list(subset) if subset else None)


def coerce_columns(
    df: DataFrame,
    columns: Iterable[str],
    to: str = "double",
    sentinels: Iterable[str] | None = None,
) -> DataFrame:
    """``try_cast`` each present column in place; absent ones are skipped."""
    present = [c for c in columns if c in df.columns]
    sent = list(sentinels) if sentinels else None
    return df.withColumns({c: coerce_numeric(c, to, sent) for c in present})


def with_parsed_range(
    df: DataFrame,
    source: str,
    min_col: str,
    max_col: str,
    avg_col: str,
) -> DataFrame:
    """Add min / max / avg columns parsed from range text in ``source``."""
    parsed = parse_range(source)
    return df.withColumns(
        {min_col: parsed["min"], max_col: parsed["max"], avg_col: parsed["avg"]}
    )


def with_money_range(df: DataFrame, source: str, min_col: str, max_col: str) -> DataFrame:
    """Add min / max amounts parsed from money-range text in ``source``."""
    parsed = parse_money_range(source)
    return df.withColumns({min_col: parsed["min"], max_col: parsed["max"]})


def with_delta(df: DataFrame, end: str, start: str, out: str) -> DataFrame:
    """Add ``end - start``; NULL if either is."""
    return df.withColumn(out, F.col(end) - F.col(start))


def dedupe(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Keep one row per ``keys``.

    With ``order_by`` the survivor is the first row in that order, so the
    result is deterministic.  It is planned as ``row_number() = 1``, for
    which Spark places a partial ``WindowGroupLimit`` *before* the shuffle:
    each map task forwards at most one row per key, so a hot key costs no
    more shuffle than any other.  Without ``order_by`` any one row survives
    (``dropDuplicates``, a partial+final aggregate).
    """
    if not order_by:
        return df.dropDuplicates(list(keys))
    order = [F.col(o) if isinstance(o, str) else o for o in order_by]
    window = Window.partitionBy(*keys).orderBy(*order)
    rank = "__tierline_rn"
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


def complete_condition(columns: Sequence[str]) -> Column:
    """``c1 IS NOT NULL AND c2 IS NOT NULL AND ...``"""
    if not columns:
        raise ValueError("at least one column is needed")
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


class Split(NamedTuple):
    valid: DataFrame
    skipped: DataFrame


def split_complete(df: DataFrame, columns: Sequence[str]) -> Split:
    """Rows where all ``columns`` are non-NULL, and the complement.

    The two sides are lazy filters of the same input; to produce both from a
    single scan write them with :func:`tierline.sources.sinks.write_split`.
    """
    cond = complete_condition(columns)
    return Split(df.filter(cond), df.filter(~cond))


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The load-then-``DELETE WHERE key IS NULL`` step, applied before the
    write (Parquet has no in-place delete).  Pushed down to the scan."""
    return df.filter(complete_condition(keys))
