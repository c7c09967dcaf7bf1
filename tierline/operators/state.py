"""Summaries that grow with their input: one row of mergeable partial results
per entity, kept as a table, so that a new batch of rows is all that is read.

A summary is described by :class:`Measure` s.  :func:`partials` reduces rows to
partial results (counts, sums of exact parts, extremes, flags), :func:`merge`
adds the partial results of any number of row sets, and :func:`finish` gives
the summary.  Because every partial result is exact and its merge commutes, any
split of the input gives the same summary as all rows at once; a single
aggregate is just ``finish(partials(rows))``.

:func:`update_state` keeps partial results on disk: it merges those of a batch
into the newest version and publishes the result in one step, together with
the names of the batches it holds, so that a batch handed in again (a rerun
after a lost driver) changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.parse import exact_parts, exact_steps, exact_total
from tierline.functions.rules import flag_any
from tierline.sources.versions import (
    current_path,
    discard,
    expire,
    last_number,
    load_path,
    new_load,
    notes_path,
    publish,
    versions,
)

KINDS = ("rows", "sum", "avg", "min", "max", "any")


@dataclass(frozen=True)
class Measure:
    """One column of a summary: ``rows`` (count of rows), ``sum`` and ``avg``
    (exact, rounded once), ``min`` and ``max`` (rounded) of a column, or
    ``any`` (does the condition, a Column or SQL text, hold for some row)."""

    kind: str
    column: str | None = None
    condition: Column | str | None = None
    scale: int = 2

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {self.kind!r}")


def _sums(measures: Mapping[str, Measure]) -> list[str]:
    """Columns that are summed or averaged, each once."""
    return list(dict.fromkeys(m.column for m in measures.values() if m.kind in ("sum", "avg")))


def partials(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    """One row of partial results per key.  A column that is summed and
    averaged is taken apart once."""
    aggs: list[Column] = []
    steps = {c: exact_steps(c) for c in _sums(measures)}
    names = {c: (f"__whole_{i}", f"__units_{i}") for i, c in enumerate(steps)}
    df = df.withColumns({n: col for c, pair in names.items() for n, col in zip(pair, steps[c], strict=True)}) if steps else df
    for c, pair in names.items():
        whole, units = (F.col(n) for n in pair)
        aggs += [F.sum(part).alias(f"{c}__{name}") for name, part in exact_parts(c, (whole, units)).items()]
        aggs.append(F.count(F.col(c)).alias(f"{c}__n"))
    for name, m in measures.items():
        if m.kind == "rows":
            aggs.append(F.count(F.lit(1)).alias(name))
        elif m.kind == "any":
            holds = F.expr(m.condition) if isinstance(m.condition, str) else m.condition
            aggs.append(flag_any(holds).alias(name))
        elif m.kind in ("min", "max"):
            aggs.append(getattr(F, m.kind)(m.column).alias(name))
    return df.groupBy(*keys).agg(*aggs)


def merge(states: DataFrame, keys: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    """Partial results of several row sets (stacked) -> of all of them."""
    aggs: list[Column] = []
    for c in _sums(measures):
        aggs += [F.sum(f"{c}__{part}").alias(f"{c}__{part}") for part in ("whole", "frac", "rest", "n")]
    for name, m in measures.items():
        if m.kind == "rows":
            aggs.append(F.sum(name).alias(name))
        elif m.kind == "any":
            aggs.append(F.max(name).alias(name))
        elif m.kind in ("min", "max"):
            aggs.append(getattr(F, m.kind)(name).alias(name))
    return states.groupBy(*keys).agg(*aggs)


def finish(state: DataFrame, keys: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    """The summary: keys and measures, in the order given."""
    out: list[Column] = []
    for name, m in measures.items():
        if m.kind in ("sum", "avg"):
            parts = [F.col(f"{m.column}__{p}") for p in ("whole", "frac", "rest")]
            count = F.col(f"{m.column}__n") if m.kind == "avg" else None
            out.append(exact_total(*parts, m.scale, count).alias(name))
        elif m.kind in ("min", "max"):
            out.append(F.round(name, m.scale).alias(name))
        else:
            out.append(F.col(name))
    return state.select(*keys, *out)


def applied_batches(spark: SparkSession, root: str) -> list[str]:
    """Names of the batches that the newest state holds."""
    found = versions(spark, root)
    if not found:
        return []
    return [r["value"] for r in spark.read.text(notes_path(root, found[-1][1])).collect()]


def update_state(
    rows: DataFrame, root: str, batch: str, keys: Sequence[str], measures: Mapping[str, Measure], keep: int = 2
) -> bool:
    """Merge a batch of rows into the state at ``root``.  False, and nothing
    done, if a batch of that name is in it already.  Only ``rows`` and the
    state, one row per key, are read.  Raises
    :class:`tierline.sources.versions.ConflictError`, and publishes nothing, if
    another run has published in the meantime."""
    if "\n" in batch:
        raise ValueError("a batch's name is one line")
    spark = rows.sparkSession
    based_on = last_number(spark, root)
    done = applied_batches(spark, root)
    if batch in done:
        return False
    state = partials(rows, keys, measures)
    if versions(spark, root):
        state = merge(spark.read.parquet(current_path(spark, root)).unionByName(state), keys, measures)
    load = new_load()
    try:
        state.write.parquet(load_path(root, load))
        names = spark.createDataFrame([(b,) for b in [*done, batch]], "value string")
        names.coalesce(1).write.text(notes_path(root, load))
        publish(spark, root, load, after=based_on)
    except Exception:
        discard(spark, root, load)
        raise
    expire(spark, root, keep)
    return True


def read_state(spark: SparkSession, root: str, keys: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    """The summary of all batches so far."""
    return finish(spark.read.parquet(current_path(spark, root)), keys, measures)
