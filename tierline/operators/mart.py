"""Marts: entity rows left-joined with event-grain and/or summary rows, and
by-name unions of tables whose columns differ."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.session import stage_table


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Union matching columns by name; a column missing on one side is NULL
    there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


#: Tasks that the rows of one key are spread over in a salted join.
SALTS = 8


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Inner join of ``big`` with ``small`` (about one row per key) that
    spreads the rows of every key of ``big`` over up to ``salts`` tasks.

    A row's salt is the number of the task that reads it, so equal rows
    spread as well, rows of any type have one, and a task that is run again
    gives the same salts.  Every row of ``small`` is there once per salt.  No
    key has to be known as hot, and nothing is collected or broadcast on
    purpose (Spark may still broadcast a ``small`` that it knows to be small,
    and then shuffles nothing).

    Same rows as ``big.join(small, on, "inner")``.
    """
    on = list(on)
    salted = big.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    copies = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "__salt"], "inner").drop("__salt")


def left_join_split(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    salts: int = SALTS,
    right_keys: DataFrame | None = None,
) -> DataFrame:
    """``left LEFT JOIN right USING (on)``, planned skew-safe for a large,
    skewed ``right`` side (events) and a ``left`` side with about one row
    per key (entities).

    A left outer join may only split skewed partitions of its *left*
    (preserved) side at runtime.  When the hot keys are on the right (an
    entity with a third of all events), the identity
    ``L ⟕ R = (R ⋈ L) ∪ (L ▷ keys(R))`` is used instead:

    * the inner join is salted (:func:`salted_join`);
    * the anti join runs against ``right_keys``, one row per key of
      ``right``: give them if they are at hand (e.g. a summary of the same
      events), else they are the *distinct* keys of ``right``, which costs a
      second scan of it.

    Row for row identical to the plain left join.
    """
    on = list(on)
    matched = salted_join(right, left, on, salts)
    keys = right.select(*on).distinct() if right_keys is None else right_keys.select(*on)
    unmatched = left.join(keys, on, "left_anti")
    right_only = [c for c in right.columns if c not in on]
    out_cols = on + [c for c in left.columns if c not in on] + right_only
    return matched.select(*out_cols).unionByName(unmatched, allowMissingColumns=True).select(*out_cols)


def one_row_per_key(df: DataFrame, key: str, what: str) -> None:
    """Raise if a key of ``df`` has several rows (one job, which returns one
    row at most)."""
    again = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
    if again is not None:
        raise ValueError(f"{what} has {again['n']} rows for {key} = {again[key]!r}; it must have one per key")


def build_mart(
    entities: DataFrame,
    key: str,
    summary: DataFrame | None = None,
    events: DataFrame | None = None,
    grain: str = "entity",
    summary_cols: Sequence[str] | None = None,
    event_cols: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
    skew_safe: bool = True,
    salts: int = SALTS,
    summary_of_events: bool = False,
    summary_is_unique: bool = False,
) -> DataFrame:
    """Entity ⟕ weather-style detail, keeping every entity.

    * ``grain="entity"``: entity ⟕ summary (1:1 per key).
    * ``grain="event"``: (entity ⟕ summary) ⟕ events: one row per event,
      summary columns repeated on each, entities without events kept once
      (with their summary, if they have one).  The two one-row-per-key
      tables are joined first, so the events meet a single join.
    * ``grain="union"``: entity ⟕ union_by_name(events, summary): summary
      and event rows side by side, each NULL in the other's columns (the
      mixed-grain table that loading a summary folder together with its
      parent folder produces).

    The summary must have one row per key in the entity and event grains (one
    with several would multiply the events); this is checked, by a job of its
    own, unless ``summary_is_unique`` states that it was grouped by the key.
    Where the mart reads it more than once (for the check, or for its keys) it
    is written once to the shared scratch folder.  ``summary_of_events`` states
    that it has exactly the keys of ``events``, which saves reading the events
    for their keys.

    Output: all entity columns, then ``columns`` (default: summary columns
    then event columns) in that order.  Summary/event inputs may carry extra
    columns; only the requested ones are kept (pruned at the scan).
    """
    scols = list(summary_cols) if summary_cols is not None else (
        [c for c in summary.columns if c != key] if summary is not None else []
    )
    ecols = list(event_cols) if event_cols is not None else (
        [c for c in events.columns if c != key] if events is not None else []
    )
    if summary is not None:
        summary = summary.select(key, *scols)
        check = grain != "union" and not summary_is_unique
        if check or (summary_of_events and grain != "entity"):
            summary = stage_table(summary, "mart-summary")
        if check:
            one_row_per_key(summary, key, "the summary")
    event_keys = summary if summary_of_events else None
    if grain == "entity":
        if summary is None:
            raise ValueError("grain='entity' needs a summary")
        right = summary.select(key, *scols)
        joined = entities.join(right, key, "left")
        wanted = list(columns) if columns is not None else scols
    elif grain in ("event", "hour"):
        if events is None:
            raise ValueError("grain='event' needs events")
        left = entities
        if summary is not None:
            # both sides have about one row per key: no skew here
            left = entities.join(summary.select(key, *scols), key, "left")
        right = events.select(key, *ecols)
        joined = (
            left_join_split(left, right, [key], salts, event_keys) if skew_safe else _plain_left(left, right, [key])
        )
        wanted = list(columns) if columns is not None else scols + ecols
    elif grain == "union":
        if events is None or summary is None:
            raise ValueError("grain='union' needs events and a summary")
        right = union_by_name(events.select(key, *ecols), summary.select(key, *scols))
        joined = (
            left_join_split(entities, right, [key], salts, event_keys)
            if skew_safe
            else _plain_left(entities, right, [key])
        )
        wanted = list(columns) if columns is not None else scols + ecols
    else:
        raise ValueError(f"unknown grain {grain!r}")
    ent_cols = entities.columns
    return joined.select(*[F.col(c) for c in ent_cols], *[F.col(c) for c in wanted if c not in ent_cols])


def _plain_left(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "left")
