"""Flattening of documents that carry parallel arrays (one array per
measure, aligned by position) into one row per position."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column as _Column


def zip_explode(
    df: DataFrame,
    arrays: Mapping[str, Column | str],
    keep: Sequence[str] = (),
    keep_empty: bool = False,
    position: str | None = None,
) -> DataFrame:
    """One output row per array position.

    ``arrays`` maps output column name -> array column (nested paths such as
    ``"hourly.time"`` are fine and prune the rest of the struct at the scan).
    Arrays are zipped by position; shorter arrays are padded with NULL.  A
    row whose arrays are all empty, or where *any* of the arrays is NULL
    (the zip is then NULL), yields no rows unless ``keep_empty`` (then it
    yields one row of NULLs).  ``keep`` columns are repeated on
    every output row; ``position`` names an optional 0-based index column.

    Work is per row (a generator inside the scan stage): no shuffle, and a
    long array never concentrates on one task beyond its own row.
    """
    names = list(arrays)
    if not names:
        raise ValueError("zip_explode needs at least one array")
    staged = df.select(
        *[F.col(k) for k in keep],
        *[
            (v if isinstance(v, _Column) else F.col(v)).alias(f"__z_{n}")
            for n, v in arrays.items()
        ],
    )
    zipped = F.arrays_zip(*[F.col(f"__z_{n}") for n in names])
    if position:
        gen = F.posexplode_outer(zipped) if keep_empty else F.posexplode(zipped)
        exploded = staged.select(*keep, gen.alias(position, "__z"))
    else:
        gen = F.explode_outer(zipped) if keep_empty else F.explode(zipped)
        exploded = staged.select(*keep, gen.alias("__z"))
    out = [F.col(k) for k in keep]
    if position:
        out.append(F.col(position))
    out += [F.col("__z").getField(f"__z_{n}").alias(n) for n in names]
    return exploded.select(*out)
