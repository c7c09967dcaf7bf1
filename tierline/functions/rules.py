"""Rule-based columns: threshold buckets, penalty scores, status bands,
worst-status roll-ups and label standardisation.

Each rule set is plain data (a list of steps) compiled into one ``CASE WHEN``
expression, so Catalyst constant-folds it and codegen evaluates it inline.
The thresholds of a concrete pipeline live with that pipeline
(``tierline.plans``), not here.
"""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.column import Column as _Column

ColumnOrName = Column | str

_OPS = {
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "==": operator.eq,
    "!=": operator.ne,
}


def _col(c: ColumnOrName) -> Column:
    return c if isinstance(c, _Column) else F.col(c)


def ladder(
    c: ColumnOrName,
    steps: Sequence[tuple[str, Any, Any]],
    otherwise: Any,
    null_value: Any = None,
    has_null_value: bool = False,
) -> Column:
    """First-match ``CASE`` over ``(op, threshold, result)`` steps.

    With ``has_null_value`` the NULL input gets ``null_value`` first;
    otherwise NULL fails every comparison and falls into ``otherwise``
    (the behaviour of a plain ``when`` chain).
    """
    src = _col(c)
    expr = None
    if has_null_value:
        expr = F.when(src.isNull(), F.lit(null_value))
    for op, threshold, result in steps:
        cond = _OPS[op](src, F.lit(threshold))
        expr = F.when(cond, F.lit(result)) if expr is None else expr.when(cond, F.lit(result))
    if expr is None:
        return F.lit(otherwise)
    return expr.otherwise(F.lit(otherwise))


def bucketize(
    c: ColumnOrName,
    bounds: Sequence[float],
    labels: Sequence[str],
    op: str = "lt",
    null_label: str | None = None,
    zero_label: str | None = None,
) -> Column:
    """Label a number by ascending upper bounds.

    ``labels`` has one more entry than ``bounds``; the last is the
    ``otherwise`` label.  ``op="lt"`` closes buckets on the left
    (``x < b``), ``op="le"`` on the right (``x <= b``).  ``zero_label``
    adds an ``x == 0`` bucket first.  ``null_label=None`` lets NULL fall into
    the last label, exactly like a bare ``when`` chain.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("bucketize needs len(labels) == len(bounds) + 1")
    if op not in ("lt", "le"):
        raise ValueError("op must be 'lt' or 'le'")
    if any(b >= a for a, b in zip(bounds[1:], bounds)):
        raise ValueError("bucketize bounds must be strictly ascending")
    cmp = "<" if op == "lt" else "<="
    steps: list[tuple[str, Any, Any]] = []
    if zero_label is not None:
        steps.append(("==", 0, zero_label))
    steps += [(cmp, b, lab) for b, lab in zip(bounds, labels[:-1])]
    return ladder(
        c, steps, labels[-1], null_value=null_label, has_null_value=null_label is not None
    )


def score(ladders: Sequence[tuple[ColumnOrName, Sequence[tuple[str, Any, int]]]]) -> Column:
    """Sum of first-match penalty ladders; a ladder with no match (or a NULL
    input) adds 0.  Returns an ``int`` column."""
    total = None
    for c, steps in ladders:
        part = ladder(c, steps, 0)
        total = part if total is None else total + part
    return (total if total is not None else F.lit(0)).cast("int")


def status_band(
    score_col: ColumnOrName,
    bands: Sequence[tuple[float, str]],
    otherwise: str,
) -> Column:
    """``score >= threshold`` bands, checked in the given (descending) order."""
    return ladder(score_col, [(">=", t, lab) for t, lab in bands], otherwise)


def flag_any(predicate: Column) -> Column:
    """Aggregate: 1 if any row of the group satisfies ``predicate``, else 0.

    ``max`` over an int is a fixed-width buffer, so it runs in the hash
    aggregate with map-side partial aggregation.
    """
    return F.max(F.when(predicate, F.lit(1)).otherwise(F.lit(0)))


def rollup_status(flags: Sequence[tuple[ColumnOrName, str]], otherwise: str) -> Column:
    """Worst status wins: the first flag (in order) equal to 1 names it."""
    if not flags:
        return F.lit(otherwise)
    expr = None
    for flag, label in flags:
        cond = _col(flag) == 1
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def standardize_label(c: ColumnOrName, labels: Sequence[str] | Mapping[str, str]) -> Column:
    """Map text to a canonical label, ignoring case and surrounding spaces.

    ``labels`` is either the list of canonical spellings (matched on
    ``lower(trim(x))``) or an explicit ``{variant: canonical}`` mapping.
    Unknown text is returned trimmed, NULL stays NULL; a label mapped to None
    becomes NULL.
    """
    if isinstance(labels, Mapping):
        mapping = {str(k).strip().lower(): v for k, v in labels.items()}
    else:
        mapping = {lab.strip().lower(): lab for lab in labels}
    trimmed = F.trim(_col(c))
    if not mapping:
        return trimmed
    key = F.lower(trimmed)
    lookup = F.create_map(*[F.lit(x).cast("string") for kv in mapping.items() for x in kv])
    return F.when(F.map_contains_key(lookup, key), F.try_element_at(lookup, key)).otherwise(trimmed)
