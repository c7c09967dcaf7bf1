"""Ordered previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_n(df: DataFrame, n: int, order_by: Sequence[Column | str]) -> DataFrame:
    """First ``n`` rows in ``order_by`` order.

    Planned as ``TakeOrderedAndProject``: every task keeps its own top ``n``
    and only those reach the final merge, so the cost is one scan plus
    ``n x tasks`` rows, never a full sort.  Give a unique tiebreak column
    last to make the result deterministic.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order_by]
    return df.orderBy(*order).limit(n)
