"""Column-level functions (pure expressions, no actions)."""

from tierline.functions.parse import (
    coerce_numeric,
    null_sentinels,
    parse_event_time,
    parse_money_range,
    parse_range,
    rounded_avg,
    rounded_sum,
)
from tierline.functions.rules import (
    bucketize,
    flag_any,
    ladder,
    rollup_status,
    score,
    standardize_label,
    status_band,
)

__all__ = [
    "bucketize",
    "coerce_numeric",
    "flag_any",
    "ladder",
    "null_sentinels",
    "parse_event_time",
    "parse_money_range",
    "parse_range",
    "rollup_status",
    "score",
    "rounded_avg",
    "rounded_sum",
    "standardize_label",
    "status_band",
]
