"""DataFrame -> DataFrame operators (compose with ``df.transform``)."""

from tierline.operators.audit import (
    StageMetrics,
    ingest_ledger,
    ledger_summary,
    reconcile,
    reconcile_content,
    stage_report,
)
from tierline.operators.clean import (
    Split,
    coerce_columns,
    complete_condition,
    dedupe,
    drop_empty_columns,
    drop_empty_rows,
    drop_null_keys,
    drop_unnamed_columns,
    empty_columns,
    split_complete,
    with_money_range,
    with_parsed_range,
)
from tierline.operators.mart import (
    build_mart,
    left_join_split,
    salted_join,
    union_by_name,
)
from tierline.operators.nested import zip_explode
from tierline.operators.order import top_n
from tierline.operators.quality import (
    expect_count,
    missing_report,
    not_null_test,
    null_profile,
    range_report,
    range_violations,
    require_columns,
    run_tests,
    unique_test,
)
from tierline.operators.summarize import count_by, distinct_keys, entity_summary, key_profile

__all__ = [
    "Split",
    "StageMetrics",
    "build_mart",
    "coerce_columns",
    "complete_condition",
    "count_by",
    "dedupe",
    "distinct_keys",
    "drop_empty_columns",
    "drop_empty_rows",
    "drop_null_keys",
    "drop_unnamed_columns",
    "empty_columns",
    "entity_summary",
    "expect_count",
    "ingest_ledger",
    "key_profile",
    "ledger_summary",
    "left_join_split",
    "missing_report",
    "not_null_test",
    "null_profile",
    "range_report",
    "range_violations",
    "reconcile",
    "reconcile_content",
    "require_columns",
    "run_tests",
    "salted_join",
    "split_complete",
    "stage_report",
    "top_n",
    "union_by_name",
    "unique_test",
    "with_money_range",
    "with_parsed_range",
    "zip_explode",
]
