"""Sources (readers) and sinks (writers, materialisation)."""

from tierline.sources.checked import read_csv_checked, read_json_checked
from tierline.sources.files import (
    describe_schema,
    list_stage,
    load_stage,
    read_csv,
    read_json_docs,
    read_parquet,
    register_sources,
    with_source_file,
)
from tierline.sources.ledger import load_new, read_ledger, read_loaded
from tierline.sources.merge import read_merged, upsert
from tierline.sources.sinks import materialize, stage_table, write_csv, write_parquet, write_split
from tierline.sources.versions import ConflictError, expire, read_current, replace_parquet

__all__ = [
    "ConflictError",
    "describe_schema",
    "expire",
    "list_stage",
    "load_new",
    "load_stage",
    "materialize",
    "read_csv",
    "read_csv_checked",
    "read_current",
    "read_json_checked",
    "read_json_docs",
    "read_ledger",
    "read_loaded",
    "read_merged",
    "read_parquet",
    "register_sources",
    "replace_parquet",
    "stage_table",
    "upsert",
    "with_source_file",
    "write_csv",
    "write_parquet",
    "write_split",
]
