"""Reads that keep malformed records apart.

A CSV line with too few or too many cells, a cell that is no value of its
column's type, or a text that is no JSON otherwise vanishes into NULLs.  Here
the input is read once; good rows and malformed records go to two folders of
one write, the latter with the file, the raw text and the reason, so that the
counts of both sides add up to the records read.

The reason is worked out from the raw text of malformed records only, with
Spark's own functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from tierline.sources.files import CSV_TEXT

RAW = "_raw_record"
FILE = "source_file"
FLAG = "is_malformed"


class Checked(NamedTuple):
    """``good``: rows of the schema and ``source_file``; ``malformed``:
    ``source_file, raw, reason``."""

    good: DataFrame
    malformed: DataFrame


def _schema(schema: StructType | str) -> StructType:
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    taken = {f.name.lower() for f in schema.fields} & {RAW, FILE, FLAG, "reason"}
    if taken:
        raise ValueError(f"columns named {sorted(taken)} are made by the reader")
    return schema


def _listed(names: dict[str, Column]) -> Column:
    """Names whose condition holds, joined."""
    return F.concat_ws(", ", *[F.when(bad, F.lit(name)) for name, bad in names.items()])


def _csv_reason(schema: StructType, options: dict[str, str]) -> Column:
    """Count the cells of the raw line, then look for cells of another type."""
    n = len(schema.fields)
    # All cells as text, one more than there should be; what is missing is
    # NULL, what is empty is not.
    wide = StructType([StructField(f"c{i}", StringType()) for i in range(n + 1)])
    kept = {k: v for k, v in options.items() if k in ("sep", "delimiter", "quote", "escape")}
    cells = F.from_csv(F.col(RAW), wide.simpleString()[7:-1].replace(":", " "), kept | {"nullValue": "\u0000", "emptyValue": ""})
    count = reduce(lambda a, b: a + b, [F.when(cells[f"c{i}"].isNotNull(), 1).otherwise(0) for i in range(n + 1)])
    other = {}
    for i, f in enumerate(schema.fields):
        cell = F.trim(cells[f"c{i}"])
        if not isinstance(f.dataType, StringType):
            other[f"{f.name} ({f.dataType.simpleString()})"] = (cell != "") & cell.try_cast(f.dataType).isNull()
    return (
        F.when(count > n, f"more than {n} cells")
        .when(count < n, F.concat(count.cast("string"), F.lit(f" of {n} cells")))
        .otherwise(F.concat(F.lit("not of its type: "), _listed(other)))
    )


def _json_reason(schema: StructType) -> Column:
    """No JSON at all, or fields that the document has but that did not fit."""
    lost = {
        f"{f.name} ({f.dataType.simpleString()})": F.get_json_object(F.col(RAW), f"$.{f.name}").isNotNull() & F.col(f"`{f.name}`").isNull()
        for f in schema.fields
    }
    inside = any(isinstance(f.dataType, StructType | ArrayType | MapType) for f in schema.fields)
    fields = _listed(lost)
    unknown = "not of its type: a nested field" if inside else "not of its type"
    return F.when(F.try_parse_json(F.col(RAW)).isNull(), "not JSON").otherwise(
        F.when(fields == "", F.lit(unknown)).otherwise(F.concat(F.lit("not of its type: "), fields))
    )


def _split(df: DataFrame, schema: StructType, reason: Column, out: str) -> Checked:
    spark = df.sparkSession
    bad = F.col(RAW).isNotNull()
    flagged = df.withColumns({FILE: F.col("_metadata.file_path"), "reason": F.when(bad, reason), FLAG: bad})
    flagged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(FLAG).parquet(out)
    both = spark.read.schema(flagged.schema).parquet(out)
    good = both.where(~F.col(FLAG)).select(*[F.col(f"`{f.name}`") for f in schema.fields], FILE)
    return Checked(good, both.where(FLAG).select(FILE, F.col(RAW).alias("raw"), "reason"))


def read_csv_checked(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str,
    out: str,
    header: bool = True,
    multi_line: bool = False,
    **options: str,
) -> Checked:
    """CSV with a schema; rows and malformed lines are written below ``out``
    in one pass and read back.  Line breaks and quotes as in
    :func:`tierline.sources.files.read_csv`."""
    schema = _schema(schema)
    text = {k: v for k, v in CSV_TEXT.items() if not (multi_line and k == "lineSep")} | options
    reader = spark.read.schema(StructType([*schema.fields, StructField(RAW, StringType())]))
    reader = reader.options(header=header, multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord=RAW, columnPruning=False)
    df = reader.options(**text).csv([path] if isinstance(path, str) else list(path))
    return _split(df, schema, _csv_reason(schema, text), out)


def read_json_checked(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str,
    out: str,
    multi_line: bool = False,
    **options: str,
) -> Checked:
    """JSON documents, one per line or (``multi_line``) one or an array per
    file; a malformed file is then one record."""
    schema = _schema(schema)
    reader = spark.read.schema(StructType([*schema.fields, StructField(RAW, StringType())]))
    reader = reader.options(multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord=RAW)
    df = reader.options(**options).json([path] if isinstance(path, str) else list(path))
    return _split(df, schema, _json_reason(schema), out)
