"""Readers: CSV, multi-line JSON documents, Parquet, stage folders.

Give readers an explicit schema whenever it is known: inference costs an
extra pass over the files (a full one for JSON), and on 100 TB that pass is
as expensive as the job itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Options under which CSV text is written and read without change.
CSV_TEXT = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "lineSep": "\n",
}

BOM = "﻿"


def _strip_bom(df: DataFrame) -> DataFrame:
    renames = {c: c.lstrip(BOM) for c in df.columns if c.startswith(BOM)}
    return df.withColumnsRenamed(renames) if renames else df


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    header: bool = True,
    infer: bool = False,
    encoding: str = "UTF-8",
    multi_line: bool | None = False,
    **options: str,
) -> DataFrame:
    """CSV with header.  With ``schema`` nothing is inferred; with
    ``infer=True`` Spark samples the files (one extra pass); otherwise all
    columns are strings.  A UTF-8 byte-order mark never leaks into the first
    column name; empty header cells become ``_c<N>`` columns.

    With ``multi_line`` quoted cells may hold line breaks; a file is then read
    by one task, so it is for feeds of many files, or small ones.  With
    ``None`` the lines are looked at first (:func:`has_open_quotes`, a pass of
    its own whose tasks share large files): only a feed that has quoted line
    breaks is read that way, any other is split.
    """
    if multi_line is None:
        multi_line = has_open_quotes(spark, path, options.get("quote", CSV_TEXT["quote"]))
    reader = spark.read.option("header", header).option("encoding", encoding).option("multiLine", multi_line)
    text = CSV_TEXT if not multi_line else {k: v for k, v in CSV_TEXT.items() if k != "lineSep"}
    for k, v in (text | options).items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer)
    paths = [path] if isinstance(path, str) else list(path)
    return _strip_bom(reader.csv(paths))


def has_open_quotes(spark: SparkSession, path: str | Sequence[str], quote: str = '"') -> bool:
    """Does a line hold an odd number of quotes?  A cell with a line break
    leaves its quote open at the end of the line, so without such a line (and
    with quotes inside cells doubled) the files may be cut at any line end.
    A stray quote in an unquoted cell counts as well, which is safe."""
    lines = spark.read.text([path] if isinstance(path, str) else list(path))
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    return lines.where(quotes % 2 == 1).limit(1).count() > 0


def read_json_docs(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    multi_line: bool = True,
    source_col: str | None = None,
    **options: str,
) -> DataFrame:
    """JSON documents; with ``multi_line`` each file holds one (pretty
    printed) document or a top-level array of documents, otherwise one
    document per line (splittable, the better layout at scale).

    Pass ``schema`` to skip inference and to let the reader materialise only
    the fields you name (unnamed nested blocks are never built).  Without a
    schema the files are scanned once to infer a union schema.
    ``source_col`` adds the file path each row came from.
    """
    reader = spark.read.option("multiLine", multi_line)
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    df = reader.json(paths)
    return with_source_file(df, source_col) if source_col else df


def read_parquet(spark: SparkSession, *paths: str, merge: bool = False) -> DataFrame:
    """Parquet files or folders (partition folders are discovered)."""
    return spark.read.option("mergeSchema", merge).parquet(*paths)


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Add the path of the file each row was read from (file sources only)."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def load_stage(
    spark: SparkSession,
    root: str | None = None,
    files: Sequence[str] | None = None,
    pattern: str = "*part-*.parquet",
    merge: bool = True,
    recursive: bool = True,
) -> DataFrame:
    """Load a folder tree of Parquet files as one table.

    * ``root`` is walked recursively; only file names matching the glob
      ``pattern`` are read (``_SUCCESS``, ``.crc`` and stray files are not).
    * ``files`` loads an explicit list instead.
    * ``merge`` makes the schema the union of all files' columns; a file
      lacking a column reads it as NULL.  Column names resolve
      case-insensitively (Spark's default ``spark.sql.caseSensitive=false``).
    * An unreadable or corrupt file aborts the load (Spark's default
      ``spark.sql.files.ignoreCorruptFiles=false``); nothing is half-loaded
      because the caller's write only commits when the job succeeds.
    """
    reader = spark.read.option("mergeSchema", merge)
    if files:
        return reader.parquet(*files)
    if root is None:
        raise ValueError("load_stage needs root or files")
    reader = reader.option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(root)


def list_stage(
    spark: SparkSession,
    root: str,
    pattern: str | None = "*part-*.parquet",
    recursive: bool = True,
) -> DataFrame:
    """``path, length, modificationTime`` of the files under ``root``.

    Uses the binary-file source with the ``content`` column pruned, so no
    file body is read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select("path", "length", "modificationTime")


def describe_schema(df: DataFrame) -> DataFrame:
    """``position, column_name, data_type, nullable`` of ``df``'s schema
    (metadata only)."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean"
    )


def register_sources(spark: SparkSession, sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Register named sources as temp views and return them re-read by name."""
    out = {}
    for name, df in sources.items():
        df.createOrReplaceTempView(name)
        out[name] = spark.table(name)
    return out
