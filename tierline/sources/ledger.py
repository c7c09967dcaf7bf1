"""Incremental loads of a stage folder, with a load ledger.

Every load notes the files that it read (path, length, modification time and,
on demand, a digest of the content), and publishes notes and rows together as
one version (:mod:`tierline.sources.versions`).  The next load reads only files
that no load has noted in their present state; ``force`` reads all of them
again, which adds a copy.  A file that has changed is loaded again;
``read_loaded(latest=True)`` takes each file's rows from its newest load only.

The stage listing is joined with the ledger in Spark.  The driver handles at
most ``files_per_load`` paths at a time, each batch a load of its own, so a
run that stops half-way has published whole batches and goes on after them.

Loaded rows are many and have few loads and files, so they are never brought
together by either: one task would get a whole load.  The loads' numbers, and
the ledger while it is of a moderate size, go to the rows instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.mart import salted_join
from tierline.sources.files import load_stage
from tierline.sources.versions import discard, last_number, load_path, new_load, notes_path, publish, versions

#: Files of one load, at most.
FILES_PER_LOAD = 10_000

#: Files whose notes are sent to every executor, at most.
FILES_TO_ALL = 100_000

LEDGER_SCHEMA = "path string, uri string, length long, modified timestamp, digest string, forced boolean"


class Loaded(NamedTuple):
    loads: list[str]
    files: int


def _listing(spark: SparkSession, stage: str, pattern: str | None, recursive: bool) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    # The content column is pruned: no file body is read.
    return reader.load(stage).select(
        "path", F.col("_metadata.file_path").alias("uri"), "length", F.col("modificationTime").alias("modified")
    )


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """``path, uri, length, modified, digest, forced, load, number``: one row
    per file and load, of published loads only."""
    loads = versions(spark, root)
    if not loads:
        return spark.createDataFrame([], f"{LEDGER_SCHEMA}, load string, number long")
    folders = [notes_path(root, load) for _, load in loads]
    noted = spark.read.schema(f"{LEDGER_SCHEMA}, load string").option("basePath", f"{root.rstrip('/')}/_notes").parquet(*folders)
    return noted.join(_numbers(spark, loads), "load").select(*noted.columns, "number")


def _numbers(spark: SparkSession, loads: list[tuple[int, str]]) -> DataFrame:
    """Load and number, sent to every executor.  Without the hint Spark knows
    no size of it: it sorts all rows of a load in one task, or sends the rows."""
    return F.broadcast(spark.createDataFrame([(load, n) for n, load in loads], "load string, number long"))


def join_files(rows: DataFrame, files: DataFrame, on: Sequence[str]) -> DataFrame:
    """Loaded rows joined with a table of one row per file (``on``:
    ``source_file``, and the load's number if the table has it).  The files are
    counted first: up to ``FILES_TO_ALL`` of them go to the rows, which stay
    where they are.  Of more, both sides are shuffled, and the rows of a file
    are spread over several tasks."""
    if files.limit(FILES_TO_ALL + 1).count() <= FILES_TO_ALL:
        return rows.join(F.broadcast(files), on)
    return salted_join(rows, files, on)


def load_new(
    spark: SparkSession,
    stage: str,
    root: str,
    pattern: str | None = "*part-*.parquet",
    recursive: bool = True,
    force: bool = False,
    digest: bool = False,
    files_per_load: int = FILES_PER_LOAD,
) -> Loaded:
    """Load the files below ``stage`` that are new or changed since they were
    last loaded into the table at ``root``; with ``force`` all of them.

    With ``digest`` the content of candidates is hashed, and a file that was
    only touched (new time, same content) is not loaded again; its body is
    read once more for that, so it is for stages of small files.  Raises
    :class:`tierline.sources.versions.ConflictError` if another run has
    published in the meantime (nothing of the present batch is published
    then).
    """
    loads: list[str] = []
    files, done = 0, ""
    while True:
        based_on = last_number(spark, root)
        listing = _listing(spark, stage, pattern, recursive)
        noted = read_ledger(spark, root)
        candidates = listing.where(F.col("path") > done)
        if not force:
            candidates = candidates.join(noted, ["path", "length", "modified"], "left_anti")
        batch = [r["path"] for r in candidates.select("path").orderBy("path").limit(files_per_load).collect()]
        if not batch:
            return Loaded(loads, files)
        done = batch[-1]
        found = _listing(spark, stage, pattern, recursive).where(F.col("path").isin(batch))
        if digest:
            bodies = spark.read.format("binaryFile").load(batch)
            hashed = bodies.select("path", F.sha2("content", 256).alias("digest"))
            found = found.join(hashed, "path")
            if not force:
                found = found.join(noted, ["path", "digest"], "left_anti")
            batch = [r["path"] for r in found.select("path").collect()]
            if not batch:
                continue
        else:
            found = found.withColumn("digest", F.lit(None).cast("string"))
        load = new_load()
        try:
            rows = load_stage(spark, files=batch)
            rows.withColumn("source_file", F.col("_metadata.file_path")).write.parquet(load_path(root, load))
            notes = found.withColumn("forced", F.lit(force)).select("path", "uri", "length", "modified", "digest", "forced")
            notes.write.parquet(notes_path(root, load))
            publish(spark, root, load, after=based_on)
        except Exception:
            discard(spark, root, load)
            raise
        loads.append(load)
        files += len(batch)


def read_loaded(spark: SparkSession, root: str, latest: bool = False) -> DataFrame:
    """All rows loaded so far, with ``source_file`` and ``load_number``; a file
    loaded twice has its rows twice.  With ``latest`` only the rows of each
    file's newest load."""
    loads = versions(spark, root)
    if not loads:
        raise FileNotFoundError(f"nothing has been loaded into {root}")
    reader = spark.read.option("mergeSchema", True).option("basePath", f"{root.rstrip('/')}/data")
    rows = reader.parquet(*[load_path(root, load) for _, load in loads])
    rows = rows.join(_numbers(spark, loads), "load").drop("load").withColumnRenamed("number", "load_number")
    if latest:
        newest = read_ledger(spark, root).groupBy(F.col("uri").alias("source_file")).agg(F.max("number").alias("load_number"))
        rows = join_files(rows, newest, ["source_file", "load_number"])
    return rows
