"""Folders whose content changes in one step.

A load is written to a fresh folder, ``root/data/load=<id>``, and becomes part
of the table with one small file, ``root/_versions/<number>-<id>``.  Until that
file is there the load does not exist for readers, so a run that is killed, or
whose job fails, leaves the last good rows as they were; a reader that has
resolved its folders keeps reading them while others publish.  Numbers are
claimed with an exclusive create (``root/_claims/<number>``), so two writers
never publish the same one, and a writer can insist on being the next after
the version that it has read.

Three kinds of table use it:

* :func:`replace_parquet` / :func:`read_current`: the newest load is the table;
* :mod:`tierline.sources.ledger`: all loads together are the table;
* :mod:`tierline.sources.merge`: a manifest names the load of each partition.

What the driver handles is names of loads and folders, never rows.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tierline.sources.sinks import write_parquet

#: Folders that no version names are removed when they are older than this.
ORPHAN_SECONDS = 24 * 3600


class ConflictError(RuntimeError):
    """Another writer has published since the version this one is based on."""


def _fs(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _fs(spark, folder)
    if not fs.exists(path(folder)):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path(folder)))


def new_load() -> str:
    """A fresh id (it starts with a letter, so that it never reads as a number)."""
    return f"v{uuid.uuid4().hex[:16]}"


def load_path(root: str, load: str) -> str:
    return f"{root.rstrip('/')}/data/load={load}"


def versions(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, load) of every published version, oldest first."""
    return [(int(n), load) for n, _, load in (v.partition("-") for v in _names(spark, f"{root}/_versions"))]


def last_number(spark: SparkSession, root: str) -> int:
    """The highest number claimed so far (0 if none); a claim whose writer
    died before it published is a number without a version."""
    names = _names(spark, f"{root}/_claims")
    return int(names[-1]) if names else 0


def publish(spark: SparkSession, root: str, load: str, after: int | None = None) -> int:
    """Make a written load the next version and return its number.  With
    ``after`` it must be the one right after that number, else
    :class:`ConflictError` is raised; without, the next free number is taken."""
    fs, path = _fs(spark, root)
    number = (last_number(spark, root) if after is None else after) + 1
    while True:
        try:
            fs.create(path(f"{root}/_claims/{number:012d}"), False).close()
            break
        except Exception as e:
            if "AlreadyExists" not in str(e):
                raise
            if after is not None:
                raise ConflictError(f"version {number} of {root} has been published or claimed by another writer") from None
            number += 1
    fs.create(path(f"{root}/_versions/{number:012d}-{load}"), False).close()
    return number


def notes_path(root: str, load: str) -> str:
    """Where a load keeps what it notes about itself (files, manifest)."""
    return f"{root.rstrip('/')}/_notes/load={load}"


def discard(spark: SparkSession, root: str, load: str) -> None:
    """Remove the folders of a load that is not published (any more)."""
    fs, path = _fs(spark, root)
    for folder in (load_path(root, load), notes_path(root, load)):
        fs.delete(path(folder), True)


def replace_parquet(
    df: DataFrame, root: str, partition_by: Sequence[str] | None = None, keep: int = 2, max_records_per_file: int | None = None
) -> int:
    """Replace the table at ``root`` by the rows of ``df``, which may be read
    from that table.  The last ``keep`` versions stay on disk, for readers that
    have resolved them and for :func:`read_current` with a number."""
    spark = df.sparkSession
    load = new_load()
    write_parquet(df, load_path(root, load), partition_by=partition_by, max_records_per_file=max_records_per_file)
    number = publish(spark, root, load)
    expire(spark, root, keep)
    return number


def current_path(spark: SparkSession, root: str, number: int | None = None) -> str:
    """The folder of the newest version, or of one by its number."""
    found = dict(versions(spark, root))
    if not found:
        raise FileNotFoundError(f"{root} has no published version")
    number = max(found) if number is None else number
    if number not in found:
        raise FileNotFoundError(f"{root} has no version {number}; there are {sorted(found)}")
    return load_path(root, found[number])


def read_current(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The rows of the newest version (or of one by its number)."""
    return spark.read.parquet(current_path(spark, root, number))


def expire(spark: SparkSession, root: str, keep: int = 2, orphan_seconds: float = ORPHAN_SECONDS) -> list[str]:
    """Forget all but the last ``keep`` versions, and folders that were never
    published and are older than ``orphan_seconds`` (left by killed runs).
    Returns the loads removed.  A version's name goes before its folder."""
    if keep < 1:
        raise ValueError("the newest version is always kept")
    fs, path = _fs(spark, root)
    found = versions(spark, root)
    old, kept = found[:-keep], {load for _, load in found[-keep:]}
    for number, load in old:
        fs.delete(path(f"{root}/_versions/{number:012d}-{load}"), False)
    removed = [load for _, load in old]
    if fs.exists(path(f"{root}/data")):
        limit = (time.time() - orphan_seconds) * 1000
        for status in fs.listStatus(path(f"{root}/data")):
            load = status.getPath().getName().partition("=")[2]
            if load not in kept and load not in removed and status.getModificationTime() < limit:
                removed.append(load)
    for load in removed:
        discard(spark, root, load)
    return removed
