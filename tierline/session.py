"""Spark session defaults and the shared scratch location.

Every operator in this package is a ``DataFrame -> DataFrame`` function, so
the session is the only global state.  ``get_session`` pins the settings the
operators rely on (UTC wall clock, ANSI on, AQE with skew-join splitting);
``scratch_path`` hands out folders under the cluster's shared
``spark.checkpoint.dir`` for the few steps that must materialise data.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every pipeline in this package assumes.  Shuffle partition count
# is deliberately *not* fixed here: it belongs to the cluster (AQE coalesces
# small partitions at runtime anyway).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(
    app_name: str = "tierline",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or create) a session with the package defaults applied.

    ``master`` is only set when given, so on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # Runtime SQL confs also apply to an already-running session.
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by whoever launches the job and points at shared
    storage every executor can reach; without it this raises, as a folder on
    the driver's disk is none that executors could write to.  Only a
    single-process session (tests, a laptop) gets a temporary folder of its
    own, registered so that ``DataFrame.checkpoint()`` works too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if sc is None or not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tierline-ckpt-")
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root.

    Never reused between calls, so concurrent or retried runs cannot read
    each other's half-written output.
    """
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/tierline"


def remove_scratch(spark: SparkSession, path: str | None = None) -> bool:
    """Delete one folder that :func:`scratch_path` named, or all of them.

    Folders stay until this is called, as results read from them may still be
    in use; call it when a run's results have been written elsewhere.
    """
    root = scratch_root(spark)
    path = path or root
    if path != root and not path.startswith(f"{root}/"):
        raise ValueError(f"{path} is not below {root}")
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet to a fresh folder under the shared
    ``spark.checkpoint.dir`` and return it read back.

    Use it where several later steps read the same expensive result (e.g.
    a de-duplicated layer): they then share one computation and one shuffle,
    and the lineage is cut, so a lost executor never forces the upstream
    stages to re-run.  Unlike ``DataFrame.checkpoint`` it computes the input
    once (an RDD checkpoint re-runs its job unless cached) and needs no
    memory for caching.  The folder stays until
    :func:`remove_scratch` is called.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
