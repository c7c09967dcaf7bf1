"""Run auditing: stage row counts, layer reconciliation and ingest ledgers.

Counts are taken either with :class:`StageMetrics` (``DataFrame.observe``:
the count rides along the job that writes the data, no extra scan) or as a
lazy DataFrame of per-stage counts (:func:`stage_report`,
:func:`reconcile`) that runs as one job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class StageMetrics:
    """Row counts per pipeline stage, collected as observed metrics.

    ``df = metrics.track(df, "silver")`` attaches a ``count`` to the plan;
    the value is filled in by whichever action next runs that plan (usually
    the write), so counting costs no job of its own.  Extra named aggregate
    expressions (e.g. ``count_if(valid)``) can be observed alongside.

    Observed metrics are accumulated per task: a count in the writing stage
    is exact, but one taken before a shuffle is counted again if Spark has
    to re-run map tasks whose shuffle output was lost with an executor.
    Use them for run logs; check layers with :func:`reconcile` over the
    written data.
    """

    def __init__(self) -> None:
        self._obs: dict[str, Observation] = {}

    def track(self, df: DataFrame, stage: str, **extra) -> DataFrame:
        obs = Observation(stage)
        self._obs[stage] = obs
        exprs = [F.count(F.lit(1)).alias("rows")]
        exprs += [expr.alias(name) for name, expr in extra.items()]
        return df.observe(obs, *exprs)

    def get(self, stage: str) -> dict:
        return dict(self._obs[stage].get)

    def counts(self) -> dict[str, int]:
        return {stage: int(obs.get["rows"]) for stage, obs in self._obs.items()}

    def removed(self, before: str, after: str) -> int:
        c = self.counts()
        return c[before] - c[after]

    def to_df(self, spark: SparkSession) -> DataFrame:
        """The observed counts as a small DataFrame (one row per stage)."""
        rows = [(i, s, n) for i, (s, n) in enumerate(self.counts().items())]
        return spark.createDataFrame(rows, "step int, stage string, records long")


#: A stage is a table, or the rows of a table under a condition.
Stage = DataFrame | tuple[DataFrame, Column]


def _wide_counts(stages: Mapping[str, Stage]) -> DataFrame:
    """One row with one count column per stage (``s0``, ``s1``, ...), built as
    a union of single-row aggregates merged by ``max`` - no join.  Stages that
    are given as conditions on one table are counted in one scan of it."""
    names = list(stages)
    if not names:
        raise ValueError("at least one stage is needed")
    tables: dict[int, tuple[DataFrame, dict[int, Column]]] = {}
    for i, name in enumerate(names):
        stage = stages[name]
        table, rows = stage if isinstance(stage, tuple) else (stage, None)
        count = F.count(F.lit(1)) if rows is None else F.count_if(rows)
        tables.setdefault(id(table), (table, {}))[1][i] = count
    parts = []
    for table, counts in tables.values():
        n = table.agg(*[c.alias(f"s{i}") for i, c in counts.items()])
        parts.append(
            n.select(
                *[(F.col(f"s{j}") if j in counts else F.lit(None).cast("long")).alias(f"s{j}") for j in range(len(names))]
            )
        )
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.agg(*[F.max(f"s{j}").alias(f"s{j}") for j in range(len(names))])


def stage_report(stages: Mapping[str, Stage]) -> DataFrame:
    """``step, stage, records, removed`` for stages given in pipeline order;
    ``removed`` is the drop from the previous stage (NULL for the first)."""
    names = list(stages)
    wide = _wide_counts(stages)
    rows = []
    for i, name in enumerate(names):
        removed = F.col(f"s{i-1}") - F.col(f"s{i}") if i else F.lit(None).cast("long")
        rows.append(
            F.struct(
                F.lit(i).alias("step"),
                F.lit(name).alias("stage"),
                F.col(f"s{i}").alias("records"),
                removed.alias("removed"),
            )
        )
    return wide.select(F.inline(F.array(*rows)))


def reconcile(
    stages: Mapping[str, Stage],
    equal: Sequence[tuple[str, str]] = (),
    nonempty: Sequence[str] = (),
) -> DataFrame:
    """Layer checks: ``check, stage, other_stage, records, other_records,
    status``.  ``equal`` pairs must have the same row count (e.g. gold vs
    silver); ``nonempty`` stages must have at least one row."""
    names = list(stages)
    if not equal and not nonempty:
        raise ValueError("reconcile needs at least one check")
    idx = {n: i for i, n in enumerate(names)}
    wide = _wide_counts(stages)
    rows = []
    for a, b in equal:
        ra, rb = F.col(f"s{idx[a]}"), F.col(f"s{idx[b]}")
        rows.append(
            F.struct(
                F.lit("equal_count").alias("check"),
                F.lit(a).alias("stage"),
                F.lit(b).alias("other_stage"),
                ra.alias("records"),
                rb.alias("other_records"),
                F.when(ra == rb, "PASS").otherwise("FAIL").alias("status"),
            )
        )
    for a in nonempty:
        ra = F.col(f"s{idx[a]}")
        rows.append(
            F.struct(
                F.lit("nonempty").alias("check"),
                F.lit(a).alias("stage"),
                F.lit(None).cast("string").alias("other_stage"),
                ra.alias("records"),
                F.lit(None).cast("long").alias("other_records"),
                F.when(ra > 0, "PASS").otherwise("FAIL").alias("status"),
            )
        )
    return wide.select(F.inline(F.array(*rows)))


#: Digest buckets of a content check.
BUCKETS = 4096


def _hash(columns: Sequence[str]) -> Column:
    """64 bits of a row.  The places of NULLs are hashed as well, as the hash
    function passes over them."""
    cols = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(*cols, *[c.isNull() for c in cols])


def _halves(h: Column, name: str, sign: Column) -> list[Column]:
    """Signed sums of both halves of 64-bit hashes: they add up whatever the
    order, repeats count, and they don't overflow below 2 ** 31 rows a group."""
    low, high = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)
    return [F.sum(sign * low).alias(f"{name}_low"), F.sum(sign * high).alias(f"{name}_high")]


def reconcile_content(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Keys whose rows differ between two tables that should hold the same:
    ``*keys, left_rows, right_rows, columns, status``.

    ``columns`` (default: all of ``left`` but the keys) are compared, ``columns``
    of the result names those that differ; ``status`` is ``only_left``,
    ``only_right`` or ``differs``.  Equal tables give no rows.  Rows of a key
    are compared as a multiset; NULL keys are a key.  For rows that differ
    only in how values of several rows of a key are combined, ``columns`` is
    empty.

    First both tables are reduced to one digest per key bucket (a shuffle of
    at most ``buckets`` narrow rows per task).  Only rows of buckets that
    differ, of which there are ``buckets`` at most, go on to a grouping by
    key, as hashes; nothing is joined.  Two contents of a bucket or key with
    equal 64-bit digest sums count as equal.
    """
    keys = list(keys)
    columns = [c for c in left.columns if c not in keys] if columns is None else list(columns)
    named = {f"__k{i}": F.col(f"`{k}`") for i, k in enumerate(keys)}
    bucket = F.pmod(F.xxhash64(*named.values(), *[c.isNull() for c in named.values()]), F.lit(buckets))

    def hashed(df: DataFrame, sign: int) -> DataFrame:
        parts = {f"__c{i}": _hash([c]) for i, c in enumerate(columns)}
        return df.select(
            *[c.alias(n) for n, c in named.items()],
            bucket.alias("__bucket"),
            F.lit(sign).cast("long").alias("__sign"),
            _hash([*keys, *columns]).alias("__row"),
            *[h.alias(n) for n, h in parts.items()],
        )

    sides = [hashed(left, 1), hashed(right, -1)]
    sign = F.col("__sign")
    both = sides[0].unionByName(sides[1])
    whole = [F.sum("__sign").alias("rows_diff"), *_halves(F.col("__row"), "row", sign)]
    differs = (F.col("rows_diff") != 0) | (F.col("row_low") != 0) | (F.col("row_high") != 0)
    digests = both.groupBy("__bucket").agg(*whole).where(differs).select("__bucket")
    # Bounded by the number of buckets.
    suspects = both.join(F.broadcast(digests), "__bucket", "left_semi")
    per_column = [col for i in range(len(columns)) for col in _halves(F.col(f"__c{i}"), f"c{i}", sign)]
    per_key = (
        suspects.groupBy(*named)
        .agg(
            F.count_if(sign == 1).alias("left_rows"),
            F.count_if(sign == -1).alias("right_rows"),
            *whole,
            *per_column,
        )
        .where(differs)
    )
    names = [
        F.when((F.col(f"c{i}_low") != 0) | (F.col(f"c{i}_high") != 0), F.lit(c)).otherwise("") for i, c in enumerate(columns)
    ]
    changed = F.array_remove(F.array(*names).cast("array<string>"), "")
    status = F.when(F.col("right_rows") == 0, "only_left").when(F.col("left_rows") == 0, "only_right").otherwise("differs")
    return per_key.select(
        *[F.col(n).alias(k) for n, k in zip(named, keys, strict=True)],
        "left_rows",
        "right_rows",
        changed.alias("columns"),
        status.alias("status"),
    )


def ingest_ledger(
    expected: DataFrame,
    landed: DataFrame,
    key: str,
    carry: Sequence[str] = (),
    file_col: str | None = None,
) -> DataFrame:
    """Per expected key: did anything land?

    Output: ``key, *carry, status (SUCCESS|FAILED), landed_records`` and,
    with ``file_col``, ``landed_file`` (the smallest landed file name).
    ``landed`` is aggregated to one row per key *before* the join (map-side
    partial aggregation), so the join is 1:1 and a key that landed a third
    of all rows is no hotter than any other.
    """
    aggs = [F.count(F.lit(1)).alias("landed_records")]
    if file_col:
        aggs.append(F.min(file_col).alias("landed_file"))
    per_key = landed.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    out = expected.select(key, *carry).join(per_key, key, "left")
    cols = [
        F.col(key),
        *[F.col(c) for c in carry],
        F.when(F.col("landed_records") > 0, "SUCCESS").otherwise("FAILED").alias("status"),
        F.coalesce(F.col("landed_records"), F.lit(0).cast("long")).alias("landed_records"),
    ]
    if file_col:
        cols.append(F.col("landed_file"))
    return out.select(*cols)


def ledger_summary(ledger: DataFrame, status_col: str = "status") -> DataFrame:
    """``expected, succeeded, failed, verdict`` in one row; the verdict is
    SUCCESS when all succeeded, PARTIAL when some did, else FAILED."""
    s = F.col(status_col)
    agg = ledger.agg(
        F.count(F.lit(1)).alias("expected"),
        F.count_if(s == "SUCCESS").alias("succeeded"),
        F.count_if(s != "SUCCESS").alias("failed"),
    )
    return agg.withColumn(
        "verdict",
        F.when((F.col("succeeded") == F.col("expected")) & (F.col("failed") == 0), "SUCCESS")
        .when(F.col("succeeded") > 0, "PARTIAL")
        .otherwise("FAILED"),
    )
