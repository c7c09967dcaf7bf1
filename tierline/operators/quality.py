"""Data-quality reports and key tests.

Reports are computed as *one* aggregate row over the input (one scan, any
number of columns) and then unpivoted to long form, instead of one job per
column.  Test results use the shape ``failures, should_warn, should_error``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Raise ``ValueError`` naming every missing column; else return ``df``.

    Checks the schema only (no job).
    """
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"Required columns are missing: {missing}")
    return df


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, null_count`` for each column, from a single scan."""
    cols = list(columns) if columns is not None else df.columns
    if not cols:
        raise ValueError("null_profile needs at least one column")
    wide = df.agg(*[F.count_if(_q(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "null_count")


def missing_report(
    df: DataFrame,
    columns: Sequence[str],
    check: str = "Missing values",  # fixed output value
) -> DataFrame:
    """``check, column, total_records, missing_records, status`` with
    ``status = PASS`` when nothing is missing.  Required columns are checked
    first (``ValueError`` if absent)."""
    require_columns(df, columns)
    cols = list(columns)
    wide = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(_q(c).isNull()).alias(c) for c in cols],
    )
    long = wide.unpivot(["total_records"], cols, "column", "missing_records")
    return long.select(
        F.lit(check).alias("check"),
        "column",
        "total_records",
        "missing_records",
        F.when(F.col("missing_records") == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def out_of_range(columns: Sequence[str], lo: float, hi: float) -> Column:
    """True when any of ``columns`` is non-NULL and outside ``[lo, hi]``."""
    parts = [_q(c).isNotNull() & ~_q(c).between(lo, hi) for c in columns]
    return reduce(lambda a, b: a | b, parts)


def range_violations(
    df: DataFrame,
    checks: Mapping[str, tuple[Sequence[str], float, float]],
) -> DataFrame:
    """Rows that violate at least one named range check, with one boolean
    column per check (``check name -> (columns, lo, hi)``)."""
    if not checks:
        raise ValueError("range_violations needs at least one check")
    flags = {name: out_of_range(cols, lo, hi) for name, (cols, lo, hi) in checks.items()}
    any_bad = reduce(lambda a, b: a | b, flags.values())
    return df.withColumns(flags).filter(any_bad)


def range_report(
    df: DataFrame,
    checks: Mapping[str, tuple[Sequence[str], float, float]],
) -> DataFrame:
    """``check, columns, total_records, invalid_records, status`` per check,
    all checks from one scan."""
    names = list(checks)
    if not names:
        raise ValueError("range_report needs at least one check")
    wide = df.agg(
        F.count(F.lit(1)).alias("__total"),
        *[F.count_if(out_of_range(cols, lo, hi)).alias(n) for n, (cols, lo, hi) in checks.items()],
    )
    long = wide.unpivot(["__total"], names, "check", "invalid_records")
    cols_text = F.create_map(*[F.lit(x) for n in names for x in (n, ",".join(checks[n][0]))])
    return long.select(
        "check",
        cols_text[F.col("check")].alias("columns"),
        F.col("__total").alias("total_records"),
        "invalid_records",
        F.when(F.col("invalid_records") == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def _test_row(failures: Column) -> list[Column]:
    f = failures.cast("long")
    return [f.alias("failures"), (f != 0).alias("should_warn"), (f != 0).alias("should_error")]


def not_null_test(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL, counted as ``failures``."""
    return df.agg(*_test_row(F.count_if(_q(column).isNull())))


def repeated_keys(df: DataFrame, column: str, hashed: Column | None = None) -> DataFrame:
    """Non-NULL values of ``column`` that occur more than once, with their
    ``n_records``.

    For keys wider than a hash (long text) this is done in two phases: 64-bit
    hashes are counted first, so the shuffle carries 8 bytes a key instead of
    the text; then only rows whose hash repeats are grouped by their value,
    which sorts out different values of one hash.  Numbers and dates are no
    wider than a hash and are counted as they are.  ``hashed`` is the hash to
    use (tests force collisions with it).
    """
    key = _q(column)
    rows = df.filter(key.isNotNull()).select(key)
    if hashed is None and not isinstance(df.schema[column].dataType, StringType | BinaryType):
        return _counted(rows, column)
    hashed = F.xxhash64(key) if hashed is None else hashed
    again = _counted(rows.select(hashed.alias("__hash")), "__hash").select("__hash")
    suspects = rows.withColumn("__hash", hashed).join(again, "__hash", "left_semi")
    return _counted(suspects.select(key), column)


def _counted(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(_q(column)).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def unique_test(df: DataFrame, column: str) -> DataFrame:
    """Number of non-NULL key values that occur more than once."""
    return repeated_keys(df, column).agg(*_test_row(F.count(F.lit(1))))


def run_tests(
    models: Mapping[str, DataFrame],
    tests: Sequence[tuple[str, str, str]],
) -> DataFrame:
    """Run ``(model, column, test)`` specs, ``test`` in {not_null, unique}.

    All ``not_null`` tests of one model share one scan; each ``unique`` test
    is one grouped aggregate.  Result: ``model, column, test, failures,
    should_warn, should_error``.
    """
    if not tests:
        raise ValueError("run_tests needs at least one test")
    parts: list[DataFrame] = []
    by_model: dict[str, list[str]] = {}
    for model, column, test in tests:
        if test == "not_null":
            by_model.setdefault(model, []).append(column)
        elif test == "unique":
            parts.append(
                unique_test(models[model], column).select(
                    F.lit(model).alias("model"),
                    F.lit(column).alias("column"),
                    F.lit("unique").alias("test"),
                    "failures",
                    "should_warn",
                    "should_error",
                )
            )
        else:
            raise ValueError(f"unknown test {test!r}")
    for model, columns in by_model.items():
        wide = models[model].agg(*[F.count_if(_q(c).isNull()).alias(c) for c in columns])
        long = wide.unpivot([], list(columns), "column", "failures")
        parts.append(
            long.select(
                F.lit(model).alias("model"),
                "column",
                F.lit("not_null").alias("test"),
                *_test_row(F.col("failures")),
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


def expect_count(
    actual: DataFrame,
    expected: int | DataFrame,
    check: str = "row count",
) -> DataFrame:
    """``check, expected, actual, status`` comparing the row count of
    ``actual`` with a number or with the row count of another DataFrame."""
    got = actual.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(None).cast("long").alias("expected"), F.col("n").alias("actual")
    )
    if isinstance(expected, DataFrame):
        want = expected.agg(F.count(F.lit(1)).alias("n")).select(
            F.col("n").alias("expected"), F.lit(None).cast("long").alias("actual")
        )
        both = want.unionByName(got).agg(
            F.max("expected").alias("expected"), F.max("actual").alias("actual")
        )
    else:
        both = got.select(F.lit(int(expected)).cast("long").alias("expected"), "actual")
    return both.select(
        F.lit(check).alias("check"),
        "expected",
        "actual",
        F.when(F.col("expected") == F.col("actual"), "PASS").otherwise("FAIL").alias("status"),
    )
