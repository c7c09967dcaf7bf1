"""The places (treks) instance: messy CSV (bronze) -> typed, de-duplicated
rows with parsed duration ranges, split into complete and quarantined
(silver) -> categories, standardised labels and parsed costs (gold) ->
count per difficulty.  Also the ingest-side quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.parse import null_sentinels
from tierline.functions.rules import bucketize, standardize_label
from tierline.operators.audit import StageMetrics
from tierline.operators.clean import (
    coerce_columns,
    complete_condition,
    dedupe,
    drop_empty_columns,
    drop_empty_rows,
    drop_unnamed_columns,
    split_complete,
    with_delta,
    with_money_range,
    with_parsed_range,
)
from tierline.operators.quality import expect_count, missing_report, range_report, require_columns
from tierline.operators.summarize import count_by
from tierline.sources.files import read_csv
from tierline.sources.sinks import stage_table, write_csv, write_parquet, write_split

# --- fixed values (must equal the reference's results) ---------------------
REQUIRED_COLUMNS = [
    "trek_id", "trek_name", "category", "starting_point", "start_lat", "start_lon",
    "start_elevation", "ending_point", "end_lat", "end_lon", "end_elevation",
    "distance_km", "duration_days", "difficulty", "best_season", "approx_cost",
]
NUMERIC_COLUMNS = [
    "start_lat", "start_lon", "start_elevation", "end_lat", "end_lon", "end_elevation",
    "distance_km",
]
REPORT_COLUMNS = [
    "start_lat", "start_lon", "start_elevation", "end_lat", "end_lon", "end_elevation",
]
LOCATION_COLUMNS = ["start_lat", "start_lon", "end_lat", "end_lon"]
COORDINATE_CHECKS = {
    "latitude": (["start_lat", "end_lat"], -90, 90),
    "longitude": (["start_lon", "end_lon"], -180, 180),
}
# What a row needs to leave the quarantine.
NEEDED_COLUMNS = ["trek_id", *LOCATION_COLUMNS]
DIFFICULTY_LABELS = [
    "Easy", "Easy-Moderate", "Moderate", "Moderate-Difficult", "Difficult",
    "Very Difficult", "Extreme", "Hard",
]
DISTANCE_BOUNDS = [10, 20]
DURATION_BOUNDS = [2, 5]
LENGTH_LABELS = ["Short", "Medium", "Long"]
UNKNOWN = "Unknown"
GOLD_COLUMNS = [
    "trek_id", "trek_name", "category", "starting_point", "start_lat", "start_lon",
    "start_elevation", "ending_point", "end_lat", "end_lon", "end_elevation",
    "elevation_gain_m", "distance_km", "distance_category", "duration_days",
    "duration_min_days", "duration_max_days", "duration_avg_days", "duration_category",
    "difficulty", "best_season", "approx_cost", "cost_min", "cost_max",
]
# ---------------------------------------------------------------------------


def read_treks(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """Bronze CSV; every column read as text (no inference pass), the parsers
    below do the typing.  Quoted cells may hold line breaks: ``multi_line``
    says whether some do (a file is then one task); by default the lines are
    looked at first, and a feed without any is split."""
    return read_csv(spark, path, multi_line=multi_line)


def treks_silver_all(
    bronze: DataFrame,
    key_order: list | None = None,
    sentinels: list[str] | None = None,
) -> DataFrame:
    """Bronze -> typed rows (before the completeness split).

    One row per ``trek_id`` survives, compared as text: ``7`` and ``007`` are
    two places, and so are two ids that are no numbers.  Without ``key_order``
    the survivor is the smallest row in the order of its remaining columns: a
    total order, so the choice does not depend on partitioning or task timing.
    ``trek_id`` is then typed; ``trek_id_text`` keeps what the feed had.
    Sentinel text (e.g. ``needs_verification``) always becomes NULL in the
    numeric columns; pass ``sentinels`` to NULL it in the text columns too
    (by default text keeps it, as the original flow does).
    """
    df = drop_unnamed_columns(bronze)
    if sentinels:
        text_cols = [c for c in df.columns if c not in NUMERIC_COLUMNS and c != "trek_id"]
        df = df.withColumns({c: null_sentinels(c, sentinels) for c in text_cols})
    order = key_order if key_order is not None else [c for c in df.columns if c != "trek_id"]
    df = dedupe(df, ["trek_id"], order)
    df = df.withColumns({"trek_id_text": F.col("trek_id"), "trek_id": F.col("trek_id").try_cast("long")})
    df = coerce_columns(df, NUMERIC_COLUMNS)
    return with_parsed_range(
        df, "duration_days", "duration_min_days", "duration_max_days", "duration_avg_days"
    )


def treks_silver(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(silver, quarantine): rows with a key and complete coordinates vs the
    rest."""
    return tuple(split_complete(treks_silver_all(bronze), NEEDED_COLUMNS))


def treks_gold(silver: DataFrame) -> DataFrame:
    df = with_delta(silver, "end_elevation", "start_elevation", "elevation_gain_m").withColumns(
        {
            "distance_category": bucketize(
                "distance_km", DISTANCE_BOUNDS, LENGTH_LABELS, "lt", null_label=UNKNOWN
            ),
            "duration_category": bucketize(
                "duration_max_days", DURATION_BOUNDS, LENGTH_LABELS, "le", null_label=UNKNOWN
            ),
            "difficulty": standardize_label("difficulty", DIFFICULTY_LABELS),
        }
    )
    df = with_money_range(df, "approx_cost", "cost_min", "cost_max")
    return df.select(*GOLD_COLUMNS)


def difficulty_summary(gold: DataFrame) -> DataFrame:
    return count_by(gold, "difficulty", "trek_count")


def ingest_quality(bronze: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The ingest-side checks: drop all-NULL columns and rows, require the
    16 columns, coerce the coordinates, then (missing report, coordinate
    range report, cleaned rows).  The rows are written once to the shared
    scratch folder; the reports and whoever uses the cleaned rows read that,
    not the CSV again."""
    bronze = stage_table(bronze, "trek-feed")
    df = drop_empty_rows(drop_empty_columns(bronze))
    require_columns(df, REQUIRED_COLUMNS)
    df = coerce_columns(df, REPORT_COLUMNS)
    return missing_report(df, REPORT_COLUMNS), range_report(df, COORDINATE_CHECKS), df


def run_treks(spark: SparkSession, csv_path: str, out_root: str, expected: DataFrame | None = None) -> dict:
    """Bronze CSV -> silver (+ quarantine, one scan) -> gold + summary.

    Counts are observed on the writes.  Returns paths, counts and checks: gold
    has as many rows as silver and, if ``expected`` is given, silver as many
    as that.
    """
    metrics = StageMetrics()
    bronze = metrics.track(read_treks(spark, csv_path), "bronze")
    typed = treks_silver_all(bronze)
    typed = metrics.track(typed, "deduped", complete=F.count_if(complete_condition(NEEDED_COLUMNS)))
    split_path = f"{out_root}/silver/treks"
    silver, _ = write_split(typed, NEEDED_COLUMNS, split_path)
    gold = metrics.track(treks_gold(silver), "gold")
    gold_path = write_parquet(gold, f"{out_root}/gold/treks")
    summary_path = write_parquet(
        difficulty_summary(spark.read.parquet(gold_path)), f"{out_root}/gold/treks_summary"
    )
    checks = expect_count(silver, spark.read.parquet(gold_path), "gold equals silver")
    if expected is not None:
        checks = checks.unionByName(expect_count(expected, silver, "silver equals expected"))
    return {
        "silver": f"{split_path}/is_complete=true",
        "skipped": f"{split_path}/is_complete=false",
        "split": split_path,
        "gold": gold_path,
        "summary": summary_path,
        "checks": [r.asDict() for r in checks.collect()],
        "counts": metrics.counts(),
        "complete": int(metrics.get("deduped")["complete"]),
    }


def run_trek_ingest(spark: SparkSession, csv_path: str, out_root: str) -> dict:
    """The ingest-side run: quality and coordinate reports plus the valid /
    skipped split, all written as CSV with a header.

    The split is one scan: rows are flagged and written with
    ``partitionBy(is_complete)``.
    """
    missing, ranges, cleaned = ingest_quality(read_treks(spark, csv_path))
    report_path = write_csv(missing, f"{out_root}/trek_quality_report")
    range_path = write_csv(ranges, f"{out_root}/trek_coordinate_report")
    split_path = f"{out_root}/treks_split"
    flagged = cleaned.withColumn("is_complete", complete_condition(LOCATION_COLUMNS))
    write_csv(flagged, split_path, partition_by=["is_complete"])
    return {
        "quality_report": report_path,
        "coordinate_report": range_path,
        "valid": f"{split_path}/is_complete=true",
        "skipped": f"{split_path}/is_complete=false",
    }
