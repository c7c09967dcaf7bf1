"""The hourly-weather instance: JSON documents with parallel hourly arrays
(bronze) -> one row per (entity, hour) (silver) -> categories, condition
score and status (gold) -> one summary row per entity.

Everything is expressed with the generic operators; this module only holds
the configuration and the column names of this feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tierline.functions.parse import parse_event_time, rounded_avg, rounded_sum
from tierline.functions.rules import bucketize, flag_any, rollup_status, score, status_band
from tierline.operators.audit import StageMetrics, ingest_ledger, ledger_summary, reconcile
from tierline.operators.clean import dedupe
from tierline.operators.nested import zip_explode
from tierline.operators.quality import null_profile, require_columns
from tierline.operators.state import Measure, finish, partials, read_state, update_state
from tierline.operators.summarize import entity_summary, key_profile
from tierline.sources.files import read_csv, read_json_docs
from tierline.sources.sinks import write_csv, write_parquet

# --- fixed values (must equal the reference's results) ---------------------
TEMPERATURE_BOUNDS = [5, 15, 25, 35]
TEMPERATURE_LABELS = ["Very Cold", "Cold", "Moderate", "Warm", "Very Hot"]
PRECIPITATION_ZERO_LABEL = "No Rain"
PRECIPITATION_BOUNDS = [2.5, 7.5]
PRECIPITATION_LABELS = ["Light Rain", "Moderate Rain", "Heavy Rain"]
WIND_BOUNDS = [20, 40, 60]
WIND_LABELS = ["Low", "Moderate", "Strong", "Very Strong"]
VISIBILITY_BOUNDS = [1000, 5000, 10000]
VISIBILITY_LABELS = ["Very Low", "Low", "Moderate", "Good"]
SCORE_LADDERS = [
    ("precipitation_mm", [(">", 7.5, 30), (">", 2.5, 15)]),
    ("wind_speed_kmh", [(">=", 60, 30), (">=", 40, 15)]),
    ("visibility_m", [("<", 1000, 25), ("<", 5000, 10)]),
    ("temperature_c", [("<", 0, 15), (">", 40, 15)]),
]
RED = "Red - High Risk"
YELLOW = "Yellow - Caution"
GREEN = "Green - Normal"
STATUS_BANDS = [(50, RED), (25, YELLOW)]
# Hourly array fields of the document -> silver column names.
HOURLY_FIELDS = {
    "weather_time_text": "time",
    "temperature_c": "temperature_2m",
    "humidity_pct": "relative_humidity_2m",
    "precipitation_mm": "precipitation",
    "visibility_m": "visibility",
    "wind_speed_kmh": "wind_speed_10m",
    "wind_gust_kmh": "wind_gusts_10m",
}
SILVER_COLUMNS = [
    "trek_id", "trek_name", "latitude", "longitude", "elevation", "weather_time",
    "temperature_c", "humidity_pct", "precipitation_mm", "visibility_m",
    "wind_speed_kmh", "wind_gust_kmh", "source_file", "weather_date",
]
SILVER_CHECK_COLUMNS = [
    "trek_id", "trek_name", "latitude", "longitude", "weather_time", "temperature_c",
    "humidity_pct", "precipitation_mm", "visibility_m", "wind_speed_kmh", "wind_gust_kmh",
]
GOLD_COLUMNS = [
    "trek_id", "trek_name", "latitude", "longitude", "elevation", "weather_date",
    "weather_time", "temperature_c", "humidity_pct", "precipitation_mm",
    "visibility_m", "wind_speed_kmh", "wind_gust_kmh", "temperature_category",
    "precipitation_category", "wind_category", "visibility_category",
    "condition_score", "condition_status", "source_file",
]
# Only the document's fields that the pipeline uses: the reader never builds
# the unused ``current`` / ``*_units`` blocks or the extra hourly arrays.
DOC_SCHEMA = StructType(
    [
        StructField("trek_id", LongType()),
        StructField("trek_name", StringType()),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        StructField("elevation", DoubleType()),
        StructField(
            "hourly",
            StructType(
                [
                    StructField("time", ArrayType(StringType())),
                    StructField("temperature_2m", ArrayType(DoubleType())),
                    StructField("relative_humidity_2m", ArrayType(LongType())),
                    StructField("precipitation", ArrayType(DoubleType())),
                    StructField("visibility", ArrayType(DoubleType())),
                    StructField("wind_speed_10m", ArrayType(DoubleType())),
                    StructField("wind_gusts_10m", ArrayType(DoubleType())),
                ]
            ),
        ),
    ]
)

# The columns of the summary, in order: kind and source column.
SUMMARY_MEASURES = {
    "weather_records": ("rows", None),
    "avg_temperature_c": ("avg", "temperature_c"),
    "min_temperature_c": ("min", "temperature_c"),
    "max_temperature_c": ("max", "temperature_c"),
    "avg_humidity_pct": ("avg", "humidity_pct"),
    "total_precipitation_mm": ("sum", "precipitation_mm"),
    "avg_visibility_m": ("avg", "visibility_m"),
    "min_visibility_m": ("min", "visibility_m"),
    "max_wind_speed_kmh": ("max", "wind_speed_kmh"),
    "max_wind_gust_kmh": ("max", "wind_gust_kmh"),
    "avg_condition_score": ("avg", "condition_score"),
}
SUMMARY_FLAGS = {"has_red_condition": RED, "has_yellow_condition": YELLOW}
ENTITY = ["trek_id", "trek_name"]
# What the list of expected places must have.
PLACE_COLUMNS = ["trek_id", "trek_name", "start_lat", "start_lon"]
# ---------------------------------------------------------------------------


def summary_measures() -> dict[str, Measure]:
    flags = {name: Measure("any", condition=F.col("condition_status") == status) for name, status in SUMMARY_FLAGS.items()}
    return {name: Measure(kind, column) for name, (kind, column) in SUMMARY_MEASURES.items()} | flags


def read_weather_docs(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return read_json_docs(spark, path, DOC_SCHEMA, multi_line=multi_line, source_col="source_file")


def flatten_weather(docs: DataFrame, position: str | None = None) -> DataFrame:
    """Documents -> one typed row per hour (NULL times kept, see
    :func:`weather_silver`).  ``position`` adds the 0-based hour index
    within the document."""
    keep = ["trek_id", "trek_name", "latitude", "longitude", "elevation", "source_file"]
    rows = zip_explode(
        docs,
        {out: F.col(f"hourly.{field}") for out, field in HOURLY_FIELDS.items()},
        keep=keep,
        position=position,
    )
    weather_time = parse_event_time("weather_time_text")
    return rows.select(
        "trek_id",
        "trek_name",
        "latitude",
        "longitude",
        "elevation",
        weather_time.alias("weather_time"),
        *[F.col(c).cast("double").alias(c) for c in list(HOURLY_FIELDS)[1:]],
        "source_file",
        F.to_date(weather_time).alias("weather_date"),
        *([position] if position else []),
    )


def weather_silver(docs: DataFrame, metrics: StageMetrics | None = None) -> DataFrame:
    """Flatten, drop rows whose time did not parse, keep one row per
    (trek_id, weather_time): deterministically the first by source file,
    then by position in the document."""
    flat = flatten_weather(docs, position="hour_index")
    if metrics:
        flat = metrics.track(flat, "flattened")
    valid = flat.filter(F.col("weather_time").isNotNull())
    if metrics:
        valid = metrics.track(valid, "valid_time")
    silver = dedupe(valid, ["trek_id", "weather_time"], order_by=["source_file", "hour_index"])
    if metrics:
        silver = metrics.track(silver, "silver")
    return silver.select(*SILVER_COLUMNS)


def weather_gold(silver: DataFrame, extra: list[str] | tuple = ()) -> DataFrame:
    """Add the four categories, the condition score and its status band.

    NULL readings fall into each ladder's last label and add 0 to the
    score, as the rules are written; pass ``null_label`` to
    :func:`bucketize` in a pipeline of your own for an explicit bucket.
    ``extra`` columns of the input are carried through after the gold ones.
    """
    out = silver.withColumns(
        {
            "temperature_category": bucketize("temperature_c", TEMPERATURE_BOUNDS, TEMPERATURE_LABELS, "lt"),
            "precipitation_category": bucketize(
                "precipitation_mm", PRECIPITATION_BOUNDS, PRECIPITATION_LABELS, "le",
                zero_label=PRECIPITATION_ZERO_LABEL,
            ),
            "wind_category": bucketize("wind_speed_kmh", WIND_BOUNDS, WIND_LABELS, "lt"),
            "visibility_category": bucketize("visibility_m", VISIBILITY_BOUNDS, VISIBILITY_LABELS, "lt"),
            "condition_score": score(SCORE_LADDERS),
        }
    )
    out = out.withColumn("condition_status", status_band("condition_score", STATUS_BANDS, GREEN))
    return out.select(*GOLD_COLUMNS, *extra)


def summary_aggregates(rounding: str = "exact") -> dict:
    """The per-entity aggregates.  ``rounding="exact"`` adds sums and averages
    up exactly before it rounds them (see
    :func:`tierline.functions.parse.rounded_sum`); ``"plain"`` is ``round(x, 2)``
    on the double, whose last digit can flip when summation noise sits on a
    boundary."""
    if rounding not in ("exact", "plain"):
        raise ValueError("rounding must be 'exact' or 'plain'")
    exact = rounding == "exact"
    made = {
        "rows": lambda m: F.count(F.lit(1)),
        "sum": lambda m: rounded_sum(m.column, m.scale) if exact else F.round(F.sum(m.column), m.scale),
        "avg": lambda m: rounded_avg(m.column, m.scale) if exact else F.round(F.avg(m.column), m.scale),
        "min": lambda m: F.round(F.min(m.column), m.scale),
        "max": lambda m: F.round(F.max(m.column), m.scale),
        "any": lambda m: flag_any(m.condition),
    }
    return {name: made[m.kind](m) for name, m in summary_measures().items()}


def _overall() -> dict:
    flags = [("has_red_condition", RED), ("has_yellow_condition", YELLOW)]
    return {"overall_condition": rollup_status(flags, GREEN)}


def weather_summary(
    gold: DataFrame, keys: list[str] | None = None, rounding: str = "exact"
) -> DataFrame:
    """One row per entity: counts, rounded averages / extremes, red and
    yellow flags, and the worst status (red > yellow > green).  An entity is
    an id and a name; give ``keys`` to have one row per id whatever its names
    (what a mart needs).  ``rounding="exact"`` adds sums and averages up exactly
    before it rounds them (:mod:`tierline.operators.state`), ``"plain"`` as
    :func:`summary_aggregates`."""
    keys = keys or ENTITY
    if rounding == "exact":
        measures = summary_measures()
        return finish(partials(gold, keys, measures), keys, measures).withColumns(_overall())
    return entity_summary(gold, keys, summary_aggregates(rounding), derived=_overall())


def update_weather_summary(gold: DataFrame, root: str, batch: str, keys: list[str] | None = None) -> bool:
    """Add a batch of hours to the summary kept at ``root``; False if a batch
    of that name is in it.  Reads the batch, not the hours before it."""
    return update_state(gold, root, batch, keys or ENTITY, summary_measures())


def read_weather_summary(spark: SparkSession, root: str, keys: list[str] | None = None) -> DataFrame:
    """The summary of all batches added so far, as :func:`weather_summary`
    gives it for all their hours at once."""
    return read_state(spark, root, keys or ENTITY, summary_measures()).withColumns(_overall())


def run_weather(
    spark: SparkSession,
    docs_path: str,
    out_root: str,
    multi_line: bool = True,
) -> dict:
    """Bronze JSON -> silver, gold (partitioned by date) and summary folders.

    Each layer is written once and the next layer reads the written files,
    so a lost executor only re-runs the tasks of the current layer; counts
    are observed on the writes (no extra jobs).  Returns paths, counts and the
    layer checks (key profile and null counts of silver; gold as long as
    silver, summary not empty), taken from the written layers.
    """
    metrics = StageMetrics()
    docs = metrics.track(read_weather_docs(spark, docs_path, multi_line), "documents")
    silver_path = f"{out_root}/silver/weather"
    write_parquet(weather_silver(docs, metrics), silver_path)
    silver = spark.read.parquet(silver_path)
    gold = metrics.track(weather_gold(silver), "gold")
    gold_path = f"{out_root}/gold/weather"
    write_parquet(gold, gold_path, partition_by=["weather_date"])
    written = read_gold(spark, gold_path)
    summary = metrics.track(weather_summary(written), "summary")
    summary_path = f"{out_root}/gold/weather_summary"
    write_parquet(summary, summary_path)
    keys, nulls = silver_checks(silver)
    checks = layer_checks(silver, written, spark.read.parquet(summary_path))
    return {
        "silver": silver_path,
        "gold": gold_path,
        "summary": summary_path,
        "counts": metrics.counts(),
        "keys": keys.first().asDict(),
        "nulls": {r["column"]: r["null_count"] for r in nulls.collect()},
        "checks": [r.asDict() for r in checks.collect()],
    }


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """The date-partitioned gold folder, columns in gold order."""
    return spark.read.parquet(path).select(*GOLD_COLUMNS)


def silver_checks(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``total_rows, unique_keys, null_keys`` of trek_id, NULL count per
    checked column) - two single-scan aggregates."""
    return key_profile(silver, "trek_id"), null_profile(silver, SILVER_CHECK_COLUMNS)


def layer_checks(silver: DataFrame, gold: DataFrame, summary: DataFrame) -> DataFrame:
    """Gold keeps every silver row; the summary is not empty."""
    return reconcile(
        {"silver": silver, "gold": gold, "summary": summary},
        equal=[("silver", "gold")],
        nonempty=["silver", "summary"],
    )


def weather_ingest_ledger(valid_places: DataFrame, docs: DataFrame) -> DataFrame:
    """Per expected place: did a weather document land for it?

    ``valid_places`` has ``trek_id, trek_name, start_lat, start_lon``;
    ``docs`` are bronze documents read with a ``source_file`` column.
    Output: ``trek_id, trek_name, latitude, longitude, status,
    landed_records, weather_file``.  Raises if ``valid_places`` lacks a column.
    """
    require_columns(valid_places, PLACE_COLUMNS)
    expected = valid_places.select(
        "trek_id", "trek_name",
        F.col("start_lat").alias("latitude"), F.col("start_lon").alias("longitude"),
    )
    landed = docs.select("trek_id", "source_file")
    out = ingest_ledger(
        expected, landed, "trek_id", carry=["trek_name", "latitude", "longitude"],
        file_col="source_file",
    )
    return out.withColumnRenamed("landed_file", "weather_file")


def run_ledger(spark: SparkSession, valid_places: DataFrame, docs_path: str, out_root: str) -> dict:
    """Write the ingest ledger as CSV and return its path and totals."""
    ledger = weather_ingest_ledger(valid_places, read_weather_docs(spark, docs_path))
    path = write_csv(ledger, f"{out_root}/weather_ingestion_ledger")
    written = read_csv(spark, path, schema=ledger.schema)
    return {"ledger": path, **ledger_summary(written).first().asDict()}
