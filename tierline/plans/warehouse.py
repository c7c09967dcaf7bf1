"""The warehouse side: load the gold folders as tables, remove keyless rows,
build the entity/weather mart and run the key tests on every model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.clean import drop_null_keys
from tierline.operators.mart import build_mart
from tierline.operators.quality import run_tests
from tierline.operators.summarize import key_profile
from tierline.plans.weather import weather_summary as weather_summary_rows
from tierline.sources.files import load_stage, register_sources
from tierline.sources.sinks import materialize

# --- fixed values (must equal the reference's results) ---------------------
# Weather columns the mart carries, in the mart's column order.
MART_WEATHER_COLUMNS = [
    "weather_records", "avg_temperature_c", "min_temperature_c", "max_temperature_c",
    "avg_humidity_pct", "weather_date", "weather_time", "temperature_c",
    "total_precipitation_mm", "humidity_pct", "avg_visibility_m", "min_visibility_m",
    "precipitation_mm", "visibility_m", "max_wind_speed_kmh", "max_wind_gust_kmh",
    "wind_speed_kmh", "avg_condition_score", "wind_gust_kmh", "has_red_condition",
    "temperature_category", "precipitation_category", "has_yellow_condition",
    "overall_condition",
]
SUMMARY_COLUMNS = [
    "weather_records", "avg_temperature_c", "min_temperature_c", "max_temperature_c",
    "avg_humidity_pct", "total_precipitation_mm", "avg_visibility_m", "min_visibility_m",
    "max_wind_speed_kmh", "max_wind_gust_kmh", "avg_condition_score",
    "has_red_condition", "has_yellow_condition", "overall_condition",
]
HOURLY_COLUMNS = [
    "weather_date", "weather_time", "temperature_c", "humidity_pct", "precipitation_mm",
    "visibility_m", "wind_speed_kmh", "wind_gust_kmh", "temperature_category",
    "precipitation_category",
]
MODEL_TESTS = [
    ("stg_treks", "trek_id", "not_null"),
    ("stg_treks", "trek_id", "unique"),
    ("stg_weather", "trek_id", "not_null"),
    ("int_trek_weather", "trek_id", "not_null"),
    ("trek_analytics", "trek_id", "not_null"),
]
# ---------------------------------------------------------------------------


def load_gold_table(
    spark: SparkSession, root: str, key: str = "trek_id", recursive: bool = True
) -> DataFrame:
    """Every ``part-*.parquet`` under ``root`` (sub-folders included) as one
    table with the union schema, minus rows whose key is NULL (rows of a
    summary that sits below the folder have no key).

    A folder written with ``partitionBy`` keeps its partition column only
    with ``recursive=False`` (partition discovery instead of a flat walk).
    """
    return drop_null_keys(load_stage(spark, root, recursive=recursive), [key])


def load_profiled(spark: SparkSession, root: str, key: str = "trek_id", recursive: bool = True) -> tuple[DataFrame, DataFrame]:
    """:func:`load_gold_table` and the table's key profile before and after
    rows without a key are removed (``step, total_rows, unique_keys,
    null_keys``)."""
    staged = load_stage(spark, root, recursive=recursive)
    kept = drop_null_keys(staged, [key])
    profiles = [key_profile(df, key).select(F.lit(step).alias("step"), "*") for step, df in (("before", staged), ("after", kept))]
    return kept, profiles[0].unionByName(profiles[1])


def trek_mart(
    treks: DataFrame,
    weather_hourly: DataFrame,
    weather_summary: DataFrame,
    grain: str = "hour",
    key: str = "trek_id",
    summary_is_unique: bool = False,
) -> DataFrame:
    """Treks ⟕ weather with the mart's 24 weather columns.  In the hour and
    entity grains ``weather_summary`` must have one row per key (checked, unless
    ``summary_is_unique`` states it)."""
    return build_mart(
        treks,
        key,
        summary=weather_summary,
        events=weather_hourly,
        grain=grain,
        summary_cols=SUMMARY_COLUMNS,
        event_cols=HOURLY_COLUMNS,
        columns=[c for c in MART_WEATHER_COLUMNS if grain != "entity" or c in SUMMARY_COLUMNS],
        summary_is_unique=summary_is_unique,
    )


def run_warehouse(
    spark: SparkSession,
    treks_root: str,
    weather_root: str,
    summary_root: str,
    grain: str = "hour",
    mart_path: str | None = None,
) -> dict[str, DataFrame]:
    """Register the staged sources and the models, materialise the mart as the
    table ``trek_analytics`` (at ``mart_path``, else in the warehouse folder),
    and return models, key profiles and test results.

    ``weather_root`` is the date-partitioned gold folder (loaded with
    partition discovery); the other two are walked recursively.  The staged
    summary has a row per id and name; where a place was renamed, the hour and
    entity grains take a summary by id from the hourly rows instead.
    """
    loaded = {
        "stg_treks": load_profiled(spark, treks_root),
        "stg_weather": load_profiled(spark, weather_root, recursive=False),
        "stg_weather_summary": load_profiled(spark, summary_root),
    }
    sources = register_sources(spark, {name: table for name, (table, _) in loaded.items()})
    profiles = [p.select(F.lit(name).alias("table"), "*") for name, (_, p) in loaded.items()]
    summary = sources["stg_weather_summary"]
    if grain != "union" and summary.groupBy("trek_id").agg(F.count("*").alias("n")).where("n > 1").first() is not None:
        summary = weather_summary_rows(sources["stg_weather"], ["trek_id"])
    # The keys were counted just now, or are those of a grouping.
    mart = trek_mart(sources["stg_treks"], sources["stg_weather"], summary, grain, summary_is_unique=True)
    inter = materialize(mart, "int_trek_weather", "view")
    final = materialize(inter, "trek_analytics", "table", mart_path)
    models = {**sources, "int_trek_weather": inter, "trek_analytics": final}
    tests = run_tests(models, MODEL_TESTS)
    return {**models, "profiles": reduce(DataFrame.unionByName, profiles), "tests": tests}
