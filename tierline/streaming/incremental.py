"""Incremental bronze -> silver ingest of a landing folder.

The batch pipeline (:func:`tierline.plans.weather.run_weather`) re-reads the
whole bronze folder on every run.  At scale the documents keep landing, so
the same flatten runs here as a Structured Streaming file source: every
trigger reads only files it has not seen, the list of seen files lives in the
checkpoint folder (a restarted job or a lost executor resumes exactly where it
stopped), and the Parquet sink commits each micro-batch atomically.

This is not a new operator: it reuses :func:`flatten_weather`.  The stream
keeps no state and drops no row but those without a time; it appends every
hour with the file and the position that it came from.
:func:`read_stream_silver` then keeps one row per place and hour by the same
rule as the batch run, so the result is the batch result whatever the order
in which documents land.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierline.operators.clean import dedupe
from tierline.plans.weather import DOC_SCHEMA, SILVER_COLUMNS, flatten_weather


def weather_silver_stream(
    spark: SparkSession,
    landing_dir: str,
    max_files_per_trigger: int | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Streaming DataFrame of the hours of documents landing in
    ``landing_dir`` (one document per file): the silver columns and
    ``hour_index``, repeats included."""
    reader = spark.readStream.schema(DOC_SCHEMA).option("multiLine", multi_line)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = reader.json(landing_dir).withColumn("source_file", F.col("_metadata.file_path"))
    flat = flatten_weather(docs, position="hour_index")
    return flat.filter(F.col("weather_time").isNotNull()).select(*SILVER_COLUMNS, "hour_index")


def read_stream_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver rows of what has been ingested so far: one per (trek_id,
    weather_time), the first by source file, then by position in it."""
    hours = spark.read.parquet(path)
    return dedupe(hours, ["trek_id", "weather_time"], order_by=["source_file", "hour_index"]).select(*SILVER_COLUMNS)


def start_weather_ingest(
    spark: SparkSession,
    landing_dir: str,
    path: str,
    checkpoint: str,
    name: str = "weather_silver",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    multi_line: bool = True,
) -> StreamingQuery:
    """Start the incremental ingest into ``path`` (Parquet, read it with
    :func:`read_stream_silver`).

    ``checkpoint`` is a folder on shared storage that every run of this
    ingest is given, so that each continues where the last one stopped.
    ``available_now`` processes everything that has landed and stops (a
    scheduled run, still split into micro-batches of at most
    ``max_files_per_trigger`` files); otherwise it keeps running with the
    default trigger.
    """
    writer = (
        weather_silver_stream(spark, landing_dir, max_files_per_trigger, multi_line)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
