"""Every operator run over the driver's generated tables, plus the
independent SQL (DuckDB dialect) that must give the same rows.

The driver tables carry none of the messy text the operators exist for, so
each query first *derives* such text from whole tables with a deterministic
expression (``CASE`` on key modulo, string concatenation) that both engines
evaluate identically; the operator under test then runs on the full derived
table.  The oracle SQL spells the operator's semantics out independently
(no shared code path with the Spark side beyond the derivation text).

Sums and averages of doubles are exact on both sides before they are rounded
(see :func:`tierline.functions.parse.rounded_sum`; the oracle works in whole
numbers), so that summation order cannot change a result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.parse import parse_event_time
from tierline.functions.rules import bucketize, standardize_label
from tierline.operators.audit import ingest_ledger, ledger_summary, reconcile, stage_report
from tierline.operators.clean import (
    coerce_columns,
    dedupe,
    drop_empty_columns,
    drop_empty_rows,
    drop_null_keys,
    drop_unnamed_columns,
    split_complete,
    with_delta,
    with_money_range,
    with_parsed_range,
)
from tierline.operators.mart import build_mart
from tierline.operators.nested import zip_explode
from tierline.operators.order import top_n
from tierline.operators.quality import (
    expect_count,
    missing_report,
    null_profile,
    range_report,
    range_violations,
    run_tests,
)
from tierline.operators.summarize import count_by, key_profile
from tierline.plans import weather as W
from tierline.plans.testdata_layers import QUERIES as LAYER_QUERIES
from tierline.plans.warehouse import (
    HOURLY_COLUMNS,
    MART_WEATHER_COLUMNS,
    MODEL_TESTS,
    SUMMARY_COLUMNS,
)
from tierline.session import scratch_path, stage_table
from tierline.sources.files import load_stage, read_csv, read_json_docs, register_sources
from tierline.sources.sinks import materialize, write_csv, write_parquet, write_split

QueryFn = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sel(df: DataFrame, exprs: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {a}" for e, a in exprs])


def _sql(exprs: list[tuple[str, str]]) -> str:
    return ",\n  ".join(f"{e} AS {a}" for e, a in exprs)


# ---------------------------------------------------------------------------
# Derived inputs: expressions valid in both Spark SQL and DuckDB.
# ---------------------------------------------------------------------------

PART_SIZE_TEXT = [
    ("p_partkey", "p_partkey"),
    (
        "CASE p_partkey % 9 WHEN 0 THEN 'needs_verification' "
        "WHEN 1 THEN CAST(p_size AS STRING) || '.5' WHEN 2 THEN '' "
        "WHEN 3 THEN CAST(p_size AS STRING) || 'e1' WHEN 4 THEN 'n/a' "
        "ELSE CAST(p_size AS STRING) END",
        "size_text",
    ),
    ("p_size", "p_size"),
]

_LN = "CAST(l_linenumber AS STRING)"
LINEITEM_RANGE_TEXT = [
    ("l_orderkey", "l_orderkey"),
    ("l_linenumber", "l_linenumber"),
    (
        f"CASE l_orderkey % 8 WHEN 0 THEN {_LN} "
        f"WHEN 1 THEN {_LN} || '–' || CAST(l_linenumber + 2 AS STRING) "
        f"WHEN 2 THEN ' ' || {_LN} || ' - ' || CAST(l_linenumber + 1 AS STRING) || ' ' "
        f"WHEN 3 THEN {_LN} || ' to ' || CAST(l_linenumber + 3 AS STRING) "
        f"WHEN 4 THEN {_LN} || '–' || CAST(l_linenumber + 1 AS STRING) || ' days' "
        f"WHEN 5 THEN 'needs_verification' "
        f"WHEN 6 THEN {_LN} || '.5–' || CAST(l_linenumber + 1 AS STRING) || '.25' "
        f"ELSE NULL END",
        "duration_text",
    ),
]

PART_LO_HI = [
    ("p_partkey", "p_partkey"),
    ("p_size", "p_size"),
    ("p_partkey % 4000 + 500", "lo"),
    ("p_partkey % 4000 + 500 + p_size * 100", "hi"),
]


def _thousands(x: str) -> str:
    return (
        f"CASE WHEN {x} >= 1000 THEN CAST(CAST(({x} - {x} % 1000) / 1000 AS BIGINT) AS STRING) "
        f"|| ',' || lpad(CAST({x} % 1000 AS STRING), 3, '0') ELSE CAST({x} AS STRING) END"
    )


PART_COST_TEXT = [
    ("p_partkey", "p_partkey"),
    (
        "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CASE p_partkey % 6 "
        f"WHEN 0 THEN '₹' || {_thousands('lo')} || '–₹' || {_thousands('hi')} "
        "WHEN 1 THEN '₹' || CAST(p_size AS STRING) || 'k–₹' || CAST(p_size + 3 AS STRING) || 'K' "
        "WHEN 2 THEN '₹' || CAST(p_size AS STRING) || '–' || CAST(p_size + 3 AS STRING) || 'k' "
        f"WHEN 3 THEN '₹' || {_thousands('lo')} "
        "WHEN 4 THEN 'needs_verification' "
        "ELSE CAST(lo AS STRING) || '.50 to ' || CAST(hi AS STRING) END END",
        "cost_text",
    ),
]

PART_BASE = PART_LO_HI + [("p_name", "p_name"), ("p_type", "p_type"), ("p_brand", "p_brand")]


def _coord(whole: int, frac: int) -> str:
    return (
        f"CAST(p_partkey % {whole} AS STRING) || '.' || "
        f"lpad(CAST(p_partkey % {frac} AS STRING), 3, '0')"
    )


_SZ = "p_size % 9"
# A place feed read from the part table: every column is text, as in the
# bronze CSV, with sentinels, missing coordinates, range and money text,
# noisy difficulty labels and two trailing unnamed columns.
PLACE_TEXT = [
    # ids: some are no numbers, some have leading zeros (and stay places of
    # their own beside the id without)
    (
        "CASE WHEN p_partkey % 29 = 0 THEN 'T' || CAST(p_partkey AS STRING) "
        "WHEN p_partkey % 31 = 5 THEN '00' || CAST(p_partkey - 1 AS STRING) "
        "ELSE CAST(p_partkey AS STRING) END",
        "trek_id",
    ),
    ("p_name", "trek_name"),
    ("p_type", "category"),
    ("CASE WHEN p_partkey % 23 = 0 THEN 'needs_verification' ELSE p_brand END", "starting_point"),
    (f"CASE WHEN p_partkey % 19 = 0 THEN 'needs_verification' ELSE {_coord(90, 997)} END", "start_lat"),
    (f"CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE {_coord(180, 991)} END", "start_lon"),
    ("CAST(1000 + p_partkey % 3000 AS STRING)", "start_elevation"),
    ("'Top ' || p_brand", "ending_point"),
    (f"CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE {_coord(89, 983)} END", "end_lat"),
    (f"CASE WHEN p_partkey % 13 = 0 THEN 'needs_verification' ELSE {_coord(179, 977)} END", "end_lon"),
    ("CAST(p_size * 100 AS STRING)", "end_elevation"),
    ("CASE WHEN p_partkey % 31 = 0 THEN 'needs_verification' ELSE CAST(p_size AS STRING) END", "distance_km"),
    (
        f"CASE p_partkey % 7 WHEN 0 THEN CAST({_SZ} + 1 AS STRING) "
        f"WHEN 1 THEN CAST({_SZ} + 1 AS STRING) || '–' || CAST({_SZ} + 3 AS STRING) "
        f"WHEN 2 THEN CAST({_SZ} + 1 AS STRING) || ' to ' || CAST({_SZ} + 4 AS STRING) "
        f"WHEN 3 THEN CAST({_SZ} + 1 AS STRING) || '–' || CAST({_SZ} + 2 AS STRING) || ' days' "
        f"WHEN 4 THEN 'needs_verification' "
        f"WHEN 5 THEN CAST({_SZ} AS STRING) || '.5-' || CAST({_SZ} + 1 AS STRING) "
        f"ELSE NULL END",
        "duration_days",
    ),
    (
        "CASE p_partkey % 10 WHEN 0 THEN 'easy' WHEN 1 THEN ' EASY-moderate ' "
        "WHEN 2 THEN 'Moderate' WHEN 3 THEN 'moderate-difficult' WHEN 4 THEN 'DIFFICULT' "
        "WHEN 5 THEN 'Very Difficult ' WHEN 6 THEN 'extreme' WHEN 7 THEN 'Hard' "
        "WHEN 8 THEN 'Unknown Grade' ELSE NULL END",
        "difficulty",
    ),
    ("'Sep–Jun'", "best_season"),
    (PART_COST_TEXT[1][0], "approx_cost"),
    ("CAST(NULL AS STRING)", "_c16"),
    ("CAST(NULL AS STRING)", "_c17"),
]
# Every place a second time under a variant name: the key de-duplication
# keeps the upper-case copy for even keys and the original for odd ones.
PLACE_TEXT_COPY = [
    ("CASE p_partkey % 2 WHEN 0 THEN upper(p_name) ELSE p_name || ' (copy)' END", "trek_name")
    if alias == "trek_name" else (expr, alias)
    for expr, alias in PLACE_TEXT
]

CUSTOMER_SEGMENT_TEXT = [
    ("c_custkey", "c_custkey"),
    (
        "CASE WHEN c_custkey % 50 = 7 THEN NULL WHEN c_custkey % 10 = 9 THEN ' Other ' "
        "ELSE CASE c_custkey % 4 WHEN 0 THEN lower(c_mktsegment) "
        "WHEN 1 THEN '  ' || c_mktsegment || ' ' "
        "WHEN 2 THEN upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) "
        "ELSE c_mktsegment END END",
        "segment_raw",
    ),
]
# The five market segments of the generated customer table.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

LINEITEM_BUCKET_INPUTS = [
    ("l_orderkey", "l_orderkey"),
    ("l_linenumber", "l_linenumber"),
    ("CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_quantity END", "distance_value"),
    ("CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE (l_quantity - 1) / 4 END", "rain_value"),
    ("CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_quantity - 10 END", "temp_value"),
]

# lineitem re-read as hourly weather: supplier = place, ship date = hour.
LINEITEM_WEATHER = [
    ("l_orderkey", "l_orderkey"),
    ("l_linenumber", "l_linenumber"),
    ("l_suppkey", "trek_id"),
    # every tenth place is renamed half-way
    (
        "'Supplier#' || lpad(CAST(l_suppkey AS STRING), 9, '0') || "
        "CASE WHEN l_suppkey % 10 = 3 AND l_orderkey % 2 = 1 THEN ' (renamed)' ELSE '' END",
        "trek_name",
    ),
    ("CAST(l_partkey % 90 AS DOUBLE)", "latitude"),
    ("CAST(l_partkey % 180 AS DOUBLE)", "longitude"),
    ("CAST(l_linenumber * 100 AS DOUBLE)", "elevation"),
    ("l_shipdate", "weather_time"),
    ("CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_quantity - 8 END", "temperature_c"),
    ("CAST(l_linenumber * 10 AS DOUBLE)", "humidity_pct"),
    ("abs(l_tax) * 100", "precipitation_mm"),
    ("l_extendedprice / 10", "visibility_m"),
    ("abs(l_discount) * 700", "wind_speed_kmh"),
    ("abs(l_discount) * 1000", "wind_gust_kmh"),
    ("'lineitem'", "source_file"),
    ("CAST(l_shipdate AS DATE)", "weather_date"),
]

LINEITEM_DELTA = [
    ("l_orderkey", "l_orderkey"),
    ("l_linenumber", "l_linenumber"),
    ("l_quantity * 1000", "start_value"),
    ("CASE WHEN l_orderkey % 10 = 3 THEN NULL ELSE l_extendedprice END", "end_value"),
]

PART_WITH_NULLS = [
    ("p_partkey", "p_partkey"),
    ("CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_name END", "p_name"),
    ("CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_size END", "p_size"),
    ("CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_retailprice END", "p_retailprice"),
    ("p_brand", "p_brand"),
    ("p_type", "p_type"),
]
PART_REQUIRED = ["p_name", "p_size", "p_retailprice"]

_BLANK = "c_custkey % 97 = 5"
CUSTOMER_MESSY = [
    (f"CASE WHEN {_BLANK} THEN NULL ELSE c_custkey END", "c_custkey"),
    (f"CASE WHEN {_BLANK} THEN NULL ELSE c_name END", "c_name"),
    (f"CASE WHEN {_BLANK} THEN NULL ELSE c_nationkey END", "c_nationkey"),
    (f"CASE WHEN {_BLANK} THEN NULL ELSE c_acctbal END", "c_acctbal"),
    (f"CASE WHEN {_BLANK} THEN NULL ELSE c_mktsegment END", "c_mktsegment"),
    ("CAST(NULL AS STRING)", "c_comment"),
    ("CAST(NULL AS STRING)", "_c5"),
    (f"CASE WHEN c_custkey % 3 = 0 AND NOT ({_BLANK}) THEN 'x' ELSE NULL END", "_c6"),
]

# A second copy of every event: same hour, an hour earlier or an hour later.
EVENTS_SHIFTED_COPY = [
    ("event_id + 1000000000", "event_id"),
    (
        "CASE user_id % 3 WHEN 0 THEN ts WHEN 1 THEN ts - INTERVAL 1 HOUR "
        "ELSE ts + INTERVAL 1 HOUR END",
        "ts",
    ),
    ("user_id", "user_id"),
    ("event_type", "event_type"),
    ("value", "value"),
]


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


def q_coerce_numeric(spark, d):
    df = _sel(_t(spark, d, "part"), PART_SIZE_TEXT)
    df = df.withColumn("size_num", F.col("size_text"))
    df = coerce_columns(df, ["size_num"])
    return df.select("p_partkey", "size_text", "size_num", F.col("p_size").cast("double").alias("size_strict"))


def q_parse_range(spark, d):
    df = _sel(_t(spark, d, "lineitem"), LINEITEM_RANGE_TEXT)
    return with_parsed_range(df, "duration_text", "range_min", "range_max", "range_avg")


def q_parse_money_range(spark, d):
    df = _sel(_sel(_t(spark, d, "part"), PART_LO_HI), PART_COST_TEXT)
    return with_money_range(df, "cost_text", "cost_min", "cost_max")


def q_standardize_label(spark, d):
    df = _sel(_t(spark, d, "customer"), CUSTOMER_SEGMENT_TEXT)
    return df.withColumn("segment", standardize_label("segment_raw", SEGMENTS))


def _buckets(spark, d):
    return _sel(_t(spark, d, "lineitem"), LINEITEM_BUCKET_INPUTS)


def q_bucketize_lt(spark, d):
    return _buckets(spark, d).select(
        "l_orderkey", "l_linenumber", "distance_value",
        bucketize("distance_value", [10, 20], ["Short", "Medium", "Long"], "lt", null_label="Unknown").alias("bucket"),
    )


def q_bucketize_le(spark, d):
    return _buckets(spark, d).select(
        "l_orderkey", "l_linenumber", "rain_value",
        bucketize(
            "rain_value", W.PRECIPITATION_BOUNDS, W.PRECIPITATION_LABELS, "le",
            null_label="Unknown", zero_label=W.PRECIPITATION_ZERO_LABEL,
        ).alias("bucket"),
    )


def q_bucketize_null(spark, d):
    return _buckets(spark, d).select(
        "l_orderkey", "l_linenumber", "temp_value",
        bucketize("temp_value", W.TEMPERATURE_BOUNDS, W.TEMPERATURE_LABELS, "lt").alias("bucket"),
    )


def lineitem_weather(spark, d) -> DataFrame:
    return _sel(_t(spark, d, "lineitem"), LINEITEM_WEATHER)


def _gold(spark, d):
    return W.weather_gold(lineitem_weather(spark, d), extra=["l_orderkey", "l_linenumber"])


def q_condition_score(spark, d):
    return _gold(spark, d).select(
        "l_orderkey", "l_linenumber", "temperature_category", "precipitation_category",
        "wind_category", "visibility_category", "condition_score", "condition_status",
    )


def q_entity_summary(spark, d):
    return W.weather_summary(_gold(spark, d))


def q_count_by(spark, d):
    return count_by(_t(spark, d, "customer"), "c_mktsegment", "customer_count")


def q_key_profile(spark, d):
    return key_profile(_t(spark, d, "orders"), "o_custkey")


def q_add_delta(spark, d):
    df = _sel(_t(spark, d, "lineitem"), LINEITEM_DELTA)
    return with_delta(df, "end_value", "start_value", "delta")


def _part_nulls(spark, d):
    return _sel(_t(spark, d, "part"), PART_WITH_NULLS)


def q_split_valid(spark, d):
    return split_complete(_part_nulls(spark, d), PART_REQUIRED).valid


def q_split_skipped(spark, d):
    return split_complete(_part_nulls(spark, d), PART_REQUIRED).skipped


def q_missing_report(spark, d):
    return missing_report(_part_nulls(spark, d), PART_REQUIRED + ["p_brand"])


def q_null_profile(spark, d):
    return null_profile(_part_nulls(spark, d))


RANGE_CHECKS = {
    "quantity": (["l_quantity"], 1, 45),
    "discount": (["l_discount"], 0, 0.08),
    "tax_and_discount": (["l_tax", "l_discount"], 0, 0.06),
}


def q_range_report(spark, d):
    return range_report(_t(spark, d, "lineitem"), RANGE_CHECKS)


def q_range_violations(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return range_violations(li, RANGE_CHECKS)


def _models(spark, d):
    return {
        "orders": _t(spark, d, "orders"),
        "events": _t(spark, d, "events"),
        "customer": _t(spark, d, "customer"),
        "part_nulls": _part_nulls(spark, d),
    }


def q_not_null_test(spark, d):
    return run_tests(
        _models(spark, d),
        [
            ("orders", "o_orderkey", "not_null"),
            ("orders", "o_custkey", "not_null"),
            ("events", "user_id", "not_null"),
            ("part_nulls", "p_name", "not_null"),
            ("part_nulls", "p_size", "not_null"),
        ],
    )


def q_unique_test(spark, d):
    return run_tests(
        _models(spark, d),
        [
            ("orders", "o_orderkey", "unique"),
            ("events", "user_id", "unique"),
            ("events", "event_id", "unique"),
            ("customer", "c_custkey", "unique"),
        ],
    )


def _messy(spark, d):
    return _sel(_t(spark, d, "customer"), CUSTOMER_MESSY)


def q_drop_unnamed_columns(spark, d):
    return drop_unnamed_columns(_messy(spark, d))


def q_drop_empty_columns(spark, d):
    return drop_empty_columns(_messy(spark, d))


def q_drop_empty_rows(spark, d):
    return drop_empty_rows(_messy(spark, d))


def q_dedupe(spark, d):
    ev = _t(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    copy = _sel(ev, EVENTS_SHIFTED_COPY)
    return dedupe(ev.unionByName(copy), ["user_id", "event_type"], order_by=["ts", "event_id"])


def q_zip_explode(spark, d):
    emb = _t(spark, d, "embeddings")
    docs = emb.select(
        "vec_id",
        "label",
        F.struct(
            F.when(F.col("vec_id") % 25 != 0, F.col("embedding")).alias("values"),
            F.slice("embedding", 1, F.size("embedding") - 1).alias("head"),
        ).alias("doc"),
    )
    out = zip_explode(
        docs, {"value": "doc.values", "head": "doc.head"}, keep=["vec_id", "label"], position="pos"
    )
    return out.select(
        "vec_id", "label", "pos", F.col("value").cast("double").alias("value"),
        F.col("head").cast("double").alias("head"),
    )


def q_parse_event_time(spark, d):
    ev = _t(spark, d, "events")
    text = (
        F.when(F.col("event_id") % 10 == 0, F.lit("not-a-time"))
        .when(F.col("event_id") % 10 == 1, F.lit(None).cast("string"))
        .when(F.col("event_id") % 10 == 2, F.date_format("ts", "yyyy-MM-dd HH:mm"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
    )
    df = ev.select("event_id", text.alias("time_text"))
    t = parse_event_time("time_text")
    return df.select("event_id", "time_text", t.alias("weather_time"), F.to_date(t).alias("weather_date")).filter(
        F.col("weather_time").isNotNull()
    )


# Microsecond text timestamps (the JSON default keeps milliseconds only).
TS_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

EVENT_DOC_SCHEMA = (
    "event_id long, user_id long, "
    "payload struct<ts: timestamp_ntz, event_type: string, value: double>, props string"
)


def q_read_json_docs(spark, d):
    path = scratch_path(spark, "json-docs")
    ev = _t(spark, d, "events")
    ev.select(
        "event_id", "user_id", F.struct("ts", "event_type", "value").alias("payload"), "props"
    ).write.mode("overwrite").option("timestampNTZFormat", TS_MICROS).json(path)
    docs = read_json_docs(
        spark, path, EVENT_DOC_SCHEMA, multi_line=False, source_col="source_file",
        timestampNTZFormat=TS_MICROS,
    )
    return docs.select(
        "event_id",
        F.col("payload.ts").alias("ts"),
        "user_id",
        F.col("payload.event_type").alias("event_type"),
        F.col("payload.value").alias("value"),
        "props",
        F.regexp_extract("source_file", r"\.(json)$", 1).alias("source_ext"),
    )


CUSTOMER_SCHEMA = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


# Text that CSV must not change: spaces at the ends, quotes, separators, line
# breaks, the empty string and NULL.
CUSTOMER_CSV = [
    ("c_custkey", "c_custkey"),
    (
        "CASE c_custkey % 8 WHEN 0 THEN ' ' || c_name || '  ' WHEN 1 THEN 'say \"' || c_name || '\", ok' "
        "WHEN 2 THEN c_name || chr(10) || 'second line' WHEN 3 THEN '' WHEN 4 THEN NULL "
        "WHEN 5 THEN '\"' WHEN 6 THEN 'back' || chr(92) || 'slash' ELSE c_name END",
        "c_name",
    ),
    ("c_nationkey", "c_nationkey"),
    ("c_acctbal", "c_acctbal"),
    ("c_mktsegment", "c_mktsegment"),
]
NULL_CELL = "\\N"


def q_read_csv_roundtrip(spark, d):
    df = _sel(_t(spark, d, "customer"), CUSTOMER_CSV)
    path = write_csv(df, scratch_path(spark, "csv"), null_value=NULL_CELL)
    return read_csv(spark, path, schema=CUSTOMER_SCHEMA, multi_line=True, nullValue=NULL_CELL)


DOC_ROWS = 500


def q_read_json_multiline(spark, d):
    """The customers as pretty-printed JSON, a file holding one top-level
    array of up to 500 documents."""
    path = scratch_path(spark, "json-multiline")
    customers = _t(spark, d, "customer").where("c_custkey is not null")
    fields = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    arrays = customers.groupBy(F.floor(F.col("c_custkey") / DOC_ROWS).alias("file")).agg(
        F.to_json(F.collect_list(F.struct(*fields)), {"pretty": "true"}).alias("value")
    )
    # one row, so one array, per file
    arrays.select("value").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    docs = read_json_docs(spark, path, CUSTOMER_SCHEMA, multi_line=True, source_col="source_file")
    return docs.select(*fields, F.regexp_extract("source_file", r"\.(txt)$", 1).alias("source_ext"))


def q_load_stage_files(spark, d):
    """Landings of different columns, loaded by an explicit list of folders."""
    root = scratch_path(spark, "stage-files")
    customers = _t(spark, d, "customer")
    write_parquet(customers.select("c_custkey", "c_name"), f"{root}/a")
    write_parquet(customers.select("c_custkey", "c_acctbal"), f"{root}/b")
    write_parquet(customers, f"{root}/not_listed")
    return load_stage(spark, files=[f"{root}/a", f"{root}/b"]).select("c_custkey", "c_name", "c_acctbal")


def q_materialized_models(spark, d):
    """A named source, a view over it and a table made from the view, each
    read by its name; the table is then replaced by one of other columns."""
    names = [f"tierline_{kind}_{uuid.uuid4().hex[:12]}" for kind in ("source", "view", "table")]
    source = register_sources(spark, {names[0]: _t(spark, d, "customer")})[names[0]]
    view = materialize(source.groupBy("c_nationkey").agg(F.count("*").alias("n")), names[1], "view")
    path = scratch_path(spark, "models")
    materialize(view, names[2], "table", f"{path}/first")
    table = materialize(view.withColumn("twice", F.col("n") * 2), names[2], "table", f"{path}/second")
    by_name = [
        spark.table(names[0]).agg(F.lit("source").alias("model"), F.count("*").alias("rows"), F.sum("c_custkey").alias("total")),
        spark.table(names[1]).agg(F.lit("view").alias("model"), F.count("*").alias("rows"), F.sum("n").alias("total")),
        table.agg(F.lit("table").alias("model"), F.count("*").alias("rows"), F.sum("twice").alias("total")),
    ]
    return reduce(DataFrame.unionByName, by_name)


def q_write_parquet_roundtrip(spark, d):
    path = write_parquet(_t(spark, d, "customer"), scratch_path(spark, "parquet"), partition_by=["c_mktsegment"])
    return spark.read.parquet(path).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def q_load_stage_union(spark, d):
    root = scratch_path(spark, "stage")
    orders = _t(spark, d, "orders")
    even = orders.filter(F.col("o_orderkey") % 2 == 0).select("o_orderkey", "o_custkey", "o_totalprice")
    # the two landings partition the whole table (every non-NULL key)
    odd = orders.filter(F.col("o_orderkey") % 2 != 0).select("o_orderkey", "o_custkey", "o_orderstatus")
    summary = count_by(orders, "o_custkey", "order_count")
    write_parquet(even, f"{root}/landing_a")
    write_parquet(odd, f"{root}/landing_b")
    write_parquet(summary, f"{root}/landing_a/summary")
    staged = drop_null_keys(load_stage(spark, root), ["o_orderkey"])
    return staged.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "order_count")


def _supplier_entities(spark, d):
    return _t(spark, d, "supplier").select(
        F.col("s_suppkey").alias("trek_id"), "s_name", "s_nationkey", "s_acctbal"
    )


def _mart(spark, d, grain):
    gold = _gold(spark, d)
    summary = W.weather_summary(gold, keys=["trek_id"])
    cols = MART_WEATHER_COLUMNS if grain != "entity" else [c for c in MART_WEATHER_COLUMNS if c in SUMMARY_COLUMNS]
    return build_mart(
        _supplier_entities(spark, d), "trek_id", summary=summary, events=gold, grain=grain,
        summary_cols=SUMMARY_COLUMNS, event_cols=HOURLY_COLUMNS, columns=cols, summary_of_events=True,
        summary_is_unique=True,
    )


def q_mart_entity(spark, d):
    return _mart(spark, d, "entity")


def q_mart_hour(spark, d):
    return _mart(spark, d, "hour")


def q_mart_union(spark, d):
    return _mart(spark, d, "union")


def q_model_tests(spark, d):
    """The warehouse's five model tests over models built from the driver
    tables: places = supplier, weather = lineitem read as hours, and the
    hour-grain mart as both the intermediate model and, written as a table,
    the final one."""
    mart = _mart(spark, d, "hour").select("trek_id", "weather_time", "weather_records")
    mart = stage_table(mart, "trek-analytics")
    models = {
        "stg_treks": _supplier_entities(spark, d),
        "stg_weather": lineitem_weather(spark, d),
        "int_trek_weather": mart,
        "trek_analytics": mart,
    }
    return run_tests(models, MODEL_TESTS)


# Customers that no order can belong to, beside the real ones.
CUSTOMER_MISSING = [
    ("c_custkey + 1000000000", "c_custkey"),
    ("c_name || ' (missing)'", "c_name"),
    ("c_nationkey", "c_nationkey"),
]


def _ledger(spark, d):
    customers = _t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    expected = customers.unionByName(_sel(customers, CUSTOMER_MISSING))
    landed = _t(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return ingest_ledger(expected, landed, "c_custkey", carry=["c_name", "c_nationkey"])


def q_ingest_ledger(spark, d):
    return _ledger(spark, d)


def q_ledger_summary(spark, d):
    return ledger_summary(_ledger(spark, d))


def _stages(spark, d):
    """The weather layers over lineitem.  Bronze and the rows with a time are
    counted in one scan; the de-duplicated layer is computed and written once
    (its columns that the later layers' counts need), and the layers after it
    read that."""
    bronze = lineitem_weather(spark, d)
    timed = F.col("weather_time").isNotNull()
    readings = ["temperature_c", "precipitation_mm", "wind_speed_kmh", "visibility_m"]
    narrow = bronze.filter(timed).select("trek_id", "trek_name", "weather_time", "l_orderkey", "l_linenumber", *readings)
    silver = stage_table(dedupe(narrow, ["trek_id", "weather_time"], order_by=["l_orderkey", "l_linenumber"]), "silver")
    absent = [c for c in W.SILVER_COLUMNS if c not in silver.columns]
    gold = W.weather_gold(silver.withColumns({c: F.lit(None) for c in absent}))
    summary = gold.select("trek_id", "trek_name").distinct()
    return {"bronze": bronze, "valid_time": (bronze, timed), "silver": silver, "gold": gold, "summary": summary}


def q_stage_report(spark, d):
    return stage_report(_stages(spark, d))


def q_reconcile(spark, d):
    return reconcile(_stages(spark, d), equal=[("silver", "gold")], nonempty=["summary"])


def q_expect_count(spark, d):
    s = _stages(spark, d)
    return expect_count(s["gold"], s["silver"], "gold equals silver").unionByName(
        expect_count(s["silver"], s["bronze"], "dedupe keeps all rows")
    )


def _hour_text(i):
    day = F.lpad((F.floor(i / 24) + 1).cast("string"), 2, "0")
    hour = F.lpad((i % 24).cast("string"), 2, "0")
    return F.concat(F.lit("2026-01-"), day, F.lit("T"), hour, F.lit(":00"))


def weather_docs_from_embeddings(spark, d, repeat_last_hour: bool = True) -> DataFrame:
    """One hourly-weather document per embedding vector: the 64 values,
    scaled, become the parallel hourly arrays.  Every 10th vector has one
    unparsable time, every 11th repeats its last hour, every 7th has a
    wind array 3 short, every 25th has no hourly block."""
    emb = _t(spark, d, "embeddings")
    n = F.size("embedding")
    vid = F.col("vec_id")
    repeat = F.lit(repeat_last_hour)
    times = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.when((vid % 10 == 0) & (i == 5), F.lit("bad"))
        .when(repeat & (vid % 11 == 0) & (i == n - 1), _hour_text(i - 1))
        .otherwise(_hour_text(i)),
    )
    dbl = lambda k: F.transform("embedding", lambda x: F.abs(x.cast("double")) * k)
    wind = dbl(400)
    hourly = F.struct(
        times.alias("time"),
        F.transform("embedding", lambda x: x.cast("double") * 100).alias("temperature_2m"),
        F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * 1000)).alias(
            "relative_humidity_2m"
        ),
        dbl(50).alias("precipitation"),
        dbl(100000).alias("visibility"),
        F.when(vid % 7 == 0, F.slice(wind, 1, n - 3)).otherwise(wind).alias("wind_speed_10m"),
        dbl(500).alias("wind_gusts_10m"),
    )
    return emb.select(
        vid.alias("trek_id"),
        F.concat(F.lit("Vector#"), vid.cast("string")).alias("trek_name"),
        F.lit(30.0).alias("latitude"),
        F.lit(78.0).alias("longitude"),
        (vid * 10).cast("double").alias("elevation"),
        F.when(vid % 25 != 0, hourly).alias("hourly"),
    )


def q_weather_docs_gold(spark, d):
    path = scratch_path(spark, "weather-docs")
    weather_docs_from_embeddings(spark, d).write.mode("overwrite").json(path)
    docs = W.read_weather_docs(spark, path, multi_line=False)
    gold = W.weather_gold(W.weather_silver(docs))
    cols = [c for c in W.GOLD_COLUMNS if c != "source_file"]
    return gold.select(*cols, F.regexp_extract("source_file", r"\.(json)$", 1).alias("source_ext"))


def q_weather_docs_stream(spark, d):
    """The incremental ingest on the same documents: they land as files, a
    file-source stream (availableNow, several micro-batches) flattens them,
    and silver and gold are built from what it wrote."""
    from tierline.streaming import read_stream_silver, start_weather_ingest

    landing = scratch_path(spark, "weather-landing")
    docs = weather_docs_from_embeddings(spark, d)
    docs.repartition(4, "trek_id").write.mode("overwrite").json(landing)
    path = scratch_path(spark, "weather-stream-hours")
    query = start_weather_ingest(
        spark, landing, path, scratch_path(spark, "weather-stream-checkpoint"),
        name=f"weather_docs_stream_{uuid.uuid4().hex[:12]}", max_files_per_trigger=2, multi_line=False,
    )
    query.awaitTermination()
    gold = W.weather_gold(read_stream_silver(spark, path))
    cols = [c for c in W.GOLD_COLUMNS if c != "source_file"]
    return gold.select(*cols, F.regexp_extract("source_file", r"\.(json)$", 1).alias("source_ext"))


def q_places_csv_gold(spark, d):
    """The place instance end to end: a messy place feed derived from the
    whole part table (every key twice) is written as CSV, read back as
    text, de-duplicated, typed, range-parsed, split on complete
    coordinates and turned into gold rows."""
    from tierline.plans import treks as T

    silver, _ = T.treks_silver(T.read_treks(spark, _places_csv(spark, d)))
    return T.treks_gold(silver)


def _places_csv(spark, d) -> str:
    base = _sel(_t(spark, d, "part"), PART_BASE)
    feed = _sel(base, PLACE_TEXT).unionByName(_sel(base, PLACE_TEXT_COPY))
    return write_csv(feed, scratch_path(spark, "places-csv"))


def q_places_quarantine(spark, d):
    """The other side of the same feed, written as a split and read back:
    rows without complete coordinates or with an id that is no number."""
    from tierline.plans import treks as T

    typed = T.treks_silver_all(T.read_treks(spark, _places_csv(spark, d)))
    _, skipped = write_split(typed, T.NEEDED_COLUMNS, scratch_path(spark, "places-split"))
    return skipped.select("trek_id_text", "trek_id", "trek_name", "start_lat", "start_lon", "end_lat", "end_lon")


def q_top_n(spark, d):
    orders = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return top_n(orders, 20, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()])


QUERIES: dict[str, QueryFn] = {
    "coerce_numeric": q_coerce_numeric,
    "parse_range": q_parse_range,
    "parse_money_range": q_parse_money_range,
    "standardize_label": q_standardize_label,
    "bucketize_lt": q_bucketize_lt,
    "bucketize_le": q_bucketize_le,
    "bucketize_null": q_bucketize_null,
    "condition_score": q_condition_score,
    "entity_summary": q_entity_summary,
    "count_by": q_count_by,
    "key_profile": q_key_profile,
    "add_delta": q_add_delta,
    "split_valid": q_split_valid,
    "split_skipped": q_split_skipped,
    "missing_report": q_missing_report,
    "null_profile": q_null_profile,
    "range_report": q_range_report,
    "range_violations": q_range_violations,
    "not_null_test": q_not_null_test,
    "unique_test": q_unique_test,
    "drop_unnamed_columns": q_drop_unnamed_columns,
    "drop_empty_columns": q_drop_empty_columns,
    "drop_empty_rows": q_drop_empty_rows,
    "dedupe": q_dedupe,
    "zip_explode": q_zip_explode,
    "parse_event_time": q_parse_event_time,
    "read_json_docs": q_read_json_docs,
    "read_csv_roundtrip": q_read_csv_roundtrip,
    "write_parquet_roundtrip": q_write_parquet_roundtrip,
    "load_stage_union": q_load_stage_union,
    "mart_entity": q_mart_entity,
    "mart_hour": q_mart_hour,
    "mart_union": q_mart_union,
    "model_tests": q_model_tests,
    "ingest_ledger": q_ingest_ledger,
    "ledger_summary": q_ledger_summary,
    "stage_report": q_stage_report,
    "reconcile": q_reconcile,
    "expect_count": q_expect_count,
    "top_n": q_top_n,
    "weather_docs_gold": q_weather_docs_gold,
    "places_csv_gold": q_places_csv_gold,
    "weather_docs_stream": q_weather_docs_stream,
    "places_quarantine": q_places_quarantine,
    "read_json_multiline": q_read_json_multiline,
    "load_stage_files": q_load_stage_files,
    "materialized_models": q_materialized_models,
}

# Tables that change over time, checked reads and content checks.
QUERIES |= LAYER_QUERIES
