"""Oracle SQL (DuckDB dialect) for every query of
:mod:`tierline.plans.testdata`, over the pre-registered driver views.

Only the *derivation* of test text is shared with the Spark side (the
expression lists); the operator semantics are spelled out here by hand.
"""

from __future__ import annotations

from tierline.plans.testdata_layers import ORACLE as LAYER_ORACLE
from tierline.plans.testdata import (
    CUSTOMER_CSV,
    CUSTOMER_MESSY,
    CUSTOMER_MISSING,
    CUSTOMER_SEGMENT_TEXT,
    EVENTS_SHIFTED_COPY,
    LINEITEM_BUCKET_INPUTS,
    LINEITEM_DELTA,
    LINEITEM_RANGE_TEXT,
    LINEITEM_WEATHER,
    PART_COST_TEXT,
    PART_LO_HI,
    PART_SIZE_TEXT,
    PART_WITH_NULLS,
    PLACE_TEXT,
    PLACE_TEXT_COPY,
    _sql,
)

NUM = r"(\d+(?:\.\d+)?)"


def _units(x: str) -> str:
    """A double as a whole number of 1e-8."""
    return f"CAST(CAST({x} AS DECIMAL(26,8)) * 100000000 AS HUGEINT)"


def _cents(total: str, n: str) -> str:
    """total / n in units of 1e-8 -> rounded to cents, half away from zero, in
    whole-number arithmetic."""
    return (
        f"CAST(sign({total}) AS DOUBLE) * CAST((2 * abs({total}) + {n} * 1000000) // (2 * {n} * 1000000) AS DOUBLE) / 100"
    )


def _sum2(x: str) -> str:
    return f"CASE WHEN count({x}) > 0 THEN {_cents(f'sum({_units(x)})', '1')} END"


def _avg2(x: str) -> str:
    return f"CASE WHEN count({x}) > 0 THEN {_cents(f'sum({_units(x)})', f'count({x})')} END"


def _one2(x: str) -> str:
    """A single double, rounded as it is printed."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,17)), 2) AS DOUBLE)"


COERCE_NUMERIC = f"""
WITH s AS (SELECT {_sql(PART_SIZE_TEXT)} FROM part)
SELECT p_partkey, size_text, TRY_CAST(size_text AS DOUBLE) AS size_num,
       CAST(p_size AS DOUBLE) AS size_strict
FROM s
"""

PARSE_RANGE = f"""
WITH s AS (SELECT {_sql(LINEITEM_RANGE_TEXT)} FROM lineitem),
p AS (
  SELECT *,
    TRY_CAST(NULLIF(regexp_extract(trim(duration_text), '^{NUM}', 1), '') AS DOUBLE) AS lo,
    regexp_extract(trim(duration_text), '(?:[–-]|to)\\s*{NUM}$', 1) AS hi_raw
  FROM s)
SELECT l_orderkey, l_linenumber, duration_text,
  lo AS range_min,
  CASE WHEN hi_raw = '' THEN lo ELSE TRY_CAST(hi_raw AS DOUBLE) END AS range_max,
  (lo + CASE WHEN hi_raw = '' THEN lo ELSE TRY_CAST(hi_raw AS DOUBLE) END) / 2 AS range_avg
FROM p
"""

_MONEY_MIN = NUM + "([kK]?)"
_MONEY_MAX = "(?:[–-]|to)" + NUM + "([kK]?)"

PARSE_MONEY_RANGE = f"""
WITH a AS (SELECT {_sql(PART_LO_HI)} FROM part),
t AS (SELECT {_sql(PART_COST_TEXT)} FROM a),
c AS (SELECT *, regexp_replace(cost_text, '[₹,\\s]', '', 'g') AS clean FROM t),
e AS (
  SELECT *,
    regexp_extract(clean, '{_MONEY_MIN}', 1) AS mn, regexp_extract(clean, '{_MONEY_MIN}', 2) AS mn_u,
    regexp_extract(clean, '{_MONEY_MAX}', 1) AS mx, regexp_extract(clean, '{_MONEY_MAX}', 2) AS mx_u
  FROM c)
SELECT p_partkey, cost_text,
  CASE WHEN mn = '' THEN NULL WHEN lower(mn_u) = 'k' THEN TRY_CAST(mn AS DOUBLE) * 1000
       ELSE TRY_CAST(mn AS DOUBLE) END AS cost_min,
  CASE WHEN mx = '' THEN NULL WHEN lower(mx_u) = 'k' THEN TRY_CAST(mx AS DOUBLE) * 1000
       ELSE TRY_CAST(mx AS DOUBLE) END AS cost_max
FROM e
"""

STANDARDIZE_LABEL = f"""
WITH s AS (SELECT {_sql(CUSTOMER_SEGMENT_TEXT)} FROM customer)
SELECT c_custkey, segment_raw,
  CASE lower(trim(segment_raw))
    WHEN 'automobile' THEN 'AUTOMOBILE' WHEN 'building' THEN 'BUILDING'
    WHEN 'furniture' THEN 'FURNITURE' WHEN 'household' THEN 'HOUSEHOLD'
    WHEN 'machinery' THEN 'MACHINERY' ELSE trim(segment_raw) END AS segment
FROM s
"""

_BUCKETS = f"WITH b AS (SELECT {_sql(LINEITEM_BUCKET_INPUTS)} FROM lineitem)"

BUCKETIZE_LT = f"""{_BUCKETS}
SELECT l_orderkey, l_linenumber, distance_value,
  CASE WHEN distance_value IS NULL THEN 'Unknown' WHEN distance_value < 10 THEN 'Short'
       WHEN distance_value < 20 THEN 'Medium' ELSE 'Long' END AS bucket
FROM b
"""

BUCKETIZE_LE = f"""{_BUCKETS}
SELECT l_orderkey, l_linenumber, rain_value,
  CASE WHEN rain_value IS NULL THEN 'Unknown' WHEN rain_value = 0 THEN 'No Rain'
       WHEN rain_value <= 2.5 THEN 'Light Rain' WHEN rain_value <= 7.5 THEN 'Moderate Rain'
       ELSE 'Heavy Rain' END AS bucket
FROM b
"""

BUCKETIZE_NULL = f"""{_BUCKETS}
SELECT l_orderkey, l_linenumber, temp_value,
  CASE WHEN temp_value < 5 THEN 'Very Cold' WHEN temp_value < 15 THEN 'Cold'
       WHEN temp_value < 25 THEN 'Moderate' WHEN temp_value < 35 THEN 'Warm'
       ELSE 'Very Hot' END AS bucket
FROM b
"""

# Weather gold and summary over lineitem, as CTEs: w -> g -> gs -> sm.
def _weather_ctes(keys: str) -> str:
    return f"""
w AS (SELECT {_sql(LINEITEM_WEATHER)} FROM lineitem),
g AS (
  SELECT *,
    CASE WHEN temperature_c < 5 THEN 'Very Cold' WHEN temperature_c < 15 THEN 'Cold'
         WHEN temperature_c < 25 THEN 'Moderate' WHEN temperature_c < 35 THEN 'Warm'
         ELSE 'Very Hot' END AS temperature_category,
    CASE WHEN precipitation_mm = 0 THEN 'No Rain' WHEN precipitation_mm <= 2.5 THEN 'Light Rain'
         WHEN precipitation_mm <= 7.5 THEN 'Moderate Rain' ELSE 'Heavy Rain' END AS precipitation_category,
    CASE WHEN wind_speed_kmh < 20 THEN 'Low' WHEN wind_speed_kmh < 40 THEN 'Moderate'
         WHEN wind_speed_kmh < 60 THEN 'Strong' ELSE 'Very Strong' END AS wind_category,
    CASE WHEN visibility_m < 1000 THEN 'Very Low' WHEN visibility_m < 5000 THEN 'Low'
         WHEN visibility_m < 10000 THEN 'Moderate' ELSE 'Good' END AS visibility_category,
    CAST(
      (CASE WHEN precipitation_mm > 7.5 THEN 30 WHEN precipitation_mm > 2.5 THEN 15 ELSE 0 END)
    + (CASE WHEN wind_speed_kmh >= 60 THEN 30 WHEN wind_speed_kmh >= 40 THEN 15 ELSE 0 END)
    + (CASE WHEN visibility_m < 1000 THEN 25 WHEN visibility_m < 5000 THEN 10 ELSE 0 END)
    + (CASE WHEN temperature_c < 0 THEN 15 WHEN temperature_c > 40 THEN 15 ELSE 0 END)
    AS INTEGER) AS condition_score
  FROM w),
gs AS (
  SELECT *,
    CASE WHEN condition_score >= 50 THEN 'Red - High Risk'
         WHEN condition_score >= 25 THEN 'Yellow - Caution'
         ELSE 'Green - Normal' END AS condition_status
  FROM g),
sm0 AS (
  SELECT {keys},
    count(*) AS weather_records,
    {_avg2('temperature_c')} AS avg_temperature_c,
    {_one2('min(temperature_c)')} AS min_temperature_c,
    {_one2('max(temperature_c)')} AS max_temperature_c,
    {_avg2('humidity_pct')} AS avg_humidity_pct,
    {_sum2('precipitation_mm')} AS total_precipitation_mm,
    {_avg2('visibility_m')} AS avg_visibility_m,
    {_one2('min(visibility_m)')} AS min_visibility_m,
    {_one2('max(wind_speed_kmh)')} AS max_wind_speed_kmh,
    {_one2('max(wind_gust_kmh)')} AS max_wind_gust_kmh,
    {_avg2('condition_score')} AS avg_condition_score,
    max(CASE WHEN condition_status = 'Red - High Risk' THEN 1 ELSE 0 END) AS has_red_condition,
    max(CASE WHEN condition_status = 'Yellow - Caution' THEN 1 ELSE 0 END) AS has_yellow_condition
  FROM gs GROUP BY {keys}),
sm AS (
  SELECT *,
    CASE WHEN has_red_condition = 1 THEN 'Red - High Risk'
         WHEN has_yellow_condition = 1 THEN 'Yellow - Caution'
         ELSE 'Green - Normal' END AS overall_condition
  FROM sm0)
"""

_WEATHER_CTES = _weather_ctes("trek_id, trek_name")
# A mart's summary has one row per place, whatever its names.
_MART_CTES = _weather_ctes("trek_id")

CONDITION_SCORE = f"""WITH {_WEATHER_CTES}
SELECT l_orderkey, l_linenumber, temperature_category, precipitation_category, wind_category,
       visibility_category, condition_score, condition_status
FROM gs
"""

ENTITY_SUMMARY = f"""WITH {_WEATHER_CTES}
SELECT * FROM sm
"""

COUNT_BY = """
SELECT c_mktsegment, count(*) AS customer_count FROM customer GROUP BY c_mktsegment
"""

KEY_PROFILE = """
SELECT count(*) AS total_rows, count(DISTINCT o_custkey) AS unique_keys,
       count(*) FILTER (WHERE o_custkey IS NULL) AS null_keys
FROM orders
"""

ADD_DELTA = f"""
WITH s AS (SELECT {_sql(LINEITEM_DELTA)} FROM lineitem)
SELECT *, end_value - start_value AS delta FROM s
"""

_PART_NULLS = f"WITH pn AS (SELECT {_sql(PART_WITH_NULLS)} FROM part)"

SPLIT_VALID = f"""{_PART_NULLS}
SELECT * FROM pn WHERE p_name IS NOT NULL AND p_size IS NOT NULL AND p_retailprice IS NOT NULL
"""

SPLIT_SKIPPED = f"""{_PART_NULLS}
SELECT * FROM pn WHERE NOT (p_name IS NOT NULL AND p_size IS NOT NULL AND p_retailprice IS NOT NULL)
"""


def _missing_row(col: str) -> str:
    return (
        f"SELECT 'Missing values' AS \"check\", '{col}' AS \"column\", count(*) AS total_records, "
        f"count(*) FILTER (WHERE {col} IS NULL) AS missing_records, "
        f"CASE WHEN count(*) FILTER (WHERE {col} IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM pn"
    )


MISSING_REPORT = f"""{_PART_NULLS}
{' UNION ALL '.join(_missing_row(c) for c in ['p_name', 'p_size', 'p_retailprice', 'p_brand'])}
"""

NULL_PROFILE = f"""{_PART_NULLS}
{' UNION ALL '.join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM pn"
    for c in ['p_partkey', 'p_name', 'p_size', 'p_retailprice', 'p_brand', 'p_type'])}
"""

_Q_BAD = "(l_quantity IS NOT NULL AND NOT (l_quantity BETWEEN 1 AND 45))"
_D_BAD = "(l_discount IS NOT NULL AND NOT (l_discount BETWEEN 0 AND CAST(0.08 AS DOUBLE)))"
_TD_BAD = (
    "((l_tax IS NOT NULL AND NOT (l_tax BETWEEN 0 AND CAST(0.06 AS DOUBLE))) OR "
    "(l_discount IS NOT NULL AND NOT (l_discount BETWEEN 0 AND CAST(0.06 AS DOUBLE))))"
)


def _range_row(name: str, cols: str, bad: str) -> str:
    return (
        f"SELECT '{name}' AS \"check\", '{cols}' AS columns, count(*) AS total_records, "
        f"count(*) FILTER (WHERE {bad}) AS invalid_records, "
        f"CASE WHEN count(*) FILTER (WHERE {bad}) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM lineitem"
    )


RANGE_REPORT = " UNION ALL ".join(
    [
        _range_row("quantity", "l_quantity", _Q_BAD),
        _range_row("discount", "l_discount", _D_BAD),
        _range_row("tax_and_discount", "l_tax,l_discount", _TD_BAD),
    ]
)

RANGE_VIOLATIONS = f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax,
  {_Q_BAD} AS quantity, {_D_BAD} AS discount, {_TD_BAD} AS tax_and_discount
FROM lineitem
WHERE {_Q_BAD} OR {_D_BAD} OR {_TD_BAD}
"""


def _nn(model: str, src: str, col: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{col}' AS \"column\", 'not_null' AS test, "
        f"count(*) FILTER (WHERE {col} IS NULL) AS failures, "
        f"count(*) FILTER (WHERE {col} IS NULL) != 0 AS should_warn, "
        f"count(*) FILTER (WHERE {col} IS NULL) != 0 AS should_error FROM {src}"
    )


NOT_NULL_TEST = f"""{_PART_NULLS}
{' UNION ALL '.join([
    _nn('orders', 'orders', 'o_orderkey'),
    _nn('orders', 'orders', 'o_custkey'),
    _nn('events', 'events', 'user_id'),
    _nn('part_nulls', 'pn', 'p_name'),
    _nn('part_nulls', 'pn', 'p_size'),
])}
"""


def _uq(model: str, col: str) -> str:
    inner = (
        f"(SELECT {col}, count(*) AS n_records FROM {model} WHERE {col} IS NOT NULL "
        f"GROUP BY {col} HAVING count(*) > 1)"
    )
    return (
        f"SELECT '{model}' AS model, '{col}' AS \"column\", 'unique' AS test, count(*) AS failures, "
        f"count(*) != 0 AS should_warn, count(*) != 0 AS should_error FROM {inner}"
    )


UNIQUE_TEST = " UNION ALL ".join(
    [
        _uq("orders", "o_orderkey"),
        _uq("events", "user_id"),
        _uq("events", "event_id"),
        _uq("customer", "c_custkey"),
    ]
)

_MESSY = f"WITH m AS (SELECT {_sql(CUSTOMER_MESSY)} FROM customer)"

DROP_UNNAMED_COLUMNS = f"""{_MESSY}
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, c_comment FROM m
"""

DROP_EMPTY_COLUMNS = f"""{_MESSY}
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, _c6 FROM m
"""

DROP_EMPTY_ROWS = f"""{_MESSY}
SELECT * FROM m
WHERE NOT (c_custkey IS NULL AND c_name IS NULL AND c_nationkey IS NULL AND c_acctbal IS NULL
           AND c_mktsegment IS NULL AND c_comment IS NULL AND _c5 IS NULL AND _c6 IS NULL)
"""

DEDUPE = f"""
WITH u AS (
  SELECT event_id, ts, user_id, event_type, value FROM events
  UNION ALL
  SELECT {_sql(EVENTS_SHIFTED_COPY)} FROM events),
r AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM u)
SELECT event_id, ts, user_id, event_type, value FROM r WHERE rn = 1
"""

ZIP_EXPLODE = """
WITH e AS (
  SELECT vec_id, label, CASE WHEN vec_id % 25 <> 0 THEN embedding END AS vals, embedding
  FROM embeddings),
x AS (
  SELECT vec_id, label, vals, embedding, unnest(generate_series(1, len(vals))) AS i
  FROM e WHERE vals IS NOT NULL AND len(vals) > 0)
SELECT vec_id, label, CAST(i - 1 AS INTEGER) AS pos, CAST(vals[i] AS DOUBLE) AS value,
  CASE WHEN i < len(embedding) THEN CAST(embedding[i] AS DOUBLE) END AS head
FROM x
"""

PARSE_EVENT_TIME = """
WITH s AS (
  SELECT event_id,
    CASE WHEN event_id % 10 = 0 THEN 'not-a-time'
         WHEN event_id % 10 = 1 THEN NULL
         WHEN event_id % 10 = 2 THEN strftime(ts, '%Y-%m-%d %H:%M')
         ELSE strftime(ts, '%Y-%m-%dT%H:%M') END AS time_text
  FROM events)
SELECT event_id, time_text, try_strptime(time_text, '%Y-%m-%dT%H:%M') AS weather_time,
  CAST(try_strptime(time_text, '%Y-%m-%dT%H:%M') AS DATE) AS weather_date
FROM s WHERE try_strptime(time_text, '%Y-%m-%dT%H:%M') IS NOT NULL
"""

READ_JSON_DOCS = """
SELECT event_id, ts, user_id, event_type, value, props, 'json' AS source_ext FROM events
"""

READ_CSV_ROUNDTRIP = f"SELECT {_sql(CUSTOMER_CSV)} FROM customer"

WRITE_PARQUET_ROUNDTRIP = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
"""

READ_JSON_MULTILINE = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'txt' AS source_ext FROM customer
WHERE c_custkey IS NOT NULL
"""

LOAD_STAGE_FILES = """
SELECT c_custkey, c_name, CAST(NULL AS DOUBLE) AS c_acctbal FROM customer
UNION ALL SELECT c_custkey, NULL, c_acctbal FROM customer
"""

MATERIALIZED_MODELS = """
WITH v AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey)
SELECT 'source' AS model, count(*) AS rows, CAST(sum(c_custkey) AS BIGINT) AS total FROM customer
UNION ALL SELECT 'view', count(*), CAST(sum(n) AS BIGINT) FROM v
UNION ALL SELECT 'table', count(*), CAST(sum(n * 2) AS BIGINT) FROM v
"""

LOAD_STAGE_UNION = """
SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 2 <> 0 THEN o_orderstatus END AS o_orderstatus,
  CAST(NULL AS BIGINT) AS order_count
FROM orders WHERE o_orderkey IS NOT NULL
"""

_SUMMARY_COLS = [
    "weather_records", "avg_temperature_c", "min_temperature_c", "max_temperature_c",
    "avg_humidity_pct", "total_precipitation_mm", "avg_visibility_m", "min_visibility_m",
    "max_wind_speed_kmh", "max_wind_gust_kmh", "avg_condition_score",
    "has_red_condition", "has_yellow_condition", "overall_condition",
]
_HOURLY_COLS = [
    "weather_date", "weather_time", "temperature_c", "humidity_pct", "precipitation_mm",
    "visibility_m", "wind_speed_kmh", "wind_gust_kmh", "temperature_category",
    "precipitation_category",
]
_SUP = "s.s_suppkey AS trek_id, s.s_name, s.s_nationkey, s.s_acctbal"

MART_ENTITY = f"""WITH {_MART_CTES}
SELECT {_SUP}, {', '.join('m.' + c for c in _SUMMARY_COLS)}
FROM supplier s LEFT JOIN sm m ON s.s_suppkey = m.trek_id
"""

MART_HOUR = f"""WITH {_MART_CTES}
SELECT {_SUP}, {', '.join('m.' + c for c in _SUMMARY_COLS)}, {', '.join('h.' + c for c in _HOURLY_COLS)}
FROM supplier s
LEFT JOIN sm m ON s.s_suppkey = m.trek_id
LEFT JOIN gs h ON s.s_suppkey = h.trek_id
"""

MART_UNION = f"""WITH {_MART_CTES},
u AS (
  SELECT trek_id, {', '.join(_HOURLY_COLS)} FROM gs
  UNION ALL BY NAME
  SELECT trek_id, {', '.join(_SUMMARY_COLS)} FROM sm)
SELECT {_SUP}, {', '.join('x.' + c for c in _SUMMARY_COLS + _HOURLY_COLS)}
FROM supplier s LEFT JOIN u x ON s.s_suppkey = x.trek_id
"""

MODEL_TESTS = """
WITH mart AS (
  SELECT s.s_suppkey AS trek_id FROM supplier s LEFT JOIN lineitem l ON s.s_suppkey = l.l_suppkey),
dup AS (
  SELECT s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL GROUP BY s_suppkey HAVING count(*) > 1),
t AS (
  SELECT 'stg_treks' AS model, 'trek_id' AS "column", 'not_null' AS test,
         count(*) FILTER (WHERE s_suppkey IS NULL) AS failures FROM supplier
  UNION ALL
  SELECT 'stg_treks', 'trek_id', 'unique', count(*) FROM dup
  UNION ALL
  SELECT 'stg_weather', 'trek_id', 'not_null', count(*) FILTER (WHERE l_suppkey IS NULL) FROM lineitem
  UNION ALL
  SELECT 'int_trek_weather', 'trek_id', 'not_null', count(*) FILTER (WHERE trek_id IS NULL) FROM mart
  UNION ALL
  SELECT 'trek_analytics', 'trek_id', 'not_null', count(*) FILTER (WHERE trek_id IS NULL) FROM mart)
SELECT model, "column", test, failures, failures != 0 AS should_warn, failures != 0 AS should_error FROM t
"""

_LEDGER = f"""
WITH landed AS (
  SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey),
expected AS (
  SELECT c_custkey, c_name, c_nationkey FROM customer
  UNION ALL
  SELECT {_sql(CUSTOMER_MISSING)} FROM customer),
ledger AS (
  SELECT c.c_custkey, c.c_name, c.c_nationkey,
    CASE WHEN l.n > 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
    coalesce(l.n, 0) AS landed_records
  FROM expected c LEFT JOIN landed l ON c.c_custkey = l.o_custkey)
"""

INGEST_LEDGER = _LEDGER + "SELECT * FROM ledger"

LEDGER_SUMMARY = (
    _LEDGER
    + """,
agg AS (
  SELECT count(*) AS expected, count(*) FILTER (WHERE status = 'SUCCESS') AS succeeded,
         count(*) FILTER (WHERE status <> 'SUCCESS') AS failed FROM ledger)
SELECT expected, succeeded, failed,
  CASE WHEN succeeded = expected AND failed = 0 THEN 'SUCCESS'
       WHEN succeeded > 0 THEN 'PARTIAL' ELSE 'FAILED' END AS verdict
FROM agg
"""
)

_STAGE_COUNTS = f"""
WITH w AS (SELECT {_sql(LINEITEM_WEATHER)} FROM lineitem WHERE l_shipdate IS NOT NULL),
d AS (
  SELECT trek_id, trek_name, row_number() OVER (
    PARTITION BY trek_id, weather_time ORDER BY l_orderkey, l_linenumber) AS rn FROM w QUALIFY rn = 1),
c AS (
  SELECT
    (SELECT count(*) FROM lineitem) AS s0,
    (SELECT count(*) FROM lineitem WHERE l_shipdate IS NOT NULL) AS s1,
    (SELECT count(*) FROM (SELECT DISTINCT l_suppkey, l_shipdate FROM lineitem
                           WHERE l_shipdate IS NOT NULL)) AS s2,
    (SELECT count(*) FROM (SELECT DISTINCT trek_id, trek_name FROM d)) AS s4)
"""

STAGE_REPORT = (
    _STAGE_COUNTS
    + """
SELECT 0 AS step, 'bronze' AS stage, s0 AS records, CAST(NULL AS BIGINT) AS removed FROM c
UNION ALL SELECT 1, 'valid_time', s1, s0 - s1 FROM c
UNION ALL SELECT 2, 'silver', s2, s1 - s2 FROM c
UNION ALL SELECT 3, 'gold', s2, 0 FROM c
UNION ALL SELECT 4, 'summary', s4, s2 - s4 FROM c
"""
)

RECONCILE = (
    _STAGE_COUNTS
    + """
SELECT 'equal_count' AS "check", 'silver' AS stage, 'gold' AS other_stage, s2 AS records,
       s2 AS other_records, 'PASS' AS status FROM c
UNION ALL
SELECT 'nonempty', 'summary', CAST(NULL AS VARCHAR), s4, CAST(NULL AS BIGINT),
       CASE WHEN s4 > 0 THEN 'PASS' ELSE 'FAIL' END FROM c
"""
)

EXPECT_COUNT = (
    _STAGE_COUNTS
    + """
SELECT 'gold equals silver' AS "check", s2 AS expected, s2 AS actual, 'PASS' AS status FROM c
UNION ALL
SELECT 'dedupe keeps all rows', s0, s2, CASE WHEN s0 = s2 THEN 'PASS' ELSE 'FAIL' END FROM c
"""
)

TOP_N = """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 20
"""

def _hour_text(i: str) -> str:
    return (
        f"'2026-01-' || lpad(CAST(1 + ({i}) // 24 AS VARCHAR), 2, '0') || 'T' || "
        f"lpad(CAST(({i}) % 24 AS VARCHAR), 2, '0') || ':00'"
    )


def _weather_docs_gold() -> str:
    return f"""
WITH d AS (
  SELECT vec_id, CASE WHEN vec_id % 25 <> 0 THEN embedding END AS hourly_values FROM embeddings),
e AS (
  -- a document without an hourly block yields no rows
  SELECT vec_id, hourly_values AS embedding, len(hourly_values) AS n FROM d
  WHERE hourly_values IS NOT NULL),
x AS (SELECT vec_id, embedding, n, unnest(generate_series(0, n - 1)) AS i FROM e),
w AS (
  SELECT vec_id AS trek_id, 'Vector#' || CAST(vec_id AS VARCHAR) AS trek_name,
    CAST(30.0 AS DOUBLE) AS latitude, CAST(78.0 AS DOUBLE) AS longitude,
    CAST(vec_id * 10 AS DOUBLE) AS elevation, i,
    CASE WHEN vec_id % 10 = 0 AND i = 5 THEN 'bad'
         WHEN vec_id % 11 = 0 AND i = n - 1 THEN {_hour_text('i - 1')}
         ELSE {_hour_text('i')} END AS time_text,
    CAST(embedding[i + 1] AS DOUBLE) * 100 AS temperature_c,
    CAST(CAST(floor(abs(CAST(embedding[i + 1] AS DOUBLE)) * 1000) AS BIGINT) AS DOUBLE) AS humidity_pct,
    abs(CAST(embedding[i + 1] AS DOUBLE)) * 50 AS precipitation_mm,
    abs(CAST(embedding[i + 1] AS DOUBLE)) * 100000 AS visibility_m,
    CASE WHEN vec_id % 7 = 0 AND i >= n - 3 THEN NULL
         ELSE abs(CAST(embedding[i + 1] AS DOUBLE)) * 400 END AS wind_speed_kmh,
    abs(CAST(embedding[i + 1] AS DOUBLE)) * 500 AS wind_gust_kmh
  FROM x),
t AS (
  SELECT *, try_strptime(time_text, '%Y-%m-%dT%H:%M') AS weather_time FROM w),
s AS (
  SELECT *, CAST(weather_time AS DATE) AS weather_date,
    row_number() OVER (PARTITION BY trek_id, weather_time ORDER BY i) AS rn
  FROM t WHERE weather_time IS NOT NULL),
g AS (
  SELECT *,
    CASE WHEN temperature_c < 5 THEN 'Very Cold' WHEN temperature_c < 15 THEN 'Cold'
         WHEN temperature_c < 25 THEN 'Moderate' WHEN temperature_c < 35 THEN 'Warm'
         ELSE 'Very Hot' END AS temperature_category,
    CASE WHEN precipitation_mm = 0 THEN 'No Rain' WHEN precipitation_mm <= 2.5 THEN 'Light Rain'
         WHEN precipitation_mm <= 7.5 THEN 'Moderate Rain' ELSE 'Heavy Rain' END AS precipitation_category,
    CASE WHEN wind_speed_kmh < 20 THEN 'Low' WHEN wind_speed_kmh < 40 THEN 'Moderate'
         WHEN wind_speed_kmh < 60 THEN 'Strong' ELSE 'Very Strong' END AS wind_category,
    CASE WHEN visibility_m < 1000 THEN 'Very Low' WHEN visibility_m < 5000 THEN 'Low'
         WHEN visibility_m < 10000 THEN 'Moderate' ELSE 'Good' END AS visibility_category,
    CAST(
      (CASE WHEN precipitation_mm > 7.5 THEN 30 WHEN precipitation_mm > 2.5 THEN 15 ELSE 0 END)
    + (CASE WHEN wind_speed_kmh >= 60 THEN 30 WHEN wind_speed_kmh >= 40 THEN 15 ELSE 0 END)
    + (CASE WHEN visibility_m < 1000 THEN 25 WHEN visibility_m < 5000 THEN 10 ELSE 0 END)
    + (CASE WHEN temperature_c < 0 THEN 15 WHEN temperature_c > 40 THEN 15 ELSE 0 END)
    AS INTEGER) AS condition_score
  FROM s WHERE rn = 1)
SELECT trek_id, trek_name, latitude, longitude, elevation, weather_date, weather_time,
  temperature_c, humidity_pct, precipitation_mm, visibility_m, wind_speed_kmh, wind_gust_kmh,
  temperature_category, precipitation_category, wind_category, visibility_category, condition_score,
  CASE WHEN condition_score >= 50 THEN 'Red - High Risk'
       WHEN condition_score >= 25 THEN 'Yellow - Caution' ELSE 'Green - Normal' END AS condition_status,
  'json' AS source_ext
FROM g
"""


WEATHER_DOCS_GOLD = _weather_docs_gold()

_PLACE_TEXT_COLS = [
    "trek_name", "category", "starting_point", "start_lat", "start_lon", "start_elevation",
    "ending_point", "end_lat", "end_lon", "end_elevation", "distance_km", "duration_days",
    "difficulty", "best_season", "approx_cost",
]
_NUMERIC = ["start_lat", "start_lon", "start_elevation", "end_lat", "end_lon", "end_elevation", "distance_km"]
_LABELS = [
    "Easy", "Easy-Moderate", "Moderate", "Moderate-Difficult", "Difficult", "Very Difficult",
    "Extreme", "Hard",
]


def _money(side_pattern: str, text: str) -> str:
    clean = f"regexp_replace({text}, '[₹,\\s]', '', 'g')"
    raw = f"regexp_extract({clean}, '{side_pattern}', 1)"
    unit = f"regexp_extract({clean}, '{side_pattern}', 2)"
    return (
        f"CASE WHEN {raw} = '' THEN NULL WHEN lower({unit}) = 'k' THEN TRY_CAST({raw} AS DOUBLE) * 1000 "
        f"ELSE TRY_CAST({raw} AS DOUBLE) END"
    )


_PLACES_DEDUPED = f"""
WITH a AS (
  SELECT p_partkey, p_size, p_name, p_type, p_brand,
         p_partkey % 4000 + 500 AS lo, p_partkey % 4000 + 500 + p_size * 100 AS hi
  FROM part),
raw AS (
  SELECT {_sql(PLACE_TEXT)} FROM a
  UNION ALL
  SELECT {_sql(PLACE_TEXT_COPY)} FROM a),
dd AS (
  SELECT trek_id AS trek_id_text, TRY_CAST(trek_id AS BIGINT) AS trek_id, {', '.join(_PLACE_TEXT_COLS)},
    row_number() OVER (
      PARTITION BY trek_id
      ORDER BY {', '.join(c + ' ASC NULLS FIRST' for c in _PLACE_TEXT_COLS)}) AS rn
  FROM raw)"""

PLACES_QUARANTINE = f"""{_PLACES_DEDUPED},
t AS (
  SELECT trek_id_text, trek_id, trek_name,
    {', '.join(f'TRY_CAST({c} AS DOUBLE) AS {c}' for c in ('start_lat', 'start_lon', 'end_lat', 'end_lon'))}
  FROM dd WHERE rn = 1)
SELECT * FROM t
WHERE trek_id IS NULL OR start_lat IS NULL OR start_lon IS NULL OR end_lat IS NULL OR end_lon IS NULL
"""

PLACES_CSV_GOLD = f"""{_PLACES_DEDUPED},
s AS (
  SELECT trek_id, trek_name, category, starting_point,
    {', '.join(f'TRY_CAST({c} AS DOUBLE) AS {c}' for c in _NUMERIC)},
    ending_point, duration_days, difficulty, best_season, approx_cost,
    TRY_CAST(NULLIF(regexp_extract(trim(duration_days), '^{NUM}', 1), '') AS DOUBLE) AS dmin,
    regexp_extract(trim(duration_days), '(?:[–-]|to)\\s*{NUM}$', 1) AS dmax_raw
  FROM dd WHERE rn = 1),
v AS (
  SELECT *, CASE WHEN dmax_raw = '' THEN dmin ELSE TRY_CAST(dmax_raw AS DOUBLE) END AS dmax
  FROM s
  WHERE trek_id IS NOT NULL AND start_lat IS NOT NULL AND start_lon IS NOT NULL AND end_lat IS NOT NULL AND end_lon IS NOT NULL)
SELECT trek_id, trek_name, category, starting_point, start_lat, start_lon, start_elevation,
  ending_point, end_lat, end_lon, end_elevation,
  end_elevation - start_elevation AS elevation_gain_m,
  distance_km,
  CASE WHEN distance_km IS NULL THEN 'Unknown' WHEN distance_km < 10 THEN 'Short'
       WHEN distance_km < 20 THEN 'Medium' ELSE 'Long' END AS distance_category,
  duration_days,
  dmin AS duration_min_days, dmax AS duration_max_days, (dmin + dmax) / 2 AS duration_avg_days,
  CASE WHEN dmax IS NULL THEN 'Unknown' WHEN dmax <= 2 THEN 'Short'
       WHEN dmax <= 5 THEN 'Medium' ELSE 'Long' END AS duration_category,
  CASE lower(trim(difficulty))
    {' '.join(f"WHEN '{lab.lower()}' THEN '{lab}'" for lab in _LABELS)}
    ELSE trim(difficulty) END AS difficulty,
  best_season, approx_cost,
  {_money(_MONEY_MIN, 'approx_cost')} AS cost_min,
  {_money(_MONEY_MAX, 'approx_cost')} AS cost_max
FROM v
"""

ORACLE: dict[str, str] = {
    "coerce_numeric": COERCE_NUMERIC,
    "parse_range": PARSE_RANGE,
    "parse_money_range": PARSE_MONEY_RANGE,
    "standardize_label": STANDARDIZE_LABEL,
    "bucketize_lt": BUCKETIZE_LT,
    "bucketize_le": BUCKETIZE_LE,
    "bucketize_null": BUCKETIZE_NULL,
    "condition_score": CONDITION_SCORE,
    "entity_summary": ENTITY_SUMMARY,
    "count_by": COUNT_BY,
    "key_profile": KEY_PROFILE,
    "add_delta": ADD_DELTA,
    "split_valid": SPLIT_VALID,
    "split_skipped": SPLIT_SKIPPED,
    "missing_report": MISSING_REPORT,
    "null_profile": NULL_PROFILE,
    "range_report": RANGE_REPORT,
    "range_violations": RANGE_VIOLATIONS,
    "not_null_test": NOT_NULL_TEST,
    "unique_test": UNIQUE_TEST,
    "drop_unnamed_columns": DROP_UNNAMED_COLUMNS,
    "drop_empty_columns": DROP_EMPTY_COLUMNS,
    "drop_empty_rows": DROP_EMPTY_ROWS,
    "dedupe": DEDUPE,
    "zip_explode": ZIP_EXPLODE,
    "parse_event_time": PARSE_EVENT_TIME,
    "read_json_docs": READ_JSON_DOCS,
    "read_csv_roundtrip": READ_CSV_ROUNDTRIP,
    "write_parquet_roundtrip": WRITE_PARQUET_ROUNDTRIP,
    "load_stage_union": LOAD_STAGE_UNION,
    "mart_entity": MART_ENTITY,
    "mart_hour": MART_HOUR,
    "mart_union": MART_UNION,
    "model_tests": MODEL_TESTS,
    "ingest_ledger": INGEST_LEDGER,
    "ledger_summary": LEDGER_SUMMARY,
    "stage_report": STAGE_REPORT,
    "reconcile": RECONCILE,
    "expect_count": EXPECT_COUNT,
    "top_n": TOP_N,
    "weather_docs_gold": WEATHER_DOCS_GOLD,
    "places_csv_gold": PLACES_CSV_GOLD,
    "weather_docs_stream": WEATHER_DOCS_GOLD,
    "places_quarantine": PLACES_QUARANTINE,
    "read_json_multiline": READ_JSON_MULTILINE,
    "load_stage_files": LOAD_STAGE_FILES,
    "materialized_models": MATERIALIZED_MODELS,
}
# The summary of all hours at once is what the batches must add up to.
ORACLE |= LAYER_ORACLE | {"summary_incremental": ENTITY_SUMMARY, "bucketed_mart": MART_ENTITY}
