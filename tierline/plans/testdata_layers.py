"""Tables that change over time, checked reads and content checks over the
driver's tables, with the SQL that must give the same rows (see
:mod:`tierline.plans.testdata` for the rules)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tierline.operators.audit import reconcile_content
from tierline.operators.mart import build_mart
from tierline.plans import weather as W
from tierline.session import scratch_path
from tierline.sources.buckets import write_bucketed
from tierline.sources.checked import read_csv_checked, read_json_checked
from tierline.sources.ledger import join_files, load_new, read_ledger, read_loaded
from tierline.sources.merge import read_merged, upsert
from tierline.sources.versions import read_current, replace_parquet


def _t(spark, d, name):
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def q_versioned_replace(spark, d):
    """The customers replaced twice, the last time by rows made from the table
    itself; the version before is still there."""
    root = scratch_path(spark, "versioned")
    customers = _t(spark, d, "customer")
    replace_parquet(customers.select("c_custkey", "c_acctbal"), root)
    replace_parquet(customers.where("c_custkey % 2 = 0").select("c_custkey", "c_acctbal"), root, partition_by=None)
    replace_parquet(read_current(spark, root).where("c_custkey % 4 = 0").withColumn("c_acctbal", F.col("c_acctbal") * 2), root)
    both = [read_current(spark, root, n).select(F.lit(n).alias("version"), "c_custkey", "c_acctbal") for n in (2, 3)]
    return both[0].unionByName(both[1])


VERSIONED_REPLACE = """
SELECT 2 AS version, c_custkey, c_acctbal FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT 3, c_custkey, c_acctbal * 2 FROM customer WHERE c_custkey % 4 = 0
"""

_LANDING = "coalesce(o_orderkey % 3, 2)"


def _land_orders(spark, d, stage, part):
    _t(spark, d, "orders").where(f"{_LANDING} = {part}").select("o_orderkey", "o_custkey", "o_totalprice").write.parquet(f"{stage}/p{part}")


def q_load_ledger(spark, d):
    """Orders land in three parts: the first two are loaded, loaded again (to
    no effect), the third lands and only it is loaded, then all by force."""
    stage, root = scratch_path(spark, "landing"), scratch_path(spark, "loaded")
    for part in (0, 1):
        _land_orders(spark, d, stage, part)
    load_new(spark, stage, root)
    load_new(spark, stage, root)
    _land_orders(spark, d, stage, 2)
    load_new(spark, stage, root)
    load_new(spark, stage, root, force=True)
    return read_loaded(spark, root).select("o_orderkey", "o_custkey", "o_totalprice", "load_number")


LOAD_LEDGER = f"""
SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN {_LANDING} < 2 THEN 1 ELSE 2 END AS load_number FROM orders
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, 3 FROM orders
"""


def q_load_latest(spark, d):
    """Rows of each file's newest load, after a forced load of all files, and
    how often the ledger notes their file."""
    stage, root = scratch_path(spark, "landing"), scratch_path(spark, "loaded")
    _land_orders(spark, d, stage, 0)
    load_new(spark, stage, root)
    _land_orders(spark, d, stage, 1)
    load_new(spark, stage, root, force=True)
    noted = read_ledger(spark, root).groupBy(F.col("uri").alias("source_file")).agg(F.count("*").alias("times_loaded"))
    return join_files(read_loaded(spark, root, latest=True), noted, ["source_file"]).select("o_orderkey", "load_number", "times_loaded")


LOAD_LATEST = f"""
SELECT o_orderkey, 2 AS load_number, CASE WHEN {_LANDING} = 0 THEN 2 ELSE 1 END AS times_loaded
FROM orders WHERE {_LANDING} < 2
"""


def q_upsert_events(spark, d):
    """Events in a table by day; two batches of corrections are merged in, the
    later one first in order."""
    root = scratch_path(spark, "upsert")
    events = _t(spark, d, "events").select("event_id", "user_id", "value", F.to_date("ts").alias("day"))
    batches = [
        events.withColumn("batch", F.lit(0)),
        events.where("event_id % 3 = 0").withColumns({"value": F.col("value") + 1, "batch": F.lit(1)}),
        events.where("event_id % 5 = 0").withColumns({"value": F.lit(0.0), "batch": F.lit(2)}),
    ]
    for batch in batches:
        upsert(batch, root, ["event_id"], "day", [F.desc("batch")])
    return read_merged(spark, root, batches[0].schema)


UPSERT_EVENTS = """
SELECT event_id, user_id,
  CASE WHEN event_id % 5 = 0 THEN 0.0 WHEN event_id % 3 = 0 THEN value + 1 ELSE value END AS value,
  CAST(ts AS DATE) AS day, CASE WHEN event_id % 5 = 0 THEN 2 WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS batch
FROM events
"""


def q_summary_incremental(spark, d):
    """The place summary, from three batches of hours; the second one is
    handed in twice."""
    from tierline.plans.testdata import _gold

    root, gold = scratch_path(spark, "summary-state"), _gold(spark, d)
    extra = lineitem_batch(spark, d)
    for batch in (0, 1, 1, 2):
        W.update_weather_summary(extra(gold, batch), root, f"batch {batch}")
    return W.read_weather_summary(spark, root)


def lineitem_batch(spark, d):
    """Hours of one of three batches (by temperature, NULL in the last)."""
    return lambda gold, k: gold.where(F.coalesce(F.pmod(F.floor("temperature_c"), F.lit(3)), F.lit(2)) == k)


# One document per line of text; every tenth is broken in one of three ways.
CSV_SCHEMA = "k long, name string, balance double"
_CSV_LINE = (
    "CASE coalesce(c_custkey, 0) % 10 WHEN 3 THEN CAST(c_custkey AS STRING) || ',' || c_name || ',1.5,one more' "
    "WHEN 6 THEN CAST(c_custkey AS STRING) || ',' || c_name "
    "WHEN 9 THEN CAST(c_custkey AS STRING) || ',' || c_name || ',n/a' "
    "ELSE CAST(c_custkey AS STRING) || ',' || c_name || ',' || CAST(c_nationkey AS STRING) || '.25' END"
)
_CSV_ROWS = "c_custkey IS NOT NULL AND c_name IS NOT NULL AND c_nationkey IS NOT NULL"


def _csv(spark, d):
    path = scratch_path(spark, "messy-csv")
    _t(spark, d, "customer").where(_CSV_ROWS).selectExpr(f"{_CSV_LINE} AS value").write.text(path)
    return read_csv_checked(spark, path, CSV_SCHEMA, scratch_path(spark, "checked-csv"), header=False)


def q_csv_good(spark, d):
    return _csv(spark, d).good.select("k", "name", "balance")


def q_csv_malformed(spark, d):
    bad = _csv(spark, d).malformed
    return bad.select("raw", "reason", F.col("source_file").isNotNull().alias("has_file"))


CSV_GOOD = f"""
SELECT c_custkey AS k, c_name AS name, c_nationkey + CAST(0.25 AS DOUBLE) AS balance
FROM customer WHERE {_CSV_ROWS} AND c_custkey % 10 NOT IN (3, 6, 9)
"""
CSV_MALFORMED = f"""
SELECT {_CSV_LINE} AS raw,
  CASE c_custkey % 10 WHEN 3 THEN 'more than 3 cells' WHEN 6 THEN '2 of 3 cells'
    ELSE 'not of its type: balance (double)' END AS reason, TRUE AS has_file
FROM customer WHERE {_CSV_ROWS} AND c_custkey % 10 IN (3, 6, 9)
"""

JSON_SCHEMA = "k long, segment string, place struct<nation: int>"
_JSON_LINE = (
    "CASE c_custkey % 10 WHEN 3 THEN '{\"k\": ' || CAST(c_custkey AS STRING) || ', \"segment\": \"cut' "
    "WHEN 6 THEN '{\"k\": \"x' || CAST(c_custkey AS STRING) || '\", \"segment\": \"s\"}' "
    "ELSE '{\"k\": ' || CAST(c_custkey AS STRING) || ', \"segment\": \"' || c_mktsegment || '\", \"place\": {\"nation\": ' "
    "|| CAST(c_nationkey AS STRING) || '}, \"more\": 1}' END"
)
_JSON_ROWS = "c_custkey IS NOT NULL AND c_mktsegment IS NOT NULL AND c_nationkey IS NOT NULL"


def q_json_checked(spark, d):
    """Good documents and malformed ones of the same read, side by side."""
    path = scratch_path(spark, "messy-json")
    _t(spark, d, "customer").where(_JSON_ROWS).selectExpr(f"{_JSON_LINE} AS value").write.text(path)
    both = read_json_checked(spark, path, JSON_SCHEMA, scratch_path(spark, "checked-json"))
    good = both.good.select("k", "segment", F.col("place.nation").alias("nation"))
    return good.unionByName(both.malformed.select("raw", "reason"), allowMissingColumns=True)


JSON_CHECKED = f"""
SELECT c_custkey AS k, c_mktsegment AS segment, c_nationkey AS nation, NULL AS raw, NULL AS reason
FROM customer WHERE {_JSON_ROWS} AND c_custkey % 10 NOT IN (3, 6)
UNION ALL
SELECT NULL, NULL, NULL, {_JSON_LINE}, CASE c_custkey % 10 WHEN 3 THEN 'not JSON' ELSE 'not of its type: k (bigint)' END
FROM customer WHERE {_JSON_ROWS} AND c_custkey % 10 IN (3, 6)
"""


def q_reconcile_content(spark, d):
    """Orders against a copy with a price changed, rows missing, rows there
    twice, and two columns swapped between neighbours."""
    orders = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    copy = orders.where("coalesce(o_orderkey % 101, 0) <> 7").withColumns(
        {
            "o_totalprice": F.expr("CASE WHEN o_orderkey % 103 = 5 THEN o_totalprice + 1 ELSE o_totalprice END"),
            "o_custkey": F.expr("CASE WHEN o_orderkey % 107 = 9 THEN o_custkey + 1 ELSE o_custkey END"),
            "o_orderstatus": F.expr("CASE WHEN o_orderkey % 107 = 9 THEN 'swapped' ELSE o_orderstatus END"),
        }
    )
    copy = copy.unionByName(copy.where("o_orderkey % 109 = 11"))
    out = reconcile_content(orders, copy, ["o_orderkey"])
    return out.withColumn("columns", F.array_join("columns", ","))


RECONCILE_CONTENT = """
WITH f AS (
  SELECT o_orderkey, o_orderkey % 101 = 7 AS gone, o_orderkey % 103 = 5 AS priced, o_orderkey % 107 = 9 AS swapped,
    o_orderkey % 109 = 11 AS again FROM orders WHERE o_orderkey IS NOT NULL)
SELECT o_orderkey, 1 AS left_rows, CASE WHEN gone THEN 0 WHEN again THEN 2 ELSE 1 END AS right_rows,
  CASE WHEN gone OR again THEN 'o_custkey,o_totalprice,o_orderstatus'
    ELSE array_to_string(list_filter([CASE WHEN swapped THEN 'o_custkey' END, CASE WHEN priced THEN 'o_totalprice' END,
      CASE WHEN swapped THEN 'o_orderstatus' END], lambda x: x IS NOT NULL), ',') END AS columns,
  CASE WHEN gone THEN 'only_left' ELSE 'differs' END AS status
FROM f WHERE gone OR priced OR swapped OR again
"""

#: Buckets of a layer's key; a cluster takes some per core.
BUCKETS = 16


def q_bucketed_mart(spark, d):
    """The entity mart over layers that are laid out by place: summary and join
    read the buckets, without an exchange."""
    from tierline.plans.testdata import MART_WEATHER_COLUMNS, SUMMARY_COLUMNS, _gold, _supplier_entities

    root, name = scratch_path(spark, "buckets"), f"tierline_{uuid.uuid4().hex[:12]}"
    hours = write_bucketed(_gold(spark, d), f"{name}_hours", f"{root}/hours", ["trek_id"], BUCKETS, ["weather_time"])
    places = write_bucketed(_supplier_entities(spark, d), f"{name}_places", f"{root}/places", ["trek_id"], BUCKETS)
    columns = [c for c in MART_WEATHER_COLUMNS if c in SUMMARY_COLUMNS]
    return build_mart(
        places, "trek_id", summary=W.weather_summary(hours, ["trek_id"]), summary_cols=SUMMARY_COLUMNS, columns=columns,
        summary_is_unique=True,
    )


QUERIES = {
    "bucketed_mart": q_bucketed_mart,
    "versioned_replace": q_versioned_replace,
    "load_ledger": q_load_ledger,
    "load_latest": q_load_latest,
    "upsert_events": q_upsert_events,
    "summary_incremental": q_summary_incremental,
    "csv_good": q_csv_good,
    "csv_malformed": q_csv_malformed,
    "json_checked": q_json_checked,
    "reconcile_content": q_reconcile_content,
}
ORACLE = {
    "versioned_replace": VERSIONED_REPLACE,
    "load_ledger": LOAD_LEDGER,
    "load_latest": LOAD_LATEST,
    "upsert_events": UPSERT_EVENTS,
    "csv_good": CSV_GOOD,
    "csv_malformed": CSV_MALFORMED,
    "json_checked": JSON_CHECKED,
    "reconcile_content": RECONCILE_CONTENT,
}
