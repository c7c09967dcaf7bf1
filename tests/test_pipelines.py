"""End-to-end runs of the two medallion instances and the warehouse step
over hand-made fixtures shaped like the original feeds (BOM, trailing
unnamed columns, sentinels, duplicate keys, a fully empty row; two JSON
document shapes, short / NULL / empty arrays, bad times, duplicate hours,
every bucket boundary)."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from tierline.plans import treks as T
from tierline.plans import warehouse as WH
from tierline.plans import weather as W
from tierline.sources import load_stage

HEADER = ",".join(T.REQUIRED_COLUMNS) + ",,"
S = "needs_verification"
TREK_ROWS = [
    '1,Alpha Ridge,Beginner,Village A,30.10,78.10,1400,Alpha Top,30.20,78.20,3000,16,2,Easy-Moderate,Sep–Jun,"₹2,500–₹4,000",,',
    '2,Beta Lake,Moderate,Village B,30.30,78.30,2000,Beta Lake,30.35,78.35,3500,25,5–6,Moderate,May–Oct,"₹8,000–₹12,000",,',
    '3,Gamma Pass,Hard,Village C,30.40,78.40,2100,Gamma Camp,,,4200,38,5–6 days,Difficult,May–Sep,"₹12,000–₹16,000",,',
    f"4,Delta Meadow,Hidden,{S},{S},{S},{S},Delta Top,{S},{S},{S},{S},4–6,Moderate,May–Oct,{S},,",
    '5,Epsilon Col,Hidden,Village E,,,2000,Epsilon Top,,,3900,38,6–7,moderate-difficult,May–Oct,"₹10,500–₹12,500",,',
    '6,Zeta Descent,Easy,Village Z,30.50,78.50,3000,Zeta Valley,30.55,78.55,2700,8,1,EASY ,All year,"₹500–₹1,500",,',
    "7,Eta Traverse,Expedition,Village H,30.60,78.60,1800,Eta Top,30.70,78.70,5000,120,10 to 12,Extreme,Jun–Sep,₹5k–₹8k,,",
    "8,Theta Hill,Beginner,Village T,30.80,78.80,1500,Theta Top,30.81,78.81,2100,9,2,  easy  ,All year,₹5–8k,,",
    '9,Iota Peak,Moderate,Village I,30.90,78.90,1600,Iota Top,30.95,78.95,3300,15,3,Unknown Grade,Mar–Jun,"₹3,000",,',
    '10,Kappa Glacier,Hard,Village K,95.0,78.0,2000,Kappa Top,30.1,78.1,4000,30,7,very difficult,May–Jun,"₹20,000–₹25,000",,',
    '2,Beta Lake,Moderate,Village B,30.30,78.30,2000,Beta Lake,30.35,78.35,3500,25,5–6,Moderate,May–Oct,"₹8,000–₹12,000",,',
    "," * 17,
]


@pytest.fixture
def treks_csv(tmp_dir):
    path = os.path.join(tmp_dir, "treks.csv")
    with open(path, "w", encoding="utf-8-sig") as fh:
        fh.write("\n".join([HEADER, *TREK_ROWS]) + "\n")
    return path


def test_treks_pipeline(spark, treks_csv, tmp_dir):
    out = T.run_treks(spark, treks_csv, tmp_dir + "/out")
    assert out["counts"]["bronze"] == 12
    assert out["counts"]["deduped"] == 11
    assert out["complete"] == 7
    assert out["counts"]["gold"] == 7
    assert [c["status"] for c in out["checks"]] == ["PASS"]
    skipped = spark.read.parquet(out["skipped"])
    assert sorted((r.trek_id for r in skipped.collect()), key=lambda x: (x is None, x)) == [3, 4, 5, None]

    gold = spark.read.parquet(out["gold"])
    assert gold.columns == T.GOLD_COLUMNS
    g = {r.trek_id: r for r in gold.collect()}
    assert g[6].elevation_gain_m == -300.0 and g[6].difficulty == "Easy"
    assert (g[6].distance_category, g[6].duration_category) == ("Short", "Short")
    assert (g[7].duration_min_days, g[7].duration_max_days, g[7].duration_avg_days) == (10.0, 12.0, 11.0)
    assert (g[7].cost_min, g[7].cost_max, g[7].distance_category) == (5000.0, 8000.0, "Long")
    assert (g[8].cost_min, g[8].cost_max, g[8].difficulty) == (5.0, 8000.0, "Easy")
    assert (g[9].cost_min, g[9].cost_max, g[9].difficulty) == (3000.0, None, "Unknown Grade")
    assert (g[9].distance_category, g[9].duration_category) == ("Medium", "Medium")
    assert (g[2].duration_avg_days, g[2].duration_category) == (5.5, "Long")
    assert (g[1].cost_min, g[1].cost_max, g[1].distance_category) == (2500.0, 4000.0, "Medium")
    assert g[10].difficulty == "Very Difficult"

    summary = {r.difficulty: r.trek_count for r in spark.read.parquet(out["summary"]).collect()}
    assert summary == {
        "Easy-Moderate": 1, "Moderate": 1, "Easy": 2, "Extreme": 1, "Unknown Grade": 1,
        "Very Difficult": 1,
    }


def test_treks_ingest_quality(spark, treks_csv):
    bronze = T.read_treks(spark, treks_csv)
    missing, ranges, cleaned = T.ingest_quality(bronze)
    assert "_c16" not in cleaned.columns and cleaned.count() == 11
    rep = {r["column"]: (r.total_records, r.missing_records, r.status) for r in missing.collect()}
    assert rep == {
        "start_lat": (11, 2, "FAIL"), "start_lon": (11, 2, "FAIL"), "start_elevation": (11, 1, "FAIL"),
        "end_lat": (11, 3, "FAIL"), "end_lon": (11, 3, "FAIL"), "end_elevation": (11, 1, "FAIL"),
    }
    rr = {r.check: (r.invalid_records, r.status) for r in ranges.collect()}
    assert rr == {"latitude": (1, "FAIL"), "longitude": (0, "PASS")}
    with pytest.raises(ValueError):
        T.ingest_quality(bronze.drop("approx_cost"))


def _hourly(times, temps, hum, rain, vis, wind, gust):
    return {
        "time": times, "temperature_2m": temps, "relative_humidity_2m": hum,
        "precipitation": rain, "visibility": vis, "wind_speed_10m": wind, "wind_gusts_10m": gust,
    }


def _doc(trek_id, name, hourly, long_shape=False):
    doc = {
        "latitude": 30.0 + trek_id / 10, "longitude": 78.0, "generationtime_ms": 0.1,
        "utc_offset_seconds": 19800, "timezone": "Etc/GMT-5", "timezone_abbreviation": "GMT+5",
        "elevation": 1500.0, "hourly_units": {"time": "iso8601"}, "hourly": hourly,
        "trek_id": trek_id, "trek_name": name,
    }
    if long_shape:
        doc["hourly"]["precipitation_probability"] = [0] * len(hourly["time"] or [])
        doc["hourly"]["weather_code"] = [1] * len(hourly["time"] or [])
        doc["trek_latitude"] = 30.5
        doc["trek_longitude"] = 78.5
    else:
        doc["current"] = {"time": "2026-09-04T00:00", "temperature_2m": 1.0}
        doc["current_units"] = {"time": "iso8601"}
    return doc


@pytest.fixture
def weather_dir(tmp_dir):
    d = os.path.join(tmp_dir, "raw", "weather")
    os.makedirs(d)
    t = [f"2026-09-04T0{h}:00" for h in range(4)]
    docs = {
        "trek_1_weather.json": _doc(1, "Alpha Ridge", _hourly(
            t, [-1.0, 4.99, 5.0, 36.0], [80, 81, 82, 83], [0.0, 2.5, 7.5, 8.0],
            [999.0, 1000.0, 5000.0, 10000.0], [19.9, 20.0, 40.0, 60.0], [25.0, 26.0, 45.0, 70.0])),
        "trek_2_weather.json": _doc(2, "Beta Lake", _hourly(
            ["2026-09-21T00:00", "2026-09-21T00:00", "garbage", "2026-09-21T01:00"],
            [10.0, 10.0, 11.0, None], [50, 50, 50, 50], [0.0, 0.0, 0.0, 0.0],
            [20000.0] * 4, [5.0, 5.0, 5.0], [6.0] * 4), long_shape=True),
        "trek_3_weather.json": _doc(3, "Gamma Pass", _hourly([], [], [], [], [], [], [])),
        "trek_4_weather.json": _doc(4, "Delta Meadow", None),
        "z_dup.json": _doc(1, "Alpha Ridge", _hourly(
            [t[0]], [99.0], [1], [0.0], [1.0], [1.0], [1.0])),
    }
    for name, doc in docs.items():
        with open(os.path.join(d, name), "w") as fh:
            json.dump(doc, fh, indent=2)
    # outside the glob and without a key: must not be read
    with open(os.path.join(tmp_dir, "raw", "stray_weather.json"), "w") as fh:
        json.dump({"hourly": _hourly(t, [1.0] * 4, [1] * 4, [0.0] * 4, [1.0] * 4, [1.0] * 4, [1.0] * 4)}, fh)
    return d


def test_weather_pipeline(spark, weather_dir, tmp_dir):
    out = W.run_weather(spark, weather_dir + "/*.json", tmp_dir + "/out")
    c = out["counts"]
    assert c["documents"] == 5
    assert c["flattened"] == 4 + 4 + 1
    assert c["valid_time"] == 8
    assert c["silver"] == 6
    assert c["gold"] == 6 and c["summary"] == 2

    silver = spark.read.parquet(out["silver"])
    assert silver.columns == W.SILVER_COLUMNS
    first = silver.filter("trek_id = 1 AND hour(weather_time) = 0").first()
    assert first.temperature_c == -1.0 and first.source_file.endswith("trek_1_weather.json")

    gold = spark.read.parquet(out["gold"])
    g = {(r.trek_id, r.weather_time.hour): r for r in gold.collect()}
    cats = [
        (g[(1, h)].temperature_category, g[(1, h)].precipitation_category, g[(1, h)].wind_category,
         g[(1, h)].visibility_category, g[(1, h)].condition_score, g[(1, h)].condition_status)
        for h in range(4)
    ]
    assert cats == [
        ("Very Cold", "No Rain", "Low", "Very Low", 40, "Yellow - Caution"),
        ("Very Cold", "Light Rain", "Moderate", "Low", 10, "Green - Normal"),
        ("Cold", "Moderate Rain", "Strong", "Moderate", 30, "Yellow - Caution"),
        ("Very Hot", "Heavy Rain", "Very Strong", "Good", 60, "Red - High Risk"),
    ]
    padded = g[(2, 1)]
    assert padded.temperature_c is None and padded.wind_speed_kmh is None
    assert (padded.temperature_category, padded.wind_category, padded.condition_score) == (
        "Very Hot", "Very Strong", 0)
    assert sorted(str(r.weather_date) for r in gold.select("weather_date").distinct().collect()) == [
        "2026-09-04", "2026-09-21"]

    s = {r.trek_id: r for r in spark.read.parquet(out["summary"]).collect()}
    assert (s[1].weather_records, s[1].avg_temperature_c, s[1].min_temperature_c) == (4, 11.25, -1.0)
    assert (s[1].has_red_condition, s[1].has_yellow_condition, s[1].overall_condition) == (1, 1, "Red - High Risk")
    assert (s[1].total_precipitation_mm, s[1].avg_condition_score) == (18.0, 35.0)
    assert (s[2].weather_records, s[2].avg_temperature_c, s[2].overall_condition) == (2, 10.0, "Green - Normal")


def test_warehouse_mart_and_tests(spark, treks_csv, weather_dir, tmp_dir):
    t = T.run_treks(spark, treks_csv, tmp_dir + "/t")
    w = W.run_weather(spark, weather_dir + "/*.json", tmp_dir + "/w")
    res = WH.run_warehouse(
        spark, t["gold"], w["gold"], w["summary"], grain="hour", mart_path=tmp_dir + "/mart"
    )
    mart = res["trek_analytics"]
    assert mart.columns == T.GOLD_COLUMNS + WH.MART_WEATHER_COLUMNS
    assert mart.count() == 4 + 2 + 5
    assert mart.filter("trek_id = 1 AND overall_condition = 'Red - High Risk'").count() == 4
    assert mart.filter("weather_records IS NULL").count() == 5
    tests = {(r.model, r.test): r.failures for r in res["tests"].collect()}
    assert tests == {
        ("stg_treks", "not_null"): 0, ("stg_treks", "unique"): 0, ("stg_weather", "not_null"): 0,
        ("int_trek_weather", "not_null"): 0, ("trek_analytics", "not_null"): 0,
    }
    # the date-partitioned weather gold prunes whole folders on a date filter
    import contextlib
    import io

    one_day = res["stg_weather"].filter(F.col("weather_date") == F.lit("2026-09-04").cast("date"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        one_day.explain()
    assert "PartitionFilters: [isnotnull(weather_date" in buf.getvalue()
    assert one_day.count() == 4
    ent = WH.trek_mart(res["stg_treks"], res["stg_weather"], res["stg_weather_summary"], grain="entity")
    assert ent.count() == 7
    un = WH.trek_mart(res["stg_treks"], res["stg_weather"], res["stg_weather_summary"], grain="union")
    assert un.count() == 4 + 2 + 2 + 5


def test_stage_with_summary_below_gold(spark, treks_csv, tmp_dir):
    """A summary written *inside* the gold folder is loaded along with it
    (union schema) and its keyless rows are removed."""
    out = T.run_treks(spark, treks_csv, tmp_dir + "/o")
    gold = spark.read.parquet(out["gold"])
    gold.write.mode("overwrite").parquet(tmp_dir + "/stage")
    T.difficulty_summary(gold).write.mode("overwrite").parquet(tmp_dir + "/stage/summary")
    raw = load_stage(spark, tmp_dir + "/stage")
    assert raw.count() == 7 + 6 and "trek_count" in raw.columns
    loaded = WH.load_gold_table(spark, tmp_dir + "/stage")
    assert loaded.count() == 7
    assert loaded.filter(F.col("trek_count").isNotNull()).count() == 0


FEED = os.environ.get("TIERLINE_FEED_DIR")


@pytest.mark.skipif(not FEED, reason="set TIERLINE_FEED_DIR to the original feed files")
def test_golden_feed(spark, tmp_dir):
    """Golden numbers of the original 100-row place feed and 110 weather
    documents (CSV at $TIERLINE_FEED_DIR/treks.csv, JSON documents at
    $TIERLINE_FEED_DIR/raw/weather/*.json)."""
    t = T.run_treks(spark, os.path.join(FEED, "treks.csv"), tmp_dir + "/t")
    assert t["counts"]["bronze"] == 100 and t["complete"] == 88
    skipped = sorted(r.trek_id for r in spark.read.parquet(t["skipped"]).collect())
    assert skipped == [55, 78, 83, 84, 85, 86, 87, 88, 90, 91, 92, 98]
    gold = spark.read.parquet(t["gold"])
    by_diff = {r.difficulty: r.trek_count for r in spark.read.parquet(t["summary"]).collect()}
    assert by_diff == {
        "Easy": 20, "Easy-Moderate": 8, "Moderate": 22, "Moderate-Difficult": 13, "Difficult": 17,
        "Very Difficult": 3, "Extreme": 5,
    }
    dist = {r.distance_category: r["count"] for r in gold.groupBy("distance_category").count().collect()}
    assert dist == {"Short": 19, "Medium": 9, "Long": 60}
    dur = {r.duration_category: r["count"] for r in gold.groupBy("duration_category").count().collect()}
    assert dur == {"Short": 25, "Medium": 11, "Long": 52}
    agg = gold.agg(
        F.sum("duration_avg_days"), F.sum("cost_min"), F.sum("cost_max"), F.count("cost_min"),
        F.sum("elevation_gain_m"), F.min("elevation_gain_m"), F.max("elevation_gain_m"),
        F.count_if(F.col("elevation_gain_m") < 0),
    ).first()
    assert tuple(agg) == (480.0, 869500.0, 1226500.0, 88, 126863.0, -303.0, 4555.0, 6)

    missing, _, _ = T.ingest_quality(T.read_treks(spark, os.path.join(FEED, "treks.csv")))
    rep = {r["column"]: r.missing_records for r in missing.collect()}
    assert rep == {"start_lat": 2, "start_lon": 2, "start_elevation": 1, "end_lat": 12,
                   "end_lon": 12, "end_elevation": 1}

    w = W.run_weather(spark, os.path.join(FEED, "raw", "weather", "*.json"), tmp_dir + "/w")
    assert w["counts"]["documents"] == 110 and w["counts"]["silver"] == 5808
    wg = spark.read.parquet(w["gold"])
    sc = {r.condition_score: r["count"] for r in wg.groupBy("condition_score").count().collect()}
    assert sc == {0: 2472, 10: 1506, 25: 1656, 40: 173, 55: 1}
    temp = {r.temperature_category: r["count"] for r in wg.groupBy("temperature_category").count().collect()}
    assert temp == {"Very Cold": 369, "Cold": 2172, "Moderate": 3204, "Warm": 63}
    rain = {r.precipitation_category: r["count"] for r in wg.groupBy("precipitation_category").count().collect()}
    assert rain == {"No Rain": 3508, "Light Rain": 1978, "Moderate Rain": 271, "Heavy Rain": 51}
    vis = {r.visibility_category: r["count"] for r in wg.groupBy("visibility_category").count().collect()}
    assert vis == {"Very Low": 1616, "Low": 1720, "Moderate": 1378, "Good": 1094}
    overall = {r.overall_condition: r["count"] for r in
               spark.read.parquet(w["summary"]).groupBy("overall_condition").count().collect()}
    assert overall == {"Red - High Risk": 1, "Yellow - Caution": 67, "Green - Normal": 20}


def test_trek_ingest_csv_outputs(spark, treks_csv, tmp_dir):
    out = T.run_trek_ingest(spark, treks_csv, tmp_dir + "/ing")
    rep = spark.read.option("header", True).csv(out["quality_report"])
    assert rep.columns == ["check", "column", "total_records", "missing_records", "status"]
    assert rep.count() == 6
    valid = spark.read.option("header", True).csv(out["valid"])
    skipped = spark.read.option("header", True).csv(out["skipped"])
    # the ingest path keeps the duplicate key (no de-duplication there)
    assert sorted(int(r.trek_id) for r in valid.collect()) == [1, 2, 2, 6, 7, 8, 9, 10]
    assert sorted(int(r.trek_id) for r in skipped.collect()) == [3, 4, 5]


def test_weather_ledger_and_checks(spark, treks_csv, weather_dir, tmp_dir):
    t = T.run_treks(spark, treks_csv, tmp_dir + "/t")
    valid = spark.read.parquet(t["silver"])
    docs = W.read_weather_docs(spark, weather_dir + "/*.json")
    led = W.weather_ingest_ledger(valid, docs)
    assert led.columns == ["trek_id", "trek_name", "latitude", "longitude", "status", "landed_records",
                           "weather_file"]
    got = {r.trek_id: (r.status, r.landed_records) for r in led.collect()}
    assert got == {1: ("SUCCESS", 2), 2: ("SUCCESS", 1), 6: ("FAILED", 0), 7: ("FAILED", 0),
                   8: ("FAILED", 0), 9: ("FAILED", 0), 10: ("FAILED", 0)}
    assert led.filter("trek_id = 1").first().weather_file.endswith("trek_1_weather.json")
    from tierline.operators import ledger_summary

    assert tuple(ledger_summary(led).first()) == (7, 2, 5, "PARTIAL")

    w = W.run_weather(spark, weather_dir + "/*.json", tmp_dir + "/w")
    silver = spark.read.parquet(w["silver"])
    keys, nulls = W.silver_checks(silver)
    assert tuple(keys.first()) == (6, 2, 0)
    n = {r["column"]: r.null_count for r in nulls.collect()}
    assert n["temperature_c"] == 1 and n["wind_speed_kmh"] == 1 and n["weather_time"] == 0
    assert w["keys"] == {"total_rows": 6, "unique_keys": 2, "null_keys": 0} and w["nulls"] == n
    assert [c["status"] for c in w["checks"]] == ["PASS", "PASS", "PASS"]
    out = W.run_ledger(spark, valid, weather_dir + "/*.json", tmp_dir + "/led")
    assert (out["expected"], out["succeeded"], out["verdict"]) == (7, 2, "PARTIAL")
    assert spark.read.option("header", True).csv(out["ledger"]).columns == led.columns
    with pytest.raises(ValueError):
        W.weather_ingest_ledger(valid.drop("start_lat"), docs)


def test_cli_runs_stages(spark, treks_csv, weather_dir, tmp_dir, capsys):
    from tierline.__main__ import main

    assert main(["treks", treks_csv, tmp_dir + "/cli"]) == 0
    treks_out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert treks_out["complete"] == 7
    assert main(["weather", weather_dir + "/*.json", tmp_dir + "/cli"]) == 0
    w = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert w["counts"]["silver"] == 6
    assert main(["ledger", treks_out["silver"], weather_dir + "/*.json", tmp_dir + "/cli"]) == 0
    led = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert led.pop("ledger").startswith(tmp_dir)
    assert led == {"expected": 7, "succeeded": 2, "failed": 5, "verdict": "PARTIAL"}
    mart = tmp_dir + "/cli_mart"
    assert main(["warehouse", treks_out["gold"], w["gold"], w["summary"], "--grain", "entity", "--mart-path", mart]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert all(t["failures"] == 0 for t in out["tests"])
    assert {(p["table"], p["step"]) for p in out["profiles"]} >= {("stg_treks", "before"), ("stg_weather", "after")}
    assert spark.read.parquet(mart).count() == 7


def test_sentinels_option(spark, treks_csv):
    bronze = T.read_treks(spark, treks_csv)
    kept = {r.trek_id: r for r in T.treks_silver_all(bronze).collect() if r.trek_id == 4}
    assert kept[4].starting_point == "needs_verification" and kept[4].start_lat is None
    nulled = {r.trek_id: r for r in T.treks_silver_all(bronze, sentinels=["needs_verification"]).collect()
              if r.trek_id == 4}
    assert nulled[4].starting_point is None and nulled[4].approx_cost is None
    assert nulled[4].trek_name == "Delta Meadow"


def test_weather_summary_groups_by_id_and_name(spark, weather_dir, tmp_dir):
    """A place renamed between documents gives two summary rows, as the
    grouping is by (id, name)."""
    renamed = _doc(1, "Alpha Ridge (renamed)", _hourly(
        ["2026-09-05T00:00"], [1.0], [1], [0.0], [20000.0], [1.0], [1.0]))
    with open(os.path.join(weather_dir, "trek_1_renamed.json"), "w") as fh:
        json.dump(renamed, fh, indent=2)
    out = W.run_weather(spark, weather_dir + "/*.json", tmp_dir + "/w2")
    s = spark.read.parquet(out["summary"])
    names = sorted(r.trek_name for r in s.filter("trek_id = 1").collect())
    assert names == ["Alpha Ridge", "Alpha Ridge (renamed)"]


def test_cli_ingest_and_stream(spark, treks_csv, weather_dir, tmp_dir, capsys):
    from tierline.__main__ import main

    assert main(["ingest", treks_csv, tmp_dir + "/ing"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert spark.read.option("header", True).csv(out["skipped"]).count() == 3
    from tierline.streaming import read_stream_silver

    run = ["weather-stream", weather_dir, tmp_dir + "/stream_hours", "--checkpoint", tmp_dir + "/stream_ckpt"]
    assert main(run) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert read_stream_silver(spark, out["silver"]).count() == 6
    # the next run takes up what has landed since
    with open(os.path.join(weather_dir, "later.json"), "w") as fh:
        json.dump(_doc(9, "Late", _hourly(["2026-08-01T00:00"], [1.0], [1], [0.0], [1.0], [1.0], [1.0])), fh)
    assert main(run) == 0
    assert read_stream_silver(spark, out["silver"]).count() == 7


def test_places_with_odd_ids(spark, tmp_dir):
    """Ids are compared as text; those that are no numbers are quarantined."""
    path = os.path.join(tmp_dir, "odd.csv")
    rest = "A,B,C,30.1,78.1,1400,D,30.2,78.2,3000,16,2,Easy,All year,₹500"
    ids = ["T1", "T2", "T3", "7", "007", "7", ""]
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join([",".join(T.REQUIRED_COLUMNS), *(f"{i},{rest}" for i in ids)]) + "\n")
    silver, skipped = T.treks_silver(T.read_treks(spark, path))
    assert sorted((r.trek_id_text, r.trek_id) for r in silver.collect()) == [("007", 7), ("7", 7)]
    assert sorted(str(r.trek_id_text) for r in skipped.collect()) == ["None", "T1", "T2", "T3"]


def test_places_without_a_complete_row(spark, tmp_dir):
    path = os.path.join(tmp_dir, "none.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join([",".join(T.REQUIRED_COLUMNS), "1,A,B,C,,,,D,,,,1,2,Easy,All year,₹500"]) + "\n")
    out = T.run_treks(spark, path, tmp_dir + "/none")
    assert out["complete"] == 0 and out["counts"]["gold"] == 0


def test_feed_text_is_kept(spark, tmp_dir):
    """A name with spaces at its ends and one with a line break."""
    path = os.path.join(tmp_dir, "text.csv")
    row = "{},{},B,C,30.1,78.1,1400,D,30.2,78.2,3000,16,2,Easy,All year,₹500"
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join([",".join(T.REQUIRED_COLUMNS), row.format(1, '"  padded  "'), row.format(2, '"two\nlines"')]) + "\n")
    out = T.run_trek_ingest(spark, path, tmp_dir + "/text")
    from tierline.sources import read_csv

    names = {r.trek_id: r.trek_name for r in read_csv(spark, out["valid"], multi_line=True).collect()}
    assert names == {"1": "  padded  ", "2": "two\nlines"}


def test_renamed_place_does_not_multiply_hours(spark, treks_csv, weather_dir, tmp_dir):
    renamed = _doc(1, "Alpha Ridge (renamed)", _hourly(
        ["2026-09-05T00:00"], [1.0], [1], [0.0], [20000.0], [1.0], [1.0]))
    with open(os.path.join(weather_dir, "trek_1_renamed.json"), "w") as fh:
        json.dump(renamed, fh, indent=2)
    t = T.run_treks(spark, treks_csv, tmp_dir + "/t")
    w = W.run_weather(spark, weather_dir + "/*.json", tmp_dir + "/w")
    hour = WH.run_warehouse(spark, t["gold"], w["gold"], w["summary"], mart_path=tmp_dir + "/h")["trek_analytics"]
    one = hour.filter("trek_id = 1").collect()
    assert len(one) == 5 and {r.weather_records for r in one} == {5}
    entity = WH.run_warehouse(
        spark, t["gold"], w["gold"], w["summary"], grain="entity", mart_path=tmp_dir + "/e"
    )["trek_analytics"]
    assert entity.count() == 7
