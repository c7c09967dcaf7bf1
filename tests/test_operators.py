"""DataFrame operators on small inline frames, plus metamorphic checks
(split is a partition of its input, dedupe is idempotent and independent of
input order / partitioning, the skew-safe left join equals the plain one)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tierline.operators import (
    StageMetrics,
    build_mart,
    count_by,
    dedupe,
    drop_empty_columns,
    drop_empty_rows,
    drop_null_keys,
    drop_unnamed_columns,
    empty_columns,
    entity_summary,
    expect_count,
    ingest_ledger,
    key_profile,
    ledger_summary,
    left_join_split,
    missing_report,
    not_null_test,
    null_profile,
    range_report,
    range_violations,
    reconcile,
    require_columns,
    run_tests,
    split_complete,
    stage_report,
    top_n,
    union_by_name,
    unique_test,
    with_money_range,
    with_parsed_range,
    zip_explode,
)


@pytest.fixture
def messy(spark):
    return spark.createDataFrame(
        [
            (1, "a", None, None, "x"),
            (None, None, None, None, None),
            (2, None, None, None, None),
        ],
        "id int, name string, empty string, _c3 string, _c4 string",
    )


def test_drop_unnamed_and_empty(messy):
    assert drop_unnamed_columns(messy).columns == ["id", "name", "empty"]
    assert empty_columns(messy) == ["empty", "_c3"]
    assert drop_empty_columns(messy).columns == ["id", "name", "_c4"]
    assert drop_empty_rows(messy).count() == 2
    assert drop_empty_rows(messy, ["name", "empty"]).count() == 1


def test_range_and_money_columns(spark):
    df = spark.createDataFrame([("5–6", "₹2,500–₹4,000"), ("2", "₹900")], "d string, c string")
    out = with_money_range(with_parsed_range(df, "d", "lo", "hi", "avg"), "c", "cmin", "cmax")
    assert rows(out.select("lo", "hi", "avg", "cmin", "cmax")) == [
        (2.0, 2.0, 2.0, 900.0, None),
        (5.0, 6.0, 5.5, 2500.0, 4000.0),
    ]


@pytest.fixture
def events(spark):
    data = [(k % 7, k % 3, k, (k * 37) % 11) for k in range(200)]
    return spark.createDataFrame(data, "user long, kind long, id long, ts long")


def test_dedupe_deterministic_idempotent_and_partition_independent(events):
    keys, order = ["user", "kind"], ["ts", "id"]
    once = dedupe(events, keys, order)
    assert once.count() == 21
    assert rows(dedupe(once, keys, order)) == rows(once)
    shuffled = events.orderBy(F.rand(7)).repartition(13)
    assert rows(dedupe(shuffled, keys, order)) == rows(once)
    # the survivor is the first in (ts, id) order
    best = events.groupBy(*keys).agg(F.min(F.struct("ts", "id")).alias("m"))
    expect = rows(best.select("user", "kind", "m.id", "m.ts"))
    assert rows(once.select("user", "kind", "id", "ts")) == expect
    # arbitrary survivor without an order still yields one row per key
    assert dedupe(events, keys).count() == 21


def test_split_is_a_partition(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 2.0), (2, None, 2.0), (3, 1.0, None), (4, None, None)], "id int, a double, b double"
    )
    s = split_complete(df, ["a", "b"])
    assert [r.id for r in s.valid.collect()] == [1]
    assert sorted(r.id for r in s.skipped.collect()) == [2, 3, 4]
    assert rows(s.valid.unionByName(s.skipped)) == rows(df)
    assert drop_null_keys(df, ["a"]).count() == 2


def test_zip_explode_pads_and_drops(spark):
    df = spark.createDataFrame(
        [
            (1, ["t0", "t1", "t2"], [1.0, 2.0]),
            (2, [], []),
            (3, None, [5.0]),
            (4, ["t0"], [None]),
        ],
        "id int, t array<string>, v array<double>",
    )
    doc = df.select("id", F.struct("t", "v").alias("h"))
    out = zip_explode(doc, {"time": "h.t", "val": "h.v"}, keep=["id"], position="pos")
    assert rows(out) == [(1, 0, "t0", 1.0), (1, 1, "t1", 2.0), (1, 2, "t2", None), (4, 0, "t0", None)]
    kept = zip_explode(doc, {"time": "h.t", "val": "h.v"}, keep=["id"], keep_empty=True)
    assert sorted(r.id for r in kept.collect()) == [1, 1, 1, 2, 3, 4]


@pytest.fixture
def coords(spark):
    return spark.createDataFrame(
        [(1, 30.0, 78.0, 30.5, 78.5), (2, None, 78.0, 95.0, 78.5), (3, 10.0, 190.0, None, None)],
        "id int, start_lat double, start_lon double, end_lat double, end_lon double",
    )


def test_quality_reports(coords):
    rep = {r["column"]: tuple(r)[2:] for r in missing_report(coords, ["start_lat", "end_lat"]).collect()}
    assert rep == {"start_lat": (3, 1, "FAIL"), "end_lat": (3, 1, "FAIL")}
    with pytest.raises(ValueError, match="missing"):
        require_columns(coords, ["id", "nope"])
    with pytest.raises(ValueError):
        missing_report(coords, ["nope"])
    prof = {r["column"]: r["null_count"] for r in null_profile(coords).collect()}
    assert prof == {"id": 0, "start_lat": 1, "start_lon": 0, "end_lat": 1, "end_lon": 1}
    checks = {
        "latitude": (["start_lat", "end_lat"], -90, 90),
        "longitude": (["start_lon", "end_lon"], -180, 180),
    }
    rr = {r["check"]: (r["columns"], r["total_records"], r["invalid_records"], r["status"])
          for r in range_report(coords, checks).collect()}
    assert rr == {
        "latitude": ("start_lat,end_lat", 3, 1, "FAIL"),
        "longitude": ("start_lon,end_lon", 3, 1, "FAIL"),
    }
    bad = range_violations(coords, checks)
    assert sorted((r.id, r.latitude, r.longitude) for r in bad.collect()) == [(2, True, False), (3, False, True)]


def test_key_tests(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,), (3,), (3,)], "k int")
    assert tuple(not_null_test(df, "k").first()) == (1, True, True)
    assert tuple(unique_test(df, "k").first()) == (2, True, True)
    ok = spark.createDataFrame([(1,), (2,)], "k int")
    assert tuple(unique_test(ok, "k").first()) == (0, False, False)
    res = run_tests(
        {"a": df, "b": ok},
        [("a", "k", "not_null"), ("a", "k", "unique"), ("b", "k", "not_null"), ("b", "k", "unique")],
    )
    got = {(r.model, r.test): r.failures for r in res.collect()}
    assert got == {("a", "not_null"): 1, ("a", "unique"): 2, ("b", "not_null"): 0, ("b", "unique"): 0}
    with pytest.raises(ValueError):
        run_tests({"a": df}, [("a", "k", "accepted_values")])


def test_expect_count(spark):
    a = spark.range(5)
    assert tuple(expect_count(a, 5).first()) == ("row count", 5, 5, "PASS")
    assert tuple(expect_count(a, spark.range(3), "vs").first()) == ("vs", 3, 5, "FAIL")


def test_summaries(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("y", None), (None, 2.0)], "k string, v double")
    assert rows(count_by(df, "k", "n")) == [("x", 2), ("y", 1), (None, 1)]
    s = entity_summary(df, ["k"], {"n": F.count(F.lit(1)), "avg_v": F.avg("v")},
                       derived={"big": F.col("avg_v") > 1.5})
    assert rows(s) == [("x", 2, 2.0, True), ("y", 1, None, None), (None, 1, 2.0, True)]
    assert tuple(key_profile(df, "k").first()) == (4, 2, 1)


def test_stage_metrics_observe_without_extra_jobs(spark, tmp_dir):
    m = StageMetrics()
    df = m.track(spark.range(100), "raw")
    kept = m.track(df.filter("id % 4 = 0"), "kept", small=F.count_if(F.col("id") < 10))
    kept.write.mode("overwrite").parquet(tmp_dir + "/out")
    assert m.counts() == {"raw": 100, "kept": 25}
    assert m.removed("raw", "kept") == 75
    assert m.get("kept")["small"] == 3
    assert [tuple(r) for r in m.to_df(spark).orderBy("step").collect()] == [(0, "raw", 100), (1, "kept", 25)]


def test_stage_report_and_reconcile(spark):
    a = spark.range(10)
    b = a.filter("id < 7")
    c = b.select("id")
    stages = {"a": a, "b": b, "c": c}
    assert [tuple(r) for r in stage_report(stages).collect()] == [
        (0, "a", 10, None), (1, "b", 7, 3), (2, "c", 7, 0)
    ]
    rec = [tuple(r) for r in reconcile(stages, equal=[("b", "c"), ("a", "b")], nonempty=["c"]).collect()]
    assert rec == [
        ("equal_count", "b", "c", 7, 7, "PASS"),
        ("equal_count", "a", "b", 10, 7, "FAIL"),
        ("nonempty", "c", None, 7, None, "PASS"),
    ]


def test_ingest_ledger(spark):
    expected = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    landed = spark.createDataFrame([(1, "f1"), (1, "f1"), (3, "f3"), (None, "fx")], "id int, file string")
    led = ingest_ledger(expected, landed, "id", carry=["name"], file_col="file")
    assert rows(led) == [(1, "a", "SUCCESS", 2, "f1"), (2, "b", "FAILED", 0, None), (3, "c", "SUCCESS", 1, "f3")]
    assert tuple(ledger_summary(led).first()) == (3, 2, 1, "PARTIAL")
    ok = ingest_ledger(expected.filter("id <> 2"), landed, "id")
    assert tuple(ledger_summary(ok).first()) == (2, 2, 0, "SUCCESS")
    none = ingest_ledger(expected, landed.filter("id > 10"), "id")
    assert tuple(ledger_summary(none).first()) == (3, 0, 3, "FAILED")


def test_left_join_split_equals_left_join(spark):
    left = spark.createDataFrame(
        [(1, "a"), (2, "b"), (2, "b2"), (None, "n"), (9, "z")], "k int, l string"
    )
    # key 1 is "hot" on the right side
    right = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 7), (None, 8)], "k int, r int")
    plain = left.join(right, "k", "left")
    split = left_join_split(left, right, ["k"])
    assert split.columns == plain.columns
    assert rows(split) == rows(plain)


def test_union_by_name_and_marts(spark):
    ent = spark.createDataFrame([(1, "p"), (2, "q"), (3, "r")], "id int, name string")
    ev = spark.createDataFrame([(1, 10.0), (1, 11.0), (2, 20.0)], "id int, v double")
    sm = spark.createDataFrame([(1, 2, "Red"), (2, 1, "Green")], "id int, n long, overall string")
    u = union_by_name(ev, sm)
    assert u.columns == ["id", "v", "n", "overall"] and u.count() == 5

    e = build_mart(ent, "id", summary=sm, grain="entity")
    assert rows(e) == [(1, "p", 2, "Red"), (2, "q", 1, "Green"), (3, "r", None, None)]
    h = build_mart(ent, "id", summary=sm, events=ev, grain="hour", columns=["n", "v", "overall"])
    assert h.columns == ["id", "name", "n", "v", "overall"]
    assert rows(h) == [
        (1, "p", 2, 10.0, "Red"), (1, "p", 2, 11.0, "Red"), (2, "q", 1, 20.0, "Green"),
        (3, "r", None, None, None),
    ]
    un = build_mart(ent, "id", summary=sm, events=ev, grain="union")
    assert un.count() == 6
    assert rows(un.filter("n IS NOT NULL").select("id", "v")) == [(1, None), (2, None)]
    plain = build_mart(ent, "id", summary=sm, events=ev, grain="hour", skew_safe=False)
    assert rows(plain) == rows(build_mart(ent, "id", summary=sm, events=ev, grain="hour"))
    with pytest.raises(ValueError):
        build_mart(ent, "id", grain="entity")


def test_top_n(spark):
    df = spark.createDataFrame([(i, float(i % 5)) for i in range(20)], "id int, v double")
    got = [tuple(r) for r in top_n(df, 3, [F.col("v").desc(), "id"]).collect()]
    assert got == [(4, 4.0), (9, 4.0), (14, 4.0)]


def test_argument_validation(spark):
    from tierline.functions import bucketize
    from tierline.operators import complete_condition

    df = spark.range(3)
    with pytest.raises(ValueError):
        bucketize("id", [5, 1], ["a", "b", "c"])
    with pytest.raises(ValueError):
        range_report(df, {})
    with pytest.raises(ValueError):
        range_violations(df, {})
    with pytest.raises(ValueError):
        run_tests({"m": df}, [])
    with pytest.raises(ValueError):
        null_profile(df, [])
    with pytest.raises(ValueError):
        stage_report({})
    with pytest.raises(ValueError):
        reconcile({"a": df})
    with pytest.raises(ValueError):
        zip_explode(df, {})
    with pytest.raises(ValueError):
        complete_condition([])


def test_uniqueness_is_exact_when_hashes_collide(spark):
    from tierline.operators.quality import repeated_keys

    data = [("a",), ("b",), ("b",), (None,), (None,), ("c",), ("d",), ("d",), ("d",), ("",)]
    df = spark.createDataFrame(data, "k string")
    expected = [("b", 2), ("d", 3)]
    assert rows(repeated_keys(df, "k")) == expected
    for one_hash in (F.lit(7), F.length("k"), F.xxhash64("k")):
        assert rows(repeated_keys(df, "k", one_hash)) == expected
    assert rows(repeated_keys(df.where("k = 'a'"), "k")) == []


def test_uniqueness_of_long_text_shuffles_hashes(spark):
    """The first exchange carries the hash, not the text; an equal text with a
    third of all rows is still counted."""
    text = F.concat(F.lit("x" * 200), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")))
    df = spark.range(3000).select(text.alias("k"))
    assert tuple(unique_test(df, "k").first()) == (1, True, True)
    plan = unique_test(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__hash" in plan
