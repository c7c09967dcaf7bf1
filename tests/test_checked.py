"""Malformed records are kept apart with their reason; contents are compared
by key."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tierline.operators import reconcile_content
from tierline.sources import read_csv_checked, read_json_checked

SCHEMA = "k long, name string, x double, day date"


def put(tmp_dir, name, text):
    os.makedirs(f"{tmp_dir}/in", exist_ok=True)
    with open(f"{tmp_dir}/in/{name}", "w", encoding="utf-8", newline="") as fh:
        fh.write(text)
    return f"{tmp_dir}/in"


def test_csv(spark, tmp_dir):
    lines = [
        "k,name,x,day",
        "1,a,1.5,2024-01-02",
        '2,"b, quoted ""b""",,',
        "3,c,1.5",
        "4,d,1.5,2024-01-02,more",
        "x5,e,1.5,2024-01-02",
        "6,f,n/a,not a day",
        ",,,",
        '7,"g,h",1.5',
        "8",
    ]
    path = put(tmp_dir, "a.csv", "\n".join(lines) + "\n")
    got = read_csv_checked(spark, path, SCHEMA, f"{tmp_dir}/out")
    assert got.good.columns == ["k", "name", "x", "day", "source_file"]
    assert [r[:3] for r in rows(got.good)] == [(1, "a", 1.5), (2, 'b, quoted "b"', None), (None, None, None)]
    assert {r.raw: r.reason for r in got.malformed.collect()} == {
        "3,c,1.5": "3 of 4 cells",
        "4,d,1.5,2024-01-02,more": "more than 4 cells",
        "x5,e,1.5,2024-01-02": "not of its type: k (bigint)",
        "6,f,n/a,not a day": "not of its type: x (double), day (date)",
        '7,"g,h",1.5': "3 of 4 cells",
        "8": "1 of 4 cells",
    }
    assert all(r.source_file.endswith("a.csv") for r in got.malformed.collect())
    assert got.good.count() + got.malformed.count() == len(lines) - 1


def test_csv_all_good_or_all_bad_or_none(spark, tmp_dir):
    good = read_csv_checked(spark, put(tmp_dir + "/g", "a.csv", "k,name,x,day\n1,a,1.0,\n"), SCHEMA, f"{tmp_dir}/o1")
    assert good.good.count() == 1 and good.malformed.count() == 0
    bad = read_csv_checked(spark, put(tmp_dir + "/b", "a.csv", "k,name,x,day\n1,a\n"), SCHEMA, f"{tmp_dir}/o2")
    assert bad.good.count() == 0 and bad.malformed.count() == 1
    none = read_csv_checked(spark, put(tmp_dir + "/n", "a.csv", "k,name,x,day\n"), SCHEMA, f"{tmp_dir}/o3")
    assert none.good.count() == 0 and none.malformed.count() == 0
    # a rerun replaces both sides
    again = read_csv_checked(spark, f"{tmp_dir}/g/in", SCHEMA, f"{tmp_dir}/o2")
    assert again.good.count() == 1 and again.malformed.count() == 0


def test_csv_other_separator_and_line_breaks(spark, tmp_dir):
    text = 'k;name;x;day\n1;"two\nlines";1.0;\n2;"more\nlines"\n'
    got = read_csv_checked(spark, put(tmp_dir, "a.csv", text), SCHEMA, f"{tmp_dir}/out", multi_line=True, sep=";")
    assert [r.name for r in got.good.collect()] == ["two\nlines"]
    assert [r.reason for r in got.malformed.collect()] == ["2 of 4 cells"]


def test_json_lines(spark, tmp_dir):
    lines = [
        '{"k": 1, "name": "a", "in": {"v": [1, 2]}}',
        '{"k": 2, "unknown": {"deep": 1}}',
        '{"k": 3, "name": "cut',
        '{"k": "three", "name": "c"}',
        '{"k": 4, "in": {"v": "none"}}',
        "no json at all",
        "[1, 2",
    ]
    path = put(tmp_dir, "a.json", "\n".join(lines) + "\n\n")
    got = read_json_checked(spark, path, "k long, name string, in struct<v: array<long>>", f"{tmp_dir}/out")
    assert sorted(r.k for r in got.good.collect()) == [1, 2]
    found = {r.raw: r.reason for r in got.malformed.collect()}
    assert set(found) == set(lines[2:])
    assert found['{"k": 3, "name": "cut'] == found["no json at all"] == found["[1, 2"] == "not JSON"
    assert found['{"k": "three", "name": "c"}'] == "not of its type: k (bigint)"
    assert found['{"k": 4, "in": {"v": "none"}}'].startswith("not of its type: ")
    assert got.good.count() + got.malformed.count() == len(lines)


def test_json_documents_of_whole_files(spark, tmp_dir):
    put(tmp_dir, "a.json", '{\n  "k": 1\n}\n')
    put(tmp_dir, "b.json", '[{"k": 2}, {"k": 3}]')
    path = put(tmp_dir, "c.json", '{\n  "k": 4,\n')
    got = read_json_checked(spark, path, "k long", f"{tmp_dir}/out", multi_line=True)
    assert sorted(r.k for r in got.good.collect()) == [1, 2, 3]
    bad = got.malformed.collect()
    assert len(bad) == 1 and bad[0].source_file.endswith("c.json") and bad[0].reason == "not JSON"


def test_names_that_clash(spark, tmp_dir):
    with pytest.raises(ValueError, match="reason"):
        read_csv_checked(spark, tmp_dir, "k long, Reason string", f"{tmp_dir}/out")


# Content ---------------------------------------------------------------------

TABLE = "k long, a string, b double"


def compare(spark, left, right, **kw):
    out = reconcile_content(spark.createDataFrame(left, TABLE).repartition(3), spark.createDataFrame(right, TABLE), ["k"], **kw)
    return sorted(((r.k, r.left_rows, r.right_rows, r["columns"], r.status) for r in out.collect()), key=repr)


def test_equal_tables_give_nothing(spark):
    data = [(i, f"v{i}", i / 3) for i in range(500)] + [(None, None, None), (1, None, 1.0), (1, None, 1.0)]
    assert compare(spark, data, random.Random(1).sample(data, len(data))) == []
    assert compare(spark, [], []) == []


@pytest.mark.parametrize("buckets", [1, 8, 4096])
def test_swapped_values_are_named(spark, buckets):
    left = [(i, f"v{i % 5}", float(i)) for i in range(200)]
    right = [(k, {3: "v4", 4: "v3"}.get(k, a), b) for k, a, b in left]  # same counts, same values
    right[7] = (7, "v2", 7.5)
    del right[9]
    right += [(12, "v2", 12.0), (999, "x", None)]
    assert compare(spark, left, right, buckets=buckets) == [
        (12, 1, 2, ["a", "b"], "differs"),
        (3, 1, 1, ["a"], "differs"),
        (4, 1, 1, ["a"], "differs"),
        (7, 1, 1, ["b"], "differs"),
        (9, 1, 0, ["a", "b"], "only_left"),
        (999, 0, 1, ["a", "b"], "only_right"),
    ]


def test_nulls_and_values_between_rows_of_a_key(spark):
    assert compare(spark, [(1, None, 1.0)], [(1, "x", None)]) == [(1, 1, 1, ["a", "b"], "differs")]
    assert compare(spark, [(None, "x", 1.0)], [(None, "y", 1.0)]) == [(None, 1, 1, ["a"], "differs")]
    crossed = compare(spark, [(1, "x", 1.0), (1, "y", 2.0)], [(1, "x", 2.0), (1, "y", 1.0)])
    assert crossed == [(1, 2, 2, [], "differs")]
    assert compare(spark, [(1, "x", 1.0)], [(1, "y", 1.0)], columns=["b"]) == []


def test_no_join_of_rows(spark):
    left = spark.range(1000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("a"))
    out = reconcile_content(left, left, ["k"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and "Cartesian" not in plan
