"""Layers laid out by key: grouping, de-duplication and join need no exchange."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tierline.operators.clean import dedupe
from tierline.operators.mart import build_mart
from tierline.operators.state import Measure, finish, partials
from tierline.sources.buckets import SALT, salted_summary, write_bucketed

MEASURES = {"n": Measure("rows"), "mean": Measure("avg", "x"), "most": Measure("max", "x")}


@pytest.fixture
def name(spark):
    name = f"tl_{uuid.uuid4().hex[:8]}"
    yield name
    for t in spark.catalog.listTables(pattern=f"{name}*"):
        spark.sql(f"DROP {'VIEW' if t.tableType == 'VIEW' else 'TABLE'} IF EXISTS {t.name}")


def hours(spark, n=2000):
    # place 1 has a third of all rows
    place = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 37).cast("long")
    return spark.range(n).select(place.alias("place"), (F.col("id") % 500).alias("hour"), (F.col("id") / 8).alias("x"))


def plan(df):
    """The plan as it ran."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_one_exchange_for_all_steps(spark, tmp_dir, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        layer = write_bucketed(hours(spark), f"{name}_h", f"{tmp_dir}/h", ["place"], 4, ["hour"])
        places = spark.range(45).select(F.col("id").alias("place"), F.concat(F.lit("p"), F.col("id")).alias("title"))
        places = write_bucketed(places, f"{name}_p", f"{tmp_dir}/p", ["place"], 4)
        once = dedupe(layer, ["place", "hour"], ["x"])
        summary = finish(partials(once, ["place"], MEASURES), ["place"], MEASURES)
        mart = build_mart(places, "place", summary=summary, summary_is_unique=True)
        assert "Exchange" not in plan(once) and "Exchange" not in plan(summary)
        text = plan(mart)
        assert "Exchange" not in text and "SortMergeJoin" in text
        plain = dedupe(hours(spark), ["place", "hour"], ["x"])
        expected = build_mart(places, "place", summary=finish(partials(plain, ["place"], MEASURES), ["place"], MEASURES))
        assert rows(mart) == rows(expected)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_buckets_spread_a_hot_key(spark, tmp_dir, name):
    even = write_bucketed(hours(spark), f"{name}_e", f"{tmp_dir}/e", ["place"], 8)
    salted = write_bucketed(hours(spark), f"{name}_s", f"{tmp_dir}/s", ["place"], 8, salt=("hour", 16))
    biggest = {}
    for kind, layer in (("even", even), ("salted", salted)):
        biggest[kind] = layer.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert biggest["even"] >= 2000 / 3 and biggest["salted"] < 2000 / 3 / 1.5
    got = salted_summary(salted, "place", MEASURES)
    assert rows(got) == rows(finish(partials(hours(spark), ["place"], MEASURES), ["place"], MEASURES))
    # rows per place and salt are all that is exchanged
    by_salt = partials(salted, ["place", SALT], MEASURES)
    assert "Exchange" not in plan(by_salt) and plan(got).count("Exchange hashpartitioning") == 1


def test_a_name_is_replaced_in_one_step(spark, tmp_dir, name):
    first = write_bucketed(hours(spark, 100), name, tmp_dir, ["place"], 2)
    assert first.count() == 100
    for n in (50, 60, 70):
        write_bucketed(spark.table(name).limit(n), name, tmp_dir, ["place"], 2)
    assert spark.table(name).count() == 50
    assert len(spark.catalog.listTables(pattern=f"{name}_b_*")) == 2
    # other columns
    write_bucketed(spark.range(3).select(F.col("id").alias("place")), name, tmp_dir, ["place"], 2)
    assert spark.table(name).columns == ["place"]
