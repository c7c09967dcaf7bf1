"""Mergeable summaries: any split of the input gives the same summary."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tierline.operators import state as S
from tierline.operators.summarize import entity_summary
from tierline.plans import weather as W
from tierline.sources.versions import ConflictError, publish, versions

MEASURES = {
    "n": S.Measure("rows"),
    "total": S.Measure("sum", "x"),
    "mean": S.Measure("avg", "x"),
    "least": S.Measure("min", "x"),
    "most": S.Measure("max", "y"),
    "wide_mean": S.Measure("avg", "y", scale=4),
    "red": S.Measure("any", condition="status = 'red'"),
}


def readings(spark, n=3000, seed=1):
    rng = random.Random(seed)
    data = [
        (
            rng.choice(["a", "a", "b", None]),
            rng.choice([None, 0.1, 0.2, 2.675, 1e-9, rng.uniform(-1e6, 1e6)]),
            rng.choice([None, 1e8 + 0.25, -3.5]),
            rng.choice(["red", "green", None]) if rng.random() < 0.01 else "green",
        )
        for _ in range(n)
    ] + [("empty", None, None, None)]
    return spark.createDataFrame(data, "k string, x double, y double, status string").withColumn("part", F.monotonically_increasing_id() % 5)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_split_gives_the_same_summary(spark, seed):
    df = readings(spark, seed=seed).cache()
    whole = rows(S.finish(S.partials(df, ["k"], MEASURES), ["k"], MEASURES))
    for split in (["part = 0", "part <> 0"], [f"part = {i}" for i in range(5)]):
        states = [S.partials(df.where(c), ["k"], MEASURES) for c in split]
        stacked = states[0]
        for s in states[1:]:
            stacked = S.merge(stacked.unionByName(s), ["k"], MEASURES)
        assert rows(S.finish(stacked, ["k"], MEASURES)) == whole
    df.unpersist()


def test_same_as_the_plain_aggregates(spark):
    gold = W.weather_gold(
        spark.range(500).select(
            (F.col("id") % 7).alias("trek_id"), F.lit("p").alias("trek_name"), F.lit(1.0).alias("latitude"),
            F.lit(2.0).alias("longitude"), F.lit(3.0).alias("elevation"), F.lit(None).cast("timestamp_ntz").alias("weather_time"),
            (F.col("id") / 8 - 10).alias("temperature_c"), (F.col("id") % 100 + 0.5).alias("humidity_pct"),
            (F.col("id") % 9 / 4).alias("precipitation_mm"), (F.col("id") * 37.25).alias("visibility_m"),
            (F.col("id") % 70 + 0.25).alias("wind_speed_kmh"), F.lit(None).cast("double").alias("wind_gust_kmh"),
            F.lit("f").alias("source_file"), F.lit(None).cast("date").alias("weather_date"),
        )
    )
    by_name = entity_summary(gold, W.ENTITY, W.summary_aggregates(), derived=W._overall())
    assert rows(W.weather_summary(gold)) == rows(by_name)
    assert W.weather_summary(gold).columns == by_name.columns


def test_batches_on_disk(spark, tmp_dir):
    df = readings(spark)
    whole = rows(S.finish(S.partials(df, ["k"], MEASURES), ["k"], MEASURES))
    for part in (3, 0, 4, 1, 2):
        assert S.update_state(df.where(f"part = {part}"), tmp_dir, f"p{part}", ["k"], MEASURES)
        assert not S.update_state(df, tmp_dir, f"p{part}", ["k"], MEASURES)  # a rerun adds nothing
    assert rows(S.read_state(spark, tmp_dir, ["k"], MEASURES)) == whole
    assert sorted(S.applied_batches(spark, tmp_dir)) == ["p0", "p1", "p2", "p3", "p4"]
    assert len(versions(spark, tmp_dir)) == 2
    assert S.update_state(df.limit(0), tmp_dir, "nothing", ["k"], MEASURES)
    assert rows(S.read_state(spark, tmp_dir, ["k"], MEASURES)) == whole


def test_only_the_batch_is_read(spark, tmp_dir):
    """After a batch is merged its rows are not needed any more."""
    df = readings(spark)
    for part in (0, 1):
        df.where(f"part = {part}").write.parquet(f"{tmp_dir}/in/{part}")
    import shutil

    S.update_state(spark.read.parquet(f"{tmp_dir}/in/0"), f"{tmp_dir}/state", "0", ["k"], MEASURES)
    shutil.rmtree(f"{tmp_dir}/in/0")
    S.update_state(spark.read.parquet(f"{tmp_dir}/in/1"), f"{tmp_dir}/state", "1", ["k"], MEASURES)
    both = df.where("part < 2")
    expected = rows(S.finish(S.partials(both, ["k"], MEASURES), ["k"], MEASURES))
    assert rows(S.read_state(spark, f"{tmp_dir}/state", ["k"], MEASURES)) == expected


def test_failed_or_late_batch_changes_nothing(spark, tmp_dir, monkeypatch):
    df = readings(spark)
    S.update_state(df.where("part = 0"), tmp_dir, "0", ["k"], MEASURES)
    before = rows(S.read_state(spark, tmp_dir, ["k"], MEASURES))
    broken = df.withColumn("x", F.when(F.col("part") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="lost"):
        S.update_state(broken, tmp_dir, "1", ["k"], MEASURES)
    real = S.partials

    def while_another_publishes(*args):
        monkeypatch.setattr(S, "partials", real)
        S.update_state(df.where("part = 2"), tmp_dir, "2", ["k"], MEASURES)
        return real(*args)

    monkeypatch.setattr(S, "partials", while_another_publishes)
    with pytest.raises(ConflictError):
        S.update_state(df.where("part = 1"), tmp_dir, "1", ["k"], MEASURES)
    assert sorted(S.applied_batches(spark, tmp_dir)) == ["0", "2"]
    assert rows(S.read_state(spark, tmp_dir, ["k"], MEASURES)) != before
    with pytest.raises(ConflictError):
        publish(spark, tmp_dir, "late", after=0)


def test_not_finite_values(spark):
    df = spark.createDataFrame([("a", float("nan")), ("a", 1.0), ("b", float("inf")), ("c", 1e30)], "k string, x double")
    m = {"total": S.Measure("sum", "x")}
    got = {r.k: r.total for r in S.finish(S.partials(df, ["k"], m), ["k"], m).collect()}
    assert got["a"] != got["a"] and got["b"] == float("inf") and got["c"] == 1e30


def test_unknown_kind():
    with pytest.raises(ValueError):
        S.Measure("median", "x")
