"""A key holding well over a third of the event rows: the skew-safe left
join spreads it over several tasks, which a plain left outer join with the
events on its right side cannot do, and the rows stay identical.  AQE
thresholds are lowered so the small test data counts as skewed."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tierline.operators import dedupe, entity_summary, left_join_split

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture
def skewed(spark):
    ent = spark.range(0, 50).select(
        F.col("id").alias("k"), F.concat(F.lit("e"), F.col("id").cast("string")).alias("name")
    )
    # key 1 holds two thirds of all events
    ev = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 != 0, F.lit(1)).otherwise(F.col("id") % 97).cast("long").alias("k"),
        F.col("id").alias("v"),
    )
    return ent, ev


def tasks_of_hot_key(df) -> int:
    return df.filter("k = 1").select(F.spark_partition_id()).distinct().count()


def test_hot_key_is_spread(skew_conf, skewed):
    ent, ev = skewed
    split = left_join_split(ent, ev, ["k"])
    plain = ent.join(ev, "k", "left")
    assert "SortMergeJoin" in _final_plan(split)
    assert tasks_of_hot_key(split) > 1 and tasks_of_hot_key(plain) == 1
    assert rows(split) == rows(plain)
    given = left_join_split(ent, ev, ["k"], right_keys=ev.groupBy("k").count())
    assert rows(given) == rows(plain)


def test_hot_key_aggregates_and_dedupe_stay_partial(skew_conf, skewed):
    _, ev = skewed
    agg = entity_summary(ev, ["k"], {"n": F.count(F.lit(1)), "s": F.sum("v")})
    plan = _final_plan(agg)
    assert "partial_count" in plan and "partial_sum" in plan
    hot = [i for i in range(30000) if i % 3 != 0 or i % 97 == 1]
    row = agg.filter("k = 1").first()
    assert (row.n, row.s) == (len(hot), sum(hot))
    d = dedupe(ev, ["k"], order_by=["v"])
    plan = _final_plan(d)
    assert "WindowGroupLimit" in plan
    assert d.filter("k = 1").first().v == 1


@pytest.mark.parametrize("grain", ["hour", "union"])
def test_default_event_grains_spread_the_hot_key(skew_conf, skewed, grain):
    from tierline.operators import build_mart

    ent, ev = skewed
    summ = entity_summary(ev, ["k"], {"n": F.count(F.lit(1))})
    safe = build_mart(ent, "k", summary=summ, events=ev, grain=grain, summary_of_events=True)
    plain = build_mart(ent, "k", summary=summ, events=ev, grain=grain, skew_safe=False)
    assert rows(safe) == rows(plain)
    assert tasks_of_hot_key(safe) > 1


def test_salted_join_spreads_equal_rows_of_any_type(skew_conf, skewed):
    from tierline.operators import salted_join

    ent, ev = skewed
    same = ev.filter("k = 1").select("k", F.lit(0).alias("v"), F.struct(F.create_map(F.lit("a"), F.lit(1))).alias("s"))
    salted = salted_join(same, ent, ["k"])
    plain = same.join(ent, "k")
    assert salted.columns == plain.columns and salted.count() == plain.count()
    skew_conf.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")  # salts alone
    try:
        assert tasks_of_hot_key(salted) > 1 and tasks_of_hot_key(plain) == 1
    finally:
        skew_conf.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert rows(salted_join(ev, ent, ["k"], salts=3)) == rows(ev.join(ent, "k"))


def test_mart_wants_one_summary_row_per_key(spark, skewed):
    from tierline.operators import build_mart

    ent, ev = skewed
    twice = entity_summary(ev, ["k", "v"], {"n": F.count(F.lit(1))}).drop("v")
    with pytest.raises(ValueError, match="one per key"):
        build_mart(ent, "k", summary=twice, events=ev, grain="hour")
    assert build_mart(ent, "k", summary=twice, events=ev, grain="union").count() > 0
