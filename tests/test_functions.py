"""Column functions: parsers and rule ladders, including every edge case
listed for the exact semantics (ranges, money, sentinels, NULL handling,
bucket boundaries, score ladders)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierline.functions import (
    bucketize,
    coerce_numeric,
    flag_any,
    ladder,
    null_sentinels,
    parse_event_time,
    parse_money_range,
    parse_range,
    rollup_status,
    score,
    rounded_avg,
    rounded_sum,
    standardize_label,
    status_band,
)


def _one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


@pytest.mark.parametrize(
    "text, lo, hi, avg",
    [
        ("2", 2.0, 2.0, 2.0),
        ("5–6", 5.0, 6.0, 5.5),
        ("5-6", 5.0, 6.0, 5.5),
        ("10 to 12", 10.0, 12.0, 11.0),
        ("5–6 days", 5.0, 5.0, 5.0),  # suffix defeats the end anchor
        ("  3 - 4 ", 3.0, 4.0, 3.5),
        ("1.5–2.25", 1.5, 2.25, 1.875),
        ("abc", None, None, None),
        ("needs_verification", None, None, None),
        (None, None, None, None),
    ],
)
def test_parse_range(spark, text, lo, hi, avg):
    r = _one_col(spark, [text]).select(parse_range("x").alias("r")).first()["r"]
    assert (r["min"], r["max"], r["avg"]) == (lo, hi, avg)


@pytest.mark.parametrize(
    "text, lo, hi",
    [
        ("₹2,500–₹4,000", 2500.0, 4000.0),
        ("₹5k–₹8k", 5000.0, 8000.0),
        ("₹5–8k", 5.0, 8000.0),  # the multiplier does not carry over
        ("₹1,000", 1000.0, None),  # a single amount has no maximum
        ("₹10,500 - ₹12,500", 10500.0, 12500.0),
        ("1200 to 1500", 1200.0, 1500.0),
        ("needs_verification", None, None),
        (None, None, None),
    ],
)
def test_parse_money_range(spark, text, lo, hi):
    r = _one_col(spark, [text]).select(parse_money_range("x").alias("r")).first()["r"]
    assert (r["min"], r["max"]) == (lo, hi)


def test_coerce_numeric_and_sentinels(spark):
    df = _one_col(spark, ["12", "12.5", "needs_verification", "", None, "1e2", "-1"])
    got = [r[0] for r in df.select(coerce_numeric("x")).collect()]
    assert got == [12.0, 12.5, None, None, None, 100.0, -1.0]
    got = [r[0] for r in df.select(coerce_numeric("x", sentinels=["-1"])).collect()]
    assert got[-1] is None
    kept = [r[0] for r in df.select(null_sentinels("x", ["needs_verification"])).collect()]
    assert kept[2] is None and kept[0] == "12"


def test_parse_event_time(spark):
    df = _one_col(spark, ["2026-09-04T00:00", "2026-09-04T23:59", "bad", "2026-09-04 01:00", None])
    out = df.select(parse_event_time("x").alias("t")).collect()
    assert out[0]["t"] == dt.datetime(2026, 9, 4, 0, 0)
    assert out[1]["t"] == dt.datetime(2026, 9, 4, 23, 59)
    assert [r["t"] for r in out[2:]] == [None, None, None]
    assert dict(df.select(parse_event_time("x").alias("t")).dtypes)["t"] == "timestamp_ntz"


def test_rounded_sum_and_avg(spark):
    df = _one_col(spark, [2.675, 1.005, -1.005, None], "double")
    assert tuple(df.agg(rounded_sum("x"), rounded_avg("x")).first()) == (2.68, 0.89)
    assert tuple(df.filter("x IS NULL").agg(rounded_sum("x"), rounded_avg("x")).first()) == (None, None)
    assert tuple(df.filter("x < 0").agg(rounded_sum("x"), rounded_avg("x")).first()) == (-1.01, -1.01)


def test_rounded_sum_does_not_depend_on_partitions(spark):
    values = spark.range(200_000).select((F.col("id") * 77.77 + 0.015).alias("x"))
    got = {tuple(values.repartition(n).agg(rounded_sum("x"), rounded_avg("x")).first()) for n in (1, 3, 7, 16)}
    assert len(got) == 1
    total = got.pop()[0]
    assert total > 1e12 and abs(total - 77.77 * 200_000 * 199_999 / 2 - 3000) < 0.011


def test_rounded_sum_of_values_without_an_exact_form(spark):
    import math

    big = _one_col(spark, [1e30, 1.0], "double").agg(rounded_sum("x"), rounded_avg("x")).first()
    assert tuple(big) == (1e30, 5e29)
    nan = _one_col(spark, [float("nan"), 1.0], "double").agg(rounded_sum("x"), rounded_avg("x")).first()
    assert all(math.isnan(v) for v in nan)
    inf = _one_col(spark, [float("inf"), 1.0], "double").agg(rounded_sum("x"), rounded_avg("x")).first()
    assert tuple(inf) == (math.inf, math.inf)


def test_rounded_sum_keeps_small_digits(spark):
    tiny = spark.range(1_000_000).select(F.lit(1e-6 / 3).alias("x"))
    assert tiny.agg(rounded_sum("x")).first()[0] == 0.33
    below = spark.range(2_000_000).select(F.lit(1e-9).alias("x"))  # nothing of it in 8 places
    assert below.agg(rounded_sum("x", 3)).first()[0] == 0.002


def test_rounded_sum_against_decimals(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal

    rng = random.Random(7)
    cent = Decimal("0.01")
    for reach in (1, 1e3, 1e6, 8.9e7, 1e8, 8.9e9):
        values = [float(f"{rng.uniform(-reach, reach):.{rng.choice([0, 1, 2, 2, 3] if reach < 9e7 else [0, 1, 2])}f}") for _ in range(300)]
        got = _one_col(spark, values, "double").agg(rounded_sum("x"), rounded_avg("x")).first()
        total = sum(Decimal(repr(v)) for v in values)
        assert got[0] == float(total.quantize(cent, ROUND_HALF_UP))
        assert got[1] == float((total / len(values)).quantize(cent, ROUND_HALF_UP))


TEMP_BOUNDS = [5, 15, 25, 35]
TEMP_LABELS = ["Very Cold", "Cold", "Moderate", "Warm", "Very Hot"]


def test_bucketize_lt_boundaries_and_null_falls_through(spark):
    df = _one_col(spark, [4.99, 5.0, 14.9, 15.0, 25.0, 34.9, 35.0, None], "double")
    got = [r[0] for r in df.select(bucketize("x", TEMP_BOUNDS, TEMP_LABELS, "lt")).collect()]
    assert got == ["Very Cold", "Cold", "Cold", "Moderate", "Warm", "Warm", "Very Hot", "Very Hot"]


def test_bucketize_le_with_zero_and_null_label(spark):
    df = _one_col(spark, [0.0, -0.0, 0.1, 2.5, 2.51, 7.5, 7.6, None], "double")
    got = [
        r[0]
        for r in df.select(
            bucketize(
                "x", [2.5, 7.5], ["Light Rain", "Moderate Rain", "Heavy Rain"], "le",
                null_label="Unknown", zero_label="No Rain",
            )
        ).collect()
    ]
    assert got == [
        "No Rain", "No Rain", "Light Rain", "Light Rain", "Moderate Rain", "Moderate Rain",
        "Heavy Rain", "Unknown",
    ]


def test_bucketize_rejects_bad_labels():
    with pytest.raises(ValueError):
        bucketize("x", [1, 2], ["a", "b"])


def test_score_status_and_rollup(spark):
    ladders = [
        ("rain", [(">", 7.5, 30), (">", 2.5, 15)]),
        ("wind", [(">=", 60, 30), (">=", 40, 15)]),
        ("vis", [("<", 1000, 25), ("<", 5000, 10)]),
        ("temp", [("<", 0, 15), (">", 40, 15)]),
    ]
    df = spark.createDataFrame(
        [
            (0.0, 10.0, 20000.0, 10.0),  # 0
            (7.6, 60.0, 999.0, 41.0),  # 100
            (2.5, 40.0, 1000.0, 0.0),  # 0 + 15 + 10 + 0
            (None, None, None, None),  # NULL adds 0
            (3.0, 20.0, 4000.0, -1.0),  # 15 + 0 + 10 + 15
        ],
        "rain double, wind double, vis double, temp double",
    )
    out = df.select(score(ladders).alias("s")).withColumn(
        "band", status_band("s", [(50, "Red"), (25, "Yellow")], "Green")
    )
    got = [(r["s"], r["band"]) for r in out.collect()]
    assert got == [(0, "Green"), (100, "Red"), (25, "Yellow"), (0, "Green"), (40, "Yellow")]
    assert dict(out.dtypes)["s"] == "int"

    flags = spark.createDataFrame(
        [("a", "Red"), ("a", "Green"), ("b", "Yellow"), ("c", "Green")], "k string, st string"
    )
    summary = flags.groupBy("k").agg(
        flag_any(F.col("st") == "Red").alias("red"), flag_any(F.col("st") == "Yellow").alias("yellow")
    )
    summary = summary.withColumn("overall", rollup_status([("red", "Red"), ("yellow", "Yellow")], "Green"))
    assert {r["k"]: r["overall"] for r in summary.collect()} == {"a": "Red", "b": "Yellow", "c": "Green"}


def test_ladder_without_steps(spark):
    assert _one_col(spark, ["x"]).select(ladder("x", [], "z")).first()[0] == "z"


LABELS = [
    "Easy", "Easy-Moderate", "Moderate", "Moderate-Difficult", "Difficult",
    "Very Difficult", "Extreme", "Hard",
]


def test_standardize_label(spark):
    df = _one_col(spark, ["easy", " EASY-moderate ", "very difficult", "Hard", " Unknown Grade ", None])
    got = [r[0] for r in df.select(standardize_label("x", LABELS)).collect()]
    assert got == ["Easy", "Easy-Moderate", "Very Difficult", "Hard", "Unknown Grade", None]


def test_standardize_label_large_mapping_uses_map(spark):
    labels = [f"Label{i}" for i in range(100)]
    df = _one_col(spark, ["label7", " LABEL99", "other"])
    got = [r[0] for r in df.select(standardize_label("x", labels)).collect()]
    assert got == ["Label7", "Label99", "other"]
    mapping = {"hi": "High", "lo": "Low"}
    got = [r[0] for r in _one_col(spark, ["HI", "x"]).select(standardize_label("x", mapping)).collect()]
    assert got == ["High", "x"]


@pytest.mark.parametrize("n", [1, 2, 31, 32, 33, 100])
def test_standardize_label_is_one_path(spark, n):
    mapping = {f"label{i}": (None if i % 2 else f"L{i}") for i in range(n)}
    texts = [" LABEL0 ", f"Label{n - 1}", " other ", "", None]
    got = [r[0] for r in _one_col(spark, texts).select(standardize_label("x", mapping)).collect()]
    assert got == ["L0", mapping[f"label{n - 1}"], "other", "", None]


def test_plain_and_exact_rounding(spark):
    from tierline.plans.weather import summary_aggregates

    assert set(summary_aggregates("plain")) == set(summary_aggregates())
    with pytest.raises(ValueError):
        summary_aggregates("banker")
