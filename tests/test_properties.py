"""Property tests: operators against brute-force Python on random inputs.

Each hypothesis example is a whole batch of values evaluated in ONE Spark
job, so a few examples cover hundreds of cases cheaply.
"""

from __future__ import annotations

import itertools
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tierline.functions import bucketize, parse_money_range, parse_range
from tierline.operators import dedupe, left_join_split, zip_explode

SETTINGS = settings(
    max_examples=6, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck)
)

# ---- brute-force references ------------------------------------------------


def py_parse_range(text):
    if text is None:
        return (None, None, None)
    t = text.strip(" ")
    lo_m = re.match(r"(\d+(?:\.\d+)?)", t)
    hi_m = re.search(r"(?:[–-]|to)\s*(\d+(?:\.\d+)?)$", t)
    lo = float(lo_m.group(1)) if lo_m else None
    hi = lo if not hi_m else float(hi_m.group(1))
    avg = (lo + hi) / 2 if lo is not None and hi is not None else None
    return (lo, hi, avg)


def py_money(text):
    if text is None:
        return (None, None)
    clean = re.sub(r"[₹,\s]", "", text)

    def side(m):
        if not m:
            return None
        v = float(m.group(1))
        return v * 1000 if m.group(2).lower() == "k" else v

    return (
        side(re.search(r"(\d+(?:\.\d+)?)([kK]?)", clean)),
        side(re.search(r"(?:[–-]|to)(\d+(?:\.\d+)?)([kK]?)", clean)),
    )


num = st.one_of(
    st.integers(0, 99999).map(str),
    st.tuples(st.integers(0, 999), st.integers(0, 99)).map(lambda t: f"{t[0]}.{t[1]}"),
)
sep = st.sampled_from(["–", "-", " - ", " to ", "to", " – "])
suffix = st.sampled_from(["", "", " days", "k", "K", " ", "x"])
prefix = st.sampled_from(["", "", " ", "₹", "  ", "about "])
range_text = st.one_of(
    st.none(),
    st.builds(lambda p, a, s, b, x: f"{p}{a}{s}{b}{x}", prefix, num, sep, num, suffix),
    st.builds(lambda p, a, x: f"{p}{a}{x}", prefix, num, suffix),
    st.sampled_from(["needs_verification", "", "n/a", "–", "to"]),
)


def _thousands(n: int) -> str:
    return f"{n:,}"


money_text = st.one_of(
    range_text,
    st.builds(
        lambda a, b, s: f"₹{_thousands(a)}{s}₹{_thousands(b)}",
        st.integers(0, 10**7), st.integers(0, 10**7), sep,
    ),
)


@SETTINGS
@given(st.lists(range_text, min_size=1, max_size=80))
def test_parse_range_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: (r.p["min"], r.p["max"], r.p["avg"]) for r in df.select("i", parse_range("t").alias("p")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == py_parse_range(t), t


@SETTINGS
@given(st.lists(money_text, min_size=1, max_size=80))
def test_parse_money_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: (r.p["min"], r.p["max"]) for r in df.select("i", parse_money_range("t").alias("p")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == py_money(t), t


bounds_st = st.lists(st.integers(-50, 50), min_size=1, max_size=4, unique=True).map(sorted)


@SETTINGS
@given(
    bounds_st,
    st.lists(st.one_of(st.none(), st.integers(-60, 60).map(float), st.floats(-60, 60)), min_size=1, max_size=60),
    st.sampled_from(["lt", "le"]),
    st.booleans(),
    st.booleans(),
)
def test_bucketize_matches_python(spark, bounds, values, op, with_null, with_zero):
    labels = [f"b{i}" for i in range(len(bounds) + 1)]
    null_label = "N" if with_null else None
    zero_label = "Z" if with_zero else None

    def py(v):
        if v is None:
            return null_label if with_null else labels[-1]
        if with_zero and v == 0:
            return "Z"
        for b, lab in zip(bounds, labels):
            if (v < b) if op == "lt" else (v <= b):
                return lab
        return labels[-1]

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    col = bucketize("v", bounds, labels, op, null_label=null_label, zero_label=zero_label)
    got = {r.i: r.b for r in df.select("i", col.alias("b")).collect()}
    assert got == {i: py(v) for i, v in enumerate(values)}


row_st = st.tuples(st.integers(0, 4), st.integers(0, 2), st.integers(0, 20), st.integers(0, 10**6))


@SETTINGS
@given(st.lists(row_st, min_size=1, max_size=120, unique_by=lambda r: r[3]))
def test_dedupe_matches_python(spark, data):
    df = spark.createDataFrame(data, "a int, b int, ts int, id int").repartition(5)
    best = {}
    for a, b, ts, i in data:
        if (a, b) not in best or (ts, i) < best[(a, b)][2:]:
            best[(a, b)] = (a, b, ts, i)
    got = rows(dedupe(df, ["a", "b"], ["ts", "id"]))
    assert got == sorted(best.values(), key=lambda t: tuple((x is None, str(x)) for x in t))


@SETTINGS
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.integers(-1000, 1000)), max_size=30),
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.integers(-1000, 1000)), max_size=60),
)
def test_left_join_split_matches_python(spark, left, right):
    ldf = spark.createDataFrame(left, "k int, l long")
    rdf = spark.createDataFrame(right, "k int, r long")
    expect = []
    for k, lv in left:
        matches = [rv for rk, rv in right if k is not None and rk == k]
        expect += [(k, lv, rv) for rv in matches] or [(k, lv, None)]
    assert rows(left_join_split(ldf, rdf, ["k"])) == sorted(
        expect, key=lambda t: tuple((x is None, str(x)) for x in t)
    )


arr = st.one_of(st.none(), st.lists(st.one_of(st.none(), st.integers(-5, 5)), max_size=5))


@SETTINGS
@given(st.lists(st.tuples(arr, arr), min_size=1, max_size=30))
def test_zip_explode_matches_python(spark, docs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(docs)], "i int, a array<int>, b array<int>")
    out = zip_explode(df, {"x": "a", "y": "b"}, keep=["i"], position="p")
    expect = []
    for i, (a, b) in enumerate(docs):
        if a is None or b is None:
            continue
        for p, (x, y) in enumerate(itertools.zip_longest(a, b)):
            expect.append((i, p, x, y))
    assert rows(out) == sorted(expect, key=lambda t: tuple((x is None, str(x)) for x in t))
    assert out.filter(F.col("i") < 0).count() == 0
