"""Fingerprints, links and components against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest
from brute import simhash, simhash_components
from tierline.llm import simhash as S
from tierline.llm.components import components


def test_fingerprint():
    rng = random.Random(1)
    words = ["a", "B", "ç", "É", "thing", "日本", "x y"]
    for text in [None, "", " \n", "one", "One two", "a b c", *(" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(50))]:
        assert S.fingerprint(text) == simhash(text)


@pytest.mark.parametrize("n", [2, 63, 64, 65, 300])
@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_links_find_all_near_pairs(n, radius):
    rng = np.random.default_rng(n + radius)
    base = rng.integers(0, 2**63, 5, dtype=np.uint64)
    fps = base[rng.integers(0, 5, n)]
    for _ in range(4):
        fps = fps ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)) * rng.integers(0, 2, n, dtype=np.uint64)
    group = np.sort(rng.integers(0, 3, n))
    group = np.cumsum(np.r_[False, group[1:] != group[:-1]])
    i, j = S.links(fps, group, np.zeros(n, int), radius)
    got = set(zip(i.tolist(), j.tolist(), strict=True))
    expected = {
        (a, b)
        for a in range(n)
        for b in range(a + 1, n)
        if group[a] == group[b] and (int(fps[a]) ^ int(fps[b])).bit_count() <= radius
    }
    assert got == expected
    # a spanning forest keeps the components
    low, root = S.forest(i, j, n)
    label = np.arange(n)
    label[low] = root
    for a, b in expected:
        assert label[a] == label[b]


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        root[max(ra, rb)] = min(ra, rb)
    expected = {x: find(x) for x in root if find(x) != x}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {x: r for x, r in got.items() if x != r} == expected
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def texts(rng, n):
    words = ["w%d" % i for i in range(40)]
    out = []
    for _ in range(n):
        base = rng.choices(words, k=60)
        out.append(" ".join(base))
        for _ in range(3):
            near = list(base)
            near[rng.randrange(60)] = "other"
            out.append(" ".join(near))
    return out


def test_near_duplicates_with_chunked_buckets(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 3)  # buckets of over three go to several tasks
    rng = random.Random(3)
    rows = list(enumerate(texts(rng, 8) + [None, "", " ", "same text here", "same text here"]))
    rows += [(40, rows[0][1]), (None, rows[1][1]), rows[2], (None, "alone with no id at all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS root", "3 AS row_key")
    got = S.near_duplicates(docs, radius=6).collect()
    expected = simhash_components(rows, radius=6)
    assert sorted(map(repr, ((r.id, f"{r.fp % 2**64:016x}", r.component_id) for r in got))) == sorted(map(repr, expected))
    assert S.near_duplicates(docs.limit(0)).collect() == []


def test_keep_one(spark):
    rows = [(5, "a b c d e"), (2, "a b c d e"), (9, None), (8, ""), (None, "only here x y"), (None, "only here x y"), (1, "z z z z"), (1, "z z z z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS row_key", "text AS kept_key")
    got = S.keep_one(docs, radius=0)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        [(2, "a b c d e"), (8, ""), (None, "only here x y"), (1, "z z z z")], key=repr
    )
