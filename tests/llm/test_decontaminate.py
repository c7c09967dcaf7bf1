"""Windows, hits and items against a plain version."""

from __future__ import annotations

import random

import pytest
from brute import contamination, sha
from tierline.llm import decontaminate as D


def collected(df):
    return sorted(
        ((r.doc_id, r.n_words, r.n_hit, len(r["items"]), sha(",".join(r["items"])), r.contaminated) for r in df.collect()), key=repr
    )


@pytest.mark.parametrize("block", [1_000_000, 7])
def test_against_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK", block)  # a small block takes several passes
    rng = random.Random(4)
    words = ["The", "of", "É", "ça", "x1", "rare", "日本", "and"]

    def text(n):
        return "".join(rng.choice(words) + rng.choice([" ", ", ", "--", "\n"]) for _ in range(n))

    items = [(i, text(rng.choice([1, 2, 4, 5, 12, 13, 14, 30]))) for i in range(12)] + [(20, None), (21, " ,."), (22, "of of of of of of of")]
    items += [items[0], (None, text(15))]
    docs = [(i, text(rng.randint(0, 60))) for i in range(30)]
    docs += [(100 + i, text(10) + t.upper() + text(30)) for i, (_, t) in enumerate(items) if t]
    docs += [(200, None), (201, ""), (202, "..."), (None, items[3][1]), (5, items[7][1]), docs[0], docs[0]]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS n_words", "0 AS items", "1 AS hash", "2 AS ws")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS ws")
    got = D.decontaminate(d, b)
    assert set(got.columns) == {"doc_id", "text", "hash", "ws", "n_words", "n_hit", "items", "contaminated"}
    assert collected(got) == sorted(contamination(docs, items), key=repr)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert collected(D.decontaminate(docs, items.limit(0))) == [(1, 3, 0, 0, sha(""), False)]
    assert D.decontaminate(docs.limit(0), items).collect() == []


def test_main_path_is_native(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    plan = D.decontaminate(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
