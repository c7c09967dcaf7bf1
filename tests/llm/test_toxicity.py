"""Held-out accuracy on made-up texts, and what a score may depend on."""

from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from tierline.llm import toxicity as X

BAD = ["grobian", "lump", "vilain", "canalla"]


def corpus(n, seed=8):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(300)]
    rows = []
    for i in range(n):
        lang = rng.choice(list(X.FUNCTION_WORDS))
        text = rng.choices(words, k=rng.randint(5, 60)) + rng.choices(X.FUNCTION_WORDS[lang].split(), k=10)
        toxic = rng.random() < 0.3
        if toxic:
            text += rng.choices(BAD, k=2)
        rng.shuffle(text)
        rows.append((i, " ".join(text).capitalize() + ".", int(toxic)))
    return rows


def test_word_hashes():
    h = X.word_hashes
    assert len(h(None)) == len(h("")) == len(h(" .,")) == 0
    assert h("One, two! ONE é1").tolist() == [*h("one"), *h("TWO"), *h("one"), *h("é1")]
    assert len(set(h("ab ba abc a b aa aaa").tolist())) == 7
    assert h("a" * 5000)[0] != h("a" * 5001)[0]


def test_word_hashes_in_slices(monkeypatch):
    text = "one two, three" * 50 + "x" * 100 + " end"
    whole = X.word_hashes(text).tolist()
    monkeypatch.setattr(X, "SLICE", 10)
    assert X.word_hashes(text).tolist() == whole


def test_responses_of_short_texts():
    table = [np.ones((3, 2)), np.ones((3, 2)) * 2, np.ones((3, 2)) * 4]
    for n in range(4):
        got = X.responses(np.ones(n, int), table, np.zeros(2))
        assert got.shape == (max(1, n - 2), 2)


def test_held_out_accuracy(spark):
    rows = corpus(900)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, found string")
    labels = [(i, y) for i, _, y in rows] + [(None, 1), (5, None), (10**6, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = X.train(docs, labels)
    scored = docs.select("doc_id", model.score(model.logits(F.col("text"))).alias("score")).collect()
    score = {r.doc_id: r.score for r in scored}
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((score[i] >= 0.5) == bool(y) for i, y in held)
    assert len(held) > 100 and right / len(held) > 0.95
    # the score depends on the text alone, and any text has one
    more = spark.createDataFrame([(None, None), (1, ""), (2, rows[0][1]), (3, rows[0][1]), (4, "lump " * 30_000)], "id long, text string")
    out = [r[0] for r in more.select(model.score(model.logits(F.col("text")))).collect()]
    assert all(0 <= s <= 1 for s in out) and out[0] == out[1] and out[2] == out[3] == score[0] and out[4] > 0.5


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    model = X.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r[0] < 0.5 for r in docs.select(model.score(model.logits(F.col("text")))).collect())
    assert docs.limit(0).select(model.logits(F.col("text"))).collect() == []


def test_thresholds_by_language():
    bins = [("en", b, y, 30) for b, y in ((-40, 0), (40, 1))] + [("de", b, y, 30) for b, y in ((-100, 0), (-60, 1))]
    got = X.calibrated(bins)
    assert -2 < got["en"] < 2 and -5 < got["de"] < -3
    assert got["fr"] == got["other"]  # too few of their own
