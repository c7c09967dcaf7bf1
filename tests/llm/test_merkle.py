"""The manifest against a plain recursive version."""

from __future__ import annotations

import hashlib
import os
import zlib

import pytest
from pyspark.sql import functions as F

from tierline.llm import merkle

SF = "/root/testdata/sf0.001"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def value(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes, fanout=8):
    """nodes -> (last node, per leaf the list of (before, after))."""
    paths, level, below = [[] for _ in nodes], nodes, [[i] for i in range(len(nodes))]
    while len(level) > 1:
        up, above = [], []
        for s in range(0, len(level), fanout):
            run = level[s : s + fanout]
            for k in range(len(run)):
                for i in below[s + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(h("".join(run)))
            above.append([i for b in below[s : s + fanout] for i in b])
        level, below = up, above
    return level[0], paths


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> the query's rows."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = {}
    for doc, source, lang, n, text in rows:
        leaf = h("".join(map(value, (doc, source, lang, n, text))))
        changed = leaf
        if doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0:
            changed = h("".join(map(value, (doc, source, lang, n, None if text is None else text.translate(low)))))
        groups.setdefault(lang, []).append((doc is not None, doc or 0, leaf, changed, doc))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([r[2] for r in sorted(groups[g])]) for g in order}
    root, tops = climb([trees[g][0] for g in order]) if order else (None, [])
    out = []
    for g, top in zip(order, tops, strict=True):
        subroot, paths = trees[g]
        for r, path in zip(sorted(groups[g]), paths, strict=True):
            folded = r[3]
            for before, after in path + top:
                folded = h(before + folded + after)
            proof = h("".join(b + a for b, a in path + top))
            out.append((r[4], r[2], subroot, root, proof, folded, folded == root))
    return out


def result(docs, digits):
    out = merkle.document_manifest(docs, digits)
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    out = out.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256), folded.alias("folded"))
    return out.withColumn("verified", F.col("folded") == F.col("root"))


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf int, grp string, item string"


def check(spark, rows, digits):
    docs = spark.createDataFrame([(*r, 1, "x", None) for r in rows], SCHEMA).repartition(3)
    got = result(docs, digits).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(rows)))


@pytest.mark.parametrize("digits", [1, 2])
def test_against_recursion(spark, digits):
    rows = [(i * 3 % 401, f"s{i % 4}", ["en", "de", "en", "fr", "en"][i % 5], i, f"Text {i} É") for i in range(401)]
    check(spark, rows, digits)


def test_nulls_ties_and_single_leaves(spark):
    rows = [
        (1, None, None, None, None), (2, "", "", 0, ""), (3, "a", "de", 5, "ABC"), (3, "a", "de", 5, "ABC"), (3, "b", "de", 5, "xyz"),
        (None, "c", "de", None, "NULL ID"), (None, None, None, None, None), (6, "s", "zz", 1, "Ä" * 20000), (7, "s", "Ä", 1, "-"),
        (8, "s", "\U0001f600", 1, "a"), (9, "s", "￿", 1, "a"),
    ]
    check(spark, rows, 2)
    check(spark, rows[:1], 2)  # one leaf: leaf, subroot and root are the same


def test_equal_rows_are_dealt_out(spark):
    rows = [(5, "s", "en", 3, "Same")] * 300 + [(i, "s", "en", 3, "x") for i in range(100)]
    check(spark, rows, 1)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert result(docs, 2).collect() == []


def test_no_join_below_the_ranks(spark):
    """Proofs come down by unions and groupings, not by joins."""
    rows = [(i, "s", "en", 3, "x") for i in range(100)]
    out = merkle.document_manifest(spark.createDataFrame([(*r, 1, "x", None) for r in rows], SCHEMA), 1)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_query(spark):
    from tierline.llm.queries import op12_merkle

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    got = op12_merkle(spark, SF).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute([tuple(r) for r in docs.collect()])))
    assert {r["verified"] for r in got} == {True, False}
