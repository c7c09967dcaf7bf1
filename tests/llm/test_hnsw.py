"""Recall and scores against brute force; ties, copies, unusable vectors."""

from __future__ import annotations

import math

import numpy as np
from tierline.llm import hnsw as H


def brute(rows, queries, k):
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in queries:
        if (q, v) not in ok:
            continue
        v64 = np.array(v)
        best = {}
        for i, u in ok:
            if i != q and len(u) == len(v):
                u64 = np.array(u)
                s = float(v64 @ u64 / (np.linalg.norm(v64) * np.linalg.norm(u64)))
                best[i] = max(s, best.get(i, -2))
        out[q] = sorted(((i, s) for i, s in best.items()), key=lambda x: (-round(x[1], 12), x[0]))[:k]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_over_several_shards(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16))
    data = centres[rng.integers(0, 20, 2000)] + rng.normal(scale=0.4, size=(2000, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(H.nearest(table, table.where("vec_id % 50 = 0"), shard_size=500))
    expected = brute(rows, [r for r in rows if r[0] % 50 == 0], 5)
    assert set(got) == set(expected) and all(len(v) == 5 for v in got.values())
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hit / (5 * len(expected)) >= 0.9
    exact = dict(rows)
    for q, found in got.items():
        for i, s in found:
            a, b = np.array(exact[q]), np.array(exact[i])
            assert abs(s - a @ b / (np.linalg.norm(a) * np.linalg.norm(b))) < 1e-12


def test_copies_ties_and_unusable_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(40)]  # one very common vector
    rows += [(50, [0.0, 1.0]), (51, [0.5, 0.5]), (52, [-1.0, 0.0]), (53, [2.0, 0.0]), (100, [0.0, 1.0]), (100, [0.0, 1.0])]
    rows += [(60, None), (61, []), (62, [0.0, 0.0]), (63, [nan, 1.0]), (64, [inf, 1.0]), (65, [None, 1.0]), (None, [1.0, 1.0]), (150, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS node", "2 AS score", "3 AS shard")
    queries = [r for r in rows if r[0] in (0, 3, 50, 52, 60, 62, 63, 150)]
    asked = table.where("vec_id in (0, 3, 50, 52, 60, 62, 63, 150)")
    got = answers(H.nearest(table, asked))
    expected = {q: found for q, found in brute(rows, queries, 5).items() if found}
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in expected.items()}
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[3]] == [0, 1, 2, 4, 5]


def test_few_and_no_rows(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (7, [2.0, 1.0]), (9, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = answers(H.nearest(table, table.where("vec_id = 0")))
    assert [i for i, _ in got[0]] == [9, 7]
    assert H.nearest(table.limit(0), table.limit(0)).collect() == []
    assert H.nearest(table, table.limit(0)).collect() == []


def test_search_keeps_to_its_layer():
    rng = np.random.default_rng(5)
    v = rng.normal(size=(700, 8))
    nodes, links = H.build(v)
    assert [len(n) for n in nodes] == [700, 44]
    for n, flat in zip(nodes, links, strict=True):
        own = flat.reshape(-1, H.PLACES)
        assert own.shape[0] == len(n) and own.max() < len(n)
        for i, row in enumerate(own):
            used = row[row >= 0].tolist()
            assert i not in used and len(set(used)) == len(used)


def test_insertion_in_batches():
    """More nodes than a batch: later ones search the graph so far; links are
    mutual or given up for nearer ones, and what is asked for is found."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(30, 24))
    v = centres[rng.integers(0, 30, 5000)] + rng.normal(scale=0.5, size=(5000, 24))
    nodes, links = H.build(v)
    own = links[0].reshape(-1, H.PLACES)
    assert own.shape == (5000, H.PLACES) and (own >= 0).any(axis=1).all()
    for i, row in enumerate(own):
        used = row[row >= 0].tolist()
        assert i not in used and len(set(used)) == len(used)
    q = v[::25] + rng.normal(scale=0.01, size=(200, 24))
    found, scores = H.search(v, [(len(n), x) for n, x in zip(nodes, links, strict=True)], q, 5)
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    exact = np.argsort(-(q / np.linalg.norm(q, axis=1)[:, None] @ unit.T), axis=1)[:, :5]
    hit = np.mean([len(set(a) & set(b)) / 5 for a, b in zip(found.tolist(), exact.tolist(), strict=True)])
    assert hit >= 0.9
    assert (np.diff(scores, axis=1) <= 0).all()


def test_blocks_of_queries_and_shards(spark, monkeypatch):
    """Any number of blocks and shards gives every query its answers, and the
    index goes to its tasks once."""
    rng = np.random.default_rng(9)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 8)))] + [(900 + i, [1.0, float(i)]) for i in range(5)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = table.where("vec_id % 3 = 0 or vec_id >= 900")
    expected = brute(rows, [r for r in rows if r[0] % 3 == 0 or r[0] >= 900], 5)
    for block, shard in ((7, 60), (1000, 1000)):
        monkeypatch.setattr(H, "QUERY_BLOCK", block)
        out = H.nearest(table, asked, shard_size=shard)
        got = answers(out)
        assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in expected.items()}
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "CoGroup" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
