"""Codes against plain integer k-means, and the bounds against brute force."""

from __future__ import annotations

import hashlib
import math
import os
import random

import numpy as np
import pytest

from tierline.llm import codes

SF = "/root/testdata/sf0.001"


def brute(rows, parts=16, entries=64, rounds=2):
    """rows: (vec_id, vector, label) -> rows of the query."""
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            chosen = {}
            for c in cut:
                chosen.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(x) // len(x) for x in zip(*chosen[k], strict=True)] if k in chosen else e for k, e in enumerate(books[p])]
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    by_label = {}
    for (_, _, lab), f in zip(kept, found, strict=True):
        by_label[lab] = by_label.get(lab, 0) + sum(d for d, _ in f)
    return [
        (i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), by_label[lab], digest)
        for (i, _, lab), f in zip(kept, found, strict=True)
    ]


def run(spark, tmp_path, rows, columns="vec_id long, embedding array<double>, label int, id long, x int, codes string"):
    from tierline.llm.queries import op11_codes

    extra = [(*r, 7, 8, "c") for r in rows]
    spark.createDataFrame(extra, columns).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return sorted(map(repr, map(tuple, op11_codes(spark, str(tmp_path)).collect())))


def vectors(n, seed=1, dim=64, spread=0.3):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(dim)], rng.choice([0, 0, 1, None])) for i in range(n)]


@pytest.mark.parametrize("n", [1, 40, 300])
def test_against_brute_force(spark, tmp_path, n):
    rows = vectors(n)
    assert run(spark, tmp_path, rows) == sorted(map(repr, brute(rows)))


def test_ties_nulls_and_repeats(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.004, 0.0, 0.004, 1.0]) for _ in range(32)], i % 3) for i in range(200)]
    rows += rows[:50] + [(5, rows[9][1], None), (None, rows[0][1], 1), (None, rows[1][1], None)]
    rows += [
        (900, None, 1), (901, [], 1), (902, [None] * 32, 1), (903, [float("nan")] * 32, 1),
        (904, [float("inf"), *rows[0][1][1:]], 1), (-1, [*rows[0][1][:-1], None], 1),
    ]
    assert run(spark, tmp_path, rows) == sorted(map(repr, brute(rows)))


def test_large_components_are_exact(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-200_000, 200_000) for _ in range(16)], 0) for i in range(150)]
    assert run(spark, tmp_path, rows) == sorted(map(repr, brute(rows)))


def test_empty_and_odd_tables(spark, tmp_path):
    assert run(spark, tmp_path / "a", []) == []
    assert run(spark, tmp_path / "b", [(1, None, 1), (2, [], None)]) == []
    rows = vectors(20) + [(50, [1.0] * 32, 1), (51, [1.0], 1)]  # other lengths are dropped
    assert run(spark, tmp_path / "c", rows) == sorted(map(repr, brute(rows[:20])))
    with pytest.raises(ValueError, match="equal parts"):
        run(spark, tmp_path / "d", [(1, [1.0] * 10, 1)])
    with pytest.raises(ValueError, match="64-bit"):
        run(spark, tmp_path / "e", [(1, [1e12] * 16, 1)])


def books(rng, n, parts=2, entries=16, width=4):
    """A history in which entries drift, some of them back again."""
    out = [rng.integers(-200, 200, (parts, entries, width))]
    for k in range(n):
        step = rng.integers(-30, 30, out[0].shape) * (rng.random((parts, entries, 1)) < 0.5)
        out.append(out[0] if k % 3 == 2 else out[-1] + step)
    return out


@pytest.mark.parametrize("kind", [np.float64, np.int64])
@pytest.mark.parametrize("groups", [1, 4, 16])
def test_bounds_give_exact_assignments(kind, groups):
    rng = np.random.default_rng(groups)
    x = rng.integers(-250, 250, (500, 2, 4)).astype(kind)
    x[:100] = x[0]  # equal vectors
    history = books(rng, 7)
    state, least = None, 0
    for t in range(1, len(history) + 1):
        state, away, scanned = codes.assign(x, history[:t], state, groups)
        d = ((x[:, :, None, :] - history[t - 1][None]) ** 2).sum(axis=3)
        assert (state.chosen == d.argmin(axis=2)).all() and (away == d.min(axis=2)).all()
        for p in range(2):  # every bound holds for the codebook of its stamp
            for g, s in enumerate(codes.group_slices(16, groups)):
                then = np.array([history[k][p, s] for k in state.stamp[:, p, g]])
                far = np.sqrt(((x[:, p, None] - then) ** 2).sum(axis=2))
                far[np.arange(s.start, s.stop)[None] == state.chosen[:, p, None]] = np.inf
                assert (state.low[:, p, g] <= far.min(axis=1) + 1e-6).all()
        if t > 1:
            least = max(least, 1 - scanned / d.size)
    assert least > 0.3 or groups == 1  # bounds spare distances


def test_net_displacement_is_tighter_than_drift():
    rng = np.random.default_rng(5)
    history = books(rng, 6)
    slices = codes.group_slices(16, 4)
    net = codes.net_displacements(history, slices)
    drift = np.zeros_like(net)
    for t in range(len(history) - 1):
        step = np.sqrt(((history[t + 1] - history[t]) ** 2).sum(axis=2))
        for g, s in enumerate(slices):
            drift[: t + 1, :, g] += step[:, s].max(axis=1)
    assert (net <= drift + 1e-6).all() and net[:-1].sum() < 0.8 * drift[:-1].sum()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_query(spark):
    from tierline.llm.queries import op11_codes

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(map(repr, map(tuple, op11_codes(spark, SF).collect()))) == sorted(map(repr, brute(rows)))
