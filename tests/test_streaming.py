"""The incremental ingest picks up only new documents on each run and gives
the batch result whatever the order in which they land."""

from __future__ import annotations

import json
import os

from conftest import rows
from tierline.plans import weather as W
from tierline.streaming import read_stream_silver, start_weather_ingest


def _doc(trek_id, times, temps):
    n = len(times)
    return {
        "trek_id": trek_id, "trek_name": f"P{trek_id}", "latitude": 30.0, "longitude": 78.0,
        "elevation": 1000.0, "current": {"temperature_2m": 1.0},
        "hourly": {
            "time": times, "temperature_2m": temps, "relative_humidity_2m": [50] * n,
            "precipitation": [0.0] * n, "visibility": [10000.0] * n,
            "wind_speed_10m": [5.0] * n, "wind_gusts_10m": [6.0] * n,
        },
    }


def _write(path, doc):
    with open(path, "w") as fh:
        json.dump(doc, fh, indent=2)


def _paths(tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    return landing, os.path.join(tmp_dir, "hours"), os.path.join(tmp_dir, "ckpt")


def _same_as_batch(spark, landing, path):
    batch = W.weather_silver(W.read_weather_docs(spark, landing))
    got = read_stream_silver(spark, path)
    assert got.columns == W.SILVER_COLUMNS
    assert rows(got) == rows(batch)
    return got


def test_incremental_ingest(spark, tmp_dir):
    landing, path, ckpt = _paths(tmp_dir)
    _write(os.path.join(landing, "a.json"), _doc(1, ["2026-09-04T00:00", "2026-09-04T01:00"], [1.0, 2.0]))
    _write(os.path.join(landing, "b.json"), _doc(2, ["2026-09-04T00:00", "bad"], [3.0, 4.0]))
    start_weather_ingest(spark, landing, path, ckpt).awaitTermination()
    first = _same_as_batch(spark, landing, path)
    assert sorted((r.trek_id, r.temperature_c) for r in first.collect()) == [(1, 1.0), (1, 2.0), (2, 3.0)]

    # a later fetch repeats one hour of place 1 and adds a new one
    _write(os.path.join(landing, "c.json"), _doc(1, ["2026-09-04T01:00", "2026-09-04T02:00"], [9.0, 5.0]))
    start_weather_ingest(spark, landing, path, ckpt).awaitTermination()
    got = sorted((r.trek_id, r.weather_time.hour, r.temperature_c) for r in _same_as_batch(spark, landing, path).collect())
    assert got == [(1, 0, 1.0), (1, 1, 2.0), (1, 2, 5.0), (2, 0, 3.0)]


def test_older_document_in_a_later_run(spark, tmp_dir):
    landing, path, ckpt = _paths(tmp_dir)
    _write(os.path.join(landing, "a.json"), _doc(1, ["2026-09-27T00:00"], [1.0]))
    start_weather_ingest(spark, landing, path, ckpt).awaitTermination()
    _write(os.path.join(landing, "b.json"), _doc(2, ["2026-09-04T00:00"], [2.0]))
    start_weather_ingest(spark, landing, path, ckpt).awaitTermination()
    assert _same_as_batch(spark, landing, path).count() == 2


def test_older_documents_in_later_micro_batches(spark, tmp_dir):
    landing, path, ckpt = _paths(tmp_dir)
    for i, day in enumerate(["27", "27", "27", "04", "04"]):
        _write(os.path.join(landing, f"f{i}.json"), _doc(i % 3, [f"2026-09-{day}T00:00"], [float(i)]))
    q = start_weather_ingest(spark, landing, path, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    assert len(q.recentProgress) >= 5  # one file per micro-batch
    assert _same_as_batch(spark, landing, path).count() == 5
