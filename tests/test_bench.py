"""bench.py prints exactly one JSON line of the agreed shape."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF, "BENCH_REPEATS": "1", "BENCH_CPUS": "2",
           "BENCH_DRIVER_MEMORY": "2g"}
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py"), "top_n", "count_by"],
        env=env, capture_output=True, text=True, timeout=600, check=True,
    ).stdout.strip().splitlines()
    assert len(out) == 1
    d = json.loads(out[0])
    assert d["metric"] == "total_median_sec" and d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"top_n", "count_by"}
    assert d["value"] == pytest.approx(sum(d["queries"].values()), abs=1e-3)
    assert d["jobs"]["count_by"] >= 1
