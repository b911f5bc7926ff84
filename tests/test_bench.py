"""bench.py prints exactly one JSON line with the agreed keys."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest

from tests.conftest import ROOT, SF_SMALL


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")
def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF_SMALL, "BENCH_CPUS": "2", "BENCH_REPEATS": "1"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=900, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and rec["value"] > 0
    assert set(rec["queries"]) >= {"q1_top_months", "q2_day_bands", "q3_profile_top", "q4_station_profile"}
