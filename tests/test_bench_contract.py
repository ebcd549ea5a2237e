"""bench.py prints exactly one JSON line with the keys the driver reads."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_STREAM="0", BENCH_QUERIES="word_count,running_sum")
    proc = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], capture_output=True, text=True,
                          env=env, timeout=600, cwd=REPO)
    lines = [line for line in proc.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, proc.stdout[-2000:] + proc.stderr[-2000:]
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out)
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"word_count", "running_sum"}
    assert abs(out["value"] - sum(out["queries"].values())) < 1e-3
