"""bench.py runs end to end (tiny scale, one run) and prints one JSON line."""

import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_RUNS="1", BENCH_GAME_DOCS="20",
               BENCH_CPUS="2", BENCH_QUERIES="arsenal,upsert,locf_zero")
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=env, capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"arsenal", "upsert", "locf_zero"}
    assert d["value"] == round(sum(d["queries"].values()), 3)
    assert len(d["all_queries_single_run"]) >= 59 and d["nested"] and d["write_path"] and d["payload_formats"]
