"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys


def test_bench_prints_one_json_line(sf_small):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=sf_small, BENCH_CPUS="2", BENCH_REPEATS="1",
               BENCH_QUERIES="member_key,loan_score_grades")
    out = subprocess.run([sys.executable, os.path.join(repo, "bench.py")], capture_output=True, text=True,
                         timeout=600, env=env, cwd=repo)
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == "0.001" and isinstance(d["value"], float)
    assert set(d["queries"]) == {"wide_table", "member_key", "loan_score_grades"}
    assert "errors" not in d and d["jvm_warmup_sec"] > 0
