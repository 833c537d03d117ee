"""bench.py prints exactly one JSON line with the fields the driver records."""
import json
import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=1200)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(rec)
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and rec["value"] > 0
    assert len(rec["queries"]) >= 10


@pytest.mark.parametrize("first", ["__spark_entry__ as E; E.oracle_sql(); E.queries()", "__spark_entry__ as E; E.queries(); E.oracle_sql()",
                                   "martlane.oracle_loads", "martlane.suite_loads", "martlane.suite", "martlane.oracle"])
def test_modules_import_in_any_order(first):
    subprocess.run([sys.executable, "-c", f"import {first}"], cwd=ROOT, check=True, timeout=120)
