"""The driver-facing contract: __spark_entry__ and bench.py."""

import importlib.util
import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_and_registry(spark):
    m = _entry_module()
    df = m.entry(spark)
    assert [f.name for f in df.schema.fields] == ["label", "n"]
    assert df.count() > 0
    q, sql = m.queries(), m.oracle_sql()
    assert set(sql) <= set(q) and len(sql) >= 40
    assert all(callable(f) for f in q.values())


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "class_distribution", "hash_split"],
                         capture_output=True, text=True, env=env, cwd=str(tmp_path), timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1, out.stderr[-2000:]
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and set(d["queries"]) == {"class_distribution", "hash_split"}


def test_entry_without_the_corpus_operators(tmp_path):
    """Neither their absence nor that of a library they need breaks the rest."""
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
sys.modules["xxhash"] = None
import __spark_entry__ as e
names = set(e.queries())
assert "class_distribution" in names and not any(n.startswith("op") or n == "pipeline" for n in names), names
assert set(e.oracle_sql()) <= names
print("rest is there")
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=str(tmp_path), timeout=120)
    assert "rest is there" in out.stdout, out.stderr[-2000:]
