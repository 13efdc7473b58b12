"""The entry point in a checkout with and without its optional parts."""

from __future__ import annotations

import json
import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def registered(where: str) -> tuple[set[str], set[str]]:
    code = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=where, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    names, sql = json.loads(done.stdout.splitlines()[-1])
    return set(names), set(sql)


@pytest.mark.parametrize("left_out", [("tidemark/llm",), ("corpus_pipeline.py",), ("tidemark/llm", "corpus_pipeline.py")])
def test_core_queries_stay_without_optional_parts(tmp_path, left_out):
    from tidemark.plans.registry import ORACLES, QUERIES

    gone = {os.path.join(ROOT, p) for p in (*left_out, "tests", ".git")}
    ignored = lambda d, names: [n for n in names if os.path.join(d, n) in gone or n == "__pycache__"]
    shutil.copytree(ROOT, tmp_path / "copy", ignore=ignored)
    names, sql = registered(str(tmp_path / "copy"))
    assert names >= set(QUERIES) and sql >= set(ORACLES)
    assert "pipeline" not in names
    if "tidemark/llm" in left_out:
        assert names == set(QUERIES)
