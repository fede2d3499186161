"""Queries run where workers cannot import this package: it travels with the functions."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from tidemill.llm import queries

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from tidemill.session import local_session
from tidemill.llm import queries
spark = local_session("packaging", 4)
for name in sys.argv[2:]:
    print(name, queries.QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.parametrize("names", [["op4_toxicity", "op12_hard_negatives", "op13_conversations", "op11_exact_dedup"]])
def test_workers_without_the_package(tmp_path, names):
    (tmp_path / "run.py").write_text(SCRIPT)
    root = str(Path(__file__).resolve().parents[2])
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "run.py", root, *names], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-3000:]
    assert set(names) <= set(done.stdout.split()) and set(names) <= set(queries.QUERIES)
