"""The entry works with and without the optional training-data operators."""

import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
BLOCKED = """
import sys
for name in {blocked!r}:
    sys.modules[name] = None
import __spark_entry__ as entry
from sievetally.plans.catalog import QUERIES
print(set(entry.queries()) == set(QUERIES), set(entry.oracle_sql()) == set(QUERIES), len(entry.queries()))
"""


@pytest.mark.parametrize("blocked", [["tiktoken"], ["sievetally.llm"], ["sievetally.llm", "corpus_pipeline"], ["xxhash", "numpy"]])
def test_entry_without_optional_parts(blocked):
    done = subprocess.run([sys.executable, "-c", BLOCKED.format(blocked=blocked)], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-1500:]
    same_queries, same_sql, n = done.stdout.split()
    assert (same_queries, same_sql) == ("True", "True") and int(n) >= 50


def test_nothing_else_imports_the_optional_parts():
    files = [p for p in REPO.glob("sievetally/**/*.py") if "llm" not in p.parts] + [REPO / "run_job.py", REPO / "bench.py"]
    assert files and not [p for p in files if "sievetally.llm" in p.read_text() or "corpus_pipeline" in p.read_text()]
