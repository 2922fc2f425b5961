"""The entry module without the corpus operators, or without what they need."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCKED = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name in {names} or any(name.startswith(n + ".") for n in {names}):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
names = list(entry.queries())
assert set(entry.oracle_sql()) <= set(names)
print(len(names), sum(n.startswith(("op", "pipeline")) for n in names))
"""


@pytest.mark.parametrize(
    "missing",
    [
        ["tidemark.llm"],
        ["corpus_pipeline", "tidemark.llm"],
        ["regex"],
        ["zstandard"],
        ["public_tokenizers"],
        ["xxhash"],
    ],
    ids="+".join,
)
def test_event_queries_do_without(missing):
    code = BLOCKED.format(names=missing)
    run = subprocess.run(
        [sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120
    )
    assert run.returncode == 0, run.stderr
    total, corpus = map(int, run.stdout.split()[-2:])
    assert total > 50 and corpus == 0
