"""The registered queries with and without the optional part."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
HIDE = """
import sys, warnings
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r} or name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hidden())
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__ as e
known = e.queries()
assert "daily_account_summary" in known and "pipeline" not in known, sorted(known)
assert set(e.oracle_sql()) <= set(known)
print(len(said), *(str(w.message) for w in said if "corpus" in str(w.message)))
"""


@pytest.mark.parametrize("name, warned", [("tokenizers", True), ("public_tokenizers", True), ("corpus_pipeline", False), ("txnmill.llm", False)])
def test_entry_without_a_part(name, warned):
    done = subprocess.run([sys.executable, "-c", HIDE.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert ("corpus operators are left out" in done.stdout and name in done.stdout) == warned
