"""The entry module without optional parts."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

BLOCKED = """
import sys
sys.modules[{name!r}] = None
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
print(len(entry.queries()), sorted(n for n in entry.queries() if n.startswith("op") or n == "pipeline"))
assert set(entry.oracle_sql()) <= set(entry.queries())
"""


def test_entry_without_a_library_of_the_optional_part():
    for name in ("public_tokenizers", "corpus_pipeline"):
        done = subprocess.run([sys.executable, "-c", BLOCKED.format(name=name, root=ROOT)], capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr[-2000:]
        count, names = done.stdout.split(" ", 1)
        assert int(count) >= 31 and names.strip() == "[]"
