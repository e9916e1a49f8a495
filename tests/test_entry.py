"""The entry point with parts of the installation missing."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from meterlake.plans.queries import REGISTRY

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

BLOCKED = """
import sys, warnings
warnings.simplefilter("ignore")
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in {blocked!r} or name in {blocked!r}:
            raise ModuleNotFoundError("blocked: " + name, name=name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()))
"""


@pytest.mark.parametrize("blocked", ["tokenizers", "meterlake.llm", "corpus_pipeline"])
def test_library_queries_load_without_the_optional_part(blocked):
    out = subprocess.run([sys.executable, "-c", BLOCKED.format(blocked=[blocked])], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    assert int(out.stdout.split()[0]) == len(REGISTRY)
