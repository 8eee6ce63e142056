"""The driver contract holds without the optional subpackage or a library that only it needs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("hidden", ["zstandard", "tokenizers", "vigil.llm", "corpus_pipeline"])
def test_core_queries_without_an_optional_library(hidden):
    code = (f"import sys; sys.modules[{hidden!r}] = None; import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); "
            "assert {'flags_by_rule', 'detector_stores', 'quality_suite'} <= set(q) and set(s) <= set(q); "
            "assert not any(k.startswith('op') or k == 'pipeline' for k in q); print(len(q))")
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split()[-1]) >= 60
