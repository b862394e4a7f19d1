"""The entry module without the optional subpackage."""

import os
import re
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_subpackage(tmp_path):
    shutil.copytree(f"{ROOT}/casemill", tmp_path / "casemill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = ("import __spark_entry__ as e; q = e.queries(); assert 'case_intake' in q and 'pipeline' not in q; "
            "assert not any(k.startswith('op') for k in [*q, *e.oracle_sql()]); assert set(e.oracle_sql()) == set(q)")
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": ""})


def test_entry_imports_when_the_subpackage_cannot(tmp_path):
    """A library that the subpackage needs is missing: the others remain."""
    shutil.copytree(f"{ROOT}/casemill", tmp_path / "casemill", ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(f"{ROOT}/{name}", tmp_path)
    code = ("import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; q = e.queries(); "
            "assert 'case_intake' in q and 'pipeline' not in q and 'op1_warc' not in q; assert set(e.oracle_sql()) == set(q)")
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": ""})


def test_nothing_else_imports_the_subpackage():
    for folder, _, names in os.walk(f"{ROOT}/casemill"):
        for name in names:
            if name.endswith(".py") and f"{os.sep}llm" not in folder:
                with open(os.path.join(folder, name)) as f:
                    assert not re.search(r"(import|from)\s+casemill\.llm|from casemill import .*llm", f.read()), name
