"""The driver's contract, also where the training-data parts are absent."""

import shutil
import subprocess
import sys

from conftest import ROOT

import __spark_entry__


def test_names_of_queries_and_sql():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert "email_domains" in queries and set(sql) <= set(queries)


def test_without_the_training_data_parts(tmp_path):
    copy = tmp_path / "repo"
    skip = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "llm", "corpus_pipeline.py")
    shutil.copytree(ROOT, copy, ignore=skip)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and not any(n.startswith('op1_') for n in q); print(len(q), len(e.oracle_sql()))"
    for _ in range(2):
        found = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env={"PYTHONPATH": str(copy), "PATH": "/usr/bin:/bin"})
        assert found.returncode == 0, found.stderr
        # An empty folder that is left over counts as absent, and so does the pipeline without its operators.
        (copy / "gazetta" / "llm").mkdir(exist_ok=True)
        shutil.copy(ROOT / "README.md", copy / "corpus_pipeline.py")
