"""The entry module with and without the corpus operators."""

import os
import shutil
import subprocess
import sys

from .conftest import ROOT

SHOW = "import __spark_entry__ as e; print(*sorted(set(e.queries())), '|', *sorted(e.oracle_sql()))"


def names(folder):
    out = subprocess.run([sys.executable, "-c", SHOW], cwd=folder, capture_output=True, text=True, check=True,
                         env={**os.environ, "PYTHONPATH": str(folder)})
    queries, sql = out.stdout.split("|")
    return set(queries.split()), set(sql.split())


def test_the_rest_stands_alone(tmp_path):
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/kinrank", tmp_path / "kinrank", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "kinrank" / "llm" / "__pycache__").mkdir(parents=True)  # what a deleted package may leave
    queries, sql = names(tmp_path)
    assert "predict_knn" in queries and queries == sql
    assert not any(q.startswith("op") or q == "pipeline" for q in queries)
