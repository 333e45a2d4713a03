"""The entry point without the add-on: its folder, pipeline and tests may be
deleted, and everything else still imports and is registered."""

import os
import shutil
import subprocess
import sys

import pytest

from conftest import ROOT
from twinrun.plans.fixture_queries import QUERIES


@pytest.mark.parametrize("pipeline", [False, True])
def test_entry_without_the_add_on(tmp_path, pipeline):
    """Also with the pipeline's file left behind, which cannot be imported then."""
    if pipeline and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
        shutil.copy(os.path.join(ROOT, "corpus_pipeline.py"), tmp_path)
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    shutil.copytree(os.path.join(ROOT, "twinrun"), tmp_path / "twinrun",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
    names, sql = (line.split() for line in out.stdout.splitlines()[-2:])
    assert set(names) == set(sql) == set(QUERIES)
