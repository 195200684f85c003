"""The library, its entry points and queries without the llm subpackage and the pipeline."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def copy(tmp_path_factory):
    folder = tmp_path_factory.mktemp("without") / "copy"
    shutil.copytree(ROOT, folder, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse"))
    return folder


def test_entry_imports_without_llm(copy):
    code = "import __spark_entry__ as e; names = set(e.queries()); assert names and not any(n.startswith('op') and n[2].isdigit() for n in names) and 'pipeline' not in names; assert set(e.oracle_sql()) <= names"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env=os.environ | {"PYTHONPATH": str(copy)})


def test_the_other_tests_are_there_and_the_queries_pass(copy):
    env = os.environ | {"PYTHONPATH": str(copy)}
    listed = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only"], cwd=copy, check=True, env=env, capture_output=True, text=True)
    assert "error" not in listed.stdout.lower().splitlines()[-1]
    subprocess.run([sys.executable, "-m", "pytest", "tests/test_queries.py", "tests/test_versions.py", "-x", "-q"], cwd=copy, check=True, env=env)


def test_nothing_else_imports_llm():
    for folder, _, files in os.walk(os.path.join(ROOT, "rivulet")):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for name in files:
            if name.endswith(".py"):
                assert "llm" not in open(os.path.join(folder, name)).read(), name
