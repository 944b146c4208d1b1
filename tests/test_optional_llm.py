"""The repository without the llm subpackage: the entry and the rest still work."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

ASK = """
import __spark_entry__ as E
from relq.plans.catalog import REGISTRY
assert set(E.queries()) == set(REGISTRY), set(E.queries()) ^ set(REGISTRY)
assert set(E.oracle_sql()) <= set(REGISTRY)
print(len(E.queries()))
"""


def _copy(target, *, pipeline):
    skipped = shutil.ignore_patterns("llm", "__pycache__", ".git", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, target, ignore=skipped)
    return target


def _run(folder, *args):
    return subprocess.run([sys.executable, *args], cwd=folder, capture_output=True, text=True, timeout=300,
                          env={**os.environ, "PYTHONPATH": str(folder), "PYTHONDONTWRITEBYTECODE": "1"})


def test_entry_without_llm(tmp_path):
    for name, pipeline in (("both", True), ("neither", False)):
        done = _run(_copy(tmp_path / name, pipeline=pipeline), "-c", ASK)
        assert done.returncode == 0, done.stderr


def test_a_folder_of_caches_is_no_package(tmp_path):
    folder = _copy(tmp_path / "copy", pipeline=True)
    os.makedirs(folder / "relq" / "llm" / "__pycache__")
    done = _run(folder, "-c", ASK)
    assert done.returncode == 0, done.stderr


def test_the_rest_collects_without_llm(tmp_path):
    folder = _copy(tmp_path / "copy", pipeline=True)
    done = _run(folder, "-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider")
    assert done.returncode == 0, done.stdout + done.stderr
