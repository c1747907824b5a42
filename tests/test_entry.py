"""The contract module with the optional part present, half removed, missing and broken."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), set(e.oracle_sql()) <= set(e.queries()))"


@pytest.fixture
def copy(tmp_path):
    target = tmp_path / "repo"
    shutil.copytree(ROOT, target, ignore=shutil.ignore_patterns(".git", "__pycache__", "tests", "*.json", "*.md"))
    return target


def run(folder, code=COUNT):
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)


def empty(folder):
    for base, _, names in os.walk(folder):
        for name in names:
            os.remove(os.path.join(base, name))


@pytest.mark.parametrize("state", ["no files", "only a cache", "no pipeline", "no library"])
def test_other_queries_survive(copy, state):
    optional = copy / "terrasift" / "llm"
    if not optional.exists():
        pytest.skip("the optional part is not here")
    if state in ("no files", "only a cache"):
        empty(optional)
        os.remove(copy / "corpus_pipeline.py")
    if state == "only a cache":
        (optional / "__pycache__").mkdir(exist_ok=True)
        (optional / "__pycache__" / "catalog.cpython-313.pyc").write_bytes(b"stale")
    if state == "no pipeline":
        os.remove(copy / "corpus_pipeline.py")
    code = COUNT if state != "no library" else "import sys; sys.modules['xxhash'] = None; " + COUNT
    done = run(copy, code)
    assert done.returncode == 0, done.stderr
    number, pipeline, subset = done.stdout.split()
    assert int(number) > 100 and pipeline == "False" and subset == "True"


def test_errors_inside_are_not_hidden(copy):
    optional = copy / "terrasift" / "llm"
    if not optional.exists():
        pytest.skip("the optional part is not here")
    (optional / "catalog.py").write_text("import terrasift.no_such_module\n")
    done = run(copy)
    assert done.returncode != 0 and "no_such_module" in done.stderr
