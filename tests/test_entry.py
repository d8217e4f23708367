"""The entry with and without its optional part."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.abspath(entry.__file__))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), any(q.startswith('op') for q in e.queries()))"


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _copy(folder, *without):
    skipped = shutil.ignore_patterns(".git", "__pycache__", "tests", *without)
    return shutil.copytree(ROOT, folder, ignore=skipped)


def test_without_the_corpus_operators(tmp_path):
    copy = _copy(tmp_path / "copy", "llm", "corpus_pipeline.py")
    done = subprocess.run([sys.executable, "-c", COUNT], cwd=copy, capture_output=True, text=True, check=True)
    count, some = done.stdout.split()
    assert int(count) > 60 and some == "False"


@pytest.mark.skipif(not os.path.isdir(f"{ROOT}/tickertone/llm"), reason="an optional part")
def test_errors_in_the_corpus_operators_are_not_hidden(tmp_path):
    copy = _copy(tmp_path / "copy")
    with open(f"{copy}/tickertone/llm/catalog.py", "a") as f:
        f.write("\nimport no_such_module\n")
    done = subprocess.run([sys.executable, "-c", COUNT], cwd=copy, capture_output=True, text=True)
    assert done.returncode != 0 and "no_such_module" in done.stderr
