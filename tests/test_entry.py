"""The entry without the optional training-data part."""

import pathlib
import re
import shutil
import subprocess
import sys

import pytest

TOP = pathlib.Path(__file__).resolve().parent.parent
ASK = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_without_the_optional_part(tmp_path, with_pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(TOP, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "*.json"))
    if not with_pipeline:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    done = subprocess.run([sys.executable, "-c", ASK], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    from geoloom.plans import catalog

    names, sql = (line.split() for line in done.stdout.splitlines())
    assert names == sorted(catalog.QUERIES) and sql == sorted(catalog.SQL)
    found = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"], cwd=copy, capture_output=True, text=True, timeout=120)
    assert found.returncode == 0, found.stdout


def test_nothing_else_imports_the_optional_part():
    for path in (TOP / "geoloom").rglob("*.py"):
        if "llm" not in path.parts:  # a word of its own
            assert not re.search(r"\bllm\b", path.read_text()), path
