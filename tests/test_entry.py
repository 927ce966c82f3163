"""The entry works without the optional folders, and only their absence is forgiven."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(folder, code):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120,
                          env={**os.environ, "PYTHONPATH": str(folder)})


def copy(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    return tmp_path / "repo"


def test_without_the_optional_folders(tmp_path):
    done = run(copy(tmp_path), "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())")
    assert done.returncode == 0, done.stderr
    count, there = done.stdout.split()
    assert int(count) > 60 and there == "False"


def test_other_import_errors_are_not_hidden(tmp_path):
    folder = copy(tmp_path)
    (folder / "corpus_pipeline.py").write_text("import no_such_module\n")
    done = run(folder, "import __spark_entry__")
    assert done.returncode != 0 and "no_such_module" in done.stderr
