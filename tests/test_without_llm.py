"""The entry and the library work without the text operators."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_them(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "tests"))
    code = ("import sys, __spark_entry__ as e; names = set(e.queries()); "
            "assert names == set(e.oracle_sql()) and 'encode_lines' in names; "
            "assert not any(n.startswith('op') or n == 'pipeline' for n in names); "
            "assert not any(m.startswith('tsline.llm') for m in sys.modules)")
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True,
                          env={**os.environ, "PYTHONPATH": str(copy)})
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_them():
    for folder, _, files in os.walk(os.path.join(REPO, "tsline")):
        if os.path.basename(folder) != "llm":
            for name in files:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name)) as f:
                        assert "tsline.llm" not in f.read(), name


def test_entry_imports_where_a_library_of_theirs_is_missing():
    code = ("import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; "
            "assert 'encode_lines' in e.queries() and 'pipeline' not in e.queries()")
    done = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True,
                          env={**os.environ, "PYTHONPATH": REPO})
    assert done.returncode == 0, done.stderr
