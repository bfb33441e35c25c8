"""The driver contract without the optional text operators."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
SCRIPT = """
import __spark_entry__ as contract
from logloom.registry.oracles import ORACLES
from logloom.registry.queries import QUERIES
assert set(contract.queries()) == set(QUERIES) and set(contract.oracle_sql()) == set(ORACLES)
"""


def copied(target, *left_out):
    shutil.copytree(REPO / "logloom", target / "logloom", ignore=shutil.ignore_patterns("__pycache__", *left_out))
    shutil.copy(REPO / "__spark_entry__.py", target)
    return target


def run(folder, script):
    return subprocess.run([sys.executable, "-c", script], cwd=folder, capture_output=True, text=True)


def test_entry_works_without_the_optional_package(tmp_path):
    done = run(copied(tmp_path, "llm"), SCRIPT)
    assert done.returncode == 0, done.stderr


def test_other_import_errors_are_not_hidden(tmp_path):
    folder = copied(tmp_path, "llm")
    (folder / "corpus_pipeline.py").write_text("import no_such_library\n")
    done = run(folder, "import __spark_entry__")
    assert done.returncode != 0 and "no_such_library" in done.stderr


def test_nothing_else_imports_the_optional_package():
    for file in (REPO / "logloom").rglob("*.py"):
        if "llm" not in file.parts:
            assert "logloom.llm" not in file.read_text(), file
