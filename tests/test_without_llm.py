"""The library on a copy without the training-data subpackage and its pipeline's stages."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

REPOSITORY = Path(__file__).resolve().parents[1]

SCRIPT = """
import __spark_entry__ as driver
names = set(driver.queries())
assert names and not any(name.startswith("op") or name == "pipeline" for name in names), names
assert set(driver.oracle_sql()) <= names
import chatloom.plans.prepare, chatloom.plans.dedup
"""


def copied(tmp_path, *left_out):
    ignored = shutil.ignore_patterns("__pycache__", ".git", *left_out)
    return Path(shutil.copytree(REPOSITORY, tmp_path / "copy", ignore=ignored))


def test_queries_without_the_subpackage(tmp_path):
    folder = copied(tmp_path, "llm")
    assert (folder / "corpus_pipeline.py").exists() == (REPOSITORY / "corpus_pipeline.py").exists()
    subprocess.run([sys.executable, "-c", SCRIPT], cwd=folder, check=True, timeout=120)


def test_queries_without_subpackage_and_pipeline(tmp_path):
    folder = copied(tmp_path, "llm", "corpus_pipeline.py")
    subprocess.run([sys.executable, "-c", SCRIPT], cwd=folder, check=True, timeout=120)
