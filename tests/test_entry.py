"""The entry point with and without its removable part."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_works_without_the_text_operators(tmp_path):
    drop = shutil.ignore_patterns("llm", "__pycache__")
    for name in ("wattline", "harness"):
        shutil.copytree(f"{ROOT}/{name}", tmp_path / name, ignore=drop)
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = (
        "import __spark_entry__ as e; q = e.queries(); "
        "assert 'five_minute_rollup' in q and 'pipeline' not in q; "
        "assert set(q) == set(e.oracle_sql())"
    )
    env = os.environ | {"PYTHONPATH": ""}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=120)


def test_nothing_else_imports_the_text_operators():
    for folder, _, files in os.walk(ROOT):
        if "/llm" in folder or "/.git" in folder:
            continue
        for name in files:
            if name.endswith(".py") and name not in ("__spark_entry__.py", "corpus_pipeline.py", "test_entry.py"):
                with open(f"{folder}/{name}") as f:
                    assert "wattline.llm" not in f.read(), f"{folder}/{name}"
