"""The library without its training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_everything_else_works_without_them(tmp_path):
    """Both folders and the pipeline deleted: all other modules import, and the entry has the other queries."""
    for name in ("tidemark", "tests", "__spark_entry__.py", "bench.py"):
        copy = shutil.copytree if os.path.isdir(f"{ROOT}/{name}") else shutil.copy
        copy(f"{ROOT}/{name}", f"{tmp_path}/{name}")
    shutil.rmtree(tmp_path / "tidemark/llm")
    shutil.rmtree(tmp_path / "tests/llm")
    code = """
import importlib, pkgutil, tidemark, __spark_entry__ as e
names = [m.name for m in pkgutil.walk_packages(tidemark.__path__, "tidemark.")]
for n in [*names, "bench", "tests.test_queries", "tests.test_semantics", "tests.test_streaming"]:
    importlib.import_module(n)
q = e.queries()
assert "attribute_last_touch" in q and not [n for n in q if n.startswith("op") or n == "pipeline"], q
assert set(e.oracle_sql()) <= set(q) and not e.HAS_LLM
print(len(names), len(q))
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    names, queries = map(int, done.stdout.split())
    assert names > 15 and queries > 40


def test_nothing_else_imports_them():
    for top, _, files in os.walk(f"{ROOT}/tidemark"):
        for f in files:
            if f.endswith(".py") and "/llm" not in top:
                with open(f"{top}/{f}") as text:
                    assert "llm" not in text.read(), f
