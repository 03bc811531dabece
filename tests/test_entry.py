"""The entry with and without its optional part."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
OPTIONAL = ("weft/llm", "tests/llm", "corpus_pipeline.py")


@pytest.mark.parametrize("gone", [OPTIONAL, OPTIONAL[:2], OPTIONAL[:1], OPTIONAL[2:]], ids=len)
def test_the_rest_imports_without_the_optional_part(tmp_path, gone):
    for part in ("weft", "tests", "__spark_entry__.py", "corpus_pipeline.py", "bench.py"):
        source = ROOT / part
        if source.is_dir():
            shutil.copytree(source, tmp_path / part, ignore=shutil.ignore_patterns("__pycache__", *(["llm"] if f"{part}/llm" in gone else [])))
        elif source.exists() and part not in gone:
            shutil.copy(source, tmp_path / part)
    code = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ""}, timeout=120)
    assert run.returncode == 0, run.stderr
    names = run.stdout.split()
    assert "gap_sessions" in names and "pipeline" not in names
    assert any(n.startswith("op1_") for n in names) == ((tmp_path / "weft/llm").exists())
