"""Without the training-data operators the rest must still import."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

TOP = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("more", [[], ["corpus_pipeline.py"]])
def test_entry_without_llm(tmp_path, more):
    shutil.copytree(TOP / "strandforge", tmp_path / "strandforge", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for f in ["__spark_entry__.py", *more]:
        if (TOP / f).exists():
            shutil.copy(TOP / f, tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 30 and not any(k.startswith('op') for k in q) and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_nothing_else_uses_llm():
    for f in (TOP / "strandforge").rglob("*.py"):
        if "llm" not in f.parts:
            assert "llm" not in f.read_text(encoding="utf-8")
