import os
import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent


def test_the_rest_works_without_the_training_data_package(tmp_path):
    shutil.copytree(REPO / "veilspan", tmp_path / "veilspan", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 30 and set(e.oracle_sql()) <= set(q); assert not [k for k in q if k.startswith('op') and k[2].isdigit()]"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


def test_nothing_else_imports_the_training_data_package():
    for p in (REPO / "veilspan").rglob("*.py"):
        if "llm" not in p.relative_to(REPO / "veilspan").parts:
            assert "veilspan.llm" not in p.read_text()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
