"""The driver's contract, with and without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent


def test_entry(spark):
    assert entry.entry(spark).count() == 27
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_rest_stands_alone(tmp_path):
    for name in ("millrace", "__spark_entry__.py"):
        (shutil.copytree if (ROOT / name).is_dir() else shutil.copy)(ROOT / name, tmp_path / name)
    shutil.rmtree(tmp_path / "millrace" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'claim_next' in q and not [n for n in q if n.startswith('op')]; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
    (tmp_path / "millrace" / "llm").mkdir()
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
