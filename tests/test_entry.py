import importlib.util
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent


def test_entry(spark, sf_dir):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 40


def test_import_needs_no_session_nor_optional_parts(tmp_path):
    """A copy without the optional subpackage still imports and lists its queries."""
    import shutil

    shutil.copytree(REPO / "siltstone", tmp_path / "siltstone", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') or k == 'pipeline' for k in e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 40 and out[1] == "False" and int(out[2]) > 35
    assert importlib.util.find_spec("siltstone")


def test_nothing_else_imports_the_optional_subpackage():
    for path in (REPO / "siltstone").rglob("*.py"):
        if "llm" not in path.parts:
            assert ".llm" not in path.read_text(encoding="utf-8"), path
