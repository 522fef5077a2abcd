"""The entry imports without the optional subpackage, and only then."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _names(folder):
    code = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    env = dict(os.environ, PYTHONPATH=str(folder))
    return subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, timeout=120)


def _copy(tmp_path, *without):
    shutil.copytree(f"{ROOT}/wattlake", tmp_path / "wattlake", ignore=shutil.ignore_patterns(*without, "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    return tmp_path


def test_imports_without_the_subpackage(tmp_path):
    out = _names(_copy(tmp_path, "llm"))
    assert out.returncode == 0, out.stderr
    names = out.stdout.split()
    assert "gold_daily" in names and "pipeline" not in names and not any(n.startswith("op") for n in names)


def test_a_broken_import_is_not_hidden(tmp_path):
    folder = _copy(tmp_path, "llm")
    (folder / "wattlake" / "llm").mkdir()
    (folder / "wattlake" / "llm" / "__init__.py").write_text("")
    (folder / "wattlake" / "llm" / "queries.py").write_text("import no_such_library\n")
    out = _names(folder)
    assert out.returncode != 0 and "no_such_library" in out.stderr
