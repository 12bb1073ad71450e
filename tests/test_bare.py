"""The library works without its optional subpackage."""

import os
import re
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_nothing_else_imports_the_subpackage():
    for folder, _, names in os.walk(os.path.join(ROOT, "logtide")):
        for name in names:
            if name.endswith(".py") and os.path.basename(folder) != "llm":
                assert not re.search(r"logtide\.llm|from \.+llm", open(os.path.join(folder, name)).read()), name


def test_entry_without_the_subpackage(tmp_path):
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    shutil.copytree(os.path.join(ROOT, "logtide"), tmp_path / "logtide", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not any(n.startswith('op') for n in q), q; assert set(e.oracle_sql()) <= set(q)"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env).returncode == 0
