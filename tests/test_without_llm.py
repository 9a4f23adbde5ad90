"""The rest of the library doesn't need the training-data subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_it(tmp_path):
    shutil.copytree(os.path.join(ROOT, "signalloom"), tmp_path / "signalloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'route_fanout_counts' in q, [n for n in q if n.startswith('op') or n == 'pipeline'])"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": os.environ["PATH"], "HOME": str(tmp_path)}, capture_output=True, text=True)
    assert "True []" in said.stdout, said.stderr


def test_nothing_else_imports_it():
    for folder, _, names in os.walk(os.path.join(ROOT, "signalloom")):
        if os.path.basename(folder) != "llm":
            for n in names:
                if n.endswith(".py"):
                    with open(os.path.join(folder, n), encoding="utf-8") as f:
                        assert "signalloom.llm" not in f.read(), n
