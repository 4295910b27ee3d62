"""The contract module without the optional corpus subpackage."""
import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAY = "import __spark_entry__ as e; print('NAMES', *e.queries()); print('SQL', *e.oracle_sql())"


def names(root):
    out = subprocess.run([sys.executable, "-B", "-c", SAY], cwd=root, capture_output=True, text=True,
                         env=os.environ | {"PYTHONPATH": root})
    return out.returncode, out.stdout, out.stderr


@pytest.fixture
def copy(tmp_path):
    root = tmp_path / "repo"
    root.mkdir()
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), root)
    shutil.copytree(os.path.join(ROOT, "monthly_facts"), root / "monthly_facts", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    return root


def test_without_the_subpackage(copy):
    code, out, err = names(str(copy))
    assert code == 0, err
    assert "gold_rollup" in out and " op1_" not in out and "pipeline" not in out


def test_other_import_errors_are_not_hidden(copy):
    (copy / "monthly_facts" / "llm").mkdir()
    (copy / "monthly_facts" / "llm" / "__init__.py").write_text("")
    (copy / "monthly_facts" / "llm" / "queries.py").write_text("import no_such_library\n")
    (copy / "corpus_pipeline.py").write_text("")
    code, _, err = names(str(copy))
    assert code != 0 and "no_such_library" in err


def test_nothing_else_imports_the_subpackage():
    for folder, _, files in os.walk(os.path.join(ROOT, "monthly_facts")):
        if os.sep + "llm" in folder:
            continue
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(folder, f)) as text:
                    assert "monthly_facts.llm" not in text.read(), f
