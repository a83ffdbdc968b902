"""The optional operators may be deleted: the rest still imports and registers."""

import shutil
import subprocess
import sys

import pytest

from conftest import ROOT

SHOW = "import __spark_entry__ as E; print(len(E.queries()), [k for k in E.queries() if k[:2] == 'op' and k[2].isdigit() or k == 'pipeline'])"


@pytest.mark.parametrize("pipeline_stays", [True, False])
def test_entry_without_the_optional_operators(tmp_path, pipeline_stays):
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", "*.json", *([] if pipeline_stays else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, tmp_path / "copy", ignore=skip)
    out = subprocess.run([sys.executable, "-c", SHOW], cwd=tmp_path / "copy", capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    n, optional = out.stdout.strip().split(" ", 1)
    assert int(n) > 150 and optional == "[]"
