"""The driver contract with and without the optional folders."""

import json
import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def names(folder):
    done = subprocess.run([sys.executable, "-c", NAMES], cwd=folder, capture_output=True, text=True, check=True)
    return json.loads(done.stdout.splitlines()[-1])


@pytest.mark.parametrize("pipeline,leftover", [(True, False), (False, False), (False, True)])
def test_entry_without_the_training_data_folders(tmp_path, pipeline, leftover):
    skipped = shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, tmp_path / "copy", ignore=skipped)
    if leftover:
        (tmp_path / "copy/verdin/llm/__pycache__").mkdir(parents=True)
    found, twins = names(tmp_path / "copy")
    assert found and set(twins) <= set(found)
    assert not any(name == "pipeline" or name.startswith("op") and name[2].isdigit() for name in found)
    if os.path.isdir(os.path.join(ROOT, "verdin", "llm")):
        every, _ = names(ROOT)
        extra = set(every) - set(found)
        assert "pipeline" in extra and all(name == "pipeline" or name.startswith("op") for name in extra)
