"""The entry points, with and without the training-data operators, and the shared folder."""

import os
import shutil
import subprocess
import sys
from types import SimpleNamespace

import pytest

from kerbsight.operators import scratch

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("keep_pipeline", [True, False])
def test_without_the_training_data_operators(tmp_path, keep_pipeline):
    for name in ("kerbsight", "__spark_entry__.py", *["corpus_pipeline.py"] * keep_pipeline):
        copy = shutil.copytree if os.path.isdir(f"{ROOT}/{name}") else shutil.copy
        if os.path.exists(f"{ROOT}/{name}"):
            copy(f"{ROOT}/{name}", tmp_path / name)
    shutil.rmtree(tmp_path / "kerbsight/llm", ignore_errors=True)
    code = "import __spark_entry__ as e, pkgutil, importlib, kerbsight; [importlib.import_module(m.name) for m in pkgutil.walk_packages(kerbsight.__path__, 'kerbsight.')]; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q) and len(q) > 50; print(*q)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True, check=True).stdout.split()
    assert "pipeline" not in out and not any(x.startswith("op") and x[2:3].isdigit() for x in out)


def test_errors_inside_a_part_are_not_hidden(monkeypatch, tmp_path):
    import __spark_entry__ as entry

    (tmp_path / "broken_part.py").write_text("import no_such_module_at_all")
    monkeypatch.syspath_prepend(str(tmp_path))
    with pytest.raises(ModuleNotFoundError):
        entry._optional("broken_part")
    assert entry._optional("no_such_module_at_all") is None


def test_no_private_folder_on_a_cluster():
    jvm = SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False)))
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="yarn", _jsc=jvm))
    with pytest.raises(RuntimeError, match="share"):
        scratch.scratch_dir(session)


def test_written_tables_are_dropped(spark):
    import glob

    folder = scratch.scratch_dir(spark).removeprefix("file://").removeprefix("file:")
    before = set(glob.glob(f"{folder}/*"))
    with pytest.raises(ZeroDivisionError), scratch.dropped_after(spark):
        one = scratch.written(spark.range(5), "one")
        with scratch.dropped_after(spark):
            two = scratch.written(one.where("id > 2"), "two")
            assert two.count() == 2
        assert one.count() == 5 and len(set(glob.glob(f"{folder}/*")) - before) == 1
        raise ZeroDivisionError
    assert set(glob.glob(f"{folder}/*")) == before
    kept = scratch.written(spark.range(3), "kept")
    assert kept.count() == 3
