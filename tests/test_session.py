from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from gridloom.operators.ordered import running_total
from gridloom.session import fresh_path, scratch, shared_folder
from gridloom.sources.store import materialize_once, remove_superseded


class Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class Session:
    def __init__(self, values):
        self.conf = Conf(values)


def test_the_folder_named_by_the_cluster_is_used():
    session = Session({"spark.checkpoint.dir": "hdfs://shared/checkpoints/"})
    assert shared_folder(session) == "hdfs://shared/checkpoints"
    assert fresh_path(session, "x").startswith("hdfs://shared/checkpoints/gridloom/x-")


def test_a_folder_of_our_own_is_set_once(spark):
    first = shared_folder(spark)
    assert shared_folder(spark) == first
    assert fresh_path(spark, "a") != fresh_path(spark, "a")


def test_entry_without_the_corpus_folders(tmp_path):
    """The corpus operators may be deleted with their tests: all other queries and their oracles are still there."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = shutil.copytree(root, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    script = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), len(o), sorted(n for n in q if n.startswith('op') and n[2].isdigit() or n == 'pipeline'))"
    for gone in ([], ["corpus_pipeline.py"]):
        for name in gone:
            os.rename(copy / name, tmp_path / name)
        out = subprocess.run([sys.executable, "-c", script], cwd=copy, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ""}, check=True).stdout.split(maxsplit=2)
        assert int(out[0]) > 130 and int(out[1]) > 130 and out[2].strip() == "[]"


def _left(spark):
    """Folders of runs under the shared folder."""
    root = shared_folder(spark).removeprefix("file://") + "/gridloom"
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_a_scope_leaves_nothing_behind(spark, monkeypatch):
    from gridloom.operators import ordered

    monkeypatch.setattr(ordered, "ROWS_PER_BLOCK", 20)
    rows = spark.range(300).select((F.col("id") % 2).alias("k"), "id", F.lit(1).alias("one"))
    before = _left(spark)
    with scratch(spark) as outer:
        with scratch(spark) as inner:
            assert inner.startswith(outer)
            got = running_total(rows, ["k"], ["id"], "one", None, "n").agg(F.max("n").alias("n")).first().n
            folder = inner.removeprefix("file://")
            assert os.listdir(folder)
        assert not os.path.exists(folder) and got == 150
        spark.range(3).write.parquet(fresh_path(spark, "still-open"))
        assert os.listdir(outer.removeprefix("file://"))
    assert _left(spark) == before
    with pytest.raises(ZeroDivisionError):
        with scratch(spark):
            spark.range(3).write.parquet(fresh_path(spark, "x"))
            raise ZeroDivisionError
    with scratch(spark):
        pass
    assert _left(spark) == before
    assert not fresh_path(spark, "x").startswith(outer)


def test_superseded_builds_are_removed(spark, tmp_path):
    root = f"file://{tmp_path}/datasets"
    for n in (1, 2, 3):
        materialize_once(spark, "numbers", lambda n=n: spark.range(n), root=root, rebuild=True)
    with pytest.raises(ZeroDivisionError):
        materialize_once(spark, "numbers", lambda: 1 / 0, root=root, rebuild=True)
    assert remove_superseded(spark, "numbers", root) == 2 and remove_superseded(spark, "numbers", root) == 0
    assert remove_superseded(spark, "never built", root) == 0
    assert materialize_once(spark, "numbers", lambda: spark.range(9), root=root).count() == 3
    assert len(os.listdir(tmp_path / "datasets" / "data" / "numbers")) == 1
