"""Workspaces: what operators write inside is gone afterwards, what is kept outside stays."""

from pathlib import Path

import pytest

from tidespan.sources import scratch


def test_tables_of_a_workspace_are_removed(spark):
    with scratch.workspace(spark) as home:
        inner = scratch.settle(spark.range(5))
        kept = scratch.settle(inner.selectExpr("id + 1 AS id"), outside=True)
        with scratch.workspace(spark) as deeper:
            again = scratch.settle(inner)
            assert again.count() == 5 and again.tidespan_path.startswith(deeper)
        assert not Path(deeper.removeprefix("file:")).exists() and inner.count() == 5
        assert inner.tidespan_path.startswith(home)
    assert not Path(home.removeprefix("file:")).exists()
    assert kept.count() == 5
    scratch.release(kept.tidespan_path)
    assert not Path(kept.tidespan_path.removeprefix("file:")).exists()


def test_it_is_closed_after_an_error(spark):
    with pytest.raises(RuntimeError), scratch.workspace(spark) as home:
        scratch.settle(spark.range(1))
        raise RuntimeError
    assert not Path(home).exists() and not scratch._open


def test_a_local_folder_is_no_fallback_on_a_cluster(spark, monkeypatch):
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://somewhere"

    with pytest.raises(ValueError, match="share"):
        scratch.scratch_dir(Cluster, "table")
