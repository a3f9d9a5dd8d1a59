"""Staging folders: shared ones only, and nothing left behind."""

import os
from types import SimpleNamespace

import pytest

from promolens import session


class Settings(dict):
    def get(self, key, default=None):
        return super().get(key, default)


def fake(master, **settings):
    return SimpleNamespace(conf=Settings(settings), sparkContext=SimpleNamespace(master=master))


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.staging_root(fake(master))
    given = fake(master, **{"spark.checkpoint.dir": "hdfs://n/x/"})
    assert session.staging_root(given) == "hdfs://n/x"


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_one_process_may_use_a_folder_of_its_own(master):
    assert os.path.isdir(session.staging_root(fake(master)))


def test_staged_files_can_be_removed(spark):
    kept = session.stage(spark.range(5), "kept")
    gone = session.stage(spark.range(5), "gone")
    folder = gone.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    session.remove_staged(spark, gone)
    assert not os.path.exists(folder)
    assert kept.count() == 5


def test_other_files_are_not_removed(spark, tmp_path):
    path = str(tmp_path / "own")
    spark.range(3).write.parquet(path)
    session.remove_staged(spark, spark.read.parquet(path))
    assert spark.read.parquet(path).count() == 3


def test_the_feature_job_is_cut_into_small_parts(spark, monkeypatch):
    """Whatever the session's number of partitions; the setting is put back afterwards."""
    from datetime import date

    from promolens.plans import runs
    from promolens.session import SHUFFLE_PARTS
    from shop_data import tables

    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    seen = {}

    def staged(df, _):
        seen["parts"] = int(spark.conf.get(name))
        seen["size"] = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")

    monkeypatch.setattr(runs, "stage", staged)
    before = spark.conf.get(name, None)
    runs.build_features(tables(spark), date(2024, 3, 31))
    assert seen["parts"] >= SHUFFLE_PARTS
    assert seen["size"].lower() in ("16m", "16777216b")
    assert spark.conf.get(name, None) == before
