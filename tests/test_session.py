"""Checkpoint folders: a scratch folder only where all executors are this process."""

from types import SimpleNamespace

import pytest

from tradescope.session import ensure_checkpoint_dir, is_local


def session(master, folder=None):
    seen = []
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: None,
        getConf=lambda: SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default),
        setCheckpointDir=seen.append,
    )
    return SimpleNamespace(sparkContext=context), seen


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"])
def test_cluster_without_folder_is_an_error(master):
    assert not is_local(master)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session(master)[0])


def test_cluster_folder_and_local_scratch():
    spark, seen = session("yarn", "hdfs:///shared")
    assert ensure_checkpoint_dir(spark) == "hdfs:///shared" and seen == ["hdfs:///shared"]
    spark, seen = session("local[4]")
    assert ensure_checkpoint_dir(spark) == seen[0]
