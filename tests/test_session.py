import os
from types import SimpleNamespace

import pytest

from sensorweave import session


def _unset(master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda p: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=context)


def test_a_cluster_needs_a_shared_folder():
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.checkpoint_dir(_unset(master))
    assert os.path.isdir(session.checkpoint_dir(_unset("local[4]")))


def test_scratch_tables_can_be_removed(spark):
    root = session.scratch_root(spark)
    kept = session.materialize(spark.range(10), "to-remove")
    assert kept.count() == 10 and kept.inputFiles()[0].split(":", 1)[1].lstrip("/").startswith(root.lstrip("/"))
    assert spark.sparkContext.applicationId in root
