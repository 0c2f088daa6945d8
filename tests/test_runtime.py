"""Where intermediate tables are written."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from sheetspark import runtime


def test_the_configured_folder_is_used(spark):
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert runtime.shared_dir(spark) == folder
    assert runtime.fresh_path(spark, "x").startswith(folder + "/x-")
    assert runtime.fresh_path(spark, "x") != runtime.fresh_path(spark, "x")
    runtime.ensure_checkpoints(spark)
    assert folder in spark.sparkContext._jsc.sc().getCheckpointDir().get()


def _session(master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_a_cluster_must_name_its_folder():
    with pytest.raises(RuntimeError):
        runtime.shared_dir(_session("spark://host:7077"))
    assert runtime.shared_dir(_session("local[2]")) == runtime.shared_dir(_session("local[2]"))
