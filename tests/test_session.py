from __future__ import annotations

from types import SimpleNamespace

import pytest

from tillflow.session import shared_folder


def on_cluster(spark, folder: str | None):
    """A session as a cluster's driver has it, with ``spark.checkpoint.dir`` set to the folder."""
    real = spark.sparkContext
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, _jvm=real._jvm, _jsc=real._jsc)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: folder))


def test_path_without_scheme_lies_on_the_default_file_system(spark):
    assert shared_folder(on_cluster(spark, "/tmp/checkpoints/")) == "file:/tmp/checkpoints"


def test_uri_stays_as_it_is(spark):
    assert shared_folder(on_cluster(spark, "hdfs://name/kept/")) == "hdfs://name/kept"


def test_cluster_needs_the_setting(spark):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(on_cluster(spark, None))
