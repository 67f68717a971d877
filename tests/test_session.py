"""Checkpoint folder rules: configured folder wins; a cluster session without one is an error."""

import pytest

from partflow.session import checkpoint_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _SC:
    def __init__(self, master, current=None):
        self.master, self.current, self.set_to = master, current, None

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, d):
        self.set_to = d
        self.current = d


class _Spark:
    def __init__(self, master, conf_value=None, current=None):
        self.sparkContext = _SC(master, current)
        self.conf = _Conf(conf_value)


def test_cluster_without_checkpoint_dir_raises():
    with pytest.raises(ValueError):
        checkpoint_dir(_Spark("yarn"))


def test_configured_dir_is_used():
    s = _Spark("yarn", conf_value="hdfs:///shared/ckpt")
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt" and s.sparkContext.set_to == "hdfs:///shared/ckpt"


def test_existing_dir_is_kept():
    s = _Spark("k8s://x", current="s3a://bucket/ckpt/")
    assert checkpoint_dir(s) == "s3a://bucket/ckpt" and s.sparkContext.set_to is None


def test_local_session_gets_a_temp_folder():
    s = _Spark("local[2]")
    assert checkpoint_dir(s).startswith("/") and s.sparkContext.set_to
