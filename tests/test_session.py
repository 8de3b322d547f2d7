"""Checkpoint folder policy: shared folder from the session; never invented on a cluster."""

import pytest

from tablestream.session import checkpoint_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default

    def set(self, key, value):
        self.value = value


class _Ctx:
    def __init__(self, master, ckpt=None):
        self.master, self.ckpt = master, ckpt

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, d):
        self.ckpt = d


class _Session:
    def __init__(self, master, conf_value=None):
        self.conf, self.sparkContext = _Conf(conf_value), _Ctx(master)


def test_cluster_without_shared_checkpoint_dir_is_refused():
    with pytest.raises(ValueError):
        checkpoint_dir(_Session("yarn"))


def test_configured_folder_is_used_as_is():
    s = _Session("yarn", "hdfs:///shared/ckpt")
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt" and s.sparkContext.ckpt == "hdfs:///shared/ckpt"


def test_local_session_gets_a_scratch_folder():
    s = _Session("local[2]")
    d = checkpoint_dir(s)
    assert d and s.conf.value == d
