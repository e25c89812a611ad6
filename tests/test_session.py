"""Scratch-location rules: the session's checkpoint folder, never a local
temp folder on a cluster; cluster defaults applied only off local mode."""

import pytest

from eventrollup import session as S


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, ckpt=None):
        self.master = master
        self.ckpt = ckpt

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, d):
        self.ckpt = d


class _Session:
    def __init__(self, master, conf=None, ckpt=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master, ckpt)


def test_work_dir_under_configured_checkpoint_dir():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt"})
    d = S.work_dir(s, "batch-view")
    assert d.startswith("hdfs://nn/shared/ckpt/eventrollup/batch-view-")
    assert d != S.work_dir(s, "batch-view")  # a fresh folder per call


def test_context_checkpoint_dir_is_used():
    s = _Session("k8s://x", ckpt="s3a://bucket/ckpt")
    assert S.work_dir(s, "v").startswith("s3a://bucket/ckpt/eventrollup/v-")


def test_cluster_without_checkpoint_dir_fails():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.work_dir(_Session("yarn"), "v")


def test_local_without_checkpoint_dir_gets_private_folder():
    s = _Session("local[2]")
    d = S.work_dir(s, "v")
    assert s.sparkContext.ckpt and d.startswith(s.sparkContext.ckpt)


def test_cluster_conf_keeps_library_settings():
    assert S.CLUSTER_CONF["spark.sql.shuffle.partitions"] == "8000"
    assert not set(S.CLUSTER_CONF) & {"spark.sql.session.timeZone", "spark.checkpoint.dir"}
