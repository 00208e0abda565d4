"""The shared folder comes from the session; programs make a temporary one
only on a local master, never on a cluster."""

from __future__ import annotations

import pytest

from stationflow.session import ensure_shared_dir
from stationflow.sources.files import shared_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master = master
        self._conf = _Conf(conf)
        self.checkpoint_dir = None

    def getCheckpointDir(self):  # noqa: N802 (Spark's name)
        return self.checkpoint_dir

    def getConf(self):  # noqa: N802
        return self._conf

    def setCheckpointDir(self, path):  # noqa: N802
        self.checkpoint_dir = path


class _Session:
    def __init__(self, master, conf=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master, conf or {})


def test_cluster_without_setting_refuses_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session("spark://cluster:7077"))


def test_cluster_setting_is_used():
    assert shared_dir(_Session("yarn", {"spark.checkpoint.dir": "hdfs:///ckpt"})) == "hdfs:///ckpt"


def test_no_fallback_on_a_local_master_either():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session("local[4]"))


def test_programs_on_a_local_master_name_a_folder():
    assert "stationflow-" in shared_dir(ensure_shared_dir(_Session("local[4]")))
    for master in ("spark://cluster:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            shared_dir(ensure_shared_dir(_Session(master)))


def test_remote_session_uses_the_setting():
    class _Remote:
        conf = _Conf({"spark.checkpoint.dir": "hdfs:///shared/ckpt"})

        @property
        def sparkContext(self):  # noqa: N802
            raise RuntimeError("no SparkContext in a remote session")

    assert shared_dir(_Remote()) == "hdfs:///shared/ckpt"
