"""Session helpers: input-sized cluster settings and the shared checkpoint folder."""

import pytest

from transitlens.session import checkpoint_dir, cluster_conf


def test_cluster_conf_sizes_and_caps_partitions():
    small = cluster_conf(10 * 1024**3)                # 10 GB -> 80 partitions of 128 MB
    assert small["spark.sql.shuffle.partitions"] == "80"
    huge = cluster_conf(100 * 1024**4)                # 100 TB -> capped
    assert huge["spark.sql.shuffle.partitions"] == "200000"
    assert cluster_conf(1)["spark.sql.shuffle.partitions"] == "8"   # at least 2 x cores


class _Conf(dict):
    def get(self, k, default=None):
        return dict.get(self, k, default)

    def set(self, k, v):
        self[k] = v


class _Ctx:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, d):
        pass


class _Session:
    def __init__(self, master):
        self.conf = _Conf()
        self.sparkContext = _Ctx(master)


def test_cluster_session_without_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError, match="shared"):
        checkpoint_dir(_Session("yarn"))


def test_local_session_gets_a_scratch_checkpoint_dir():
    s = _Session("local[2]")
    d = checkpoint_dir(s)
    assert d and s.conf.get("spark.checkpoint.dir") == d
