import os

import pytest

from passagework import session


class _Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master, folder=None):
        self.sparkContext = _Context(master)
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}


def test_a_cluster_must_name_its_shared_folder():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="checkpoint"):
            session.shared_folder(_Session(master))
        assert session.shared_folder(_Session(master, "hdfs:///x")) == "hdfs:///x"
    assert os.path.isdir(session.shared_folder(_Session("local[4]")))
    assert os.path.isdir(session.shared_folder(_Session("local")))


def test_written_files_can_be_removed(spark):
    session.remove_scratch(spark)
    stored = session.written(spark.range(10))
    path = stored.inputFiles()[0].removeprefix("file://")
    assert stored.count() == 10 and os.path.exists(path)
    assert session.remove_scratch(spark) == 1
    assert not os.path.exists(path)
