import os

import pytest

from clickloom import session as Se


class _Context:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d

    def getConf(self):
        return {}


class _Session:
    def __init__(self, master):
        self.sparkContext = _Context(master)
        self.conf = self

    def get(self, key):
        raise KeyError(key)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://https://host", "local-cluster[2,1,1024]"])
def test_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        Se.checkpoint_dir(_Session(master))


def test_local_master_gets_a_scratch_folder():
    assert os.path.isdir(Se.checkpoint_dir(_Session("local[2]")))


def _exists(spark, path):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def test_scope_deletes_its_tables_only(spark):
    outer = Se.cut_lineage(spark.range(3))
    noted = Se._SCRATCH[spark.sparkContext.applicationId]
    first = noted[-1]
    with Se.scratch_scope(spark):
        Se.cut_lineage(spark.range(4))
        inner = noted[-1]
        assert inner != first and _exists(spark, inner)
    assert not _exists(spark, inner) and _exists(spark, first) and outer.count() == 3
