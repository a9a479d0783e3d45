"""The shared folder of a session that names none."""

import os
import time

import pytest
from pyspark.sql import functions as F

from barloom import session
from barloom.sources import tables


class Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class Fake:
    """A session without the setting; a real one here always has it from the machine's defaults."""

    def __init__(self, master, named=None):
        self.conf, self.sparkContext, self.master, self.applicationId = Conf(), self, master, f"app-{id(self)}"
        self.named = named

    def getConf(self):
        return Conf({"spark.checkpoint.dir": self.named} if self.named else {})


def test_local_sessions_keep_one_temporary_folder():
    one, other = Fake("local[2]"), Fake("local[2]")
    assert session.shared_folder(one) == session.shared_folder(one) != session.shared_folder(other)
    assert os.path.isdir(os.path.dirname(session.shared_folder(one)))


def test_clusters_must_name_one():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_folder(Fake(master))
    assert session.shared_folder(Fake("yarn", "hdfs://x/shared/")) .startswith("hdfs://x/shared/barloom-app-")


def test_clean_deletes_what_was_staged(spark, monkeypatch):
    kept = session.shared_folder(spark)
    frame = tables.stage(spark.range(3), "kept")
    assert frame.count() == 3 and kept in frame.inputFiles()[0]
    # the folder of the test session is still read by other tests, so one below it is cleaned
    monkeypatch.setattr(session, "shared_folder", lambda s: f"{kept}/part")
    spark.range(2).write.parquet(f"{kept}/part/x")
    session.clean(spark)
    assert frame.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{kept}/part/x")


def test_staging_leaves_no_shuffle_files(spark):
    folders = [str(f) for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def files():
        return {f for folder in folders for _, _, names in os.walk(folder) for f in names if f.startswith("shuffle_")}

    before = files()
    frame = tables.stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "dealt")
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and frame.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
