"""Session settings the operators are written for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # the work per byte is high here (windows, parsing), so small shuffles are not merged down to one task
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "barloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` overrides them (dots as double underscores)."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_TEMPORARY: dict[str, str] = {}  # by application, since the setting cannot be changed in a running session


def shared_folder(spark: SparkSession) -> str:
    """This application's folder in the one that every executor can reach, which ``spark.checkpoint.dir`` names.

    Staged tables stay there until :func:`clean`. Only a local session, whose executors are this machine, may name none: then a new temporary folder is taken and kept for the rest
    of the session. On a cluster such a folder would lose rows, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("name a folder that every executor can reach in spark.checkpoint.dir")
        application = spark.sparkContext.applicationId
        if application not in _TEMPORARY:
            _TEMPORARY[application] = tempfile.mkdtemp(prefix="barloom-")
        named = _TEMPORARY[application]
    return f"{named.rstrip('/')}/barloom-{spark.sparkContext.applicationId}"


def clean(spark: SparkSession) -> None:
    """Delete what this application has staged. Frames that still read it fail afterwards, so call it when their results are written."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
