"""The shared folder for checkpoints and intermediate tables."""

import tempfile

from pyspark.sql import SparkSession

_LOCAL = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.

    Where none is named, a temporary one is made, but only for a local master:
    on a cluster every executor would write to a disk of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="tillwright-")
    return _LOCAL[app]
