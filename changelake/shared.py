"""Folders that the driver and every executor see."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a session on one machine (tests) gets a folder of its own; a cluster gets an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="changelake-")
    return _LOCAL[app]
