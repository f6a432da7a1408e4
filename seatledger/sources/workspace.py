"""Where jobs may put files: the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def workspace(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder set in ``spark.checkpoint.dir``.

    Only a local session may do without the setting; a cluster must name a
    folder all its machines see.
    """
    base = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder shared by the cluster")
        base = tempfile.gettempdir() + "/seatledger"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
