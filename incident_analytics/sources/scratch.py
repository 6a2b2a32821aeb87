"""Where intermediate copies go."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder that ``spark.checkpoint.dir`` names.

    Without that setting it is the folder given to `SparkContext.setCheckpointDir`; without both
    it is an error, since a folder of the driver's machine is out of the executors' reach.
    Copies stay until their folder is cleared, because plans read them when they run.
    """
    shared = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
