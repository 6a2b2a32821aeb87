"""What driver and executors share: a folder, and this package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]


def ship(spark: SparkSession) -> None:
    """Sends this package to the workers, once for each context; every operator with Python on the executors begins so.

    Executors need neither the package nor the driver's folders: Spark hands the archive out.
    """
    context = spark.sparkContext
    if getattr(context, "_shipped", None) == str(_PACKAGE):
        return
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp()), f"{_PACKAGE.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(_PACKAGE.rglob("*.py")):
            out.write(path, path.relative_to(_PACKAGE.parent))
    context.addPyFile(archive)
    context._shipped = str(_PACKAGE)


def cut(df: DataFrame) -> DataFrame:
    """`df` computed once and read again from the folder named by spark.checkpoint.dir.

    The copy outlives lost executors. Where neither that setting nor the context names a folder, the
    job stops: a folder of one machine would be missing on the others.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder:
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(folder)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """`df` written once as Parquet to a new folder below spark.checkpoint.dir, and read from there."""
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None) or df.sparkSession.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    path = f"{folder.rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
