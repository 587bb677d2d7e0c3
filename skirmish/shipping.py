"""What jobs with Python workers need: this package on the executors, and a folder that all share."""

from __future__ import annotations

import re
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for an application."""
    if spark.sparkContext.applicationId not in _shipped:
        top = Path(__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{top.name}", "zip", top.parent, top.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(spark.sparkContext.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a local one of our own only where that is unset and executors are
    threads of this process (tests). A cluster without a shared folder is an error."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not re.fullmatch(r"local(\[[0-9*, ]+\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="skirmish-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """df computed and written to the shared folder; its partitions, and the rows' order in them, stay."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
