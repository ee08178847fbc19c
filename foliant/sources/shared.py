"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Only where it is unset and driver and
    executors are one process a temporary folder of this machine; on a cluster that raises."""
    at = spark.sparkContext._jsc.sc().getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if at.isEmpty():
        if named is None and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="foliant-"))
        at = spark.sparkContext._jsc.sc().getCheckpointDir()
    return named or at.get()


def durable(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept by a reliable checkpoint: what is built on them neither
    computes them again nor depends on an executor that may be lost."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
