"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, through Spark's own reader (the path may be remote)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Only where it is unset and driver and
    executors are one process (tests, notebooks) a temporary folder of this machine; on a
    cluster each executor would write to its own disk, so that raises."""
    at = spark.sparkContext._jsc.sc().getCheckpointDir()
    if at.isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="foliant-ckpt-"))
        at = spark.sparkContext._jsc.sc().getCheckpointDir()
    return spark.conf.get("spark.checkpoint.dir", None) or at.get()


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Spark deletes the files with the frame if spark.cleaner.referenceTracking.cleanCheckpoints
    is on.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Cut lineage with a compressed Parquet table in the shared folder, a fraction of a
    checkpoint's size. The folder's owner deletes the tables."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file systems."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Scratch:
    """Written tables of one operator that go when they are no longer needed."""

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, {}

    def write(self, df: DataFrame) -> DataFrame:
        """``written``; then the files of the shuffles behind it may go, which Spark removes
        once the driver has collected their objects."""
        path = f"{shared_folder(self._spark)}/table-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        out = self._spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = (out, path)
        self._spark._jvm.System.gc()
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            removed(self._spark, self._paths.pop(id(t))[1])

    def keep(self, table: DataFrame) -> DataFrame:
        """Drop all but this table, which the caller's result reads."""
        self._paths.pop(id(table))
        self.drop(*(t for t, _ in list(self._paths.values())))
        return table


def bytes_of(column: str) -> F.Column:
    """Text as UTF-8 bytes; null is empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))
