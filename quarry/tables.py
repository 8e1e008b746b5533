"""Materialised intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the warehouse
    where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    path = f"{scratch_root(spark)}/quarry-{uuid.uuid4().hex}-{tag}"
    if not _made:
        atexit.register(_clean)
    _made.append((spark, path))
    return path


def drop_scratch(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _clean() -> None:
    for spark, path in _made:
        try:
            drop_scratch(spark, path)
        except Exception:  # the session has ended; the shared folder's owner cleans up
            return


class Table:
    """A materialised intermediate: ``df`` reads it, ``drop()`` frees its disk.

    Writing Parquet to the shared folder cuts lineage, so a lost executor costs
    the running stage only, never the stages before the table.
    """

    def __init__(self, df: DataFrame, tag: str, partition_by: tuple[str, ...] = ()):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, tag)
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        drop_scratch(self.spark, self.path)
