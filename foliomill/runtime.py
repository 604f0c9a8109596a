"""Session-level helpers: reading tables and writing intermediate results.

Intermediate tables go to the folder named by ``spark.checkpoint.dir``, which all executors of a cluster share; only
where that setting is absent and Spark runs in one process (tests, a laptop) is a folder of our own used.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables; also makes it Spark's checkpoint folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + os.path.join(tempfile.gettempdir(), "foliomill-checkpoints")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


_WRITTEN: list[str] = []


def fresh_path(spark: SparkSession, label: str) -> str:
    _WRITTEN.append(f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}")
    return _WRITTEN[-1]


def clear(spark: SparkSession) -> None:
    """Deletes what this process has written to the shared folder; results that read from it must have been stored before."""
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and a lost executor costs nothing."""
    path = fresh_path(df.sparkSession, label)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
