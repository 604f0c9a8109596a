"""Sinks: append what is new, never change what is there, say when a result is complete."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.functions.hashing import digest
from foliomill.operators.ledger import least_rows


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def append_new(df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Append the rows whose key the table lacks, one of each key (the least by its other columns); returns them."""
    spark = df.sparkSession
    rows = least_rows(df, keys)
    if _exists(spark, path):
        rows = rows.join(spark.read.schema(df.schema).parquet(path).select(*keys), keys, "left_anti")
    rows.write.mode("append").parquet(path)
    return rows


def put_immutable(df: DataFrame, path: str, key: str, sha: str) -> DataFrame:
    """Append by key; a key with another hash, in the table or among the rows themselves, is an error, and nothing is
    written. Returns the conflicts (key, sha, held)."""
    spark = df.sparkSession
    seen = df.groupBy(key).agg(F.min(sha).alias(sha), F.max(sha).alias("__most"))
    conflicts = seen.where(F.col(sha) != F.col("__most")).select(key, sha, F.col("__most").alias("held"))
    if _exists(spark, path):
        held = spark.read.schema(df.schema).parquet(path).select(key, F.col(sha).alias("held"))
        conflicts = conflicts.unionByName(df.join(held, key).where(~F.col(sha).eqNullSafe(F.col("held"))).select(key, sha, "held"))
    conflicts = conflicts.distinct()
    if conflicts.isEmpty():
        append_new(df, path, [key])
    return conflicts


def publish(df: DataFrame, path: str, line: str) -> str:
    """Write once (an existing result is an error) and leave a marker with the digest of the sorted lines beside it."""
    df.write.mode("errorifexists").parquet(f"{path}/data")
    written = df.sparkSession.read.schema(df.schema).parquet(f"{path}/data")
    # digests of hash buckets, then the digest of these: no task sees more than one bucket
    buckets = written.select(F.pmod(F.xxhash64(line), F.lit(4096)).alias("b"), F.col(line).alias("line"))
    parts = buckets.groupBy("b").agg(digest(F.col("line")).alias("d"), F.count(F.lit(1)).alias("n"))
    total = parts.agg(digest(F.concat_ws(":", F.lpad(F.col("b").cast("string"), 4, "0"), "d")).alias("sha256"), F.sum("n").alias("n_rows"))
    total.coalesce(1).write.mode("errorifexists").json(f"{path}/_COMPLETE")
    return df.sparkSession.read.schema("sha256 string, n_rows bigint").json(f"{path}/_COMPLETE").first()["sha256"]
