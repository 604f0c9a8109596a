"""Journals as streams: new objects are read as they come, with the same parsing as the batch reader."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from foliomill.operators.relational import latest
from foliomill.sources.files import journal_records

KEYS = ["source_identifier", "document_url"]


def journal_stream(spark: SparkSession, folder: str, files_a_batch: int = 1000) -> DataFrame:
    """(source_identifier, document_url, status, sha256, recorded) of each complete record in files that arrive in ``folder``."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_a_batch).text(folder).withColumnRenamed("value", "line_text")
    rows = journal_records(lines).where("not corrupt and recorded is not null")
    return rows.select("r.source_identifier", "r.document_url", "r.status", "r.sha256", "recorded")


def status_windows(records: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, status, n) in windows of event time; what comes later than ``late`` is left out."""
    windows = records.withWatermark("recorded", late).groupBy(F.window("recorded", size), "status")
    return windows.agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "status", "n")


def once_each(records: DataFrame, late: str = "1 day") -> DataFrame:
    """Records without those sent again within ``late``; state older than that is dropped."""
    return records.withWatermark("recorded", late).dropDuplicatesWithinWatermark([*KEYS, "status", "sha256"])


def breaker(records: DataFrame, limit: int = 5, idle_days: int = 30, late: str = "1 day") -> DataFrame:
    """(source_identifier, failures, open) whenever a key's run of failures grows or ends.

    State of a key: how many failures in a row, over all batches. Order within a batch is by time recorded. A key of which
    nothing has come for ``idle_days`` of event time is forgotten, so the state holds the keys of that time and no others.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        run = state.get[0] if state.exists else 0
        rows = pd.concat(list(batches)).sort_values("recorded", kind="stable")
        for status in rows["status"]:
            run = run + 1 if status == "failed" else 0
        state.update((run,))
        last = int(rows["recorded"].max().timestamp() * 1000)
        state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + idle_days * 86_400_000)
        yield pd.DataFrame({"source_identifier": [key[0]], "failures": [run], "open": [run >= limit]})

    return records.withWatermark("recorded", late).groupBy("source_identifier").applyInPandasWithState(
        step, "source_identifier string, failures int, open boolean", "failures int", "update", GroupStateTimeout.EventTimeTimeout
    )


def keep_latest(records: DataFrame, path: str, checkpoint: str):
    """Start a query that keeps the newest record of each key in ``path/batch=<id>``.

    A batch that is done again after a failure writes the same folder again, so the result is exact. Folders that no batch
    can need any more are removed.
    """
    spark = records.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        rows = batch
        if number > 0:
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(f"{path}/batch={number - 1}"))
        kept = latest(rows, KEYS, F.desc("recorded"), F.desc_nulls_last("sha256"), F.desc("status"))
        kept.write.mode("overwrite").parquet(f"{path}/batch={number}")
        if number > 1:
            old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch={number - 2}")
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)

    return records.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
