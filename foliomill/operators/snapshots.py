"""Changes between consecutive full snapshots, by a bucketed key-to-hash index.

A snapshot's index has one row per key with the 128-bit hash of the key and the hash of its value, bucketed by key hash. The
index of the last snapshot is stored. A new delivery becomes an index with the same buckets, which probes the stored one
over the narrow columns without a shuffle; the wide key values are fetched only for the keys that changed. Then the new
index takes the place of the old one. Several snapshots delivered at once are indexed with one shuffle and probed in turn.

Defined results: surrounding white space is trimmed from keys and hashes, hashes compare in lower case, URLs with their
scheme and host in lower case. Of several rows of a key in a snapshot the latest ``recorded_at`` counts (null is the
oldest), then the latest ``delivered_at``, then the greatest hash. Null keys, blank keys and null hashes are values like
any other. Rows without a snapshot number belong to no snapshot. An empty table and a single snapshot give no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.operators.commits import Commits
from foliomill.runtime import fresh_path, materialize, shuffle_partitions

#: The characters with the Unicode property White_Space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
CHANGE_SCHEMA = "snapshot_no int, source_identifier string, document_url string, change_kind string"


def trimmed(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITE_SPACE))


def normal_url(col: Column) -> Column:
    """Trimmed, with scheme and host in lower case; user names, ports, paths and queries stay as they are."""
    url = trimmed(col)
    pattern = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*://)([^/?#@]*@)?([^/?#]*)(.*)$"
    part = lambda i: F.regexp_extract(url, pattern, i)
    rebuilt = F.concat(F.lower(part(1)), part(2), F.lower(part(3)), part(4))
    # most rows are in lower case already and need no regular expression
    return F.when(url == F.lower(url), url).when(url.rlike(pattern), rebuilt).otherwise(url)


def key_hashes(*cols: Column) -> tuple[Column, Column]:
    """128 bits over the columns, with null apart from the empty string."""
    parts = [x for c in cols for x in (c.isNull(), F.coalesce(c, F.lit("")))]
    return F.xxhash64(*parts), F.xxhash64(F.lit("second"), *reversed(parts))


class SnapshotIndex:
    """The key-to-hash index of the last snapshot, kept in ``workdir`` between deliveries.

    ``apply`` takes the next delivery, probes the stored index with it, fetches values for the keys that changed, and swaps:
    a commit makes the new index the stored one, and the old one is deleted. A run broken before the commit leaves the
    stored index as it was, and the delivery is applied again.
    """

    def __init__(self, spark: SparkSession, workdir: str, buckets: int | None = None):
        self.spark, self.commits = spark, Commits(spark, workdir)
        self.workdir = workdir
        state = self.commits.folders("state")
        self.snapshot, self.folder, self.buckets = state[-1] if state else (None, None, buckets)

    def apply(self, rows: DataFrame) -> DataFrame:
        """The changes of each snapshot in ``rows`` that is newer than the stored one, in order; all are applied."""
        rows = rows.where(F.col("snapshot_no").isNotNull())
        if self.snapshot is not None:
            rows = rows.where(F.col("snapshot_no") > self.snapshot)
        self.buckets = self.buckets or _buckets(rows)
        staged = f"index-{uuid.uuid4().hex}"
        name = self._stage(rows, staged)
        numbers = sorted(r[0] for r in self.spark.table(name).select("snapshot_no").distinct().collect())
        changes = f"changes-{uuid.uuid4().hex}"
        old = self._stored(self.folder) if self.snapshot is not None else None
        before = self.snapshot
        for number in numbers:
            if old is not None:
                self._diff((old, before), (name, number), f"{changes}/{number}")
            if old not in (None, name):
                self.spark.sql(f"DROP TABLE {old}")
            old, before = name, number
        self.spark.sql(f"DROP TABLE {name}")  # the files stay; what is read below is read by its path
        if numbers:
            gone = self.folder
            self.snapshot, self.folder = numbers[-1], staged
            self.commits.commit(state=[self.snapshot, self.folder, self.buckets])
            if gone:
                self.commits.delete(gone)
            for number in numbers[:-1]:  # snapshots that have been passed
                self.commits.delete(f"{staged}/snapshot_no={number}")
        else:
            self.commits.delete(staged)
        done = [f"{self.workdir}/{changes}/{n}" for n in numbers if self.commits.fs.exists(self.commits.path(f"{changes}/{n}"))]
        if not done:
            return self.spark.createDataFrame([], CHANGE_SCHEMA)
        return self.spark.read.schema(CHANGE_SCHEMA).parquet(*done)

    def _stage(self, rows: DataFrame, folder: str) -> str:
        """Indexes every snapshot of ``rows`` with one shuffle, as a bucketed table."""
        clean = rows.select(
            F.col("snapshot_no").cast("int"),
            trimmed(F.col("source_identifier")).alias("source_identifier"),
            normal_url(F.col("document_url")).alias("document_url"),
            F.lower(trimmed(F.col("sha256"))).alias("sha256"),
            "recorded_at",
            "delivered_at",
        )
        k1, k2 = key_hashes(F.col("source_identifier"), F.col("document_url"))
        v1, v2 = key_hashes(F.col("sha256"))
        keyed = clean.select("*", k1.alias("k1"), k2.alias("k2"), v1.alias("v1"), v2.alias("v2")).drop("sha256")
        # the order of recorded_at decides; the hash of the value settles what is still tied
        age = F.struct("recorded_at", "delivered_at", "v1", "v2")
        kept = F.struct("source_identifier", "document_url", "v1", "v2")
        latest = (
            keyed.repartition(self.buckets, "k1", "k2")
            .groupBy("snapshot_no", "k1", "k2")
            .agg(F.max_by(kept, age).alias("kept"))
            .select("snapshot_no", "k1", "k2", "kept.*")
        )
        name = _table_name(folder)
        (
            latest.write.partitionBy("snapshot_no")
            .bucketBy(self.buckets, "k1", "k2")
            .sortBy("k1", "k2")
            .option("path", f"{self.workdir}/{folder}")
            .saveAsTable(name)
        )
        return name

    def _stored(self, folder: str) -> str:
        """The stored index as a table of the session, with its buckets."""
        name = _table_name(folder)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (k1 BIGINT, k2 BIGINT, source_identifier STRING, document_url STRING, v1 BIGINT, "
            f"v2 BIGINT, snapshot_no INT) USING parquet PARTITIONED BY (snapshot_no) "
            f"CLUSTERED BY (k1, k2) SORTED BY (k1, k2) INTO {self.buckets} BUCKETS LOCATION '{self.workdir}/{folder}'"
        )
        self.spark.sql(f"MSCK REPAIR TABLE {name}")
        return name

    def _rows(self, place: tuple[str, int]) -> DataFrame:
        return self.spark.table(place[0]).where(F.col("snapshot_no") == place[1])

    def _diff(self, old: tuple[str, int], new: tuple[str, int], out: str) -> None:
        """One probe over the narrow columns of both indexes, then the values of what it found."""
        o = self._rows(old).select("k1", "k2", F.col("v1").alias("o1"), F.col("v2").alias("o2"))
        n = self._rows(new).select("k1", "k2", F.col("v1").alias("n1"), F.col("v2").alias("n2"))
        kind = (
            F.when(F.col("o1").isNull(), "added")
            .when(F.col("n1").isNull(), "removed")
            .when((F.col("o1") != F.col("n1")) | (F.col("o2") != F.col("n2")), "changed")
        )
        found = n.join(o, ["k1", "k2"], "full_outer").select("k1", "k2", kind.alias("change_kind"))
        found = materialize(found.where(F.col("change_kind").isNotNull()), "snapshot-probe")
        fetch = lambda place, keys: keys.join(
            self._rows(place).select("k1", "k2", "source_identifier", "document_url"), ["k1", "k2"]
        ).select(F.lit(new[1]).cast("int").alias("snapshot_no"), "source_identifier", "document_url", "change_kind")
        gone, there = found.where("change_kind = 'removed'"), found.where("change_kind <> 'removed'")
        fetch(old, gone).unionAll(fetch(new, there)).write.parquet(f"{self.workdir}/{out}")


def _table_name(folder: str) -> str:
    return "snapshot_" + folder.replace("-", "_")


BUCKET_BYTES = 128 << 20


def _buckets(rows: DataFrame) -> int:
    """By the size of the rows, so that a bucket of a snapshot fits a task whatever the number of shuffle partitions."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return int(min(max(shuffle_partitions(rows.sparkSession), size // BUCKET_BYTES), 1 << 16))


def snapshot_changes(rows: DataFrame, buckets: int | None = None) -> DataFrame:
    """Added, removed and changed keys of each snapshot against the one before it."""
    return SnapshotIndex(rows.sparkSession, fresh_path(rows.sparkSession, "snapshots"), buckets).apply(rows)
