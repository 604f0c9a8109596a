"""Size-tiered, incremental compaction of journals kept in many tiny objects.

**Index.** Every line that is new to the folder becomes a narrow row (place, 128-bit name of its record, size). The first
line of a record, by object key as plain bytes and line number, is the one that counts; whether a record is new is decided
on these rows alone, so texts are not shuffled for it.

**Tiers.** Files are sorted into tiers by size (tier t holds sizes up to ``base_bytes * fanout ** t``). Tier by tier the files
that no merge has taken up yet are packed, in key order, into merges of about the next tier's size; each merge is one file,
which holds the texts of its inputs' records once. A file alone in its place, or of over half the target, is left as it is.

**Journal.** Each merge is a transaction named by its inputs. Data is written first, then the journal row with inputs and
outputs, then a numbered commit that makes both count. A run over the same listing finds nothing new; a run over one more
object indexes that object and merges it with what is in its tier, and all other files keep their names. Files that a later
merge has taken up are deleted after its commit. Of two runs at the same time one gets ``ConcurrentRun``.

Defined results: a record is a line that is a complete JSON object; two records are the same if all fields have the
same values, an absent field being null and ``recorded_at`` an instant. Null, blank and broken lines are no records. A
key listed twice counts once with its latest size; an object missing from the listing takes the length of its lines;
null sizes count as 0. Lines with a null key or number come first. Empty tables give empty results.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliomill.operators.commits import Commits
from foliomill.operators.ranges import placed
from foliomill.runtime import fresh_path, materialize, shared_dir

INDEX_SCHEMA = "file string, object_key string, line_no int, record string, h bigint, bytes bigint, stored boolean"
DATA_SCHEMA = "record string, object_key string, line_no int, line_text string"
JOURNAL_SCHEMA = (
    "txn string, level int, run string, inputs bigint, input_bytes bigint, records_in bigint, records_out bigint, "
    "output_bytes bigint, files array<string>"
)
MOST_INPUTS = 1 << 16  # files of one merge
MOST_TASKS = 1 << 14  # of one tier; a task writes several merges where there are more
NO_KEY = "\x00"  # the file of lines without a key


@dataclass(frozen=True)
class Tiers:
    base_bytes: int = 64 * 1024
    fanout: int = 64
    target_bytes: int = 128 * 1024 * 1024

    def bound(self, tier: int) -> int:
        """The largest size of a tier."""
        return self.base_bytes * self.fanout**tier if tier >= 0 else -1

    def goal(self, tier: int) -> int:
        """What a merge of files of this tier is to reach."""
        return min(self.bound(tier + 1), self.target_bytes)

    def count(self) -> int:
        n = 1
        while self.bound(n - 1) < self.target_bytes // 2 and n < 40:
            n += 1
        return n


def named_records(lines: DataFrame, column: str = "line_text") -> DataFrame:
    """Adds ``record``: equal for equal records, null where the line is none."""
    # As the only element of an array, a line with anything after its object is no JSON. The lambdas hold the parsed line
    # and its fields, so each is worked out once.
    instant = "coalesce(cast(unix_micros(try_cast(e.value as timestamp)) as string), e.value)"
    field = f"named_struct('key', e.key, 'value', if(e.key = 'recorded_at', {instant}, e.value))"
    canonical = f"array_sort(transform(filter(map_entries(m), e -> e.value is not null), e -> {field}))"
    whole = "try_variant_get(a, '$[1]', 'variant') is null and schema_of_variant(try_variant_get(a, '$[0]', 'variant')) like 'OBJECT%'"
    fields = f"if({whole}, try_cast(try_variant_get(a, '$[0]', 'variant') as map<string,string>), null)"
    name = f"transform(array({fields}), m -> if(m is null, null, md5(to_json({canonical}))))[0]"
    return lines.withColumn("record", F.expr(f"transform(array(try_parse_json(concat('[', {column}, ']'))), a -> {name})[0]"))


def file_sizes(held: DataFrame, objects: DataFrame) -> DataFrame:
    """(file, bytes) of the objects ``held`` (file, object_key, held): the latest listed size, else the length of their lines."""
    listed = objects.groupBy("key").agg(
        F.max_by(F.coalesce("size", F.lit(0)), F.struct("listed_at", "last_modified", "size")).alias("listed")
    )
    rows = held.join(listed, held["object_key"].eqNullSafe(listed["key"]), "left")
    return rows.select("file", F.coalesce("listed", "held").alias("bytes"))


def plan_tier(files: DataFrame, tiers: Tiers, tier: int, close: bool = True) -> DataFrame:
    """(file, bytes, records, object, level, txn): the files of one tier that are merged, in key order.

    A merge takes files up to about the next tier's size; a file alone stays as it is, and so does one of over half the
    target. Unless the run is to ``close`` the tier, a merge waits for half its size or ``fanout`` files.
    """
    least, most, goal = tiers.bound(tier - 1), min(tiers.bound(tier), tiers.target_bytes // 2), tiers.goal(tier)
    here = files.where((F.col("bytes") > least) & (F.col("bytes") <= most)) if tier else files.where(F.col("bytes") <= most)
    # a file weighs something even where it is empty, so that a merge has at most MOST_INPUTS of them
    weight = F.greatest("bytes", F.lit(max(1, goal // MOST_INPUTS)))
    slots = placed(here, F.asc("file"), value=weight).withColumn("slot", F.floor(F.col("before") / goal))
    merges = slots.groupBy("slot").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("bytes").alias("size"),
        F.md5(F.concat_ws("\n", F.lit(str(tier + 1)), F.array_sort(F.collect_list("file")))).alias("txn"),
    )
    fires = F.col("n") > 1 if close else (F.col("n") >= tiers.fanout) | (F.col("n") > 1) & (F.col("size") >= goal // 2)
    return slots.join(merges.where(fires), "slot").select("file", "bytes", "records", "object", F.lit(tier + 1).alias("level"), "txn")


class Journal(Commits):
    """The index, the merges and their data, as far as commits name them."""

    def read(self, kind: str, schema: str) -> DataFrame:
        folders = [f"{self.workdir}/{x}" for x in self.folders(kind)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def rows(self) -> DataFrame:
        return self.read("merges", JOURNAL_SCHEMA)

    def consumed(self) -> DataFrame:
        return self.rows().select(F.explode("files").alias("file"))

    def data(self) -> DataFrame:
        """(file, record, object_key, line_no, line_text) of every merge that no later one has taken up."""
        kept = [x for x in self.folders("data") if self.fs.exists(self.path(x))]
        if not kept:
            return self.spark.createDataFrame([], f"file string, {DATA_SCHEMA}")
        parts = [self.spark.read.schema(f"{DATA_SCHEMA}, file string").parquet(f"{self.workdir}/{x}") for x in kept]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows.join(self.consumed(), "file", "left_anti").select("file", *[c.split()[0] for c in DATA_SCHEMA.split(", ")])

    def clean(self) -> None:
        """Deletes the files of merges that later ones have taken up; they are committed, so nothing refers to them."""
        gone = self.consumed().select(F.col("file").alias("txn"), F.lit(True).alias("gone"))
        merges = self.rows().select("txn", "level", "run").join(gone, "txn", "left")
        sums = merges.groupBy("level", "run").agg(F.count(F.lit(1)).alias("n"), F.count("gone").alias("gone")).where("gone > 0")
        for row in sums.collect():  # a row for each tier of each run
            folder = f"data/level={row['level']}/run={row['run']}"
            if not self.fs.exists(self.path(folder)):
                continue
            if row["n"] == row["gone"]:
                self.delete(folder)
                continue
            part = merges.where((F.col("level") == row["level"]) & (F.col("run") == row["run"]) & F.col("gone"))
            for merge in part.select("txn").toLocalIterator():
                self.delete(f"{folder}/file={merge['txn']}")


@dataclass
class Compacted:
    records: DataFrame  # object_key, line_no, record, line_text, file
    dropped: DataFrame  # object_key, line_no
    journal: DataFrame  # a row for each merge


def compact(
    lines: DataFrame, objects: DataFrame, tiers: Tiers | None = None, workdir: str | None = None, close: bool = True
) -> Compacted:
    """Compact ``lines`` (object_key, line_no, line_text) of the listing ``objects`` (key, size, listed_at,
    last_modified). With the same ``workdir`` a later run reads what is new, and merges only that and what it meets."""
    tiers, spark = tiers or Tiers(), lines.sparkSession
    workdir = workdir or fresh_path(spark, "compaction")
    shared_dir(spark)
    journal, run = Journal(spark, workdir), uuid.uuid4().hex
    lines = lines.select("object_key", F.col("line_no").cast("int").alias("line_no"), "line_text")
    _index(journal, lines, run)
    seen = journal.read("index", INDEX_SCHEMA)
    held = seen.groupBy("file", "object_key").agg(F.sum("bytes").alias("held"), F.count("record").alias("records"))
    held = materialize(held, "compaction-objects")
    sizes = file_sizes(held, objects).join(held.select("file", "records"), "file")
    taken = journal.consumed()
    first = sizes.select("file", "bytes", "records", F.lit(True).alias("object"))
    for tier in range(tiers.count()):
        merged = journal.rows().select(F.col("txn").alias("file"), F.col("output_bytes").alias("bytes"), F.col("records_out").alias("records"), F.lit(False).alias("object"))
        live = first.unionByName(merged).join(journal.consumed(), "file", "left_anti")
        plan = materialize(plan_tier(live, tiers, tier, close), "compaction-plan")
        if not plan.isEmpty():
            _merge(journal, plan, lines, seen, run)
    journal.clean()
    return _result(journal, lines, seen)


def _index(journal: Journal, lines: DataFrame, run: str) -> None:
    """Writes a row for each line not seen before; ``stored`` marks the line whose text stands for a record that is new."""
    old = journal.read("index", INDEX_SCHEMA)
    known = bool(journal.folders("index"))
    file = F.coalesce("object_key", F.lit(NO_KEY))
    if known:
        o = old.select(F.col("object_key").alias("k"), F.col("line_no").alias("n")).distinct()
        lines = lines.join(o, lines["object_key"].eqNullSafe(o["k"]) & lines["line_no"].eqNullSafe(o["n"]), "left_anti")
        file = F.concat(file, F.lit(f"@{run}"))  # lines that an object got later are a file of their own
    rows = named_records(lines).select(
        file.alias("file"), "object_key", "line_no", "record", F.xxhash64("line_text").alias("h"),
        F.coalesce(F.octet_length("line_text"), F.lit(0)).cast("bigint").alias("size"),
    )
    rows = materialize(rows.withColumn("bytes", F.col("size") + 1).drop("size"), "compaction-lines")
    if known and rows.isEmpty():
        return
    # narrow rows only; a record sent everywhere is one row of each task before the shuffle
    winners = _winners(rows)
    if known:
        winners = winners.join(old.where("record is not null").select("record").distinct(), "record", "left_anti")
    stored = winners.select("record", "w", F.lit(True).alias("stored"))
    place = F.struct("object_key", "line_no")
    out = rows.join(stored, "record", "left").select(
        "file", "object_key", "line_no", "record", "h", "bytes", F.coalesce(F.col("stored") & (place == F.col("w")), F.lit(False)).alias("stored")
    )
    out.write.parquet(f"{journal.workdir}/index/run={run}")
    journal.commit(index=f"index/run={run}")


def _winners(rows: DataFrame) -> DataFrame:
    """(record, w) with the place of each record's first line: keys as plain bytes, nulls first."""
    return rows.where("record is not null").groupBy("record").agg(F.min(F.struct("object_key", "line_no")).alias("w"))


def _texts(lines: DataFrame, stored: DataFrame) -> DataFrame:
    """The lines at the places of ``stored`` (object_key, line_no, h, ...) with its other columns."""
    s = stored.withColumnsRenamed({"object_key": "k", "line_no": "n"})
    same = lines["object_key"].eqNullSafe(s["k"]) & lines["line_no"].eqNullSafe(s["n"]) & (F.xxhash64(lines["line_text"]) == s["h"])
    return lines.join(s, same).drop("k", "n", "h")


def _merge(journal: Journal, plan: DataFrame, lines: DataFrame, seen: DataFrame, run: str) -> None:
    """Data first, then the journal rows, then the commit that makes both count."""
    spark, level = journal.spark, plan.select("level").first()[0]
    columns = ["txn", *[c.split()[0] for c in DATA_SCHEMA.split(", ")]]
    stored = seen.where("stored").join(plan.where("object").select("file", "txn"), "file").select("object_key", "line_no", "h", "record", "txn")
    rows = _texts(lines, stored).select(*columns)
    if level > 1:
        rows = rows.unionByName(journal.data().join(plan.where("not object").select("file", "txn"), "file").select(*columns))
    count = min(plan.select("txn").distinct().count(), MOST_TASKS)
    # all of a merge is in one task, which writes it as one file
    rows = rows.repartition(count, "txn")
    if not plan.where("object").isEmpty():  # a row given twice has its text twice; what merges hold, they hold once
        once = Window.partitionBy("txn", "record").orderBy("object_key", "line_no")
        rows = rows.withColumn("r", F.row_number().over(once)).where("r = 1").drop("r")
    rows = rows.withColumnRenamed("txn", "file").sortWithinPartitions("file")
    folder = f"data/level={level}/run={run}"
    rows.write.mode("overwrite").partitionBy("file").parquet(f"{journal.workdir}/{folder}")
    written = spark.read.schema(f"{DATA_SCHEMA}, file string").parquet(f"{journal.workdir}/{folder}")
    out = written.groupBy(F.col("file").alias("txn")).agg(F.count(F.lit(1)).alias("records_out"), F.sum(F.octet_length("line_text") + 1).alias("output_bytes"))
    inputs = plan.groupBy("txn", "level").agg(
        F.count(F.lit(1)).alias("inputs"), F.sum("bytes").alias("input_bytes"), F.sum("records").alias("records_in"), F.array_sort(F.collect_list("file")).alias("files")
    )
    done = inputs.join(out, "txn", "left").fillna(0, ["records_out", "output_bytes"]).withColumn("run", F.lit(run))
    done.select(*[c.split()[0] for c in JOURNAL_SCHEMA.split(", ")]).write.mode("overwrite").parquet(f"{journal.workdir}/merges/level={level}/run={run}")
    journal.commit(merges=f"merges/level={level}/run={run}", data=folder)


def _result(journal: Journal, lines: DataFrame, seen: DataFrame) -> Compacted:
    waiting = seen.where("stored").join(journal.consumed(), "file", "left_anti")
    waiting = _texts(lines, waiting.select("file", "object_key", "line_no", "h", "record")).dropDuplicates(["record"])
    columns = ["file", "object_key", "line_no", "record", "line_text"]
    records = journal.data().select(*columns).unionByName(waiting.select(*columns))
    winners = _winners(seen)
    if len(journal.folders("index")) > 1:  # a record's first line may have come with a later run
        records = records.drop("object_key", "line_no").join(winners, "record").select("*", "w.object_key", "w.line_no")
    place = F.struct("object_key", "line_no")
    dropped = seen.join(winners, "record").where(place != F.col("w")).select("object_key", "line_no")
    return Compacted(records.select("object_key", "line_no", "record", "line_text", "file"), dropped, journal.rows())
