"""Runs, gaps, segments and packings over ordered rows of a group."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from foliomill.operators.ranges import attach, placed_within


def runs(df: DataFrame, group: list[str], place: str) -> DataFrame:
    """(group, first, last, length) of the maximal runs of consecutive integers."""
    order = Window.partitionBy(*group).orderBy(place)
    rows = df.select(*group, place).distinct().withColumn("__g", F.col(place) - F.row_number().over(order))
    return rows.groupBy(*group, "__g").agg(
        F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("length")
    ).drop("__g")


def bridged(df: DataFrame, group: list[str], place: str, label: str, most: int) -> DataFrame:
    """``label`` where null runs of at most ``most`` rows lie between two equal labels: they take it."""
    order = Window.partitionBy(*group).orderBy(place)
    before = F.last(label, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(label, ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
    rows = df.withColumn("__b", before).withColumn("__a", after)
    rows = rows.withColumn("__k", F.count(label).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    gap = F.count_if(F.col(label).isNull()).over(Window.partitionBy(*group, "__k"))
    fill = F.col(label).isNull() & (F.col("__b") == F.col("__a")) & (gap <= most)
    return rows.withColumn(label, F.when(fill, F.col("__b")).otherwise(F.col(label))).drop("__b", "__a", "__k")


def between_starts(starts: DataFrame, group: list[str], place: str, end: Column) -> DataFrame:
    """``starts`` with ``last``: one before the next start of the group, ``end`` for the last one."""
    following = F.lead(place).over(Window.partitionBy(*group).orderBy(place))
    return starts.withColumn("last", F.coalesce(following - 1, end))


def change_segments(df: DataFrame, group: list[str], place: str, identity: str) -> DataFrame:
    """(group, segment, identity, first, last, n): a segment ends where the identity changes or a place is missing."""
    order = Window.partitionBy(*group).orderBy(place)
    fresh = ~F.lag(identity).over(order).eqNullSafe(F.col(identity)) | (F.col(place) - F.lag(place).over(order) != 1)
    rows = df.select(*group, place, identity).withColumn("__f", F.coalesce(fresh, F.lit(True)).cast("int"))
    rows = rows.withColumn("segment", F.sum("__f").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*group, "segment").agg(
        F.first(identity).alias(identity), F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("n")
    )


def longest_repeat(df: DataFrame, group: list[str], place: str, value: str) -> DataFrame:
    """(group, longest): the greatest number of equal values in a row."""
    order = Window.partitionBy(*group).orderBy(place)
    rows = df.withColumn("__f", (~F.lag(value).over(order).eqNullSafe(F.col(value))).cast("int"))
    rows = rows.withColumn("__g", F.sum("__f").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*group, "__g").agg(F.count(F.lit(1)).alias("n")).groupBy(*group).agg(F.max("n").alias("longest"))


def overlaps(df: DataFrame, group: list[str], start: str, end: str, key: str) -> DataFrame:
    """Intervals that begin before an earlier one of their group has ended; a null end is open."""
    order = Window.partitionBy(*group).orderBy(start, key).rowsBetween(Window.unboundedPreceding, -1)
    open_before = F.max(F.col(end).isNull()).over(order)
    return df.withColumn("__e", F.max(end).over(order)).withColumn("__o", open_before).where(
        F.coalesce("__o", F.lit(False)) | (F.col(start) < F.col("__e"))
    ).drop("__e", "__o")


PACK_CHUNK = 4096


def pack(df: DataFrame, group: str, place: str, cost: str, budget: int, most: int) -> DataFrame:
    """``batch`` of each row: rows in order, a batch ends before it would pass the budget or the count ``most``.

    The fold of a group is cut into chunks of ``PACK_CHUNK`` rows. When a chunk begins, fewer than ``most`` of its rows still
    belong to the batch before; for each such number the chunk tells, on its own, how many batches it begins and how many
    rows of the next chunk the last of them takes. These few numbers are then folded chunk by chunk, and the rows get
    their batches in parallel. Null costs count as 0; a null group is one.
    """
    rows = placed_within(df.select(group, place, cost), [group], F.asc(place))
    rows = rows.withColumn("__chunk", F.floor((F.col("place") - 1) / PACK_CHUNK)).withColumn("__i", (F.col("place") - 1) % PACK_CHUNK)
    # the first rows of a chunk are also seen by the one before, which may reach into them
    ahead = rows.where((F.col("__i") < most) & (F.col("__chunk") > 0))
    seen = rows.unionByName(ahead.withColumn("__chunk", F.col("__chunk") - 1).withColumn("__i", F.col("__i") + PACK_CHUNK))

    def fold(costs: list, first: int, n: int) -> tuple[list[int], int]:
        """Where batches begin if the first one does at ``first``, and how many rows after the n-th the last one takes."""
        starts, total, count = [], 0, most
        for i in range(first, len(costs)):
            if count >= most or total + costs[i] > budget:
                if i >= n:
                    return starts, i - n
                starts.append(i)
                total, count = 0, 0
            total, count = total + costs[i], count + 1
        return starts, max(0, len(costs) - n)

    def chunk(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("__i", kind="stable")
        costs, n = part[cost].fillna(0).tolist(), int((part["__i"] < PACK_CHUNK).sum())
        out = []
        for first in range(min(most, n + 1)):
            starts, left = fold(costs, first, n)
            out.append((key[0], key[1], first, len(starts), left))
        return pd.DataFrame(out, columns=[group, "__chunk", "__first", "__starts", "__left"])

    kind = df.schema[group].dataType.simpleString()
    steps = seen.groupBy(group, "__chunk").applyInPandas(chunk, f"{group} {kind}, __chunk bigint, __first int, __starts bigint, __left int")

    def chain(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        table = {(c, f): (s, r) for c, f, s, r in zip(part["__chunk"], part["__first"], part["__starts"], part["__left"])}
        out, first, base = [], 0, 0
        for c in sorted(set(part["__chunk"])):
            out.append((key[0], c, first, base))
            starts, first = table[(c, first)]
            base += starts
        return pd.DataFrame(out, columns=[group, "__chunk", "__first", "__base"])

    entries = steps.groupBy(group).applyInPandas(chain, f"{group} {kind}, __chunk bigint, __first int, __base bigint")
    rows = attach(rows, entries, [group, "__chunk"])

    def number(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("__i", kind="stable")
        starts, _ = fold(part[cost].fillna(0).tolist(), int(part["__first"].iloc[0]), len(part))
        marks = pd.Series(0, index=range(len(part)))
        marks.iloc[starts] = 1
        batch = int(part["__base"].iloc[0]) - 1 + marks.cumsum().to_numpy()
        return part.assign(batch=batch)[[group, place, cost, "batch"]]

    schema = StructType([*df.select(group, place, cost).schema.fields, StructField("batch", IntegerType())])
    return rows.groupBy(group, "__chunk").applyInPandas(number, schema)


def joined_digest(df: DataFrame, group: str, order: list[str], text: str, flag: str, between: str) -> DataFrame:
    """(group, h, n): md5 of the group's texts in order, ``between`` them; n counts the flagged rows. A null key is a group.

    The sort is the engine's and spills; the digest takes one row after the other, so a group may be of any size.
    """
    mark = between.encode()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, n, kind = None, None, 0, pa.string()
        done: list[tuple] = []
        flush = lambda: pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in done], t) for i, t in enumerate((kind, pa.string(), pa.int64()))], names=[group, "h", "n"]
        )
        for batch in batches:
            kind = batch.schema.field(0).type
            for k, t, f in zip(*[c.to_pylist() for c in batch.columns]):
                if digest is None or k != key:
                    if digest is not None:
                        done.append((key, digest.hexdigest(), n))
                    key, digest, n = k, hashlib.md5(), 0
                else:
                    digest.update(mark)
                digest.update(t)
                n += f
            if done:
                yield flush()
                done.clear()
        if digest is not None:
            done.append((key, digest.hexdigest(), n))
            yield flush()

    rows = df.repartition(group).sortWithinPartitions(group, *order)
    rows = rows.select(group, F.col(text).cast("binary"), F.col(flag).cast("int"))
    return rows.mapInArrow(fold, f"{group} {df.schema[group].dataType.simpleString()}, h string, n bigint")


def halves(first: int, last: int, size: Callable[[int, int], int], most: int) -> list[tuple[int, int]]:
    """A range split in halves until each part fits."""
    if first >= last or size(first, last) <= most:
        return [(first, last)]
    middle = (first + last) // 2
    return halves(first, middle, size, most) + halves(middle + 1, last, size, most)


def round_robin(df: DataFrame, bucket: str, *order: Column) -> DataFrame:
    """``turn``: the place of each row in its bucket; taken turn by turn, buckets alternate. Buckets may be few and large."""
    return placed_within(df, [bucket], *order).withColumnRenamed("place", "turn")
