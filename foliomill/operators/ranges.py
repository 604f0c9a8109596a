"""Orders over a whole table without one task that sorts it: range partitions, and sums of what lies before each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliomill.runtime import materialize


def placed(df: DataFrame, *order: Column, value: Column | None = None) -> DataFrame:
    """Adds ``place`` (from 1) in ``order`` and, with ``value``, ``before``: the sum of it over all rows that come earlier.

    Rows are sorted and numbered in range partitions; the partitions' totals, one row each, are summed and added. Ties may
    come in any order. A null value counts as 0.
    """
    rows = df.withColumn("__v", F.coalesce(value, F.lit(0)) if value is not None else F.lit(0))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__m", F.monotonically_increasing_id())
    # written once: a second run might draw other range bounds
    rows = materialize(rows.select("*", F.shiftright("__m", 33).alias("__p"), (F.col("__m") % (1 << 33)).alias("__i")), "placed")
    sizes = rows.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"), F.sum("__v").alias("__s"))
    earlier = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__p", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__b"), F.coalesce(F.sum("__s").over(earlier), F.lit(0)).alias("__c"))
    rows = rows.join(F.broadcast(starts), "__p")  # a row for each partition
    if value is not None:
        within = Window.partitionBy("__p").orderBy("__i").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("before", F.col("__c") + F.coalesce(F.sum("__v").over(within), F.lit(0)))
    return rows.withColumn("place", F.col("__i") + F.col("__b") + 1).drop("__p", "__i", "__b", "__c", "__m", "__v")


def attach(rows: DataFrame, more: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with the other columns of ``more`` where ``columns`` are equal; nulls are equal."""
    names = {c: f"__on_{c}" for c in columns}
    other = more.withColumnsRenamed(names)
    on = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    return rows.join(other, on, how).drop(*names.values())


def placed_within(df: DataFrame, group: list[str], *order: Column, value: Column | None = None) -> DataFrame:
    """As ``placed``, but ``place`` and ``before`` start anew in each group: for few groups of any size, which a window would
    send to one task each. Nulls are a group."""
    rows = placed(df, *[F.asc(g) for g in group], *order, value=value)
    least = [F.min("place").alias("__place")] + ([F.min("before").alias("__before")] if value is not None else [])
    starts = rows.groupBy(*group).agg(*least)
    out = attach(rows, starts, group).withColumn("place", F.col("place") - F.col("__place") + 1)
    if value is not None:
        out = out.withColumn("before", F.col("before") - F.col("__before"))
    return out.drop("__place", "__before")


def percentiles(df: DataFrame, group: list[str], value: str, **asked: tuple[str, float]) -> DataFrame:
    """(group, names): exact percentiles, each (kind, fraction) of linear (interpolated), floor or rounded (half to even) rank.

    Values are counted first; the distinct ones are placed by range with their counts, so that no group is ever in one
    task. Null values do not count, and a group without any is left out.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, F.col(value).alias("__value")).agg(F.count(F.lit(1)).alias("__times"))
    rows = placed_within(counts, group, F.asc("__value"), value=F.col("__times"))
    sizes = rows.groupBy(*group).agg(F.sum("__times").alias("__total"))
    both = attach(rows, sizes, group)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + F.col("__times")), F.col("__value")))

    columns = []
    for name, (kind, fraction) in asked.items():
        place = F.lit(float(fraction)) * (F.col("__total") - 1)
        if kind == "linear":
            low, high, rest = at(F.floor(place)), at(F.ceil(place)), F.max(place - F.floor(place))
            columns.append((low + (high - low) * rest).alias(name))
        else:
            columns.append(at(F.floor(place) if kind == "floor" else F.bround(place)).alias(name))
    return both.groupBy(*group).agg(*columns)
