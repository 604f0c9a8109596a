"""Joins, pages of keys and choices of one row. Null keys never meet unless a function says so."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def where_given(df: DataFrame, **wanted: object) -> DataFrame:
    """Equality filters for the arguments that are given; the absent ones leave no trace in the plan."""
    for column, value in wanted.items():
        if value is not None:
            df = df.where(F.col(column) == F.lit(value))
    return df


def key_page(df: DataFrame, key: str, after: object, size: int) -> DataFrame:
    """The ``size`` rows that follow ``after`` by ``key``, with ``has_more``. One row more is read to know."""
    rows = df if after is None else df.where(F.col(key) > F.lit(after))
    rows = rows.orderBy(key).limit(size + 1)
    place = F.row_number().over(Window.orderBy(key))  # over size + 1 rows at most
    rows = rows.withColumn("__n", place).withColumn("has_more", F.lit(size) < F.max("__n").over(Window.partitionBy()))
    return rows.where(F.col("__n") <= size).drop("__n")


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row of each key: the first by ``order``. Only as many columns travel as ``df`` has."""
    place = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(place)).where("__n = 1").drop("__n")


def with_mark(df: DataFrame, other: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df`` with a flag that says whether ``other`` has its key."""
    held = other.select(*keys).distinct().withColumn(name, F.lit(True))
    return df.join(held, keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def null_safe(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join where null equals null; the keys come from ``a``."""
    renamed = b.select(*[F.col(c).alias(f"__{c}") if c in keys else F.col(c) for c in b.columns])
    on = [a[k].eqNullSafe(renamed[f"__{k}"]) for k in keys]
    return a.join(renamed, on, how).drop(*[f"__{k}" for k in keys])


def either_end(edges: DataFrame, nodes: DataFrame, source: str, target: str, node: str) -> DataFrame:
    """(node, *edges): edges at either end of each node, once; two equi joins, as an OR would be a nested loop."""
    at = lambda end: edges.join(nodes.select(F.col(node).alias("__n")).distinct(), F.col(end) == F.col("__n"))
    both = at(source).withColumnRenamed("__n", node)
    loops = F.col(source) == F.col(target)
    other = at(target).where(~loops).withColumnRenamed("__n", node)
    return both.unionByName(other)


def matched(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, side): 'both', 'left' or 'right' for each key of either."""
    x = a.select(*keys).distinct().withColumn("__a", F.lit(1))
    y = b.select(*keys).distinct().withColumn("__b", F.lit(1))
    side = F.when(F.col("__b").isNull(), "left").when(F.col("__a").isNull(), "right").otherwise("both")
    return x.join(y, keys, "full_outer").select(*keys, side.alias("side"))


def neighbours(wanted: DataFrame, rows: DataFrame, key: str, place: str, radius: int) -> DataFrame:
    """(key, at, place, found): for every wanted (key, place) the places within ``radius``, found or not."""
    around = F.explode(F.sequence(F.col(place) - radius, F.col(place) + radius))
    asked = wanted.select(key, F.col(place).alias("at"), around.alias(place))
    held = rows.select(key, place).distinct().withColumn("found", F.lit(True))
    return asked.join(held, [key, place], "left").withColumn("found", F.coalesce("found", F.lit(False)))


def range_lookup(ranges: DataFrame, rows: DataFrame, key: str, place: str, block: int = 4096) -> DataFrame:
    """(key, first, last, n_found, missing): places of each range that ``rows`` has and lacks.

    A range is looked up and gathered in blocks of places, so a long one is many small arrays until the last step.
    """
    numbers = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"greatest(0, (last - first) div {block})"))).alias("__b")
    start = (F.col("first") + F.col("__b") * block).cast(ranges.schema["first"].dataType)
    within = F.explode(F.sequence(start, F.least(F.col("last"), start + (block - 1)))).alias(place)
    asked = ranges.select(key, "first", "last", numbers).select(key, "first", "last", "__b", within)
    held = rows.select(key, place).distinct().withColumn("__f", F.lit(1))
    found = asked.join(held, [key, place], "left")
    lacking = F.array_sort(F.collect_list(F.when(F.col("__f").isNull(), F.col(place))))
    parts = found.groupBy(key, "first", "last", "__b").agg(F.count("__f").alias("n"), lacking.alias("m"))
    ordered = F.array_sort(F.collect_list(F.struct("__b", "m")))
    return parts.groupBy(key, "first", "last").agg(F.sum("n").alias("n_found"), F.flatten(F.transform(ordered, lambda p: p["m"])).alias("missing"))


def of_last(df: DataFrame, number: str) -> DataFrame:
    """The rows with the greatest ``number``; one row is broadcast."""
    last = df.agg(F.max(number).alias("__last"))
    return df.join(F.broadcast(last), F.col(number) == F.col("__last")).drop("__last")
