"""Set reconciliation and keyed merges. Plain files know no transactions: results are computed, not enforced."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def differences(sets: dict[str, DataFrame], wanted: dict[str, tuple[str, str]], key: str) -> DataFrame:
    """(name, key): for each wanted name the keys of the first set that the second lacks."""
    parts = [
        sets[a].select(key).distinct().join(sets[b].select(key), key, "left_anti").select(F.lit(name).alias("name"), key)
        for name, (a, b) in wanted.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def full_merge(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both sides as structs ``o`` and ``n`` under their keys; what an upsert is made of."""
    o = old.select(*keys, F.struct(*[c for c in old.columns if c not in keys]).alias("o"))
    n = new.select(*keys, F.struct(*[c for c in new.columns if c not in keys]).alias("n"))
    return o.join(n, keys, "full_outer")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep: str = "new") -> DataFrame:
    """Merged rows; where both sides have a value the ``keep`` side's stays, its nulls are filled by the other."""
    rows = full_merge(old, new, keys)
    first, second = ("n", "o") if keep == "new" else ("o", "n")
    rest = [c for c in old.columns if c not in keys]
    return rows.select(*keys, *[F.coalesce(F.col(f"{first}.{c}"), F.col(f"{second}.{c}")).alias(c) for c in rest])


def least_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key, the same one in every run."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    rows = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__r"))
    return rows.select(*[F.col(c) if c in keys else F.col(f"__r.{c}").alias(c) for c in df.columns])


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``new`` whose key is not there yet, one of each key: the least by its other columns, nulls first."""
    return least_rows(new, keys).join(old.select(*keys), keys, "left_anti")


def compare_and_set(stored: DataFrame, asked: DataFrame, keys: list[str], revision: str, expected: str) -> DataFrame:
    """(keys, outcome, revision) of each request: applied where the stored revision is the one expected, which then goes up by
    one; else a conflict with the revision that is there, or unknown where no row has the key."""
    rows = asked.join(stored, keys, "left")
    fits = F.col(revision) == F.col(expected)
    outcome = F.when(F.col(revision).isNull(), "unknown").when(fits, "applied").otherwise("conflict")
    return rows.select(*keys, outcome.alias("outcome"), F.when(fits, F.col(revision) + 1).otherwise(F.col(revision)).alias(revision))


def status_counts(df: DataFrame, group: list[str], status: str, values: list[str]) -> DataFrame:
    """One column for each status, counted in one scan."""
    counts = [F.count_if(F.col(status) == v).alias(v) for v in values]
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("total"), *counts)


def run_state(failed: Column, done: Column, total: Column) -> Column:
    return F.when(total == 0, "empty").when(failed == 0, "completed").when(done == 0, "failed").otherwise("partial")


def history(df: DataFrame, keys: list[str], value: str, at: str) -> DataFrame:
    """Slowly changing rows: (keys, value, valid_from, valid_to); equal values in a row are one, the last is open."""
    order = Window.partitionBy(*keys).orderBy(at, value)
    rows = df.select(*keys, value, at).distinct().withColumn("__f", ~F.lag(value).over(order).eqNullSafe(F.col(value)))
    rows = rows.withColumn("__n", F.row_number().over(order)).where(F.col("__f") | (F.col("__n") == 1))
    return rows.select(*keys, value, F.col(at).alias("valid_from"), F.lead(at).over(order).alias("valid_to"))


def resolved(df: DataFrame, group: list[str], value: str, verified: Column, channel: str) -> DataFrame:
    """(group, state, value): no value where candidates disagree; verified, corroborated by two channels, or unverified."""
    rows = df.where(F.col(value).isNotNull()).groupBy(*group).agg(
        F.count_distinct(value).alias("__n"), F.min(value).alias("__v"), F.bool_or(verified).alias("__ok"), F.count_distinct(channel).alias("__c")
    )
    state = (
        F.when(F.col("__n") > 1, "conflict").when(F.col("__ok"), "verified").when(F.col("__c") >= 2, "corroborated").otherwise("unverified")
    )
    return rows.select(*group, state.alias("state"), F.when(F.col("__n") == 1, F.col("__v")).alias("value"))
