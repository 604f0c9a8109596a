"""Ratios by how an empty denominator counts, and the three percentiles. They are never mixed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NumberOrColumn = Column | float | int


def ratio_or_null(part: Column, whole: Column) -> Column:
    """Null where there is nothing to divide by."""
    return F.when(whole != 0, part / whole)


def ratio_or(part: Column, whole: Column, empty: float) -> Column:
    """``empty`` where there is nothing to divide by."""
    return F.when(whole == 0, F.lit(float(empty))).otherwise(part / whole)


def f1(precision: Column, recall: Column) -> Column:
    """Null if either is null, 0 if both are 0."""
    both = precision + recall
    return F.when(both == 0, F.lit(0.0)).otherwise(2 * precision * recall / both)


def overlap_precision(matched: Column, predicted: Column, expected: Column) -> Column:
    """1 if nothing was expected or predicted, 0 if nothing was predicted, else the share that matched."""
    return F.when((predicted == 0) & (expected == 0), F.lit(1.0)).when(predicted == 0, F.lit(0.0)).otherwise(matched / predicted)


def overlap_recall(matched: Column, expected: Column) -> Column:
    return ratio_or(matched, expected, 1.0)


def linear_percentile(col: str, fraction: float, empty: float | None = None) -> Column:
    """Aggregate: interpolated at fraction * (n - 1). ``empty`` stands for no values at all."""
    value = F.percentile(F.col(col), F.lit(fraction))
    return value if empty is None else F.coalesce(value, F.lit(empty))


def _rank(col: str, position: Column) -> Column:
    """Aggregate over the sorted values of a group; for groups whose values fit a task."""
    return F.element_at(F.sort_array(F.collect_list(col)), position)


def floor_percentile(col: str, fraction: float) -> Column:
    """Aggregate: the value of rank floor(fraction * (n - 1)), null for no values."""
    n = F.count(col)
    return F.when(n > 0, _rank(col, (F.floor(fraction * (n - 1)) + 1).cast("int")))


def rounded_percentile(col: str, fraction: float) -> Column:
    """Aggregate: the value of rank fraction * (n - 1) rounded half to even, null for no values."""
    n = F.count(col)
    return F.when(n > 0, _rank(col, (F.bround(fraction * (n - 1)) + 1).cast("int")))
