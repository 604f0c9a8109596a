"""Scores of a candidate text against a reference. The recurrences have no built-in form: Arrow-batched Python, with the
rows of the recurrence as bits of one integer, so that a step of a text of n symbols costs n / 64 operations."""

from __future__ import annotations

import difflib
import re
from collections import Counter
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

#: Fixed value: a word with inner dots, slashes and hyphens.
CONTENT = re.compile(r"\w+(?:[./-]\w+)*")


def _places(a: Sequence) -> dict:
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | (1 << i)
    return where


def edit_distance(a: Sequence, b: Sequence) -> int:
    """Insertions, deletions and substitutions; the differences down a column are held as two sets of bits."""
    if not a or not b:
        return len(a) + len(b)
    where, full, last = _places(a), (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = full, 0, len(a)
    for y in b:
        match = where.get(y, 0)
        diagonal = ((((match & up) + up) ^ up) | match | down) & full
        rises, falls = down | (full & ~(diagonal | up)), up & diagonal
        score += bool(rises & last) - bool(falls & last)
        rises = (rises << 1 | 1) & full
        up, down = (falls << 1 | (full & ~(diagonal | rises))) & full, rises & diagonal
    return score


def common_subsequence(a: Sequence, b: Sequence) -> int:
    """Length of the longest common subsequence."""
    where, full = _places(a), (1 << len(a)) - 1
    row = full
    for y in b:
        match = row & where.get(y, 0)
        row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


def content(text: str) -> list[str]:
    return [w.casefold() for w in CONTENT.findall(text)]


def error_rate(expected: Sequence, candidate: Sequence) -> float:
    """Edits by symbols expected; the edits alone where none are."""
    return edit_distance(expected, candidate) / max(1, len(expected))


def scores(expected: str, candidate: str) -> tuple[float, ...]:
    """(cer, wer, recall, precision, f1, order): characters, words between white space, and content words."""
    a, b = content(expected), content(candidate)
    both = sum((Counter(a) & Counter(b)).values())
    recall = both / len(a) if a else 1.0
    precision = both / len(b) if b else float(not a)
    f1 = 2 * recall * precision / (recall + precision) if recall + precision else 0.0
    order = common_subsequence(a, b) / len(a) if a else 1.0
    return error_rate(expected, candidate), error_rate(expected.split(), candidate.split()), recall, precision, f1, order


NAMES = ("cer", "wer", "recall", "precision", "f1", "order_kept")


@F.pandas_udf(StructType([StructField(n, DoubleType()) for n in NAMES]))
def fidelity(expected: pd.Series, candidate: pd.Series) -> pd.DataFrame:
    """All scores of a pair; null if either text is null."""
    rows = [scores(e, c) if e is not None and c is not None else (None,) * len(NAMES) for e, c in zip(expected, candidate)]
    return pd.DataFrame(rows, columns=NAMES, dtype="float64")


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching blocks of characters, 2 * matched / total. Null if either text is null."""
    ratio = lambda x, y: None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio()
    return pd.Series([ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def segments(a: str, b: str, around: int, most: int) -> list[tuple[str, int, int, str, str]]:
    """(change, from, to, before, after) of the first ``most`` stretches in which two texts differ, with ``around`` characters."""
    out = []
    for tag, i, j, k, m in difflib.SequenceMatcher(None, a, b).get_opcodes():
        if tag != "equal" and len(out) < most:
            out.append((tag, i, j, a[max(0, i - around) : j + around], b[max(0, k - around) : m + around]))
    return out


_SEGMENT = {"change": StringType(), "begin": IntegerType(), "end": IntegerType(), "before": StringType(), "after": StringType()}


@F.pandas_udf(ArrayType(StructType([StructField(n, t) for n, t in _SEGMENT.items()])))
def diff_segments(a: pd.Series, b: pd.Series) -> pd.Series:
    """Where two texts differ, twenty characters around, the first twelve; null if either is null."""
    rows = []
    for x, y in zip(a, b):
        parts = None if x is None or y is None else segments(x, y, 20, 12)
        rows.append(None if parts is None else [dict(zip(_SEGMENT, p)) for p in parts])
    return pd.Series(rows, dtype="object")
