"""Lexical rank, vector neighbours and rank fusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliomill.functions import text as T
from foliomill.runtime import materialize


def lexical_rank(docs: DataFrame, key: str, text: str, words: list[str], k: int) -> DataFrame:
    """(key, score): the k rows whose text holds the query's words most, rare words weighing more.

    Words are counted in place; only document frequencies, one number a word, are gathered.
    """
    tokens = T.tokens(F.col(text))
    # array_remove counts a word without a lambda
    counts = [(F.size("w") - F.size(F.array_remove("w", q))).alias(f"n{i}") for i, q in enumerate(words)]
    rows = docs.select(F.col(key), tokens.alias("w")).select(key, F.size("w").alias("n"), *counts)
    rows = materialize(rows, "lexical-counts")  # a few numbers a row: texts are read and split once
    seen = [F.count_if(F.col(f"n{i}") > 0).alias(f"d{i}") for i in range(len(words))]
    totals = rows.agg(F.count(F.lit(1)).alias("total"), *seen)
    weight = lambda i: F.log((F.col("total") + 1) / (F.col(f"d{i}") + 1)) + 1
    score = sum((F.col(f"n{i}") / F.greatest("n", F.lit(1)) * weight(i) for i in range(1, len(words))), F.col("n0") / F.greatest("n", F.lit(1)) * weight(0))
    rows = rows.crossJoin(F.broadcast(totals)).select(key, F.round(score, 9).alias("score"))  # one row of totals
    return rows.where("score > 0").orderBy(F.desc("score"), key).limit(k)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def nearest(vectors: DataFrame, key: str, vector: str, query: list[float], k: int) -> DataFrame:
    """(key, similarity): the k vectors of greatest cosine to ``query``; null and zero vectors are left out."""
    q = F.array(*[F.lit(float(x)) for x in query])
    norm = F.sqrt(dot(F.col(vector), F.col(vector)))
    size = sum(x * x for x in query) ** 0.5
    rows = vectors.where(F.col(vector).isNotNull()).select(key, dot(F.col(vector), q).alias("d"), norm.alias("n")).where("n > 0")
    return rows.select(key, F.round(F.col("d") / (F.col("n") * size), 6).alias("similarity")).orderBy(F.desc("similarity"), key).limit(k)


def fuse(rankings: list[DataFrame], key: str, k: int = 60) -> DataFrame:
    """(key, score): sum of 1 / (k + place) over rankings that hold (key, place)."""
    rows = rankings[0].select(key, "place")
    for r in rankings[1:]:
        rows = rows.unionAll(r.select(key, "place"))
    return rows.groupBy(key).agg(F.round(F.sum(1.0 / (F.lit(k) + F.col("place"))), 9).alias("score"))


def placed(top: DataFrame, *order: Column) -> DataFrame:
    """``place`` in a ranking that has been cut to k rows."""
    return top.withColumn("place", F.row_number().over(Window.orderBy(*order)))
