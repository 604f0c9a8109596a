"""Queries of the language-model operators and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.llm import encoding_repair, scan_repair
from foliomill.llm.mixing import mix, shares
from foliomill.llm.spans import shared_characters, shared_span_pairs
from foliomill.llm.tokenize import token_counts, token_ids
from foliomill.llm.truncation import text_records, truncated, truncation_report
from foliomill.runtime import table


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return text_records(table(spark, d, "source_texts"), table(spark, d, "candidate_texts"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return truncated(_texts(spark, d)).where("cut").select("table_name", "record_id")


def p1_by_source(spark: SparkSession, d: str) -> DataFrame:
    return truncation_report(_texts(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return scan_repair.scanned(_texts(spark, d))


def p4_repaired(spark: SparkSession, d: str) -> DataFrame:
    """The affected records with their text as paragraphs parted by an empty line."""
    return scan_repair.scanned(_texts(spark, d), repaired=True)


def _repairs(spark: SparkSession, d: str) -> DataFrame:
    model = encoding_repair.fit(table(spark, d, "documents"))
    return encoding_repair.repaired(table(spark, d, "source_texts"), model)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _repairs(spark, d).select(F.col("record_id").alias("text_id"))


def p5_restored(spark: SparkSession, d: str) -> DataFrame:
    """The affected records with the chain undone, their text, and whether characters are lost for good."""
    return _repairs(spark, d).withColumnRenamed("record_id", "text_id")


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return token_ids(table(spark, d, "documents").select("doc_id", "text"))


def p6_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows and tokens of each source."""
    counts = token_counts(table(spark, d, "documents").select("source", "text"))
    return counts.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return shares(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return shared_span_pairs(table(spark, d, "documents")).select(
        F.col("id_a").alias("doc_id_a"), F.col("id_b").alias("doc_id_b")
    )


def p8_shared(spark: SparkSession, d: str) -> DataFrame:
    """How much of each record stands in another one too."""
    return shared_characters(table(spark, d, "documents"))


QUERIES = {
    "p1_found": p1_found,
    "p1_by_source": p1_by_source,
    "p4_found": p4_found,
    "p4_repaired": p4_repaired,
    "p5_found": p5_found,
    "p5_restored": p5_restored,
    "p6_ids": p6_ids,
    "p6_counts": p6_counts,
    "p7_mix": p7_mix,
    "p7_shares": p7_shares,
    "p8_found": p8_found,
    "p8_shared": p8_shared,
}

#: Brute force: every window of 200 characters of every text.
_WINDOWS = """
WITH w AS (
  SELECT doc_id, i, substr(text, i, 200) AS s FROM documents, unnest(range(1, length(text) - 198)) AS t(i)
  WHERE length(text) >= 200),
k AS (SELECT s FROM w GROUP BY s HAVING count(DISTINCT doc_id) > 1),
h AS (SELECT DISTINCT doc_id, i, s FROM w SEMI JOIN k USING (s))
"""
ORACLES: dict[str, str] = {
    "p8_found": _WINDOWS
    + "SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM h a JOIN h b ON a.s = b.s AND a.doc_id < b.doc_id",
    "p8_shared": _WINDOWS
    + """, f AS (
  SELECT doc_id, i, coalesce(max(i + 200) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS far
  FROM h),
c AS (SELECT doc_id, sum(i + 200 - greatest(i, far)) AS n FROM f GROUP BY doc_id)
SELECT d.doc_id, length(d.text)::BIGINT AS n_chars, coalesce(c.n, 0)::BIGINT AS shared_chars FROM documents d LEFT JOIN c USING (doc_id)""",
}
