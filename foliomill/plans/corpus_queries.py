"""Queries of the general training-data operators: snapshot changes (p2) and compaction (p3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.operators.compaction import compact
from foliomill.operators.snapshots import snapshot_changes
from foliomill.runtime import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshot_changes(table(spark, d, "checkpoint_snapshots"))


def p2_change_counts(spark: SparkSession, d: str) -> DataFrame:
    return p2_found(spark, d).groupBy("snapshot_no", "change_kind").agg(F.count(F.lit(1)).alias("n_keys"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _compact(spark, d).dropped.select("object_key", "line_no")


def p3_records(spark: SparkSession, d: str) -> DataFrame:
    """Each checkpoint record once: the copy that comes first."""
    return _compact(spark, d).records.select("object_key", "line_no", F.length("line_text").cast("bigint").alias("n_chars"))


def p3_journal(spark: SparkSession, d: str) -> DataFrame:
    """What each level of merges read and wrote."""
    return (
        _compact(spark, d)
        .journal.groupBy("level")
        .agg(
            F.count(F.lit(1)).alias("merges"),
            F.sum("inputs").alias("files_in"),
            F.sum("input_bytes").alias("bytes_in"),
            F.sum("records_in").alias("records_in"),
            F.sum("records_out").alias("records_out"),
        )
    )


def _compact(spark: SparkSession, d: str):
    return compact(table(spark, d, "object_lines"), table(spark, d, "stored_objects"))


QUERIES = {
    "p2_found": p2_found,
    "p2_change_counts": p2_change_counts,
    "p3_found": p3_found,
    "p3_records": p3_records,
    "p3_journal": p3_journal,
}

_P2 = r"""
WITH c AS (
  SELECT snapshot_no, regexp_replace(source_identifier, '^\s+|\s+$', '', 'g') AS source_identifier,
         regexp_replace(document_url, '^\s+|\s+$', '', 'g') AS u,
         lower(regexp_replace(sha256, '^\s+|\s+$', '', 'g')) AS sha256, recorded_at, delivered_at
  FROM checkpoint_snapshots WHERE snapshot_no IS NOT NULL),
n AS (
  SELECT snapshot_no, source_identifier, sha256, recorded_at, delivered_at,
         CASE WHEN regexp_matches(u, '^[A-Za-z][A-Za-z0-9+.-]*://')
              THEN lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*'))
                   || substr(u, length(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*')) + 1)
              ELSE u END AS document_url
  FROM c),
l AS (
  SELECT snapshot_no, source_identifier, document_url, sha256 FROM n
  QUALIFY row_number() OVER (PARTITION BY snapshot_no, source_identifier, document_url
                             ORDER BY recorded_at DESC NULLS LAST, delivered_at DESC NULLS LAST) = 1),
pairs AS (SELECT snapshot_no, lag(snapshot_no) OVER (ORDER BY snapshot_no) AS before
          FROM (SELECT DISTINCT snapshot_no FROM l)),
o AS (SELECT p.snapshot_no, source_identifier, document_url, sha256 FROM l JOIN pairs p ON l.snapshot_no = p.before),
w AS (SELECT l.* FROM l JOIN pairs p USING (snapshot_no) WHERE p.before IS NOT NULL),
j AS (
  SELECT coalesce(w.snapshot_no, o.snapshot_no) AS snapshot_no,
         CASE WHEN w.snapshot_no IS NULL THEN o.source_identifier ELSE w.source_identifier END AS source_identifier,
         CASE WHEN w.snapshot_no IS NULL THEN o.document_url ELSE w.document_url END AS document_url,
         CASE WHEN o.snapshot_no IS NULL THEN 'added' WHEN w.snapshot_no IS NULL THEN 'removed'
              WHEN w.sha256 IS DISTINCT FROM o.sha256 THEN 'changed' END AS change_kind
  FROM w FULL JOIN o ON w.snapshot_no = o.snapshot_no AND w.source_identifier IS NOT DISTINCT FROM o.source_identifier
   AND w.document_url IS NOT DISTINCT FROM o.document_url)
"""

_P3 = """
WITH p AS (
  SELECT object_key, line_no, line_text, CASE WHEN json_valid(line_text) THEN line_text::JSON END AS j FROM object_lines),
r AS (
  SELECT object_key, line_no, line_text,
         [j->>'byte_count', j->>'content_type', j->>'document_url', j->>'error_type', j->>'file_extension', j->>'object_key',
          j->>'reason', j->>'sha256', j->>'source_identifier', j->>'status',
          epoch_us((j->>'recorded_at')::TIMESTAMPTZ)::VARCHAR] AS record
  FROM p WHERE json_type(j) = 'OBJECT'),
k AS (SELECT *, row_number() OVER (PARTITION BY record ORDER BY encode(object_key), line_no) AS rn FROM r)
"""

#: Tier by tier: files of like size in key order, packed by the bytes before them; the sizes are those of Tiers().
_JOURNAL = """,
s AS (SELECT object_key, count(*) FILTER (record IS NOT NULL) AS records, sum(coalesce(octet_length(encode(line_text)), 0) + 1) AS held
      FROM (SELECT p.object_key, p.line_no, p.line_text, r.record FROM p LEFT JOIN r ON p.object_key = r.object_key AND p.line_no = r.line_no)
      GROUP BY object_key),
o AS (SELECT key, arg_max(coalesce(size, 0), (listed_at, last_modified, size)) AS listed FROM stored_objects GROUP BY key),
f AS (SELECT object_key, records, coalesce(listed, held) AS bytes FROM s LEFT JOIN o ON s.object_key = o.key),
b1 AS (SELECT *, floor(coalesce(sum(greatest(bytes, 64)) OVER (ORDER BY encode(object_key) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 4194304)
              AS slot FROM f WHERE bytes <= 65536),
m1 AS (SELECT slot, count(*) AS inputs, sum(bytes) AS input_bytes, sum(records) AS records_in FROM b1 GROUP BY slot HAVING count(*) > 1),
w1 AS (SELECT b1.slot, count(*) AS records_out, sum(octet_length(encode(k.line_text)) + 1) AS output_bytes
       FROM k JOIN b1 USING (object_key) JOIN m1 USING (slot) WHERE rn = 1 GROUP BY b1.slot),
l1 AS (SELECT m1.*, coalesce(records_out, 0) AS records_out, coalesce(output_bytes, 0) AS output_bytes FROM m1 LEFT JOIN w1 USING (slot)),
l2 AS (SELECT output_bytes AS bytes, records_out AS records FROM l1 WHERE output_bytes > 65536 AND output_bytes <= 4194304
       UNION ALL SELECT bytes, records FROM f WHERE bytes > 65536 AND bytes <= 4194304)
SELECT 1 AS level, count(*) AS merges, sum(inputs)::BIGINT AS files_in, sum(input_bytes)::BIGINT AS bytes_in, sum(records_in)::BIGINT AS records_in,
       sum(records_out)::BIGINT AS records_out FROM l1 HAVING count(*) > 0
UNION ALL SELECT 2, 1, count(*), sum(bytes)::BIGINT, sum(records)::BIGINT, sum(records)::BIGINT FROM l2 HAVING count(*) > 1 AND sum(bytes) < 134217728
"""

ORACLES = {
    "p2_found": _P2 + "SELECT * FROM j WHERE change_kind IS NOT NULL",
    "p2_change_counts": _P2
    + "SELECT snapshot_no, change_kind, count(*) AS n_keys FROM j WHERE change_kind IS NOT NULL GROUP BY ALL",
    "p3_found": _P3 + "SELECT object_key, line_no FROM k WHERE rn > 1",
    "p3_journal": _P3 + _JOURNAL,
    "p3_records": _P3 + "SELECT object_key, line_no, length(line_text) AS n_chars FROM k WHERE rn = 1",
}
