"""Reconciliation, upserts, resolution, lineage and time."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliomill.functions import hashing as H
from foliomill.operators import ledger as L
from foliomill.operators import lineage as G
from foliomill.operators.ranges import attach
from foliomill.operators.relational import of_last
from foliomill.plans.define import Book
from foliomill.runtime import table

book = Book()


def _snapshot(spark: SparkSession, d: str, n: int) -> DataFrame:
    """One row of each key of a snapshot: the latest."""
    rows = table(spark, d, "checkpoint_snapshots").where(F.col("snapshot_no") == n)
    best = F.max_by(F.struct("status", "sha256", "file_extension", "recorded_at"), F.struct("recorded_at", "delivered_at", F.coalesce("sha256", F.lit("")), "status"))
    return rows.groupBy("source_identifier", "document_url").agg(best.alias("b")).select("source_identifier", "document_url", "b.*")


_SNAPSHOT = """SELECT source_identifier, document_url, status, sha256, file_extension, recorded_at FROM checkpoint_snapshots WHERE snapshot_no = {n}
  QUALIFY row_number() OVER (PARTITION BY source_identifier, document_url ORDER BY recorded_at DESC, delivered_at DESC, coalesce(sha256, '') DESC, status DESC) = 1"""
_KEYS = ["source_identifier", "document_url"]


@book.add(
    "SET-01 SET-02 SET-03",
    """WITH e AS (SELECT DISTINCT source_artifact_id FROM source_artifacts), t AS (SELECT DISTINCT source_artifact_id FROM source_texts),
            o AS (SELECT DISTINCT source_artifact_id FROM documents)
       SELECT 'catalogued_not_read' AS name, source_artifact_id FROM e WHERE source_artifact_id NOT IN (SELECT source_artifact_id FROM t WHERE source_artifact_id IS NOT NULL)
       UNION ALL SELECT 'read_not_catalogued', source_artifact_id FROM t WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.source_artifact_id = t.source_artifact_id)
       UNION ALL SELECT 'used_not_catalogued', source_artifact_id FROM o WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.source_artifact_id = o.source_artifact_id)""",
)
def q_reachability(spark: SparkSession, d: str) -> DataFrame:
    sets = {n: table(spark, d, t) for n, t in (("catalog", "source_artifacts"), ("read", "source_texts"), ("used", "documents"))}
    wanted = {"catalogued_not_read": ("catalog", "read"), "read_not_catalogued": ("read", "catalog"), "used_not_catalogued": ("used", "catalog")}
    return L.differences(sets, wanted, "source_artifact_id")


@book.add(
    "SET-04 FLT-29",
    """WITH a AS (SELECT sha256, count(DISTINCT source_identifier) AS n FROM checkpoint_snapshots WHERE sha256 IS NOT NULL GROUP BY 1),
            k AS (SELECT source_identifier, document_url, count(DISTINCT lower(trim(sha256))) AS n FROM checkpoint_snapshots GROUP BY ALL)
       SELECT (SELECT count(*) FROM k WHERE n = 0) AS missing, (SELECT count(*) FROM k WHERE n > 1) AS ambiguous,
              (SELECT count(*) FROM a WHERE n > 1) AS shared, (SELECT count(*) FROM k WHERE n <> 1) = 0 AS complete""",
)
def q_completeness(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "checkpoint_snapshots")
    keys = rows.groupBy(*_KEYS).agg(F.count_distinct(F.lower(F.trim("sha256"))).alias("n"))
    shared = rows.where("sha256 is not null").groupBy("sha256").agg(F.count_distinct("source_identifier").alias("n")).where("n > 1")
    counts = keys.agg(F.count_if(F.col("n") == 0).alias("missing"), F.count_if(F.col("n") > 1).alias("ambiguous"))
    both = counts.crossJoin(F.broadcast(shared.agg(F.count(F.lit(1)).alias("shared"))))  # one row each
    return both.withColumn("complete", F.col("missing") + F.col("ambiguous") == 0)


@book.add(
    "SET-05 SRC-22 UPS-26",
    """WITH r AS (SELECT document_url, 'missing_storage' AS why, 0 AS p FROM checkpoint_snapshots WHERE snapshot_no = (SELECT max(snapshot_no) FROM checkpoint_snapshots) AND status = 'stored' AND object_key NOT IN (SELECT key FROM stored_objects)
                  UNION ALL SELECT document_url, 'not_stored', 1 FROM checkpoint_snapshots WHERE snapshot_no = (SELECT max(snapshot_no) FROM checkpoint_snapshots) AND status <> 'stored')
       SELECT document_url, why FROM r QUALIFY row_number() OVER (PARTITION BY document_url ORDER BY p) = 1""",
)
def q_reconcile_plan(spark: SparkSession, d: str) -> DataFrame:
    """What to fetch again: once for each url, a missing object before a failed fetch."""
    rows = of_last(table(spark, d, "checkpoint_snapshots"), "snapshot_no")
    keys = table(spark, d, "stored_objects").select(F.col("key").alias("object_key")).distinct()
    lost = rows.where("status = 'stored' and object_key is not null").join(keys, "object_key", "left_anti")
    both = lost.select("document_url", F.lit("missing_storage").alias("why"))
    both = both.unionAll(rows.where("status <> 'stored'").select("document_url", F.lit("not_stored").alias("why")))
    return both.groupBy("document_url").agg(F.min("why").alias("why"))


@book.add(
    "UPS-02 UPS-22 UPS-29",
    f"""WITH o AS ({_SNAPSHOT.format(n=1)}), n AS ({_SNAPSHOT.format(n=2)})
        SELECT coalesce(o.source_identifier, n.source_identifier) AS source_identifier, coalesce(o.document_url, n.document_url) AS document_url,
               coalesce(o.status, n.status) AS status, coalesce(o.sha256, n.sha256) AS sha256, coalesce(o.file_extension, n.file_extension) AS file_extension,
               coalesce(o.recorded_at, n.recorded_at) AS recorded_at FROM o FULL JOIN n ON o.source_identifier = n.source_identifier AND o.document_url = n.document_url""",
)
def q_upsert_keep_old(spark: SparkSession, d: str) -> DataFrame:
    return L.upsert(_snapshot(spark, d, 1), _snapshot(spark, d, 2), _KEYS, keep="old")


@book.add(
    "UPS-03 UPS-20",
    f"""WITH o AS ({_SNAPSHOT.format(n=1)}), n AS ({_SNAPSHOT.format(n=2)})
        SELECT coalesce(n.source_identifier, o.source_identifier) AS source_identifier, coalesce(n.document_url, o.document_url) AS document_url,
               coalesce(n.status, o.status) AS status, coalesce(n.sha256, o.sha256) AS sha256, coalesce(n.file_extension, o.file_extension) AS file_extension,
               coalesce(n.recorded_at, o.recorded_at) AS recorded_at FROM o FULL JOIN n ON o.source_identifier = n.source_identifier AND o.document_url = n.document_url""",
)
def q_upsert_keep_new(spark: SparkSession, d: str) -> DataFrame:
    return L.upsert(_snapshot(spark, d, 1), _snapshot(spark, d, 2), _KEYS, keep="new")


@book.add(
    "UPS-01 UPS-07 UPS-16 UPS-17 UPS-28 JOI-05 JOI-09",
    f"""WITH o AS ({_SNAPSHOT.format(n=1)}), n AS ({_SNAPSHOT.format(n=2)})
        SELECT source_identifier, document_url, status, sha256 FROM n WHERE NOT EXISTS
        (SELECT 1 FROM o WHERE o.source_identifier = n.source_identifier AND o.document_url = n.document_url)""",
)
def q_insert_ignore(spark: SparkSession, d: str) -> DataFrame:
    return L.insert_missing(_snapshot(spark, d, 1), _snapshot(spark, d, 2), _KEYS).select(*_KEYS, "status", "sha256")


@book.add(
    "UPS-04 UPS-05 WIN-01",
    """WITH r AS (SELECT DISTINCT source_identifier, document_url, status, recorded_at FROM checkpoint_snapshots),
       f AS (SELECT *, lag(status) OVER w AS b, row_number() OVER w AS n FROM r WINDOW w AS (PARTITION BY source_identifier, document_url ORDER BY recorded_at, status))
       SELECT source_identifier, document_url, status, recorded_at AS valid_from,
              lead(recorded_at) OVER (PARTITION BY source_identifier, document_url ORDER BY recorded_at, status) AS valid_to FROM f WHERE n = 1 OR b IS DISTINCT FROM status""",
)
def q_observe_history(spark: SparkSession, d: str) -> DataFrame:
    return L.history(table(spark, d, "checkpoint_snapshots"), _KEYS, "status", "recorded_at")


@book.add(
    "UPS-14 UPS-15",
    f"""WITH o AS ({_SNAPSHOT.format(n=7)}), n AS ({_SNAPSHOT.format(n=8)})
        SELECT n.source_identifier, n.document_url, coalesce(o.recorded_at, n.recorded_at) AS first_recorded,
               o.source_identifier IS NULL OR (o.sha256 IS NOT DISTINCT FROM n.sha256 AND o.status IS NOT DISTINCT FROM n.status) AS same
        FROM n LEFT JOIN o ON o.source_identifier = n.source_identifier AND o.document_url = n.document_url""",
)
def q_write_once(spark: SparkSession, d: str) -> DataFrame:
    """A time that is set once, and whether a repeated write carries the same content."""
    rows = L.full_merge(_snapshot(spark, d, 7), _snapshot(spark, d, 8), _KEYS).where("n is not null")
    same = F.col("o").isNull() | (F.col("o.sha256").eqNullSafe(F.col("n.sha256")) & F.col("o.status").eqNullSafe(F.col("n.status")))
    return rows.select(*_KEYS, F.coalesce("o.recorded_at", "n.recorded_at").alias("first_recorded"), same.alias("same"))


@book.add(
    "UPS-23 HSH-02",
    """SELECT source_artifact_id, CASE WHEN byte_count IS NULL THEN 'skip_unavailable' WHEN page_count IS NULL THEN 'inspect' WHEN EXISTS
         (SELECT 1 FROM source_texts t WHERE t.source_artifact_id = a.source_artifact_id) THEN 'reuse' ELSE 'normalize' END AS disposition,
       sha256(concat_ws(chr(10), coalesce(sha256, ''), 'v1', coalesce(file_extension, ''))) AS idempotency_key FROM source_artifacts a""",
)
def q_plan_disposition(spark: SparkSession, d: str) -> DataFrame:
    held = table(spark, d, "source_texts").select("source_artifact_id").distinct().withColumn("held", F.lit(True))
    rows = table(spark, d, "source_artifacts").join(held, "source_artifact_id", "left")
    kind = F.when(F.col("byte_count").isNull(), "skip_unavailable").when(F.col("page_count").isNull(), "inspect")
    kind = kind.when(F.col("held"), "reuse").otherwise("normalize")
    key = H.joined_hash("\n", F.col("sha256"), F.lit("v1"), F.col("file_extension"))
    return rows.select("source_artifact_id", kind.alias("disposition"), key.alias("idempotency_key"))


@book.add(
    "UPS-24",
    """WITH c AS (SELECT text_id, count(*) AS n, min(candidate_text) FILTER (adapter = 'visual_model') AS t FROM candidate_texts WHERE text_id IS NOT NULL GROUP BY 1)
       SELECT s.text_id, CASE WHEN s.text IS NULL THEN 'no_observation' WHEN n IS NULL THEN 'as_observed' WHEN n > 1 THEN 'ambiguous' ELSE 'corrected' END AS state,
              md5(CASE WHEN n = 1 THEN coalesce(t, s.text) ELSE s.text END) AS h FROM source_texts s LEFT JOIN c USING (text_id)""",
)
def q_text_resolution(spark: SparkSession, d: str) -> DataFrame:
    """The digest of each text as it is resolved; digests, not texts, go to the join."""
    visual = F.when(F.col("adapter") == "visual_model", F.md5("candidate_text"))
    cand = table(spark, d, "candidate_texts").where("text_id is not null").groupBy("text_id").agg(F.count(F.lit(1)).alias("n"), F.min(visual).alias("t"))
    rows = table(spark, d, "source_texts").select("text_id", F.md5("text").alias("own")).join(cand, "text_id", "left")
    state = F.when(F.col("own").isNull(), "no_observation").when(F.col("n").isNull(), "as_observed").when(F.col("n") > 1, "ambiguous").otherwise("corrected")
    return rows.select("text_id", state.alias("state"), F.when(F.col("n") == 1, F.coalesce("t", "own")).otherwise(F.col("own")).alias("h"))


@book.add(
    "UPS-25 TMP-07",
    """WITH c AS (SELECT decision_number, count(DISTINCT decision_date) AS n, min(decision_date) AS v, bool_or(lang = 'es') AS ok, count(DISTINCT source) AS k
                  FROM documents WHERE decision_date IS NOT NULL GROUP BY 1)
       SELECT decision_number, CASE WHEN n > 1 THEN 'conflict' WHEN ok THEN 'verified' WHEN k >= 2 THEN 'corroborated' ELSE 'unverified' END AS state,
              CASE WHEN n = 1 THEN v END AS value FROM c""",
)
def q_date_resolution(spark: SparkSession, d: str) -> DataFrame:
    return L.resolved(table(spark, d, "documents"), ["decision_number"], "decision_date", F.col("lang") == "es", "source")


@book.add(
    "UPS-31 AGG-21 AGG-44",
    """SELECT adapter, media_type, count(*) AS n_calls, count(DISTINCT text_id) AS n_texts, count(*) FILTER (candidate_text IS NULL) AS n_empty,
              sum(length(candidate_text))::BIGINT AS n_chars FROM candidate_texts GROUP BY ALL""",
)
def q_evidence_ledger(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "candidate_texts").groupBy("adapter", "media_type").agg(
        F.count(F.lit(1)).alias("n_calls"),
        F.count_distinct("text_id").alias("n_texts"),
        F.count_if(F.col("candidate_text").isNull()).alias("n_empty"),
        F.sum(F.length("candidate_text")).alias("n_chars"),
    )


def _part_edges(spark: SparkSession, d: str) -> DataFrame:
    """Each part derives from the one a third and from the one half its number: a graph of logarithmic depth."""
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("dst")).where("dst > 1")
    half, third = F.floor(F.col("dst") / 2).cast("bigint"), F.floor(F.col("dst") / 3).cast("bigint")
    return parts.select(F.explode(F.array(half, third)).alias("src"), "dst").where("src > 0")


_PART_EDGES = """SELECT DISTINCT src, dst FROM (SELECT p_partkey // 2 AS src, p_partkey AS dst FROM part UNION ALL SELECT p_partkey // 3, p_partkey FROM part)
                 WHERE src > 0 AND dst > 1"""


@book.add(
    "GRF-01 JOI-10",
    f"""WITH RECURSIVE e AS ({_PART_EDGES}), c(src, dst, depth) AS (SELECT src, dst, 1 FROM e UNION SELECT c.src, e.dst, c.depth + 1 FROM c JOIN e ON c.dst = e.src)
        SELECT src, dst, min(depth) AS depth FROM c GROUP BY ALL""",
)
def q_closure(spark: SparkSession, d: str) -> DataFrame:
    return G.closure(_part_edges(spark, d))


@book.add(
    "GRF-02",
    """WITH RECURSIVE e AS (SELECT DISTINCT n_nationkey AS src, (n_nationkey * 7 + n_regionkey) % 25 AS dst FROM nation),
       c(src, dst) AS (SELECT src, dst FROM e UNION SELECT c.src, e.dst FROM c JOIN e ON c.dst = e.src)
       SELECT DISTINCT src AS node FROM c WHERE src = dst""",
)
def q_cycle_check(spark: SparkSession, d: str) -> DataFrame:
    edges = table(spark, d, "nation").select(F.col("n_nationkey").alias("src"), ((F.col("n_nationkey") * 7 + F.col("n_regionkey")) % 25).alias("dst"))
    return G.on_cycles(G.closure(edges))


@book.add(
    "GRF-04",
    """WITH RECURSIVE t(node, path) AS (SELECT 1::BIGINT, '1' UNION ALL SELECT p_partkey, path || '.' || p_partkey FROM part JOIN t ON p_partkey // 8 = node WHERE p_partkey > 1)
       SELECT node, path FROM t""",
)
def q_provision_tree(spark: SparkSession, d: str) -> DataFrame:
    """Paths of a tree of parts by parent number, in recursive SQL."""
    return spark.sql(
        """WITH RECURSIVE t(node, path) AS (
             SELECT 1L, '1' UNION ALL
             SELECT p_partkey, concat(path, '.', p_partkey) FROM {nodes} JOIN t ON p_partkey div 8 = node WHERE p_partkey > 1)
           SELECT node, path FROM t""",
        nodes=table(spark, d, "part").select("p_partkey"),
    )


@book.add(
    "AGG-47 GRF-03",
    """WITH e AS (SELECT DISTINCT c_nationkey AS src, s_nationkey AS dst FROM customer, supplier WHERE c_custkey = s_suppkey),
       n AS (SELECT src AS node FROM e UNION SELECT dst FROM e)
       SELECT node, (SELECT count(*) FROM e WHERE src = node) AS n_out, (SELECT count(*) FROM e WHERE dst = node) AS n_in FROM n""",
)
def q_degree(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").join(table(spark, d, "supplier"), F.col("c_custkey") == F.col("s_suppkey"))
    return G.degrees(rows.select(F.col("c_nationkey").alias("src"), F.col("s_nationkey").alias("dst")))


@book.add(
    "GRF-06",
    """WITH a AS (SELECT DISTINCT source_identifier AS src, document_url AS dst FROM checkpoint_snapshots WHERE snapshot_no = 1),
            b AS (SELECT DISTINCT source_identifier AS src, document_url AS dst FROM checkpoint_snapshots WHERE snapshot_no = 8)
       SELECT src, dst, 'removed' AS change FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT src, dst, 'added' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def q_graph_diff(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "checkpoint_snapshots")
    at = lambda n: rows.where(F.col("snapshot_no") == n).select(F.col("source_identifier").alias("src"), F.col("document_url").alias("dst"))
    return G.edge_changes(at(1), at(8))


@book.add(
    "TMP-02 TMP-01",
    """WITH v AS (SELECT source_identifier, document_url, status, recorded_at AS valid_from, lead(recorded_at) OVER (PARTITION BY source_identifier, document_url ORDER BY recorded_at, delivered_at, snapshot_no, status, coalesce(sha256, '')) AS valid_to,
                  delivered_at AS known_from, min(delivered_at) OVER (PARTITION BY source_identifier, document_url ORDER BY delivered_at RANGE BETWEEN INTERVAL 1 MICROSECOND FOLLOWING AND UNBOUNDED FOLLOWING) AS known_to FROM checkpoint_snapshots)
       SELECT source_identifier, document_url, status, valid_from FROM v WHERE valid_from <= TIMESTAMP '2024-03-01' AND (valid_to IS NULL OR TIMESTAMP '2024-03-01' < valid_to)
         AND known_from <= TIMESTAMP '2024-03-20' AND (known_to IS NULL OR TIMESTAMP '2024-03-20' < known_to)""",
)
def q_bitemporal_asof(spark: SparkSession, d: str) -> DataFrame:
    """What was valid on one day as it was known on another; a row is known until the next delivery of its key."""
    order = Window.partitionBy(*_KEYS).orderBy("recorded_at", "delivered_at", "snapshot_no", "status", F.coalesce("sha256", F.lit("")))
    rows = table(spark, d, "checkpoint_snapshots")
    times = rows.select(*_KEYS, F.col("delivered_at").alias("known_from")).distinct()
    known = times.withColumn("known_to", F.lead("known_from").over(Window.partitionBy(*_KEYS).orderBy("known_from")))
    rows = rows.select(
        *_KEYS, "status", F.col("recorded_at").alias("valid_from"), F.lead("recorded_at").over(order).alias("valid_to"), F.col("delivered_at").alias("known_from")
    )
    return G.as_of(attach(rows, known, [*_KEYS, "known_from"]), datetime(2024, 3, 1), datetime(2024, 3, 20)).select(*_KEYS, "status", "valid_from")


@book.add(
    "GRF-01",
    """WITH RECURSIVE n AS (SELECT n_nationkey AS src, (n_nationkey * 7 + n_regionkey) % 25 AS dst FROM nation), o AS (SELECT src, dst FROM n WHERE src < dst),
       e AS (SELECT * FROM o UNION SELECT src, dst FROM n), c(src, dst) AS (SELECT src, dst FROM e UNION SELECT c.src, e.dst FROM c JOIN e ON c.dst = e.src)
       SELECT n.src, n.dst, n.src <> n.dst AND NOT EXISTS (SELECT 1 FROM c WHERE c.src = n.dst AND c.dst = n.src) AS accepted FROM n""",
)
def q_edges_without_cycles(spark: SparkSession, d: str) -> DataFrame:
    """Edges that may be added to those that only go up: what would close a cycle is rejected."""
    edges = table(spark, d, "nation").select(F.col("n_nationkey").alias("src"), ((F.col("n_nationkey") * 7 + F.col("n_regionkey")) % 25).alias("dst"))
    return G.without_cycles(edges.where("src < dst"), edges)


@book.add(
    "TMP-04 RET-09",
    """SELECT source, count(*) FILTER (decision_date < DATE '2000-01-01') AS n_before, count(*) FILTER (decision_date BETWEEN DATE '2000-01-01' AND DATE '2009-12-31') AS n_between,
              count(*) FILTER (decision_date > DATE '2009-12-31') AS n_after, max(decision_date) FILTER (decision_date <= DATE '2005-06-30') AS latest_as_of FROM documents GROUP BY 1""",
)
def q_date_filters(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("decision_date")
    return table(spark, d, "documents").groupBy("source").agg(
        F.count_if(day < date(2000, 1, 1)).alias("n_before"),
        F.count_if(day.between(date(2000, 1, 1), date(2009, 12, 31))).alias("n_between"),
        F.count_if(day > date(2009, 12, 31)).alias("n_after"),
        F.max(F.when(day <= date(2005, 6, 30), day)).alias("latest_as_of"),
    )


@book.add(
    "TMP-05 TMP-06",
    """SELECT d.doc_id, coalesce(m.first_id, d.doc_id) AS canonical, d.decision_date IS NULL AS date_missing FROM documents d LEFT JOIN
       (SELECT decision_number, min(doc_id) AS first_id FROM documents WHERE decision_date IS NOT NULL AND decision_number IS NOT NULL GROUP BY 1) m USING (decision_number)""",
)
def q_entity_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Each document under the first one with its decision number that has a date as evidence; else under itself."""
    docs = table(spark, d, "documents").select("doc_id", "decision_number", "decision_date")
    first = docs.where("decision_date is not null and decision_number is not null").groupBy("decision_number").agg(F.min("doc_id").alias("first_id"))
    rows = docs.join(first, "decision_number", "left")
    return rows.select("doc_id", F.coalesce("first_id", "doc_id").alias("canonical"), F.col("decision_date").isNull().alias("date_missing"))
