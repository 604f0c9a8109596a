"""Filters, joins, pages and choices of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliomill.functions import text as T
from foliomill.operators import relational as R
from foliomill.operators.ranges import attach, percentiles
from foliomill.plans.define import Book
from foliomill.runtime import table

book = Book()


@book.add(
    "FLT-09 STR-14 AGG-05",
    r"""
    WITH f AS (
      SELECT lang, source, n_chars, text,
        CASE WHEN text IS NULL OR trim(regexp_replace(text, '\s+', ' ', 'g')) = '' THEN 1 ELSE 0 END AS blank,
        CASE WHEN length(text) > 0 AND length(text) - length(replace(text, chr(65533), '')) > 0.001 * length(text) THEN 1 ELSE 0 END AS lost
      FROM documents)
    SELECT lang, source, count(*) AS n_docs, sum(blank)::BIGINT AS n_empty, sum(lost)::BIGINT AS n_replacement,
           round(avg(n_chars), 6) AS mean_chars, round(quantile_cont(n_chars, 0.95), 6) AS p95_chars
    FROM f GROUP BY lang, source""",
)
def q_document_quality_report(spark: SparkSession, d: str) -> DataFrame:
    docs, key = table(spark, d, "documents"), ["lang", "source"]
    rows = docs.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(T.is_blank(F.col("text"))).alias("n_empty"),
        F.count_if(T.has_replacements(F.col("text"))).alias("n_replacement"),
        F.round(F.avg("n_chars"), 6).alias("mean_chars"),
    )
    ranks = percentiles(docs, key, "n_chars", p95_chars=("linear", 0.95))
    return attach(rows, ranks, key, "left").withColumn("p95_chars", F.round("p95_chars", 6))


@book.add(
    "SRT-01 SRT-19 FLT-01 TMP-01",
    """SELECT o_orderkey, o_custkey, o_totalprice, true AS has_more FROM orders
       WHERE o_orderkey > 500 AND o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 25""",
)
def q_keyset_page(spark: SparkSession, d: str) -> DataFrame:
    rows = R.where_given(table(spark, d, "orders"), o_orderstatus="F", o_orderpriority=None)
    return R.key_page(rows, "o_orderkey", 500, 25).select("o_orderkey", "o_custkey", "o_totalprice", "has_more")


@book.add(
    "SRT-02 FLT-02 SRC-57",
    """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus <> 'P'
       AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
       ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey LIMIT 50""",
)
def q_topk_recency(spark: SparkSession, d: str) -> DataFrame:
    able = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    rows = table(spark, d, "orders").where("o_orderstatus <> 'P'").join(able, "o_custkey", "left_semi")
    return rows.orderBy(F.desc_nulls_first("o_orderdate"), "o_orderkey").limit(50).select("o_orderkey", "o_orderdate")


@book.add(
    "SRT-20",
    """SELECT source_artifact_id, collection, page_count FROM source_artifacts WHERE source_artifact_id = 'art-000000003'""",
)
def q_point_lookup(spark: SparkSession, d: str) -> DataFrame:
    rows = R.where_given(table(spark, d, "source_artifacts"), source_artifact_id="art-000000003", collection=None)
    return rows.select("source_artifact_id", "collection", "page_count")


@book.add(
    "JOI-01 JOI-18",
    """SELECT c_mktsegment, o_orderpriority, count(*) AS n_lines, count(DISTINCT o_orderkey) AS n_orders,
              round(sum(l_extendedprice), 2) AS total FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)
def q_three_way_join(spark: SparkSession, d: str) -> DataFrame:
    lines, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.groupBy("c_mktsegment", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_distinct("o_orderkey").alias("n_orders"), F.round(F.sum("l_extendedprice"), 2).alias("total")
    )


@book.add(
    "JOI-02",
    """SELECT a.source_artifact_id, a.source, t.text_id FROM source_artifacts a LEFT JOIN source_texts t USING (source_artifact_id)""",
)
def q_left_join_registry(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "source_texts").select("source_artifact_id", "text_id")
    return table(spark, d, "source_artifacts").join(texts, "source_artifact_id", "left").select("source_artifact_id", "source", "text_id")


@book.add(
    "JOI-03 SRT-06 SRT-20",
    """SELECT o_orderkey, l_linenumber, l_extendedprice FROM orders LEFT JOIN
       (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_returnflag = 'R' DESC, l_extendedprice DESC, l_linenumber) = 1) ON l_orderkey = o_orderkey""",
)
def q_lateral_preferred(spark: SparkSession, d: str) -> DataFrame:
    best = R.latest(
        table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag"),
        ["l_orderkey"],
        (F.col("l_returnflag") == "R").desc(),
        F.desc("l_extendedprice"),
        F.asc("l_linenumber"),
    )
    orders = table(spark, d, "orders").select("o_orderkey")
    return orders.join(best, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "l_linenumber", "l_extendedprice")


@book.add(
    "JOI-04",
    """SELECT source_artifact_id, EXISTS (SELECT 1 FROM source_texts t WHERE t.source_artifact_id = a.source_artifact_id) AS has_text
       FROM source_artifacts a""",
)
def q_exists_mark(spark: SparkSession, d: str) -> DataFrame:
    artifacts = table(spark, d, "source_artifacts").select("source_artifact_id")
    return R.with_mark(artifacts, table(spark, d, "source_texts"), ["source_artifact_id"], "has_text")


@book.add(
    "JOI-05 SET-02 SRC-27 UPS-01",
    """SELECT DISTINCT key FROM stored_objects WHERE starts_with(key, '_checkpoints/')
       AND NOT EXISTS (SELECT 1 FROM object_lines WHERE object_key = key)""",
)
def q_anti_missing(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "stored_objects").where(F.col("key").startswith("_checkpoints/")).select("key").distinct()
    held = table(spark, d, "object_lines").select(F.col("object_key").alias("key"))
    return keys.join(held, "key", "left_anti")


@book.add(
    "JOI-06",
    """SELECT a.text_id AS text_id, b.candidate_id FROM source_texts a JOIN (
         SELECT c.candidate_id, s.source_artifact_id, s.page_index FROM candidate_texts c JOIN source_texts s USING (text_id)) b
       ON a.source_artifact_id IS NOT DISTINCT FROM b.source_artifact_id AND a.page_index IS NOT DISTINCT FROM b.page_index
       WHERE a.page_index IS NULL""",
)
def q_null_safe_match(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "source_texts").select("text_id", "source_artifact_id", "page_index")
    cand = table(spark, d, "candidate_texts").select("candidate_id", "text_id").join(texts, "text_id").drop("text_id")
    # the equality on the artifact keeps this a hash join; the page may be null on both sides
    rows = R.null_safe(texts.where("page_index is null"), cand, ["source_artifact_id", "page_index"])
    return rows.select("text_id", "candidate_id")


@book.add(
    "JOI-08 GRF-03 TMP-01",
    """WITH e AS (SELECT DISTINCT c_nationkey AS src, s_nationkey AS dst FROM customer JOIN orders ON o_custkey = c_custkey
         JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey)
       SELECT n_nationkey, src, dst FROM nation JOIN e ON src = n_nationkey OR dst = n_nationkey""",
)
def q_endpoint_relations(spark: SparkSession, d: str) -> DataFrame:
    return R.either_end(_nation_edges(spark, d), table(spark, d, "nation"), "src", "dst", "n_nationkey").select("n_nationkey", "src", "dst")


def _nation_edges(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("src")), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("dst")), F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.select("src", "dst").distinct()


@book.add(
    "JOI-12 SET-06",
    """WITH a AS (SELECT DISTINCT text_id FROM source_texts), b AS (SELECT DISTINCT text_id FROM candidate_texts WHERE text_id IS NOT NULL)
       SELECT CASE WHEN b.text_id IS NULL THEN 'left' WHEN a.text_id IS NULL THEN 'right' ELSE 'both' END AS side, count(*) AS n
       FROM a FULL JOIN b ON a.text_id = b.text_id GROUP BY 1""",
)
def q_full_outer_match(spark: SparkSession, d: str) -> DataFrame:
    cand = table(spark, d, "candidate_texts").where("text_id is not null")
    return R.matched(table(spark, d, "source_texts"), cand, ["text_id"]).groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@book.add(
    "JOI-13 RET-08",
    """WITH w AS (SELECT DISTINCT source_artifact_id, page_index FROM source_texts WHERE page_index IS NOT NULL AND source = 'doctrina'),
            r AS (SELECT DISTINCT source_artifact_id, page_index FROM source_texts WHERE page_index IS NOT NULL),
            a AS (SELECT source_artifact_id, page_index AS "at", unnest(range(page_index - 1, page_index + 2)) AS page_index FROM w)
       SELECT a.source_artifact_id, "at", a.page_index::INT AS page_index, r.page_index IS NOT NULL AS found FROM a LEFT JOIN r
       ON a.source_artifact_id = r.source_artifact_id AND a.page_index = r.page_index""",
)
def q_neighbour_pages(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "source_texts").where("page_index is not null")
    wanted = pages.where("source = 'doctrina'").select("source_artifact_id", "page_index").distinct()
    return R.neighbours(wanted, pages, "source_artifact_id", "page_index", 1).select("source_artifact_id", "at", "page_index", "found")


@book.add(
    "JOI-14",
    """SELECT source_artifact_id, page_index, n AS next_page_index, abs(l - length(text)) AS difference FROM (
         SELECT source_artifact_id, page_index, text, lead(page_index) OVER w AS n, lead(length(text)) OVER w AS l
         FROM source_texts WHERE page_index IS NOT NULL WINDOW w AS (PARTITION BY source_artifact_id ORDER BY page_index, text_id))
       WHERE n IS NOT NULL""",
)
def q_adjacent_pages(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "source_texts").where("page_index is not null")
    order = Window.partitionBy("source_artifact_id").orderBy("page_index", "text_id")
    rows = rows.select(
        "source_artifact_id",
        "page_index",
        F.lead("page_index").over(order).alias("next_page_index"),
        F.abs(F.lead(F.length("text")).over(order) - F.length("text")).cast("bigint").alias("difference"),
    )
    return rows.where("next_page_index is not null")


@book.add(
    "JOI-15",
    """WITH p AS (SELECT o_orderkey, list(l_partkey ORDER BY l_linenumber) AS parts, list(l_quantity ORDER BY l_linenumber) AS amounts
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
       SELECT o_orderkey, i::INT AS place, parts[i] AS part, amounts[i] AS amount FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM p)""",
)
def q_zip_join(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").join(table(spark, d, "orders").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    place = F.row_number().over(Window.partitionBy("o_orderkey").orderBy("l_linenumber"))
    numbered = rows.select("o_orderkey", "l_partkey", "l_quantity", place.alias("place"))
    parts = numbered.select("o_orderkey", "place", F.col("l_partkey").alias("part"))
    amounts = numbered.select("o_orderkey", "place", F.col("l_quantity").alias("amount"))
    return parts.join(amounts, ["o_orderkey", "place"])


@book.add(
    "JOI-16 JOI-17 AGG-42",
    """SELECT text_id, count(*) FILTER (adapter = 'pdf_aware') AS pdf_aware, count(*) FILTER (adapter = 'full_ocr') AS full_ocr,
              count(*) FILTER (adapter = 'visual_model') AS visual_model FROM candidate_texts GROUP BY text_id""",
)
def q_model_pivot(spark: SparkSession, d: str) -> DataFrame:
    names = ["pdf_aware", "full_ocr", "visual_model"]
    rows = table(spark, d, "candidate_texts").groupBy("text_id").pivot("adapter", names).count()
    return rows.fillna(0, names)


@book.add(
    "ARR-01",
    """WITH r AS (SELECT source_artifact_id, min(page_index) AS first, max(page_index) AS last
                  FROM source_texts WHERE page_index IS NOT NULL GROUP BY 1),
            a AS (SELECT *, unnest(range(first, last + 1)) AS p FROM r),
            h AS (SELECT DISTINCT source_artifact_id, page_index FROM source_texts)
       SELECT a.source_artifact_id, first, last, count(h.page_index) AS n_found,
              coalesce(list_sort(list(p::INT) FILTER (h.page_index IS NULL)), []) AS missing
       FROM a LEFT JOIN h ON a.source_artifact_id = h.source_artifact_id AND p = h.page_index GROUP BY ALL""",
)
def q_page_range_lookup(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "source_texts").where("page_index is not null")
    ranges = pages.groupBy("source_artifact_id").agg(F.min("page_index").alias("first"), F.max("page_index").alias("last"))
    return R.range_lookup(ranges, pages, "source_artifact_id", "page_index")


@book.add(
    "WIN-01 SRC-14 SRC-15 SRC-50",
    """SELECT source_identifier, document_url, status, recorded_at FROM checkpoint_snapshots
       QUALIFY row_number() OVER (PARTITION BY source_identifier, document_url ORDER BY recorded_at DESC NULLS LAST,
       snapshot_no DESC, delivered_at DESC, coalesce(sha256, '') DESC, status DESC) = 1""",
)
def q_latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    order = [F.desc(c) for c in ("recorded_at", "snapshot_no", "delivered_at")]
    order += [F.coalesce("sha256", F.lit("")).desc(), F.desc("status")]
    rows = R.latest(table(spark, d, "checkpoint_snapshots"), ["source_identifier", "document_url"], *order)
    return rows.select("source_identifier", "document_url", "status", "recorded_at")


@book.add(
    "SRT-04",
    """SELECT authority, text_id FROM source_texts WHERE len(risk_flags) > 0
       QUALIFY row_number() OVER (PARTITION BY authority ORDER BY text_id) <= 5""",
)
def q_first_examples(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "source_texts").where(F.size("risk_flags") > 0).select("authority", "text_id")
    place = F.row_number().over(Window.partitionBy("authority").orderBy("text_id"))
    return rows.withColumn("n", place).where("n <= 5").drop("n")


@book.add(
    "SRT-07",
    """SELECT source_artifact_id, text_id, authority FROM source_texts QUALIFY row_number() OVER (PARTITION BY source_artifact_id
       ORDER BY CASE authority WHEN 'html_publication' THEN 0 WHEN 'docx_body_text' THEN 1 WHEN 'pdf_native_text_layer' THEN 2 ELSE 3 END,
       length(text) DESC NULLS LAST, text_id) = 1""",
)
def q_priority_choice(spark: SparkSession, d: str) -> DataFrame:
    ranks = {"html_publication": 0, "docx_body_text": 1, "pdf_native_text_layer": 2}
    rank = F.coalesce(*[F.when(F.col("authority") == k, v) for k, v in ranks.items()], F.lit(3))
    rows = table(spark, d, "source_texts").select("source_artifact_id", "text_id", "authority", rank.alias("r"), F.length("text").alias("n"))
    return R.latest(rows, ["source_artifact_id"], F.asc("r"), F.desc_nulls_last("n"), F.asc("text_id")).drop("r", "n")


@book.add(
    "FLT-03 FLT-04 FLT-05 UPS-30",
    """SELECT source, collection, count(*) AS n, count(*) FILTER (file_extension = 'pdf' OR collection = 'bulletins') AS n_permitted
       FROM source_artifacts WHERE source IN ('sala_civil', 'sala_penal', 'tribunal_constitucional') GROUP BY ALL""",
)
def q_scope_policy(spark: SparkSession, d: str) -> DataFrame:
    scope = ["sala_civil", "sala_penal", "tribunal_constitucional"]
    permitted = (F.col("file_extension") == "pdf") | (F.col("collection") == "bulletins")
    rows = table(spark, d, "source_artifacts").where(F.col("source").isin(scope))
    return rows.groupBy("source", "collection").agg(F.count(F.lit(1)).alias("n"), F.count_if(permitted).alias("n_permitted"))


@book.add(
    "FLT-28 SET-06",
    """SELECT source, 'not_in_targets' AS drift FROM (SELECT DISTINCT source FROM source_artifacts EXCEPT SELECT source FROM mix_targets)
       UNION ALL SELECT source, 'not_in_artifacts' FROM (SELECT source FROM mix_targets EXCEPT SELECT source FROM source_artifacts)""",
)
def q_reference_drift(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "source_artifacts").select("source").distinct()
    b = table(spark, d, "mix_targets").select("source").distinct()
    left = a.exceptAll(b).withColumn("drift", F.lit("not_in_targets"))
    return left.unionAll(b.exceptAll(a).withColumn("drift", F.lit("not_in_artifacts")))
