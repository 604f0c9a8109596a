"""Runs, segments, packings, samples and shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliomill.functions import hashing as H
from foliomill.functions import text as T
from foliomill.operators import sequence as S
from foliomill.operators.ranges import placed, placed_within
from foliomill.plans.define import Book
from foliomill.runtime import table

book = Book()


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "source_texts").where("page_index is not null")


@book.add(
    "WIN-02",
    """WITH p AS (SELECT DISTINCT source_artifact_id, page_index FROM source_texts WHERE page_index IS NOT NULL),
            g AS (SELECT *, page_index - row_number() OVER (PARTITION BY source_artifact_id ORDER BY page_index) AS k FROM p)
       SELECT source_artifact_id, min(page_index) AS first, max(page_index) AS last, count(*) AS length FROM g GROUP BY source_artifact_id, k""",
)
def q_runs(spark: SparkSession, d: str) -> DataFrame:
    return S.runs(_pages(spark, d), ["source_artifact_id"], "page_index")


@book.add(
    "WIN-03",
    """WITH e AS (SELECT user_id, event_id, CASE WHEN value >= 20 THEN event_type END AS label FROM events),
       k AS (SELECT *, last_value(label IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
               first_value(label IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS a,
               count(label) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM e),
       n AS (SELECT *, count(*) FILTER (label IS NULL) OVER (PARTITION BY user_id, g) AS gap FROM k)
       SELECT user_id, event_id, CASE WHEN label IS NULL AND a = b AND gap <= 2 THEN b ELSE label END AS label FROM n""",
)
def q_gap_bridge(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("user_id", "event_id", F.when(F.col("value") >= 20, F.col("event_type")).alias("label"))
    return S.bridged(rows, ["user_id"], "event_id", "label", 2)


@book.add(
    "WIN-04 WIN-07",
    """WITH s AS (SELECT DISTINCT t.source_artifact_id, page_index AS first, page_count FROM source_texts t JOIN source_artifacts a
                  ON a.source_artifact_id = t.source_artifact_id WHERE page_index IS NOT NULL AND contains(text, 'SENTENCIA NÚM'))
       SELECT source_artifact_id, first, coalesce(lead(first) OVER (PARTITION BY source_artifact_id ORDER BY first) - 1, page_count - 1) AS last FROM s""",
)
def q_segments_lead(spark: SparkSession, d: str) -> DataFrame:
    starts = _pages(spark, d).where(F.contains("text", F.lit("SENTENCIA NÚM"))).select("source_artifact_id", F.col("page_index").alias("first"))
    sizes = table(spark, d, "source_artifacts").select("source_artifact_id", "page_count")
    rows = starts.distinct().join(sizes, "source_artifact_id")
    return S.between_starts(rows, ["source_artifact_id"], "first", F.col("page_count") - 1).select("source_artifact_id", "first", "last")


@book.add(
    "WIN-05",
    """WITH p AS (SELECT source_artifact_id, page_index, min(authority) AS authority FROM source_texts WHERE page_index IS NOT NULL GROUP BY ALL),
       f AS (SELECT *, CASE WHEN lag(authority) OVER w IS DISTINCT FROM authority OR page_index - lag(page_index) OVER w <> 1 THEN 1 ELSE 0 END AS fresh
             FROM p WINDOW w AS (PARTITION BY source_artifact_id ORDER BY page_index)),
       g AS (SELECT *, sum(fresh) OVER (PARTITION BY source_artifact_id ORDER BY page_index) AS segment FROM f)
       SELECT source_artifact_id, segment::BIGINT AS segment, min(authority) AS authority, min(page_index) AS first, max(page_index) AS last, count(*) AS n
       FROM g GROUP BY source_artifact_id, segment""",
)
def q_segments_change(spark: SparkSession, d: str) -> DataFrame:
    pages = _pages(spark, d).groupBy("source_artifact_id", "page_index").agg(F.min("authority").alias("authority"))
    return S.change_segments(pages, ["source_artifact_id"], "page_index", "authority")


@book.add(
    "WIN-08",
    """WITH f AS (SELECT user_id, event_id, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END AS fresh FROM events),
       g AS (SELECT user_id, sum(fresh) OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM f),
       n AS (SELECT user_id, k, count(*) AS n FROM g GROUP BY ALL) SELECT user_id, max(n) AS longest FROM n GROUP BY 1""",
)
def q_longest_repeat(spark: SparkSession, d: str) -> DataFrame:
    return S.longest_repeat(table(spark, d, "events"), ["user_id"], "event_id", "event_type")


@book.add(
    "WIN-09 STR-07 JOI-14",
    r"""WITH t AS (SELECT source_artifact_id, page_index, text_id, list_distinct(list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+(?:[./-][\p{L}\p{N}_]+)*'), lambda x: length(x) >= 2)) AS w
                   FROM source_texts WHERE page_index IS NOT NULL AND text IS NOT NULL),
            n AS (SELECT *, lead(text_id) OVER o AS next_text_id, lead(w) OVER o AS nw FROM t WINDOW o AS (PARTITION BY source_artifact_id ORDER BY page_index, text_id))
        SELECT text_id, next_text_id, round(CASE WHEN len(list_distinct(list_concat(w, nw))) = 0 THEN 0 ELSE len(list_intersect(w, nw)) / len(list_distinct(list_concat(w, nw))) END, 6) AS similarity
        FROM n WHERE next_text_id IS NOT NULL""",
)
def q_adjacent_jaccard(spark: SparkSession, d: str) -> DataFrame:
    """Neighbours are found on ids alone, by place over the whole order; the words of both go to the pair by text."""
    pages = _pages(spark, d).where("text is not null")
    rows = placed(pages.select("source_artifact_id", "page_index", "text_id"), F.asc("source_artifact_id"), F.asc("page_index"), F.asc("text_id"))
    after = rows.select((F.col("place") - 1).alias("place"), F.col("source_artifact_id").alias("a"), F.col("text_id").alias("next_text_id"))
    pairs = rows.join(after, "place").where(F.col("source_artifact_id").eqNullSafe(F.col("a"))).select("text_id", "next_text_id")
    words = pages.select("text_id", T.token_set(F.col("text")).alias("w"))
    both = pairs.join(words, "text_id").join(words.toDF("next_text_id", "v"), "next_text_id")
    return both.select("text_id", "next_text_id", F.round(T.jaccard(F.col("w"), F.col("v")), 6).alias("similarity"))


@book.add(
    "WIN-10",
    """WITH p AS (SELECT source_artifact_id, page_index, text_id, md5(text) AS h FROM source_texts WHERE page_index IS NOT NULL AND length(text) > 0),
       f AS (SELECT *, CASE WHEN lag(h) OVER w = h THEN 0 ELSE 1 END AS fresh FROM p WINDOW w AS (PARTITION BY source_artifact_id ORDER BY page_index, text_id)),
       g AS (SELECT *, sum(fresh) OVER (PARTITION BY source_artifact_id ORDER BY page_index, text_id) AS k FROM f)
       SELECT source_artifact_id, min(text_id) AS first_text, count(*) AS n FROM g GROUP BY source_artifact_id, k""",
)
def q_duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    """Neighbouring pages with the same text are one scan group."""
    order = Window.partitionBy("source_artifact_id").orderBy("page_index", "text_id")
    rows = _pages(spark, d).where(F.length("text") > 0).select("source_artifact_id", "page_index", "text_id", F.md5("text").alias("h"))
    rows = rows.withColumn("f", F.when(F.lag("h").over(order) == F.col("h"), 0).otherwise(1))
    rows = rows.withColumn("k", F.sum("f").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("source_artifact_id", "k").agg(F.min("text_id").alias("first_text"), F.count(F.lit(1)).alias("n")).drop("k")


@book.add("WIN-12 MAT-02")
def q_token_batches(spark: SparkSession, d: str) -> DataFrame:
    """Rows of an artifact in batches of at most 2,000 estimated tokens and 8 texts, in order."""
    rows = table(spark, d, "source_texts").select(
        "source_artifact_id", "text_id", F.greatest(F.lit(1), F.ceil(F.octet_length("text") / 3)).cast("bigint").alias("cost")
    )
    return S.pack(rows, "source_artifact_id", "text_id", "cost", 2000, 8)


@book.add(
    "WIN-14",
    """SELECT source, source_artifact_id, page_count FROM (SELECT *, sum(page_count) OVER (PARTITION BY source ORDER BY page_count DESC, source_artifact_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - page_count AS before FROM source_artifacts WHERE page_count IS NOT NULL) WHERE before < 200""",
)
def q_budget_selection(spark: SparkSession, d: str) -> DataFrame:
    """The largest artifacts of each source until 200 pages are reached."""
    rows = table(spark, d, "source_artifacts").where("page_count is not null").select("source", "source_artifact_id", "page_count")
    rows = placed_within(rows, ["source"], F.desc("page_count"), F.asc("source_artifact_id"), value=F.col("page_count"))
    return rows.where("before < 200").select("source", "source_artifact_id", "page_count")


@book.add(
    "WIN-16 WIN-17",
    """SELECT source, source_artifact_id, row_number() OVER (PARTITION BY source ORDER BY page_count DESC NULLS LAST, source_artifact_id) AS turn FROM source_artifacts""",
)
def q_round_robin(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "source_artifacts").select("source", "source_artifact_id", "page_count")
    return S.round_robin(rows, "source", F.desc_nulls_last("page_count"), F.asc("source_artifact_id")).drop("page_count")


@book.add(
    "WIN-18",
    """WITH g AS (SELECT source_identifier, snapshot_no, recorded_at, status = 'failed' AS bad, count(*) FILTER (status <> 'failed') OVER
                  (PARTITION BY source_identifier ORDER BY snapshot_no, recorded_at, document_url, sha256 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM checkpoint_snapshots),
       n AS (SELECT source_identifier, k, count(*) AS n FROM g WHERE bad GROUP BY ALL) SELECT source_identifier, max(n) >= 5 AS open FROM n GROUP BY 1""",
)
def q_circuit_breaker(spark: SparkSession, d: str) -> DataFrame:
    """Whether five failures in a row have opened the breaker of a key. A key may hold any part of the rows: the successes
    before each row are summed over ranges, and failures with the same sum are one streak."""
    bad = F.col("status") == "failed"
    rows = table(spark, d, "checkpoint_snapshots").select("source_identifier", "snapshot_no", "recorded_at", "document_url", "sha256", "status")
    order = [F.asc(c) for c in ("snapshot_no", "recorded_at", "document_url")]
    rows = placed_within(rows, ["source_identifier"], *order, F.asc_nulls_last("sha256"), value=(~F.coalesce(bad, F.lit(False))).cast("int"))
    streaks = rows.where(bad).groupBy("source_identifier", "before").agg(F.count(F.lit(1)).alias("n"))
    return streaks.groupBy("source_identifier").agg((F.max("n") >= 5).alias("open"))


@book.add(
    "WIN-20",
    """SELECT o_custkey, count(*) FILTER (bad) AS n_bad, count(*) AS n FROM (SELECT o_custkey, o_orderdate < max(o_orderdate + INTERVAL 30 DAY) OVER
       (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bad FROM orders) GROUP BY 1""",
)
def q_interval_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Orders as intervals of thirty days: those that begin before an earlier one of the customer has ended."""
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("a"), F.expr("o_orderdate + interval 30 days").alias("b"))
    bad = S.overlaps(rows, ["o_custkey"], "a", "b", "o_orderkey").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_bad"))
    total = rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return total.join(bad, "o_custkey", "left").select("o_custkey", F.coalesce("n_bad", F.lit(0)).alias("n_bad"), "n")


@book.add(
    "SRT-08 SRT-09 AGG-07",
    """WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM documents),
       w AS (SELECT DISTINCT source, round_even(k * (n - 1) / 9.0::DOUBLE, 0)::BIGINT AS i FROM (SELECT DISTINCT source, n FROM r), range(10) t(k))
       SELECT r.source, doc_id FROM r JOIN w ON r.source IS NOT DISTINCT FROM w.source AND r.i = w.i""",
)
def q_even_sample(spark: SparkSession, d: str) -> DataFrame:
    """Ten documents of each source, evenly spread by id."""
    rows = placed_within(table(spark, d, "documents").select("source", "doc_id"), ["source"], F.asc("doc_id"))
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    places = F.explode(F.array(*[F.bround(F.lit(k) * (F.col("n") - 1) / F.lit(9.0)).cast("bigint") for k in range(10)]))
    wanted = sizes.select(F.col("source").alias("s"), places.alias("p")).distinct()
    return rows.join(wanted, F.col("source").eqNullSafe(F.col("s")) & (F.col("place") - 1 == F.col("p"))).select("source", "doc_id")


@book.add(
    "SRT-10 SRT-11",
    f"""SELECT doc_id FROM documents WHERE sha256(concat_ws(chr(10), 'seed', coalesce(source, ''), doc_id::VARCHAR)) <= '{int(0.1 * (2**256 - 1)):064x}'""",
)
def q_hash_sample(spark: SparkSession, d: str) -> DataFrame:
    name = H.joined_hash("\n", F.lit("seed"), F.col("source"), F.col("doc_id"))
    return table(spark, d, "documents").where(H.in_hash_sample(name, 0.1)).select("doc_id")


@book.add(
    "SRT-12 SRT-14 SRC-55 AGG-51",
    """SELECT (('0x' || substr(sha256, 1, 16))::UBIGINT % 16)::INT AS shard, ('0x' || substr(sha256, 1, 2))::INT % 8 AS dealt, count(*) AS n FROM source_artifacts GROUP BY ALL""",
)
def q_hash_shard(spark: SparkSession, d: str) -> DataFrame:
    sha = F.col("sha256")
    dealt = (F.conv(F.substring(sha, 1, 2), 16, 10).cast("int") % 8).alias("dealt")
    return table(spark, d, "source_artifacts").groupBy(H.hash_shard(sha, 16).alias("shard"), dealt).agg(F.count(F.lit(1)).alias("n"))


@book.add(
    "SRT-16",
    """WITH r AS (SELECT source, source_artifact_id, page_count, collection = 'bulletins' AS must, row_number() OVER (PARTITION BY source
         ORDER BY collection = 'bulletins' DESC, page_count DESC NULLS LAST, source_artifact_id) AS i FROM source_artifacts)
       SELECT source, source_artifact_id, must FROM r WHERE i <= 5""",
)
def q_mandatory_fill(spark: SparkSession, d: str) -> DataFrame:
    """Five of each source: bulletins first, then the longest."""
    must = F.col("collection") == "bulletins"
    order = Window.partitionBy("source").orderBy(must.desc(), F.desc_nulls_last("page_count"), "source_artifact_id")
    rows = table(spark, d, "source_artifacts").select("source", "source_artifact_id", must.alias("must"), F.row_number().over(order).alias("i"))
    return rows.where("i <= 5").drop("i")


@book.add(
    "SRT-17 STR-30 ARR-04",
    """SELECT text_id, substr(text, greatest(1, strpos(lower(text), 'casación') - 30), 70) AS snippet FROM source_texts
       WHERE contains(lower(text), 'casación') ORDER BY text_id LIMIT 40""",
)
def q_text_search(spark: SparkSession, d: str) -> DataFrame:
    at = F.instr(F.lower("text"), F.lit("casación"))
    rows = table(spark, d, "source_texts").where(at > 0)
    snippet = F.substring(F.col("text"), F.greatest(F.lit(1), at - 30), F.lit(70))
    return rows.orderBy("text_id").limit(40).select("text_id", snippet.alias("snippet"))
