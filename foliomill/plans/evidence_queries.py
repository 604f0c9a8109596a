"""Evidence checks, schema checks, coverage of shards, budgets and renderings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliomill.functions import plugins as P
from foliomill.operators import ledger as L
from foliomill.operators.ranges import placed_within
from foliomill.operators.relational import of_last
from foliomill.operators.sequence import halves
from foliomill.plans.define import Book
from foliomill.runtime import table

book = Book()


@book.add(
    "FLT-21 FLT-23",
    """SELECT candidate_id, CASE WHEN text IS NULL THEN 'no_page' WHEN coalesce(candidate_text, '') = '' THEN 'no_text'
         WHEN starts_with(text, candidate_text) THEN 'exact'
         WHEN len(list_filter(range(1, length(candidate_text) + 1, 40), lambda i: NOT contains(text, substr(candidate_text, i, 40)))) = 0 THEN 'moved' ELSE 'not_found' END AS evidence
       FROM candidate_texts LEFT JOIN source_texts USING (text_id)""",
)
def q_evidence_spans(spark: SparkSession, d: str) -> DataFrame:
    """Whether all of a candidate stands where it is said to, elsewhere on the page, or nowhere: the weakest of its excerpts of 40."""
    cand = table(spark, d, "candidate_texts").select("candidate_id", "text_id", F.col("candidate_text").alias("c"))
    rows = cand.join(table(spark, d, "source_texts").select("text_id", "text"), "text_id", "left")
    excerpts = F.transform(F.sequence(F.lit(1), F.length("c"), F.lit(40)), lambda i: F.substring("c", i, F.lit(40)))
    state = (
        F.when(F.col("text").isNull(), "no_page")
        .when(F.coalesce(F.length("c"), F.lit(0)) == 0, "no_text")
        .when(F.startswith("text", "c"), "exact")  # every excerpt at its place
        .when(F.forall(excerpts, lambda x: F.contains("text", x)), "moved")
        .otherwise("not_found")
    )
    return rows.select("candidate_id", state.alias("evidence"))


@book.add(
    "FLT-24 SRC-44",
    """WITH p AS (SELECT object_key, line_no, CASE WHEN json_valid(line_text) THEN line_text::JSON END AS j FROM object_lines)
       SELECT object_key, line_no, CASE WHEN j IS NULL THEN 'not_json' WHEN j->>'source_identifier' IS NULL OR j->>'document_url' IS NULL OR j->>'recorded_at' IS NULL THEN 'required'
         WHEN (j->>'status') NOT IN ('stored', 'unavailable', 'failed') THEN 'enum' WHEN (j->>'status') = 'stored' AND j->>'byte_count' IS NULL THEN 'dependent' ELSE 'valid' END AS verdict FROM p""",
)
def q_schema_validation(spark: SparkSession, d: str) -> DataFrame:
    v = F.try_parse_json("line_text")
    rows = table(spark, d, "object_lines").select("object_key", "line_no", F.when(F.schema_of_variant(v).startswith("OBJECT"), v).alias("v"))
    field = lambda name: F.try_variant_get("v", f"$.{name}", "string")
    lacks = field("source_identifier").isNull() | field("document_url").isNull() | field("recorded_at").isNull()
    verdict = (
        F.when(F.col("v").isNull(), "not_json")
        .when(lacks, "required")
        .when(~field("status").isin("stored", "unavailable", "failed"), "enum")
        .when((field("status") == "stored") & field("byte_count").isNull(), "dependent")
        .otherwise("valid")
    )
    return rows.select("object_key", "line_no", verdict.alias("verdict"))


@book.add(
    "FLT-30 FLT-32",
    """WITH p AS (SELECT text_id, count(*) AS n, min(candidate_id) AS first_id, max(candidate_id) AS last_id FROM candidate_texts WHERE text_id IS NOT NULL GROUP BY 1)
       SELECT p.text_id, CASE WHEN n = 1 THEN 'single_pass' WHEN a.candidate_text IS NOT DISTINCT FROM b.candidate_text THEN 'same' ELSE 'changed' END AS state
       FROM p JOIN candidate_texts a ON a.candidate_id = first_id JOIN candidate_texts b ON b.candidate_id = last_id""",
)
def q_pass_pairs(spark: SparkSession, d: str) -> DataFrame:
    """First and last evaluation of a text, compared by digest so that no text is shuffled."""
    rows = table(spark, d, "candidate_texts").where("text_id is not null")
    h = F.struct("candidate_id", F.md5("candidate_text").alias("h"))
    pairs = rows.groupBy("text_id").agg(F.count(F.lit(1)).alias("n"), F.min(h).alias("a"), F.max(h).alias("b"))
    state = F.when(F.col("n") == 1, "single_pass").when(F.col("a.h").eqNullSafe(F.col("b.h")), "same").otherwise("changed")
    return pairs.select("text_id", state.alias("state"))


@book.add(
    "JOI-07 AGG-49",
    """SELECT s.source_artifact_id, max_by(c.candidate_id, struct_pack(t := c.evaluated_at, i := c.candidate_id)) AS newest FROM source_texts s JOIN candidate_texts c USING (text_id)
       WHERE c.adapter = 'pdf_aware' AND c.evaluated_at IS NOT NULL GROUP BY 1""",
)
def q_reusable_newest(spark: SparkSession, d: str) -> DataFrame:
    """The newest result of one kind derived from each artifact, over two levels of lineage."""
    cand = table(spark, d, "candidate_texts").where("adapter = 'pdf_aware' and evaluated_at is not null").select("candidate_id", "text_id", "evaluated_at")
    rows = cand.join(table(spark, d, "source_texts").select("text_id", "source_artifact_id"), "text_id")
    return rows.groupBy("source_artifact_id").agg(F.max_by("candidate_id", F.struct("evaluated_at", "candidate_id")).alias("newest"))


@book.add(
    "JOI-11 SET-08 SRC-21",
    """WITH o AS (SELECT DISTINCT key FROM stored_objects), s AS (SELECT DISTINCT source_identifier, document_url, object_key FROM checkpoint_snapshots WHERE snapshot_no = (SELECT max(snapshot_no) FROM checkpoint_snapshots))
       SELECT CASE WHEN object_key IS NULL THEN 'unregistered' WHEN o.key IS NULL THEN 'object_missing' ELSE 'complete' END AS state, count(*) AS n FROM s LEFT JOIN o ON object_key = o.key GROUP BY 1""",
)
def q_storage_check(spark: SparkSession, d: str) -> DataFrame:
    rows = of_last(table(spark, d, "checkpoint_snapshots"), "snapshot_no").select("source_identifier", "document_url", "object_key").distinct()
    keys = table(spark, d, "stored_objects").select("key").distinct()
    joined = rows.join(keys, F.col("object_key") == F.col("key"), "left")
    state = F.when(F.col("object_key").isNull(), "unregistered").when(F.col("key").isNull(), "object_missing").otherwise("complete")
    return joined.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


@book.add(
    "AGG-27 AGG-45 AGG-26",
    """WITH w AS (SELECT unnest(range(0, 6))::INT AS shard), s AS (SELECT DISTINCT object_key, regexp_extract(object_key, 'shard-(\\d+)', 1)::INT AS shard FROM object_lines)
       SELECT w.shard, count(object_key) AS n_files, count(object_key) = 0 AS missing FROM w LEFT JOIN s USING (shard) GROUP BY 1""".replace("\\\\", "\\"),
)
def q_shard_cover(spark: SparkSession, d: str) -> DataFrame:
    """Files of each expected shard, and the shards that none came from."""
    files = table(spark, d, "object_lines").select("object_key").distinct()
    files = files.withColumn("shard", F.regexp_extract("object_key", r"shard-(\d+)", 1).cast("int"))
    wanted = spark.range(6).select(F.col("id").cast("int").alias("shard"))
    rows = wanted.join(files, "shard", "left").groupBy("shard").agg(F.count("object_key").alias("n_files"))
    return rows.withColumn("missing", F.col("n_files") == 0)


@book.add(
    "AGG-55",
    """SELECT '| ' || adapter || ' | ' || count(*) || ' | ' || coalesce(printf('%.3f', avg(length(candidate_text))), '-') || ' |' AS line FROM candidate_texts GROUP BY adapter""",
)
def q_report_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "candidate_texts").groupBy("adapter").agg(F.count(F.lit(1)).alias("n"), F.avg(F.length("candidate_text")).alias("m"))
    return rows.select(F.concat(F.lit("| "), "adapter", F.lit(" | "), F.col("n").cast("string"), F.lit(" | "), F.coalesce(F.format_string("%.3f", "m"), F.lit("-")), F.lit(" |")).alias("line"))


@book.add(
    "WIN-15",
    """WITH RECURSIVE r(source_artifact_id, first, last) AS (SELECT source_artifact_id, 0, page_count - 1 FROM source_artifacts WHERE page_count > 0
         UNION ALL SELECT source_artifact_id, CASE h WHEN 0 THEN first ELSE (first + last) // 2 + 1 END, CASE h WHEN 0 THEN (first + last) // 2 ELSE last END FROM r, (SELECT unnest([0, 1]) AS h) WHERE last - first + 1 > 16)
       SELECT source_artifact_id, first, last FROM r WHERE last - first + 1 <= 16""",
)
def q_range_halving(spark: SparkSession, d: str) -> DataFrame:
    """Page ranges split in halves until each has at most 16 pages."""
    split = F.udf(lambda n: halves(0, n - 1, lambda a, b: b - a + 1, 16), "array<struct<first:int,last:int>>", useArrow=True)
    rows = table(spark, d, "source_artifacts").where("page_count > 0")
    return rows.select("source_artifact_id", F.explode(split("page_count")).alias("r")).select("source_artifact_id", "r.first", "r.last")


@book.add(
    "UPS-19",
    """WITH s AS (SELECT source, min(first_seen_at) AS first_seen FROM source_artifacts GROUP BY 1)
       SELECT coalesce(m.source, s.source) AS source, m.target_share, s.first_seen, m.source IS NULL AS unknown FROM mix_targets m FULL JOIN s ON m.source = s.source""",
)
def q_reference_bootstrap(spark: SparkSession, d: str) -> DataFrame:
    """Reference rows merged with what is there; rows that no reference knows are marked."""
    seen = table(spark, d, "source_artifacts").groupBy("source").agg(F.min("first_seen_at").alias("first_seen"))
    merged = L.full_merge(table(spark, d, "mix_targets").select("source", "target_share"), seen, ["source"])
    return merged.select("source", F.col("o.target_share"), F.col("n.first_seen"), F.col("o").isNull().alias("unknown"))


@book.add(
    "STR-31 STR-36",
    """SELECT event_id, CASE WHEN length(b) > 9 THEN substr(b, 1, 8) || '…' ELSE b END AS state FROM (SELECT event_id, nullif(regexp_extract('x ' || props || ' y', '\\{.*\\}'), '') AS b FROM events)""".replace("\\\\", "\\"),
)
def q_bounded_state(spark: SparkSession, d: str) -> DataFrame:
    cut = P.json_cut(F.concat(F.lit("x "), "props", F.lit(" y")))
    return table(spark, d, "events").select("event_id", P.bounded(cut, 9).alias("state"))


@book.add(
    "SRC-48",
    r"""WITH m AS (SELECT text_id, regexp_extract_all(text, '\d{3}-\d{4}-[A-Z]{4}-\d{5}') AS f FROM source_texts), u AS (SELECT text_id, f, unnest(range(1, len(f) + 1)) AS i FROM m),
        k AS (SELECT text_id, f[i] AS found, min(i) AS i FROM u GROUP BY ALL)
        SELECT text_id, found, row_number() OVER (PARTITION BY text_id ORDER BY i) AS ordinal FROM k""",
)
def q_id_ordinals(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers numbered by first appearance in their text; in place, so a text is one row throughout."""
    found = F.array_distinct(F.regexp_extract_all("text", F.lit(r"(\d{3}-\d{4}-[A-Z]{4}-\d{5})"), F.lit(1)))
    rows = table(spark, d, "source_texts").select("text_id", F.posexplode(found).alias("i", "found"))
    return rows.select("text_id", "found", (F.col("i") + 1).cast("bigint").alias("ordinal"))


@book.add(
    "UDF-08 MAT-03",
    """SELECT source, count(*) AS n_fit FROM (SELECT source, sum(length(text)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM documents WHERE text IS NOT NULL) WHERE total <= 20000 GROUP BY 1""",
)
def q_budget_prefix(spark: SparkSession, d: str) -> DataFrame:
    """How many documents of each source come before a budget of characters is spent."""
    rows = table(spark, d, "documents").where("text is not null").select("source", "doc_id", F.length("text").alias("n"))
    rows = placed_within(rows, ["source"], F.asc("doc_id"), value=F.col("n")).where("before + n <= 20000")
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_fit"))


@book.add(
    "UDF-10",
    """SELECT text_id, text_id || '__' || q AS name, CASE q WHEN 'readable' THEN 'boolean' ELSE 'probability' END AS kind FROM source_texts, (SELECT unnest(['readable', 'complete']) AS q)""",
)
def q_questions(spark: SparkSession, d: str) -> DataFrame:
    asked = P.questions(F.col("text_id").cast("string"), {"readable": "boolean", "complete": "probability"})
    return table(spark, d, "source_texts").select("text_id", asked.alias("q")).select("text_id", "q.*")


@book.add("UDF-01 UDF-02 UDF-03")
def q_provider_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers of a pluggable provider, here the constant one of the tests."""
    make = P.constant_provider({"probability": 0.5}, "text_id")
    return P.evaluate(table(spark, d, "source_texts"), make, "text_id bigint, probability double", ["text_id", "text"])


@book.add(
    "",
    """SELECT regexp_extract(document_url, '/((?:19|20)\\d\\d)/', 1) AS year, CASE WHEN starts_with(trim(source_identifier), 'TC/') THEN 'constitutional' WHEN starts_with(trim(source_identifier), 'BJ') THEN 'bulletins' ELSE 'decisions' END AS surface,
              count(DISTINCT trim(source_identifier)) AS n FROM checkpoint_snapshots WHERE regexp_matches(document_url, '/(19|20)\\d\\d/') GROUP BY ALL""".replace("\\\\", "\\"),
)
def q_surface_years(spark: SparkSession, d: str) -> DataFrame:
    """Documents of each surface and year, the year taken from the address."""
    key = F.trim("source_identifier")
    surface = F.when(key.startswith("TC/"), "constitutional").when(key.startswith("BJ"), "bulletins").otherwise("decisions")
    rows = table(spark, d, "checkpoint_snapshots").where(F.col("document_url").rlike(r"/(19|20)\d\d/"))
    year = F.regexp_extract("document_url", r"/((?:19|20)\d\d)/", 1)
    return rows.groupBy(year.alias("year"), surface.alias("surface")).agg(F.count_distinct(key).alias("n"))
