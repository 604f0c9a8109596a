"""Records as sources deliver them: normalised, named, checked, merged and written into manifests; layouts and printed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliomill.functions import layouts as Y
from foliomill.functions import schema as C
from foliomill.functions import text as T
from foliomill.operators import ledger as L
from foliomill.operators import sequence as S
from foliomill.operators.ranges import attach, placed, placed_within
from foliomill.operators.relational import of_last
from foliomill.plans.define import Book
from foliomill.runtime import table
from foliomill.sources import observations as O

book = Book()


@book.add(
    "SRC-10",
    """WITH u AS (SELECT snapshot_no, trim(document_url) AS raw FROM checkpoint_snapshots),
       s AS (SELECT snapshot_no, CASE WHEN raw IS NULL THEN 'source_null' WHEN raw = '' OR lower(raw) = 'null' THEN 'source_null_text' WHEN starts_with(raw, 'https://') THEN 'available'
             WHEN starts_with(raw, 'NULLhttps://') THEN 'stripped' ELSE 'unsupported' END AS state, CASE WHEN starts_with(raw, 'NULLhttps://') THEN substr(raw, 5) WHEN starts_with(raw, 'https://') THEN raw END AS url FROM u)
       SELECT snapshot_no, state, count(*) AS n, count(DISTINCT url) AS n_urls FROM s GROUP BY ALL""",
)
def q_url_states(spark: SparkSession, d: str) -> DataFrame:
    """Urls as delivered: null, null in words, with null before them, as they should be, or of no shape that is known."""
    rows = table(spark, d, "checkpoint_snapshots").select("snapshot_no", O.bulletin_url(F.col("document_url")).alias("u"))
    return rows.groupBy("snapshot_no", "u.state").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("u.url").alias("n_urls"))


@book.add(
    "SRC-07",
    """WITH r AS (SELECT snapshot_no, count(*) AS n, count(DISTINCT source_identifier) AS n_sources, bool_or(delivered_at > snapshot_at + INTERVAL 1 DAY) AS late FROM checkpoint_snapshots GROUP BY 1)
       SELECT snapshot_no, n, n_sources, NOT late AS enumeration_complete, CASE WHEN late THEN 'rows_delivered_late' ELSE 'delivered_with_the_snapshot' END AS enumeration_basis FROM r""",
)
def q_inventory_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Each inventory with whether it is a full enumeration, and what that rests on."""
    late = F.bool_or(F.col("delivered_at") > F.col("snapshot_at") + F.expr("interval 1 day"))
    rows = table(spark, d, "checkpoint_snapshots").groupBy("snapshot_no").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("source_identifier").alias("n_sources"), late.alias("late")
    )
    basis = F.when(F.col("late"), "rows_delivered_late").otherwise("delivered_with_the_snapshot")
    return rows.select("snapshot_no", "n", "n_sources", (~F.col("late")).alias("enumeration_complete"), basis.alias("enumeration_basis"))


_ITEM = "coalesce(source_identifier, '') || chr(9) || coalesce(document_url, '') || chr(9) || status || chr(9) || coalesce(sha256, '')"


@book.add(
    "SRC-34 SRC-35 HSH-03",
    f"""WITH i AS (SELECT snapshot_no, status, {_ITEM} AS item FROM checkpoint_snapshots)
       SELECT snapshot_no, count(*) AS selected, count(*) FILTER (status = 'stored') AS stored, count(*) FILTER (status = 'unavailable') AS unavailable,
              count(*) FILTER (status = 'failed') AS failed, md5(string_agg(item, chr(10) ORDER BY encode(item))) AS digest FROM i GROUP BY 1""",
)
def q_run_manifests(spark: SparkSession, d: str) -> DataFrame:
    """The manifest of each run: counts by status and the digest of its items in order, taken row after row."""
    return _manifests(table(spark, d, "checkpoint_snapshots"))


def _manifests(rows: DataFrame) -> DataFrame:
    zero = lambda c: F.coalesce(c, F.lit(""))
    item = F.concat_ws("\t", zero("source_identifier"), zero("document_url"), "status", zero("sha256"))
    items = rows.select("snapshot_no", item.alias("item"), F.lit(False).alias("flag"))
    digests = S.joined_digest(items, "snapshot_no", ["item"], "item", "flag", "\n").select("snapshot_no", F.col("h").alias("digest"))
    counts = L.status_counts(rows, ["snapshot_no"], "status", ["stored", "unavailable", "failed"])
    return counts.withColumnRenamed("total", "selected").join(digests, "snapshot_no")


@book.add(
    "SRC-33 SRC-36",
    f"""WITH i AS (SELECT snapshot_no, delivered_at <= snapshot_at + INTERVAL 1 DAY AS early, status, {_ITEM} AS item FROM checkpoint_snapshots),
       d AS (SELECT snapshot_no, count(*) AS n, count(*) FILTER (status = 'stored') AS stored, md5(string_agg(item, chr(10) ORDER BY encode(item))) AS h FROM i WHERE early GROUP BY 1),
       r AS (SELECT snapshot_no, count(*) AS n, count(*) FILTER (status = 'stored') AS stored, md5(string_agg(item, chr(10) ORDER BY encode(item))) AS h FROM i GROUP BY 1)
       SELECT snapshot_no, d.n AS declared, r.n AS found, CASE WHEN d.n IS NULL THEN 'no_manifest' WHEN d.n <> r.n OR d.stored <> r.stored THEN 'counts' WHEN d.h <> r.h THEN 'digest' ELSE 'ok' END AS verdict
       FROM r LEFT JOIN d USING (snapshot_no)""",
)
def q_manifest_check(spark: SparkSession, d: str) -> DataFrame:
    """What a manifest written on the first day declares against what is there now: counts and digest worked out anew."""
    rows = table(spark, d, "checkpoint_snapshots")
    early = _manifests(rows.where(F.col("delivered_at") <= F.col("snapshot_at") + F.expr("interval 1 day")))
    both = _manifests(rows).alias("r").join(early.alias("d"), "snapshot_no", "left")
    verdict = (
        F.when(F.col("d.selected").isNull(), "no_manifest")
        .when((F.col("d.selected") != F.col("r.selected")) | (F.col("d.stored") != F.col("r.stored")), "counts")
        .when(F.col("d.digest") != F.col("r.digest"), "digest")
        .otherwise("ok")
    )
    return both.select("snapshot_no", F.col("d.selected").alias("declared"), F.col("r.selected").alias("found"), verdict.alias("verdict"))


@book.add(
    "SRC-45 SRC-56",
    """WITH t AS (SELECT 'source_texts' AS table_name, text_id AS record_id, text FROM source_texts UNION ALL SELECT 'candidate_texts', candidate_id, candidate_text FROM candidate_texts)
       SELECT g.table_name, g.record_id, CASE WHEN t.record_id IS NULL THEN 'no_record' WHEN t.text IS NULL THEN 'no_text' WHEN g.expected_text IS NULL THEN 'no_gold' ELSE 'ready' END AS state,
              sha256(g.expected_text) AS gold_sha256, g.record_id % 2 = 0 AS holdout FROM gold_pages g LEFT JOIN t USING (table_name, record_id)""",
)
def q_gold_cases(spark: SparkSession, d: str) -> DataFrame:
    """Reviewed pages with the records they are gold for, their digest and their side of the split."""
    texts = table(spark, d, "source_texts").select(F.lit("source_texts").alias("table_name"), F.col("text_id").alias("record_id"), "text")
    cand = table(spark, d, "candidate_texts").select(F.lit("candidate_texts").alias("table_name"), F.col("candidate_id").alias("record_id"), F.col("candidate_text").alias("text"))
    gold = table(spark, d, "gold_pages")
    rows = gold.join(texts.unionByName(cand).withColumn("there", F.lit(True)), ["table_name", "record_id"], "left")
    state = F.when(F.col("there").isNull(), "no_record").when(F.col("text").isNull(), "no_text").when(F.col("expected_text").isNull(), "no_gold").otherwise("ready")
    return rows.select("table_name", "record_id", state.alias("state"), F.sha2("expected_text", 256).alias("gold_sha256"), (F.col("record_id") % 2 == 0).alias("holdout"))


@book.add(
    "FLT-16 FLT-34",
    """WITH s AS (SELECT text_id, CASE WHEN text IS NULL THEN 'fatal' WHEN len(risk_flags) = 0 THEN 'accepted' WHEN len(risk_flags) = 1 THEN 'review' ELSE 'weak' END AS c FROM source_texts)
       SELECT text_id, unnest(CASE c WHEN 'accepted' THEN ['accepted'] WHEN 'review' THEN ['review', 'rejected'] ELSE ['rejected'] END) AS queue FROM s""",
)
def q_fan_out(spark: SparkSession, d: str) -> DataFrame:
    """Each text goes to its queue; one that is to be reviewed stands in two."""
    flags = F.size("risk_flags")
    queues = (
        F.when(F.col("text").isNull(), F.array(F.lit("rejected")))
        .when(flags == 0, F.array(F.lit("accepted")))
        .when(flags == 1, F.array(F.lit("review"), F.lit("rejected")))
        .otherwise(F.array(F.lit("rejected")))
    )
    return table(spark, d, "source_texts").select("text_id", F.explode(queues).alias("queue"))


_MARKER = r"""list_filter(list_transform(regexp_extract_all(left({0}, 500) || chr(10) || right({0}, 500), '(?m)^\s*[-–—]?\s*(\d{{1,4}})\s*[-–—]?\s*$', 1), lambda x: x::INT), lambda n: n > 0 AND n < 5000)[-1]"""


@book.add(
    "FLT-22 FLT-23",
    f"""WITH c AS (SELECT candidate_id, text_id, source, {_MARKER.format("candidate_text")} AS claimed FROM candidate_texts),
            s AS (SELECT text_id, source, {_MARKER.format("text")} AS printed FROM source_texts)
       SELECT candidate_id, CASE WHEN s.text_id IS NULL THEN 'no_page' WHEN claimed IS NULL THEN 'no_claim' WHEN printed IS NULL THEN 'no_printed_page' WHEN claimed <> printed THEN 'other_page'
         WHEN c.source IS NOT NULL AND s.source IS NULL THEN 'no_provenance' WHEN c.source IS NOT NULL AND c.source <> s.source THEN 'other_provenance' ELSE 'proven' END AS evidence
       FROM c LEFT JOIN s USING (text_id)""",
)
def q_reference_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Whether the page that a reading claims exists, bears the printed number the reading has, and comes from its source."""
    cand = table(spark, d, "candidate_texts").select("candidate_id", "text_id", Y.printed_marker(F.col("candidate_text")).alias("claimed"), F.col("source").alias("said"))
    pages = table(spark, d, "source_texts").select("text_id", Y.printed_marker(F.col("text")).alias("printed"), "source", F.lit(True).alias("there"))
    state = (
        F.when(F.col("there").isNull(), "no_page")
        .when(F.col("claimed").isNull(), "no_claim")
        .when(F.col("printed").isNull(), "no_printed_page")
        .when(F.col("claimed") != F.col("printed"), "other_page")
        .when(F.col("said").isNotNull() & F.col("source").isNull(), "no_provenance")
        .when(F.col("said") != F.col("source"), "other_provenance")
        .otherwise("proven")
    )
    return cand.join(pages, "text_id", "left").select("candidate_id", state.alias("evidence"))


@book.add(
    "FLT-30 FLT-31",
    """WITH p AS (SELECT candidate_id, text_id, adapter, md5(candidate_text) AS h, lag(candidate_id) OVER w AS before, lag(md5(candidate_text)) OVER w AS bh, lag(adapter) OVER w AS ba
                  FROM candidate_texts WHERE text_id IS NOT NULL WINDOW w AS (PARTITION BY text_id ORDER BY evaluated_at, candidate_id))
       SELECT candidate_id, before, CASE WHEN h IS NULL OR bh IS NULL THEN 'unverified' WHEN h = bh THEN 'verified' ELSE 'mismatch' END AS state, adapter IS NOT DISTINCT FROM ba AS same_adapter FROM p WHERE before IS NOT NULL""",
)
def q_consecutive_passes(spark: SparkSession, d: str) -> DataFrame:
    """Every evaluation of a text against the one before it, by digest."""
    rows = table(spark, d, "candidate_texts").where("text_id is not null").select("candidate_id", "text_id", "adapter", "evaluated_at", F.md5("candidate_text").alias("h"))
    order = Window.partitionBy("text_id").orderBy("evaluated_at", "candidate_id")
    rows = rows.select("*", *[F.lag(c).over(order).alias(n) for c, n in (("candidate_id", "before"), ("h", "bh"), ("adapter", "ba"))])
    state = F.when(F.col("h").isNull() | F.col("bh").isNull(), "unverified").when(F.col("h") == F.col("bh"), "verified").otherwise("mismatch")
    return rows.where("before is not null").select("candidate_id", "before", state.alias("state"), F.col("adapter").eqNullSafe(F.col("ba")).alias("same_adapter"))


@book.add(
    "FLT-26",
    """WITH p AS (SELECT object_key, line_no, CASE WHEN json_valid(line_text) THEN line_text::JSON END AS j FROM object_lines),
       k AS (SELECT object_key, line_no, list_sort(json_keys(j)) AS keys FROM p WHERE json_type(j) = 'OBJECT')
       SELECT object_key, line_no, list_filter(['source_identifier', 'document_url', 'recorded_at', 'status'], lambda x: NOT list_contains(keys, x)) AS missing,
              list_filter(keys, lambda x: NOT list_contains(['source_identifier', 'document_url', 'recorded_at', 'status', 'sha256', 'object_key', 'byte_count', 'content_type', 'file_extension', 'error_type', 'reason'], x)) AS unknown FROM k""",
)
def q_payload_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys a payload lacks, and keys it should not have."""
    v = F.try_parse_json(F.concat(F.lit("["), "line_text", F.lit("]")))
    whole = F.try_variant_get(v, "$[1]", "variant").isNull() & F.schema_of_variant(F.try_variant_get(v, "$[0]", "variant")).startswith("OBJECT")
    rows = table(spark, d, "object_lines").select("object_key", "line_no", F.when(whole, F.expr("map_keys(try_cast(try_variant_get(try_parse_json(concat('[', line_text, ']')), '$[0]', 'variant') as map<string, string>))")).alias("k"))
    need = F.array(*[F.lit(x) for x in ("source_identifier", "document_url", "recorded_at", "status")])
    may = F.concat(need, F.array(*[F.lit(x) for x in ("sha256", "object_key", "byte_count", "content_type", "file_extension", "error_type", "reason")]))
    rows = rows.where("k is not null")
    return rows.select("object_key", "line_no", F.array_except(need, "k").alias("missing"), F.array_sort(F.array_except("k", may)).alias("unknown"))


@book.add(
    "WIN-19 FLT-27",
    """WITH p AS (SELECT source_artifact_id, text_id, page_index, lag(page_index) OVER (PARTITION BY source_artifact_id ORDER BY text_id) AS b FROM source_texts WHERE page_index IS NOT NULL)
       SELECT source_artifact_id, count(*) AS n, count(*) FILTER (b >= page_index) AS n_back FROM p GROUP BY 1""",
)
def q_page_order(spark: SparkSession, d: str) -> DataFrame:
    """How often the pages of an artifact, in order of their ids, do not go up; by place, so that no artifact is one task."""
    rows = table(spark, d, "source_texts").where("page_index is not null").select("source_artifact_id", "text_id", "page_index")
    rows = placed(rows, F.asc("source_artifact_id"), F.asc("text_id"))
    before = rows.select((F.col("place") + 1).alias("place"), F.col("source_artifact_id").alias("a"), F.col("page_index").alias("b"))
    both = rows.join(before, "place", "left").withColumn("back", F.col("a").eqNullSafe(F.col("source_artifact_id")) & (F.col("b") >= F.col("page_index")))
    return both.groupBy("source_artifact_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("back").alias("n_back"))


@book.add(
    "SRT-13",
    """SELECT source_artifact_id, ((row_number() OVER (ORDER BY source_artifact_id) - 1) % 7)::BIGINT AS shard FROM source_artifacts""",
)
def q_position_shard(spark: SparkSession, d: str) -> DataFrame:
    rows = placed(table(spark, d, "source_artifacts").select("source_artifact_id"), F.asc("source_artifact_id"))
    return rows.select("source_artifact_id", ((F.col("place") - 1) % 7).alias("shard"))


@book.add(
    "SRT-18",
    """WITH s AS (SELECT text_id, string_split(lower(text), 'artículo') AS x FROM source_texts WHERE contains(lower(text), 'artículo')),
       h AS (SELECT text_id, unnest(range(1, least(len(x), 21))) AS i, x FROM s)
       SELECT text_id, i::INT AS hit, (list_sum(list_transform(x[1:i], lambda y: length(y))) + (i - 1) * 8)::INT AS begin FROM h""",
)
def q_literal_hits(spark: SparkSession, d: str) -> DataFrame:
    """Where a literal stands in each text, up to twenty times."""
    rows = table(spark, d, "source_texts").where(F.contains(F.lower("text"), F.lit("artículo")))
    hits = F.slice(Y.places(F.lower("text"), "artículo"), 1, 20)
    return rows.select("text_id", F.posexplode(hits).alias("i", "h")).select("text_id", (F.col("i") + 1).alias("hit"), "h.begin")


_OBSERVED = {"law": r"Ley núm\. \d+-\d+", "docket": r"\d{3}-\d{4}-[A-Z]{4}-\d{5}", "long_date": r"\d{1,2} de [a-z]+ de \d{4}", "amount": r"(?:RD|US)\$ ?[\d,]+\.\d{2}"}


@book.add(
    "STR-17",
    "WITH s AS ("
    + " UNION ALL ".join(
        f"SELECT text_id, '{n}' AS method, string_split_regex(text, '{p}') AS g, regexp_extract_all(text, '{p}') AS h FROM source_texts WHERE regexp_matches(text, '{p}')"
        for n, p in _OBSERVED.items()
    )
    + """), i AS (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM s)
       SELECT text_id, method, (list_sum(list_transform(g[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(h[1:i - 1], lambda y: length(y))), 0))::INT AS begin, h[i] AS value FROM i""",
)
def q_observation_spans(spark: SparkSession, d: str) -> DataFrame:
    """What each page says about its case: every match with its method and its place."""
    kinds = [F.struct(F.lit(n).alias("method"), Y.places(F.col("text"), p).alias("hits")) for n, p in _OBSERVED.items()]
    rows = table(spark, d, "source_texts").where("text is not null").select("text_id", F.inline(F.array(*kinds)))
    return rows.select("text_id", "method", F.explode("hits").alias("h")).select("text_id", "method", "h.begin", "h.value")


@book.add(
    "STR-28",
    """SELECT candidate_id, CASE WHEN c.source IS NULL OR s.source IS NULL OR trim(c.source) = '' OR trim(s.source) = '' THEN false ELSE contains(lower(trim(c.source)), lower(trim(s.source))) OR contains(lower(trim(s.source)), lower(trim(c.source))) END AS match
       FROM candidate_texts c JOIN source_texts s USING (text_id)""",
)
def q_provider_match(spark: SparkSession, d: str) -> DataFrame:
    """Whether one name holds the other; an empty name matches none."""
    cand = table(spark, d, "candidate_texts").select("candidate_id", "text_id", F.lower(F.trim("source")).alias("a"))
    rows = cand.join(table(spark, d, "source_texts").select("text_id", F.lower(F.trim("source")).alias("b")), "text_id")
    a, b = F.nullif("a", F.lit("")), F.nullif("b", F.lit(""))
    return rows.select("candidate_id", F.coalesce(F.contains(a, b) | F.contains(b, a), F.lit(False)).alias("match"))


@book.add(
    "STR-20",
    r"""WITH l AS (SELECT text_id, unnest(string_split_regex(text, '\r\n|\n|\r')) AS line FROM source_texts)
       SELECT text_id, regexp_extract(line, '^\s*(\S.*?)\s*\.{4,}\s*(\S.*?)\s*$', 1) AS title, regexp_extract(line, '^\s*(\S.*?)\s*\.{4,}\s*(\S.*?)\s*$', 2) AS entry FROM l WHERE regexp_matches(line, '^\s*(\S.*?)\s*\.{4,}\s*(\S.*?)\s*$')""",
)
def q_index_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of an index: a title, leaders, and the page or sum it leads to."""
    rows = table(spark, d, "source_texts").select("text_id", F.explode(F.split("text", "\r\n|\n|\r")).alias("line")).where(F.col("line").rlike(Y.INDEX_LINE))
    return rows.select("text_id", *[F.regexp_extract("line", Y.INDEX_LINE, i).alias(n) for i, n in ((1, "title"), (2, "entry"))])


@book.add(
    "STR-21",
    r"""WITH s AS (SELECT text_id, list_filter(list_transform(regexp_extract_all(left(text, 500) || chr(10) || right(text, 500), '(?m)^\s*[-–—]?\s*(\d{1,4})\s*[-–—]?\s*$', 1), lambda x: x::INT), lambda n: n > 0 AND n < 5000) AS n FROM source_texts WHERE text IS NOT NULL)
       SELECT text_id, n[-1] AS marker FROM s WHERE len(n) > 0""",
)
def q_printed_markers(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "source_texts").where("text is not null").select("text_id", Y.printed_marker(F.col("text")).alias("marker"))
    return rows.where("marker is not null")


def _layout_sql() -> str:
    quote = lambda p: p.replace("'", "''").replace("(?im)", "(?im)")
    when = []
    for layout in Y.LAYOUTS:
        at = lambda n, x=layout: "text" if x.top is None else f"left(text, {Y.ID_TOP if n == 'first_chamber_id' else x.top})"
        fits = [f"regexp_matches({at(n)}, '{quote(Y.HEADINGS[n])}')" for n in layout.needs]
        if layout.some_of:
            fits.append("(" + " + ".join(f"regexp_matches({at(n)}, '{quote(Y.HEADINGS[n])}')::INT" for n in layout.some_of) + f") >= {layout.at_least}")
        when.append(f"WHEN {' AND '.join(fits)} THEN '{layout.family}'")
    return f"SELECT source_artifact_id, family, count(*) AS n FROM (SELECT source_artifact_id, CASE {' '.join(when)} ELSE 'unknown' END AS family FROM source_texts WHERE text IS NOT NULL) GROUP BY ALL"


@book.add("STR-16", _layout_sql())
def q_page_layouts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "source_texts").where("text is not null").select("source_artifact_id", Y.page_layout(F.col("text")).alias("x"))
    return rows.groupBy("source_artifact_id", "x.family").agg(F.count(F.lit(1)).alias("n"))


@book.add(
    "WIN-06",
    r"""WITH p AS (SELECT source_artifact_id, count(*) FILTER (regexp_matches(text, '(?m)^\s*RESOLUCI[ÓO]N\s+N[ÚU]M|^SENTENCIA NÚM')) AS old, count(*) FILTER (regexp_matches(text, '(?m)^Expediente \d')) AS modern FROM source_texts GROUP BY 1)
       SELECT source_artifact_id, old, modern, CASE WHEN old > 0 AND old >= modern THEN 'old' ELSE 'modern' END AS grammar FROM p""",
)
def q_grammar_choice(spark: SparkSession, d: str) -> DataFrame:
    """One grammar for each document: that of single headings where these are no fewer than the repeated ones."""
    text = F.col("text")
    rows = table(spark, d, "source_texts").groupBy("source_artifact_id").agg(
        F.count_if(text.rlike(r"(?m)^\s*RESOLUCI[ÓO]N\s+N[ÚU]M|^SENTENCIA NÚM")).alias("old"), F.count_if(text.rlike(r"(?m)^Expediente \d")).alias("modern")
    )
    grammar = F.when((F.col("old") > 0) & (F.col("old") >= F.col("modern")), "old").otherwise("modern")
    return rows.withColumn("grammar", grammar)


@book.add(
    "DAT-02",
    r"""WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text, '\b\d{1,2}/\d{1,2}/\d{4}\b')) AS found FROM documents)
       SELECT doc_id, found, try_strptime(found, '%d/%m/%Y')::DATE AS day, count(*) AS n FROM m GROUP BY ALL""",
)
def q_numeric_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates in figures; null where there is no such day."""
    found = F.explode(F.regexp_extract_all("text", F.lit(r"\b\d{1,2}/\d{1,2}/\d{4}\b"), F.lit(0))).alias("found")
    rows = table(spark, d, "documents").select("doc_id", found)
    return rows.groupBy("doc_id", "found", T.numeric_date(F.col("found")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


@book.add(
    "DAT-03",
    r"""WITH p AS (SELECT object_key, line_no, (CASE WHEN json_valid(line_text) THEN line_text::JSON END)->>'recorded_at' AS t FROM object_lines)
       SELECT object_key, line_no, CASE WHEN regexp_matches(t, '(Z|[+-]\d\d:?\d\d)$') THEN strftime(t::TIMESTAMPTZ AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S.%fZ') END AS utc,
              NOT regexp_matches(t, '(Z|[+-]\d\d:?\d\d)$') AS naive FROM p WHERE t IS NOT NULL""",
)
def q_utc_times(spark: SparkSession, d: str) -> DataFrame:
    """Instants in one spelling; times without a zone are not guessed at."""
    t = F.get_json_object("line_text", "$.recorded_at")
    rows = table(spark, d, "object_lines").where(F.try_parse_json("line_text").isNotNull()).select("object_key", "line_no", t.alias("t")).where("t is not null")
    zoned = F.col("t").rlike(r"(Z|[+-]\d\d:?\d\d)$")
    utc = F.date_format(F.try_to_timestamp("t"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return rows.select("object_key", "line_no", F.when(zoned, utc).alias("utc"), (~zoned).alias("naive"))


@book.add(
    "MAT-05",
    """SELECT name, state, count(*) AS n FROM (SELECT name, CASE WHEN raw IS NULL THEN 'missing' WHEN raw IN ('true', 'false') THEN 'boolean' WHEN try_cast(raw AS DOUBLE) IS NULL THEN 'not_a_number' WHEN raw::DOUBLE BETWEEN 0 AND 1 THEN 'ok' ELSE 'out_of_range' END AS state
       FROM (SELECT 'k' AS name, props->>'$.k' AS raw FROM events UNION ALL SELECT 'value', value::VARCHAR FROM events UNION ALL SELECT 'event_type', event_type FROM events)) GROUP BY ALL""",
)
def q_probabilities(spark: SparkSession, d: str) -> DataFrame:
    """Which fields can be read as probabilities: numbers, none of true and false, from 0 to 1."""
    fields = {"k": F.get_json_object("props", "$.k"), "value": F.col("value").cast("string"), "event_type": F.col("event_type")}
    rows = table(spark, d, "events").select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), c.alias("raw")) for n, c in fields.items()])))
    number = F.expr("try_cast(raw as double)")
    state = (
        F.when(F.col("raw").isNull(), "missing").when(F.col("raw").isin("true", "false"), "boolean").when(number.isNull(), "not_a_number")
        .when(number.between(0, 1), "ok").otherwise("out_of_range")
    )
    return rows.groupBy("name", state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


@book.add(
    "JSN-01",
    """SELECT event_id, json_extract_string(j, '$.k') AS k, json_extract_string(j, '$.user_id') AS user_id, len(json_keys(j)) AS n_keys FROM (SELECT event_id, json_merge_patch(props::JSON, json_object('user_id', user_id, 'k', CASE WHEN event_type = 'error' THEN 0 ELSE (props->>'$.k')::BIGINT END)) AS j FROM events)""",
)
def q_json_merge(spark: SparkSession, d: str) -> DataFrame:
    """Fields merged into an object; where both have one the later counts."""
    rows = table(spark, d, "events")
    old = F.from_json("props", "map<string,string>")
    k = F.when(F.col("event_type") == "error", F.lit("0")).otherwise(F.get_json_object("props", "$.k"))
    new = F.create_map(F.lit("user_id"), F.col("user_id").cast("string"), F.lit("k"), k)
    merged = F.map_concat(F.map_filter(old, lambda key, _: ~F.map_contains_key(new, key)), new)
    return rows.select("event_id", merged.alias("m")).select("event_id", F.col("m")["k"].alias("k"), F.col("m")["user_id"].alias("user_id"), F.size("m").cast("bigint").alias("n_keys"))


@book.add(
    "JSN-04",
    """WITH p AS (SELECT object_key, line_no, CASE WHEN json_valid(line_text) THEN line_text::JSON END AS j FROM object_lines), k AS (SELECT object_key, line_no, unnest(json_keys(j)) AS k FROM p WHERE json_type(j) = 'OBJECT')
       SELECT object_key, line_no, split_part(k, '_', 1) AS prefix, list_sort(list(k)) AS fields FROM k GROUP BY ALL""",
)
def q_prefixed_fields(spark: SparkSession, d: str) -> DataFrame:
    """Fields of an object regrouped by the first part of their names, inside the row."""
    keys = F.expr("map_keys(try_cast(try_variant_get(a, '$[0]', 'variant') as map<string, string>))")
    a = F.expr("try_parse_json(concat('[', line_text, ']'))")
    whole = F.expr("try_variant_get(a, '$[1]', 'variant') is null and schema_of_variant(try_variant_get(a, '$[0]', 'variant')) like 'OBJECT%'")
    rows = table(spark, d, "object_lines").select("object_key", "line_no", a.alias("a")).where(whole).select("object_key", "line_no", F.array_sort(keys).alias("k"))
    first = lambda x: F.substring_index(x, "_", 1)
    groups = F.transform(F.array_distinct(F.transform("k", first)), lambda p: F.struct(p.alias("prefix"), F.filter("k", lambda x: first(x) == p).alias("fields")))
    return rows.select("object_key", "line_no", F.inline(groups))


@book.add(
    "UPS-06",
    """WITH k AS (SELECT source_artifact_id, coalesce(page_index, -1) AS parent, authority AS label, text_id FROM source_texts WHERE authority IS NOT NULL)
       SELECT source_artifact_id, parent, label, max(text_id) AS text_id, count(*) AS n FROM k GROUP BY ALL""",
)
def q_derived_key_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Upsert on a key in which a missing parent is one value, for labelled rows only; the last of a key stays."""
    rows = table(spark, d, "source_texts").where("authority is not null")
    parent = F.coalesce("page_index", F.lit(-1)).alias("parent")
    return rows.groupBy("source_artifact_id", parent, F.col("authority").alias("label")).agg(F.max("text_id").alias("text_id"), F.count(F.lit(1)).alias("n"))


_REVISED = """o AS (SELECT source_identifier, document_url, count(*) AS revision FROM checkpoint_snapshots WHERE snapshot_no < 8 GROUP BY ALL),
       e AS (SELECT source_identifier, document_url, count(*) + 1 AS expected FROM checkpoint_snapshots WHERE snapshot_no < 7 GROUP BY ALL)"""


@book.add(
    "UPS-10 UPS-11 UPS-12 UPS-27",
    f"""WITH {_REVISED} SELECT source_identifier, document_url, CASE WHEN revision IS NULL THEN 'unknown' WHEN expected = revision THEN 'applied' ELSE 'conflict' END AS outcome,
       CASE WHEN expected = revision THEN revision + 1 ELSE revision END AS revision FROM e LEFT JOIN o USING (source_identifier, document_url)""",
)
def q_revisions(spark: SparkSession, d: str) -> DataFrame:
    """Updates that expect a revision, joined to the stored rows on key and revision; what does not fit is a conflict row."""
    keys = ["source_identifier", "document_url"]
    rows = table(spark, d, "checkpoint_snapshots")
    stored = rows.where("snapshot_no < 8").groupBy(*keys).agg(F.count(F.lit(1)).alias("revision"))
    asked = rows.where("snapshot_no < 7").groupBy(*keys).agg((F.count(F.lit(1)) + 1).alias("expected"))
    return L.compare_and_set(stored, asked, keys, "revision", "expected").select(*keys, "outcome", "revision")


@book.add(
    "UPS-18",
    """WITH c AS (SELECT candidate_id, c.text_id, s.text_id AS known, row_number() OVER (PARTITION BY c.text_id, md5(candidate_text) ORDER BY candidate_id) AS n FROM candidate_texts c LEFT JOIN source_texts s USING (text_id))
       SELECT candidate_id, CASE WHEN known IS NULL THEN 'unknown_subject' WHEN n > 1 THEN 'duplicate_key' ELSE 'created' END AS outcome FROM c""",
)
def q_observation_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Observations to be created: those of no known subject and those already made come out as errors of their own."""
    rows = table(spark, d, "candidate_texts").select("candidate_id", "text_id", F.md5("candidate_text").alias("h"))
    first = rows.where("text_id is not null").groupBy("text_id", "h").agg(F.min("candidate_id").alias("first"))
    known = table(spark, d, "source_texts").select("text_id", F.lit(True).alias("known"))
    rows = attach(rows.join(known, "text_id", "left"), first, ["text_id", "h"], "left")
    outcome = F.when(F.col("known").isNull(), "unknown_subject").when(F.col("first") < F.col("candidate_id"), "duplicate_key").otherwise("created")
    return rows.select("candidate_id", outcome.alias("outcome"))


@book.add(
    "TMP-03 TMP-02",
    """WITH v AS (SELECT source_identifier, document_url, recorded_at AS valid_from, sha256 FROM checkpoint_snapshots WHERE recorded_at IS NOT NULL),
       q AS (SELECT DISTINCT source_identifier, document_url, snapshot_at AS asked FROM checkpoint_snapshots WHERE snapshot_no = 5)
       SELECT q.source_identifier, q.document_url, max(valid_from) AS valid_from, max(struct_pack(t := valid_from, s := coalesce(sha256, ''))).s AS sha256 FROM q JOIN v USING (source_identifier, document_url) WHERE valid_from <= asked GROUP BY 1, 2""",
)
def q_version_on_date(spark: SparkSession, d: str) -> DataFrame:
    """The version of each document in force when the fifth snapshot was taken."""
    keys = ["source_identifier", "document_url"]
    rows = table(spark, d, "checkpoint_snapshots")
    versions = rows.where("recorded_at is not null").select(*keys, F.col("recorded_at").alias("valid_from"), F.coalesce("sha256", F.lit("")).alias("sha256"))
    asked = rows.where("snapshot_no = 5").select(*keys, F.col("snapshot_at").alias("at")).distinct()
    fit = asked.join(versions, keys).where("valid_from <= at")
    return fit.groupBy(*keys).agg(F.max(F.struct("valid_from", "sha256")).alias("v")).select(*keys, "v.*")


@book.add(
    "AGG-28",
    """WITH r AS (SELECT * FROM checkpoint_snapshots WHERE snapshot_no = (SELECT max(snapshot_no) FROM checkpoint_snapshots))
       SELECT unnest(['stored_has_digest', 'digest_is_sha256', 'stored_has_key', 'absent_has_reason', 'known_status']) AS rule, unnest([count(*) FILTER (status = 'stored' AND sha256 IS NULL), count(*) FILTER (sha256 IS NOT NULL AND NOT regexp_full_match(lower(trim(sha256)), '[0-9a-f]{64}')),
         count(*) FILTER (status = 'stored' AND object_key IS NULL), count(*) FILTER (status <> 'stored' AND error_type IS NULL AND reason IS NULL), count(*) FILTER (status NOT IN ('stored', 'unavailable', 'failed'))]) AS n_bad FROM r""",
)
def q_certified_rules(spark: SparkSession, d: str) -> DataFrame:
    """What a certified inventory asserts, and how many rows of the last one break it."""
    rows = of_last(table(spark, d, "checkpoint_snapshots"), "snapshot_no")
    stored = F.col("status") == "stored"
    rules = {
        "stored_has_digest": stored & F.col("sha256").isNull(),
        "digest_is_sha256": ~F.lower(F.trim("sha256")).rlike("^[0-9a-f]{64}$"),
        "stored_has_key": stored & F.col("object_key").isNull(),
        "absent_has_reason": ~stored & F.col("error_type").isNull() & F.col("reason").isNull(),
        "known_status": ~F.col("status").isin("stored", "unavailable", "failed"),
    }
    counts = rows.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("n_bad")) for n in rules])))


@book.add(
    "MAT-04",
    """SELECT adapter, sum(greatest(0, length(candidate_text) - coalesce(length(text), 0)))::BIGINT AS answer, sum(coalesce(length(text), 0))::BIGINT AS reasoning, count(*) FILTER (length(text) > length(candidate_text)) AS n_floored
       FROM candidate_texts LEFT JOIN source_texts USING (text_id) WHERE candidate_text IS NOT NULL GROUP BY 1""",
)
def q_token_breakdown(spark: SparkSession, d: str) -> DataFrame:
    """What is left of a total after a part of it, never less than nothing."""
    cand = table(spark, d, "candidate_texts").where("candidate_text is not null").select("adapter", "text_id", F.length("candidate_text").alias("whole"))
    rows = cand.join(table(spark, d, "source_texts").select("text_id", F.length("text").alias("part")), "text_id", "left")
    part = F.coalesce("part", F.lit(0))
    return rows.groupBy("adapter").agg(
        F.sum(F.greatest(F.lit(0), F.col("whole") - part)).alias("answer"), F.sum(part).alias("reasoning"), F.count_if(F.col("part") > F.col("whole")).alias("n_floored")
    )


@book.add(
    "STR-30",
    """SELECT doc_id, left(text, 120) AS clipped, length(text) > 120 AS truncated FROM documents WHERE text IS NOT NULL""",
)
def q_clipped(spark: SparkSession, d: str) -> DataFrame:
    """The beginning of each text, and whether more follows."""
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.left("text", F.lit(120)).alias("clipped"), (F.length("text") > 120).alias("truncated"))


@book.add(
    "SRT-08",
    """WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i, count(*) OVER (PARTITION BY source) AS n FROM documents)
       SELECT source, doc_id, CASE WHEN i <= 3 THEN 'head' ELSE 'tail' END AS part FROM r WHERE i <= 3 OR i > n - 3""",
)
def q_head_and_tail(spark: SparkSession, d: str) -> DataFrame:
    """The first and the last three documents of each source; a document that is both counts as first."""
    docs = table(spark, d, "documents").select("source", "doc_id")
    rows = attach(placed_within(docs, ["source"], F.asc("doc_id")), docs.groupBy("source").agg(F.count(F.lit(1)).alias("n")), ["source"])
    head, tail = F.col("place") <= 3, F.col("place") > F.col("n") - 3
    return rows.where(head | tail).select("source", "doc_id", F.when(head, "head").otherwise("tail").alias("part"))


@book.add(
    "WIN-16 WIN-17",
    """WITH r AS (SELECT source, source_artifact_id, row_number() OVER (PARTITION BY source ORDER BY page_count DESC NULLS LAST, source_artifact_id) AS turn FROM source_artifacts),
       p AS (SELECT *, row_number() OVER (ORDER BY turn, source NULLS FIRST) AS place FROM r) SELECT source, source_artifact_id, turn, place FROM p WHERE place <= 60""",
)
def q_diverse_selection(spark: SparkSession, d: str) -> DataFrame:
    """Sixty artifacts taken from the sources in turn, the longest of each first."""
    rows = table(spark, d, "source_artifacts").select("source", "source_artifact_id", "page_count")
    turns = S.round_robin(rows, "source", F.desc_nulls_last("page_count"), F.asc("source_artifact_id"))
    taken = turns.orderBy("turn", F.asc_nulls_first("source")).limit(60)  # sixty rows, which one window may number
    place = F.row_number().over(Window.orderBy("turn", F.asc_nulls_first("source")))
    return taken.select("source", "source_artifact_id", "turn", place.cast("bigint").alias("place"))


@book.add(
    "JSN-03",
    """WITH p AS (SELECT object_key, line_no, line_text::JSON AS j FROM object_lines WHERE json_valid(line_text))
       SELECT object_key, line_no, j->>'source_identifier' AS source_identifier, j->>'document_url' AS document_url, j->>'status' AS status, j->>'sha256' AS sha256, (j->>'byte_count')::BIGINT AS byte_count, j->>'content_type' AS content_type, j->>'file_extension' AS file_extension, j->>'error_type' AS error_type, j->>'reason' AS reason FROM p WHERE json_type(j) = 'OBJECT'""",
)
def q_record_set(spark: SparkSession, d: str) -> DataFrame:
    """Objects as rows of typed columns."""
    schema = "array<struct<source_identifier: string, document_url: string, status: string, sha256: string, byte_count: bigint, content_type: string, file_extension: string, error_type: string, reason: string>>"
    text = F.concat(F.lit("["), "line_text", F.lit("]"))
    v = F.try_parse_json(text)
    whole = F.try_variant_get(v, "$[1]", "variant").isNull() & F.schema_of_variant(F.try_variant_get(v, "$[0]", "variant")).startswith("OBJECT")
    rows = table(spark, d, "object_lines").where(whole)
    return rows.select("object_key", "line_no", F.inline(F.from_json(text, schema)))


@book.add(
    "STR-12",
    r"""WITH p AS (SELECT candidate_id, candidate_text AS c, list_distinct(regexp_extract_all(text, 'Ley núm\. \d+-\d+|\d{3}-\d{4}-[A-Z]{4}-\d{5}')) AS need FROM candidate_texts JOIN source_texts USING (text_id) WHERE text IS NOT NULL AND candidate_text IS NOT NULL)
       SELECT candidate_id, len(need) AS n_required, len(list_filter(need, lambda x: NOT contains(lower(c), lower(x)))) AS n_missing FROM p""",
)
def q_missing_spans(spark: SparkSession, d: str) -> DataFrame:
    """Spans of the reference that a candidate must hold, and how many it does not."""
    texts = table(spark, d, "source_texts").where("text is not null")
    need = F.array_distinct(F.regexp_extract_all("text", F.lit(r"Ley núm\. \d+-\d+|\d{3}-\d{4}-[A-Z]{4}-\d{5}"), F.lit(0)))
    cand = table(spark, d, "candidate_texts").where("candidate_text is not null").select("candidate_id", "text_id", F.lower("candidate_text").alias("c"))
    rows = cand.join(texts.select("text_id", need.alias("need")), "text_id")
    missing = F.size(F.filter("need", lambda x: ~F.contains("c", F.lower(x))))
    return rows.select("candidate_id", F.size("need").cast("bigint").alias("n_required"), missing.cast("bigint").alias("n_missing"))


@book.add(
    "STR-04",
    """SELECT doc_id, md5(strip_accents(decision_number || ' ' || coalesce(court_organ, '') || ' ' || left(text, 400))) AS plain FROM documents WHERE decision_number IS NOT NULL AND regexp_full_match(left(text, 400), '[\x00-ɏ]*')""".replace("\\x00", "\\x{00}"),
)
def q_accent_strip(spark: SparkSession, d: str) -> DataFrame:
    """Names and beginnings of texts without their marks, whatever the alphabet; canonical decomposition has no built-in form."""
    head = F.left("text", F.lit(400))
    rows = table(spark, d, "documents").where("decision_number is not null").where(head.rlike("^[\u0000-\u024f]*$"))
    name = F.concat("decision_number", F.lit(" "), F.coalesce("court_organ", F.lit("")), F.lit(" "), head)
    return rows.select("doc_id", F.md5(T.strip_marks(name)).alias("plain"))


@book.add(
    "GRF-04",
    """WITH p AS (SELECT source_artifact_id, page_index, authority FROM source_texts), l AS (SELECT source_artifact_id, coalesce(page_index, -1) AS parent, authority AS label, count(*) AS n FROM p WHERE authority IS NOT NULL GROUP BY ALL)
       SELECT source_artifact_id, parent, label, n FROM l WHERE n > 1""",
)
def q_repeated_siblings(spark: SparkSession, d: str) -> DataFrame:
    """Labels that stand more than once under one parent."""
    rows = table(spark, d, "source_texts").where("authority is not null")
    parent = F.coalesce("page_index", F.lit(-1)).alias("parent")
    return rows.groupBy("source_artifact_id", parent, F.col("authority").alias("label")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


_PRINTED = f"m AS (SELECT source_artifact_id, text_id, page_index, {_MARKER.format('text')} AS printed FROM source_texts WHERE page_index IS NOT NULL)"


def _printed(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "source_texts").where("page_index is not null")
    return pages.select("source_artifact_id", "text_id", "page_index", Y.printed_marker(F.col("text")).alias("printed"))


@book.add(
    "STR-33",
    f"""WITH {_PRINTED} SELECT source_artifact_id, printed, min(page_index) AS view, count(DISTINCT page_index) AS n_views, count(DISTINCT page_index) > 1 AS conflict FROM m WHERE printed IS NOT NULL GROUP BY 1, 2""",
)
def q_resolved_pages(spark: SparkSession, d: str) -> DataFrame:
    """Printed page to page of the view, from what the pages bear; a number on two pages is a conflict."""
    rows = _printed(spark, d).where("printed is not null").groupBy("source_artifact_id", "printed")
    rows = rows.agg(F.min("page_index").alias("view"), F.count_distinct("page_index").alias("n_views"))
    return rows.withColumn("conflict", F.col("n_views") > 1)


@book.add(
    "ARR-02",
    f"""WITH {_PRINTED}, o AS (SELECT source_artifact_id, printed - page_index AS shift, count(DISTINCT page_index) AS support FROM m WHERE printed IS NOT NULL GROUP BY 1, 2),
       n AS (SELECT source_artifact_id, count(DISTINCT page_index) AS n_marked FROM m WHERE printed IS NOT NULL GROUP BY 1),
       b AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY source_artifact_id ORDER BY support DESC, shift) = 1)
       SELECT m.source_artifact_id, m.text_id, b.shift, CASE WHEN b.support >= 2 AND b.support / n.n_marked >= 0.5 THEN m.page_index + b.shift END AS logical_page,
              m.printed IS NOT NULL AND m.printed = m.page_index + b.shift AS confirmed
       FROM m JOIN b USING (source_artifact_id) JOIN n USING (source_artifact_id)""",
)
def q_logical_view(spark: SparkSession, d: str) -> DataFrame:
    """Pages of an artifact under the shift between printed and physical numbers that most of its marked pages bear."""
    pages = _printed(spark, d)
    marked = pages.where("printed is not null")
    shifts = marked.groupBy("source_artifact_id", (F.col("printed") - F.col("page_index")).alias("shift")).agg(F.count_distinct("page_index").alias("support"))
    best = shifts.groupBy("source_artifact_id").agg(F.max(F.struct("support", (-F.col("shift")).alias("minus"))).alias("b"))
    n = marked.groupBy("source_artifact_id").agg(F.count_distinct("page_index").alias("n_marked"))
    rows = pages.join(best.join(n, "source_artifact_id"), "source_artifact_id").withColumn("shift", -F.col("b.minus"))
    sure = (F.col("b.support") >= 2) & (F.col("b.support") / F.col("n_marked") >= 0.5)
    page = F.col("page_index") + F.col("shift")
    return rows.select("source_artifact_id", "text_id", "shift", F.when(sure, page).alias("logical_page"), F.coalesce(F.col("printed") == page, F.lit(False)).alias("confirmed"))


@book.add(
    "SRC-13",
    """WITH y AS (SELECT source, year(decision_date) AS year, count(*) AS n FROM documents WHERE source IS NOT NULL AND decision_date IS NOT NULL GROUP BY 1, 2),
       s AS (SELECT source, count(*) FILTER (year BETWEEN 1000 AND 9999) AS size FROM y GROUP BY 1), w AS (SELECT source FROM s ORDER BY size DESC, source LIMIT 1)
       SELECT source, year, n FROM y JOIN w USING (source) WHERE year BETWEEN 1000 AND 9999""",
)
def q_year_domain(spark: SparkSession, d: str) -> DataFrame:
    """The years that may be asked for: those of the source that offers the most."""
    docs = table(spark, d, "documents").where("source is not null and decision_date is not null")
    years = docs.groupBy("source", F.year("decision_date").alias("year")).agg(F.count(F.lit(1)).alias("n")).where(F.col("year").between(1000, 9999))
    widest = years.groupBy("source").agg(F.count(F.lit(1)).alias("size")).orderBy(F.desc("size"), "source").limit(1).select("source")
    return years.join(F.broadcast(widest), "source").select("source", "year", "n")  # one row


#: What a journal record must hold.
_RECORD = {
    "type": "object",
    "required": ["source_identifier", "document_url", "status", "recorded_at"],
    "properties": {
        "status": {"enum": ["stored", "unavailable", "failed"]},
        "sha256": {"type": ["string", "null"], "minLength": 64},
        "byte_count": {"type": ["integer", "null"], "minimum": 1},
    },
}


@book.add(
    "FLT-24",
    """WITH p AS (SELECT CASE WHEN json_valid(line_text) THEN line_text::JSON END AS j FROM object_lines WHERE line_text IS NOT NULL),
       e AS (SELECT '$' AS path, 'json' AS rule FROM p WHERE j IS NULL UNION ALL SELECT '$', 'type' FROM p WHERE json_type(j) <> 'OBJECT'
         UNION ALL SELECT '$.' || f, 'required' FROM p, (SELECT unnest(['source_identifier', 'document_url', 'status', 'recorded_at']) AS f) WHERE json_type(j) = 'OBJECT' AND NOT list_contains(json_keys(j), f)
         UNION ALL SELECT '$.status', 'enum' FROM p WHERE json_type(j) = 'OBJECT' AND list_contains(json_keys(j), 'status') AND coalesce(j->>'status', '') NOT IN ('stored', 'unavailable', 'failed')
         UNION ALL SELECT '$.sha256', 'length' FROM p WHERE json_type(j->'sha256') = 'VARCHAR' AND length(j->>'sha256') < 64 UNION ALL SELECT '$.sha256', 'type' FROM p WHERE json_type(j->'sha256') NOT IN ('VARCHAR', 'NULL')
         UNION ALL SELECT '$.byte_count', 'type' FROM p WHERE json_type(j->'byte_count') NOT IN ('UBIGINT', 'BIGINT', 'NULL') UNION ALL SELECT '$.byte_count', 'range' FROM p WHERE json_type(j->'byte_count') IN ('UBIGINT', 'BIGINT') AND (j->>'byte_count')::BIGINT < 1)
       SELECT path, rule, count(*) AS n FROM e GROUP BY ALL""",
)
def q_schema_failures(spark: SparkSession, d: str) -> DataFrame:
    """Where the lines of the journals break the schema of a record, and how often."""
    rows = table(spark, d, "object_lines").where("line_text is not null")
    found = rows.select(F.explode(C.json_failures(F.col("line_text"), _RECORD)).alias("e"))
    return found.groupBy("e.path", "e.rule").agg(F.count(F.lit(1)).alias("n"))
