"""Text functions, facts, sources and retrieval over the corpus tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliomill.functions import hashing as H
from foliomill.functions import text as T
from foliomill.operators import retrieval as V
from foliomill.operators import sequence as Q
from foliomill.plans.define import Book
from foliomill.runtime import table
from foliomill.sources import files as S

book = Book()
ACCENTS = (T.ACCENTED, T.PLAIN)


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "source_texts").where("text is not null").select("text_id", F.col("text").alias("e"))
    cand = table(spark, d, "candidate_texts").where("candidate_text is not null").select("candidate_id", "text_id", F.col("candidate_text").alias("c"))
    return cand.join(texts, "text_id")


@book.add(
    "STR-01 STR-02 STR-04 STR-05",
    rf"""WITH p AS (SELECT candidate_id, s.text AS e, c.candidate_text AS c FROM candidate_texts c JOIN source_texts s USING (text_id) WHERE s.text IS NOT NULL AND c.candidate_text IS NOT NULL),
        k AS (SELECT *, trim(regexp_replace(e, '[\s\x0b\x1c-\x1f\x85\x{{a0}}]+', ' ', 'g')) AS x, trim(regexp_replace(c, '[\s\x0b\x1c-\x1f\x85\x{{a0}}]+', ' ', 'g')) AS y FROM p),
        l AS (SELECT *, translate(lower(x), '{T.ACCENTED}', '{T.PLAIN}') AS px, translate(lower(y), '{T.ACCENTED}', '{T.PLAIN}') AS py FROM k),
        b AS (SELECT *, trim(regexp_replace(regexp_replace(px, '[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}\s]', '', 'g'), '\s+', ' ', 'g')) AS bx, trim(regexp_replace(regexp_replace(py, '[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}\s]', '', 'g'), '\s+', ' ', 'g')) AS by_ FROM l)
        SELECT CASE WHEN e = c THEN 'exact' WHEN x = y THEN 'whitespace' WHEN lower(x) = lower(y) THEN 'case' WHEN px = py THEN 'accent' WHEN bx = by_ THEN 'punctuation'
          WHEN trim(regexp_replace(regexp_replace(bx, '\p{{Nd}}', '', 'g'), '\s+', ' ', 'g')) = trim(regexp_replace(regexp_replace(by_, '\p{{Nd}}', '', 'g'), '\s+', ' ', 'g')) THEN 'digits' ELSE 'substantive' END AS change, count(*) AS n
        FROM b GROUP BY 1""",
)
def q_change_taxonomy(spark: SparkSession, d: str) -> DataFrame:
    rows = _pairs(spark, d).select(T.change_class(F.col("e"), F.col("c")).alias("change"))
    return rows.groupBy("change").agg(F.count(F.lit(1)).alias("n"))


@book.add(
    "",
    r"""SELECT text_id, list_sort(list_distinct(list_transform(regexp_extract_all(text, 'Ley núm\. \d+-\d+'), lambda x: lower(x)))) AS laws,
               list_sort(list_distinct(list_transform(regexp_extract_all(text, '\d{3}-\d{4}-[A-Z]{4}-\d{5}'), lambda x: lower(x)))) AS dockets FROM source_texts WHERE text IS NOT NULL""",
)
def q_fact_extract(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "source_texts").where("text is not null")
    laws, dockets = T.facts(F.col("text"), r"Ley núm\. \d+-\d+"), T.facts(F.col("text"), T.FACTS["dockets"])
    return rows.select("text_id", F.array_sort(laws).alias("laws"), F.array_sort(dockets).alias("dockets"))


@book.add(
    "STR-14 STR-23 FLT-09",
    r"""SELECT text_id, length(regexp_replace(text, '[\s\x0b\x1c-\x1f\x85\x{a0}]', '', 'g')) AS visible, len(string_split_regex(text, '\r\n|\n|\r|\x0b|\f|\x1c|\x1d|\x1e|\x{85}|\x{2028}|\x{2029}')) - ends_with(text, chr(10))::INT AS n_lines
        FROM source_texts WHERE length(text) > 0""",
)
def q_line_stats(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "source_texts").where(F.length("text") > 0)
    return rows.select("text_id", T.visible_length(F.col("text")).cast("bigint").alias("visible"), F.size(T.lines(F.col("text"))).cast("bigint").alias("n_lines"))


@book.add(
    "STR-15 FLT-06 FLT-11",
    r"""SELECT text_id, list_filter([CASE WHEN regexp_matches(text, '\.{5,}') THEN 'leaders' END, CASE WHEN contains(text, chr(65533)) THEN 'replacement' END,
          CASE WHEN regexp_matches(lower(text), 'considerando|atendido') THEN 'body' END, CASE WHEN NOT contains(lower(text), 'art') THEN 'no_article' END], lambda x: x IS NOT NULL) AS labels
        FROM source_texts WHERE text IS NOT NULL""",
)
def q_anomaly_labels(spark: SparkSession, d: str) -> DataFrame:
    text, low = F.col("text"), F.lower("text")
    labels = F.array(
        F.when(text.rlike(r"\.{5,}"), "leaders"),
        F.when(text.contains("�"), "replacement"),
        F.when(low.rlike("considerando|atendido"), "body"),
        F.when(~low.contains("art"), "no_article"),
    )
    return table(spark, d, "source_texts").where("text is not null").select("text_id", F.array_compact(labels).alias("labels"))


@book.add(
    "",
    r"""SELECT text_id, CASE WHEN regexp_matches(text, '^SENTENCIA N') THEN 'sentence' WHEN regexp_matches(text, '^Expediente \d') THEN 'file' WHEN regexp_matches(text, '^(BOLET|Bolet)') THEN 'bulletin'
          WHEN regexp_matches(text, '^(Análisis|Estudio|Informe) ') THEN 'editorial' ELSE 'unknown' END AS family, nullif(regexp_extract(text, '^SENTENCIA NÚM\. (\S+)', 1), '') AS number FROM source_texts WHERE text IS NOT NULL""",
)
def q_layout_grammar(spark: SparkSession, d: str) -> DataFrame:
    """Ordered grammar: the first form that fits names the layout."""
    text = F.col("text")
    family = (
        F.when(text.rlike("^SENTENCIA N"), "sentence")
        .when(text.rlike(r"^Expediente \d"), "file")
        .when(text.rlike("^(BOLET|Bolet)"), "bulletin")
        .when(text.rlike("^(Análisis|Estudio|Informe) "), "editorial")
        .otherwise("unknown")
    )
    number = F.nullif(F.regexp_extract(text, r"^SENTENCIA NÚM\. (\S+)", 1), F.lit(""))
    return table(spark, d, "source_texts").where("text is not null").select("text_id", family.alias("family"), number.alias("number"))


@book.add(
    "STR-17 DAT-01",
    r"""WITH m AS (SELECT text_id, unnest(regexp_extract_all(text, '\d{1,2} de (?:enero|febrero|marzo|abril|mayo|junio|julio|agosto|septiembre|octubre|noviembre|diciembre) de \d{4}')) AS f FROM source_texts)
        SELECT text_id, f AS found, try_strptime(regexp_extract(f, '(\d{4})$', 1) || '-' || (list_position(['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre','octubre','noviembre','diciembre'], split_part(f, ' ', 3))) || '-' || split_part(f, ' ', 1), '%Y-%m-%d')::DATE AS day, count(*) AS n FROM m GROUP BY ALL""",
)
def q_spanish_dates(spark: SparkSession, d: str) -> DataFrame:
    pattern = r"(\d{1,2} de (?:" + "|".join(T.SPANISH_MONTHS) + r") de \d{4})"
    rows = table(spark, d, "source_texts").select("text_id", F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(1))).alias("found"))
    part = F.split("found", " ")
    day = T.spanish_date(part[0], part[2], part[4])
    return rows.groupBy("text_id", "found", day.alias("day")).agg(F.count(F.lit(1)).alias("n"))


@book.add(
    "",
    r"""SELECT doc_id, nullif(regexp_extract(text, '[A-Z]{3}-[A-Z]{2}-\d{2}-\d{4,5}'), '') AS identifier, regexp_replace(decision_number, '\d$', chr(65533)) AS corrupted FROM documents WHERE decision_number IS NOT NULL""",
)
def q_identifiers(spark: SparkSession, d: str) -> DataFrame:
    found = F.nullif(F.regexp_extract("text", r"([A-Z]{3}-[A-Z]{2}-\d{2}-\d{4,5})", 1), F.lit(""))
    return table(spark, d, "documents").where("decision_number is not null").select(
        "doc_id", found.alias("identifier"), F.regexp_replace("decision_number", r"\d$", "�").alias("corrupted")
    )


@book.add(
    "STR-29",
    r"""SELECT DISTINCT document_url, nullif(regexp_extract(trim(document_url), '/([^/?]*)(\?.*)?\s*$', 1), '') AS filename, contains(lower(document_url), 'boletin') AS bulletin FROM checkpoint_snapshots""",
)
def q_filename_from_url(spark: SparkSession, d: str) -> DataFrame:
    name = F.nullif(F.regexp_extract(F.trim("document_url"), r"/([^/?]*)(\?.*)?\s*$", 1), F.lit(""))
    return table(spark, d, "checkpoint_snapshots").select(
        "document_url", name.alias("filename"), F.lower("document_url").contains("boletin").alias("bulletin")
    ).distinct()


@book.add(
    "ARR-03",
    """WITH p AS (SELECT source_artifact_id, string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY page_index, text_id) AS t, count(*) FILTER (text IS NULL OR trim(text) = '') AS n_open
                  FROM source_texts WHERE page_index IS NOT NULL GROUP BY 1)
       SELECT source_artifact_id, md5(t) AS h, n_open FROM p""",
)
def q_page_reconstruct(spark: SparkSession, d: str) -> DataFrame:
    """Every artifact's pages as one text, in order, and how many of them are open."""
    rows = table(spark, d, "source_texts").where("page_index is not null")
    blank = F.col("text").isNull() | (F.trim("text") == "")
    pages = rows.select("source_artifact_id", "page_index", "text_id", F.coalesce("text", F.lit("")).alias("t"), blank.alias("blank"))
    return Q.joined_digest(pages, "source_artifact_id", ["page_index", "text_id", "t"], "t", "blank", "\n\n").withColumnRenamed("n", "n_open")


@book.add(
    "MAT-02 MAT-03",
    """SELECT doc_id, greatest(1, ceil(strlen(text) / 3.0::DOUBLE))::BIGINT AS by_bytes, greatest(1, ceil(length(text) / 4.0::DOUBLE))::BIGINT AS by_chars,
              greatest(1, ceil(strlen(text) / 3.0::DOUBLE)) + 500 <= 2000 AS fits FROM documents WHERE text IS NOT NULL""",
)
def q_token_estimates(spark: SparkSession, d: str) -> DataFrame:
    estimate = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / 3)).cast("bigint")
    chars = F.greatest(F.lit(1), F.ceil(F.length("text") / 4)).cast("bigint")
    return table(spark, d, "documents").where("text is not null").select(
        "doc_id", estimate.alias("by_bytes"), chars.alias("by_chars"), (estimate + 500 <= 2000).alias("fits")
    )


@book.add(
    "HSH-01 HSH-03 HSH-04 SRC-18 SRC-17 DAT-04",
    """SELECT source_artifact_id, sha256('{"byte_count":' || coalesce(byte_count::VARCHAR, 'null') || ',"collection":"' || collection || '","sha256":"' || sha256 || '"}') AS payload_sha256,
              'store/' || source || '/' || collection || '/' || substr(sha256, 1, 2) || '/' || sha256 || '.' || file_extension AS object_key, strftime(first_seen_at, '%Y/%m/%d') AS day FROM source_artifacts""",
)
def q_content_names(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "source_artifacts")
    payload = H.content_hash(sha256=F.col("sha256"), byte_count=F.col("byte_count"), collection=F.col("collection"))
    key = H.object_key("store", F.col("source"), F.col("collection"), F.col("sha256"), F.col("file_extension"))
    return rows.select("source_artifact_id", payload.alias("payload_sha256"), key.alias("object_key"), F.date_format("first_seen_at", "yyyy/MM/dd").alias("day"))


@book.add(
    "JSN-02",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_type(props) = 'OBJECT' AS is_object FROM events""",
)
def q_json_props(spark: SparkSession, d: str) -> DataFrame:
    v = F.try_parse_json("props")
    return table(spark, d, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.schema_of_variant(v).startswith("OBJECT").alias("is_object")
    )


@book.add(
    "SRC-14 SRC-15 SRC-16 SRC-46 SRC-54",
    """WITH p AS (SELECT object_key AS file, line_no, CASE WHEN json_valid(line_text) THEN line_text::JSON END AS j FROM object_lines WHERE trim(line_text) <> ''),
       r AS (SELECT j->>'source_identifier' AS source_identifier, j->>'document_url' AS document_url, j->>'status' AS status, j->>'sha256' AS sha256, (j->>'recorded_at')::TIMESTAMPTZ AS t, file, line_no FROM p WHERE j IS NOT NULL)
       SELECT source_identifier, document_url, status, sha256 FROM r QUALIFY row_number() OVER (PARTITION BY source_identifier, document_url ORDER BY t DESC NULLS LAST, encode(file) DESC, line_no DESC) = 1""",
)
def q_journal_state(spark: SparkSession, d: str) -> DataFrame:
    return S.latest_records(table(spark, d, "object_lines")).select("source_identifier", "document_url", "status", "sha256")


@book.add(
    "SRC-53",
    """WITH p AS (SELECT object_key, line_no, NOT json_valid(line_text) AS bad FROM object_lines WHERE trim(line_text) <> '')
       SELECT object_key, count(*) FILTER (bad) AS n_corrupt, min(line_no) FILTER (bad) = max(line_no) AS only_tail FROM p GROUP BY 1 HAVING count(*) FILTER (bad) > 0""",
)
def q_torn_journals(spark: SparkSession, d: str) -> DataFrame:
    return S.torn_tail_only(table(spark, d, "object_lines"), "object_key", "line_no")


@book.add(
    "SRC-25 SRC-26 SRC-49 SRC-51 SRC-52",
    """WITH l AS (SELECT key, max(size) AS size FROM stored_objects GROUP BY key)
       SELECT CASE WHEN starts_with(key, '_checkpoints/') THEN 'journal' WHEN ends_with(key, '.pdf') THEN 'pdf' ELSE 'other' END AS class, count(*) AS n, sum(size)::BIGINT AS bytes, count(*) FILTER (size = 0) AS n_empty FROM l GROUP BY 1""",
)
def q_listing_audit(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "stored_objects").groupBy("key").agg(F.max("size").alias("size"))
    kind = F.when(F.col("key").startswith("_checkpoints/"), "journal").when(F.col("key").endswith(".pdf"), "pdf").otherwise("other")
    return rows.groupBy(kind.alias("class")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.count_if(F.col("size") == 0).alias("n_empty"))


@book.add(
    "SRC-28",
    """WITH r AS (SELECT key, last_modified, regexp_extract(key, 'run-\\d+') AS run FROM stored_objects WHERE starts_with(key, '_checkpoints/'))
       SELECT run, max(last_modified) AS at, arg_max(key, struct_pack(m := last_modified, k := encode(key))) AS newest FROM r GROUP BY 1""".replace("\\\\", "\\"),
)
def q_latest_generation(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "stored_objects").where(F.col("key").startswith("_checkpoints/"))
    run = F.regexp_extract("key", r"(run-\d+)", 1)
    return rows.groupBy(run.alias("run")).agg(
        F.max("last_modified").alias("at"), F.max_by("key", F.struct("last_modified", "key")).alias("newest")
    )


_QUERY = ["casación", "laboral", "embargo"]


@book.add(
    "RET-02 RET-03",
    r"""WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+(?:[./-][\p{L}\p{N}_]+)*') AS w FROM documents WHERE text IS NOT NULL AND lang = 'es'),
       c AS (SELECT doc_id, len(w) AS n, len(list_filter(w, lambda x: x = 'casación')) AS n0, len(list_filter(w, lambda x: x = 'laboral')) AS n1, len(list_filter(w, lambda x: x = 'embargo')) AS n2 FROM t),
       d AS (SELECT count(*) AS total, count(*) FILTER (n0 > 0) AS d0, count(*) FILTER (n1 > 0) AS d1, count(*) FILTER (n2 > 0) AS d2 FROM c),
       s AS (SELECT doc_id, round(n0 / greatest(n, 1) * (ln((total + 1) / (d0 + 1)) + 1) + n1 / greatest(n, 1) * (ln((total + 1) / (d1 + 1)) + 1) + n2 / greatest(n, 1) * (ln((total + 1) / (d2 + 1)) + 1), 9) AS score FROM c, d)
       SELECT doc_id, round(score, 6) AS score FROM s WHERE score > 0 ORDER BY s.score DESC, doc_id LIMIT 50""",
)
def q_lexical_rank(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("text is not null and lang = 'es'")
    return V.lexical_rank(docs, "doc_id", "text", _QUERY, 50).select("doc_id", F.round("score", 6).alias("score"))


def _first_vector(spark: SparkSession, d: str) -> list[float]:
    row = table(spark, d, "embeddings").where("vec_id = 0").select("embedding").first()
    return list(row[0])


@book.add(
    "RET-04",
    """WITH q AS (SELECT embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id = 0)
       SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], e), 6) AS similarity FROM embeddings, q ORDER BY 2 DESC, 1 LIMIT 20""",
)
def q_vector_topk(spark: SparkSession, d: str) -> DataFrame:
    return V.nearest(table(spark, d, "embeddings"), "vec_id", "embedding", _first_vector(spark, d), 20)


@book.add(
    "RET-06",
    """WITH q AS (SELECT embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id = 0),
       a AS (SELECT vec_id, row_number() OVER (ORDER BY s DESC, vec_id) AS place FROM (SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], e), 6) AS s FROM embeddings, q ORDER BY s DESC, vec_id LIMIT 20)),
       b AS (SELECT vec_id, row_number() OVER (ORDER BY label DESC, vec_id) AS place FROM (SELECT vec_id, label FROM embeddings ORDER BY label DESC, vec_id LIMIT 20))
       SELECT vec_id, round(sum(1.0::DOUBLE / (60 + place)), 9) AS score FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY 1""",
)
def q_rank_fusion(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings")
    near = V.nearest(rows, "vec_id", "embedding", _first_vector(spark, d), 20)
    by_label = rows.select("vec_id", "label").orderBy(F.desc("label"), "vec_id").limit(20)
    return V.fuse([V.placed(near, F.desc("similarity"), F.asc("vec_id")), V.placed(by_label, F.desc("label"), F.asc("vec_id"))], "vec_id")


@book.add(
    "RET-01 RET-05",
    r"""WITH c AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[A-Z]{3}-[A-Z]{2}-\d{2}-\d{4,5}')) AS cited FROM documents),
            n AS (SELECT decision_number, min(doc_id) AS target FROM documents WHERE decision_number IS NOT NULL GROUP BY 1)
       SELECT doc_id, cited, target FROM c LEFT JOIN n ON cited = decision_number""",
)
def q_citations(spark: SparkSession, d: str) -> DataFrame:
    """Decisions cited in texts with the document they name; what resolves to none is kept."""
    docs = table(spark, d, "documents")
    found = F.regexp_extract_all("text", F.lit(r"([A-Z]{3}-[A-Z]{2}-\d{2}-\d{4,5})"), F.lit(1))
    cites = docs.select("doc_id", F.explode(found).alias("cited")).distinct()
    names = docs.where("decision_number is not null").groupBy(F.col("decision_number").alias("cited")).agg(F.min("doc_id").alias("target"))
    return cites.join(names, "cited", "left").select("doc_id", "cited", "target")


@book.add(
    "WIN-11",
    """SELECT source_artifact_id, text_id, row_number() OVER (PARTITION BY source_artifact_id ORDER BY page_index NULLS LAST, text_id) - 1 AS ordinal FROM source_texts""",
)
def q_ordinals(spark: SparkSession, d: str) -> DataFrame:
    order = Window.partitionBy("source_artifact_id").orderBy(F.asc_nulls_last("page_index"), "text_id")
    return table(spark, d, "source_texts").select("source_artifact_id", "text_id", (F.row_number().over(order) - 1).cast("bigint").alias("ordinal"))
