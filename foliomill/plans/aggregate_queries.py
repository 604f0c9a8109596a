"""Conditional, layered and ranked aggregates; evaluation metrics; gates and routing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliomill.functions import ratios as Q
from foliomill.functions import text as T
from foliomill.operators import ledger
from foliomill.operators.ranges import attach, percentiles, placed
from foliomill.plans.define import Book
from foliomill.runtime import materialize, table

book = Book()
STATUSES = ["stored", "unavailable", "failed"]


@book.add(
    "AGG-01 UPS-13 AGG-43 SRC-34",
    """SELECT snapshot_no, total, stored, unavailable, failed, CASE WHEN total = 0 THEN 'empty' WHEN failed = 0 THEN 'completed'
       WHEN stored = 0 THEN 'failed' ELSE 'partial' END AS state FROM (SELECT snapshot_no, count(*) AS total,
       count(*) FILTER (status = 'stored') AS stored, count(*) FILTER (status = 'unavailable') AS unavailable,
       count(*) FILTER (status = 'failed') AS failed FROM checkpoint_snapshots GROUP BY 1)""",
)
def q_conditional_run_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = ledger.status_counts(table(spark, d, "checkpoint_snapshots"), ["snapshot_no"], "status", STATUSES)
    return rows.withColumn("state", ledger.run_state(F.col("failed"), F.col("stored"), F.col("total")))


@book.add(
    "AGG-02 AGG-03 AGG-04 AGG-39",
    """WITH l AS (SELECT l_returnflag, l_orderkey, l_discount, l_quantity, l_linestatus = 'F' AS reliable FROM lineitem),
       o AS (SELECT l_returnflag, l_orderkey, avg(l_discount) AS m, max(l_discount) AS worst, bool_or(l_discount >= 0.1) AS loss,
                    bool_and(l_discount <= 0.08) AS ok FROM l WHERE reliable GROUP BY ALL),
       q AS (SELECT l_returnflag, count(*) AS n_docs, round(avg(m), 6) AS mean_of_means, round(quantile_cont(m, 0.5), 6) AS median_of_means,
                    round(quantile_cont(worst, 0.95), 6) AS p95_of_worst, count(*) FILTER (loss) AS n_loss,
                    round(count(*) FILTER (ok) / count(*), 6) AS pass_rate FROM o GROUP BY 1)
       SELECT s.*, coalesce(n_docs, 0) AS n_docs, mean_of_means, median_of_means, p95_of_worst, coalesce(n_loss, 0) AS n_loss,
              coalesce(pass_rate, 1.0) AS pass_rate FROM
       (SELECT l_returnflag, count(*) AS n_records, round(sum(l_quantity), 2) AS seconds FROM l GROUP BY 1) s LEFT JOIN q USING (l_returnflag)""",
)
def q_suite_report(spark: SparkSession, d: str) -> DataFrame:
    """Speed counts all records; quality only the reliable ones, by document and then over documents."""
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_orderkey", "l_discount", "l_quantity", (F.col("l_linestatus") == "F").alias("reliable"))
    docs = rows.where("reliable").groupBy("l_returnflag", "l_orderkey").agg(
        F.avg("l_discount").alias("m"),
        F.max("l_discount").alias("worst"),
        F.bool_or(F.col("l_discount") >= 0.1).alias("loss"),
        F.bool_and(F.col("l_discount") <= 0.08).alias("ok"),
    )
    docs = materialize(docs, "suite-docs")
    quality = docs.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.round(F.avg("m"), 6).alias("mean_of_means"),
        F.count_if("loss").alias("n_loss"),
        F.round(F.count_if("ok") / F.count(F.lit(1)), 6).alias("pass_rate"),
    )
    middle = percentiles(docs, ["l_returnflag"], "m", median_of_means=("linear", 0.5))
    high = percentiles(docs, ["l_returnflag"], "worst", p95_of_worst=("linear", 0.95))
    quality = quality.join(middle, "l_returnflag").join(high, "l_returnflag")
    quality = quality.withColumns({c: F.round(c, 6) for c in ("median_of_means", "p95_of_worst")})
    speed = rows.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_records"), F.round(F.sum("l_quantity"), 2).alias("seconds"))
    return speed.join(quality, "l_returnflag", "left").fillna({"n_docs": 0, "n_loss": 0, "pass_rate": 1.0})


@book.add(
    "AGG-05 AGG-06 AGG-07",
    """WITH r AS (SELECT o_orderpriority, o_totalprice, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) - 1 AS i,
                  count(*) OVER (PARTITION BY o_orderpriority) - 1 AS m FROM orders)
       SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.9), 4) AS linear,
              max(o_totalprice) FILTER (i = floor(0.9 * m)) AS floored, max(o_totalprice) FILTER (i = round_even(0.9 * m, 0)) AS rounded
       FROM r GROUP BY 1""",
)
def q_percentile_families(spark: SparkSession, d: str) -> DataFrame:
    asked = {"linear": ("linear", 0.9), "floored": ("floor", 0.9), "rounded": ("rounded", 0.9)}
    rows = percentiles(table(spark, d, "orders"), ["o_orderpriority"], "o_totalprice", **asked)
    return rows.withColumn("linear", F.round("linear", 4))


@book.add(
    "AGG-09 AGG-10 AGG-11 AGG-35 JOI-12",
    """WITH g AS (SELECT DISTINCT s.text_id, unnest(regexp_extract_all(lower(s.text), 'ley núm\\. \\d+-\\d+')) AS fact FROM source_texts s),
            p AS (SELECT DISTINCT c.text_id, unnest(regexp_extract_all(lower(c.candidate_text), 'ley núm\\. \\d+-\\d+')) AS fact
                  FROM candidate_texts c WHERE c.text_id IS NOT NULL AND c.candidate_text IS NOT NULL),
            j AS (SELECT g.fact IS NOT NULL AS ing, p.fact IS NOT NULL AS inp FROM g FULL JOIN p ON g.text_id = p.text_id AND g.fact = p.fact)
       SELECT tp, fp, fn, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall,
              round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM (
       SELECT count(*) FILTER (ing AND inp) AS tp, count(*) FILTER (inp AND NOT ing) AS fp, count(*) FILTER (ing AND NOT inp) AS fn FROM j)""",
)
def q_fact_metrics(spark: SparkSession, d: str) -> DataFrame:
    pattern = F.lit(r"(ley núm\. \d+-\d+)")
    gold = table(spark, d, "source_texts").select("text_id", F.explode(F.regexp_extract_all(F.lower("text"), pattern, F.lit(1))).alias("fact")).distinct()
    cand = table(spark, d, "candidate_texts").where("text_id is not null")
    cand = cand.select("text_id", F.explode(F.regexp_extract_all(F.lower("candidate_text"), pattern, F.lit(1))).alias("fact")).distinct()
    both = gold.withColumn("g", F.lit(True)).join(cand.withColumn("p", F.lit(True)), ["text_id", "fact"], "full_outer")
    sums = both.agg(
        F.count_if(F.col("g") & F.col("p")).alias("tp"),
        F.count_if(F.col("p") & F.col("g").isNull()).alias("fp"),
        F.count_if(F.col("g") & F.col("p").isNull()).alias("fn"),
    )
    p, r = Q.ratio_or_null(F.col("tp"), F.col("tp") + F.col("fp")), Q.ratio_or_null(F.col("tp"), F.col("tp") + F.col("fn"))
    return sums.select("tp", "fp", "fn", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(Q.f1(p, r), 6).alias("f1"))


@book.add(
    "AGG-12 FLT-18",
    """WITH g AS (SELECT text_id, authority AS family FROM source_texts), p AS (
         SELECT DISTINCT text_id, CASE adapter WHEN 'full_ocr' THEN 'ocr_text_layer' ELSE 'pdf_native_text_layer' END AS family
         FROM candidate_texts WHERE text_id IS NOT NULL),
       f AS (SELECT DISTINCT family FROM (SELECT family FROM g UNION ALL SELECT family FROM p)),
       s AS (SELECT 'all' AS stratum, (SELECT count(*) FROM g WHERE text_id IN (SELECT text_id FROM p)) AS matched,
               (SELECT count(*) FROM g) AS expected, (SELECT count(DISTINCT text_id) FROM p) AS predicted
             UNION ALL SELECT family, (SELECT count(*) FROM g JOIN p USING (text_id, family) WHERE family = f.family),
               (SELECT count(*) FROM g WHERE family = f.family), (SELECT count(*) FROM p WHERE family = f.family) FROM f)
       SELECT stratum, matched, expected, predicted, CASE WHEN expected < 100 THEN 'insufficient_sample'
         WHEN coalesce(matched / nullif(expected, 0) < 0.5, true) THEN 'fail' ELSE 'pass' END AS gate FROM s""",
)
def q_stratified_gate(spark: SparkSession, d: str) -> DataFrame:
    """Overall and by family: a key matched across families counts overall, but in none of the families."""
    gold = table(spark, d, "source_texts").select("text_id", F.col("authority").alias("family"))
    family = F.when(F.col("adapter") == "full_ocr", "ocr_text_layer").otherwise("pdf_native_text_layer")
    cand = table(spark, d, "candidate_texts").where("text_id is not null").select("text_id", family.alias("family")).distinct()

    def counts(g: DataFrame, p: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
        both = g.withColumn("g", F.lit(1)).join(p.withColumn("p", F.lit(1)), keys, "full_outer")
        rows = both.groupBy(*by) if by else both.groupBy()
        return rows.agg(F.count(F.col("g") + F.col("p")).alias("matched"), F.count("g").alias("expected"), F.count("p").alias("predicted"))

    overall = counts(gold.select("text_id"), cand.select("text_id").distinct(), ["text_id"], []).select(F.lit("all").alias("stratum"), "*")
    strata = counts(gold, cand, ["text_id", "family"], ["family"]).withColumnRenamed("family", "stratum")
    rows = overall.unionAll(strata)
    low = F.coalesce(Q.ratio_or_null(F.col("matched"), F.col("expected")) < 0.5, F.lit(True))
    gate = F.when(F.col("expected") < 100, "insufficient_sample").when(low, "fail").otherwise("pass")
    return rows.withColumn("gate", gate)


def _scores(spark: SparkSession, d: str) -> DataFrame:
    """Observations: whether a text carries a risk flag, and a score that may tell."""
    score = F.round(F.lit(1.0) / (F.lit(1.0) + F.length("text") / 1000.0), 2)
    return table(spark, d, "source_texts").where("text is not null and risk_flags is not null").select(
        "text_id", (F.size("risk_flags") > 0).alias("positive"), score.alias("p")
    )


_SCORES = """s AS (SELECT text_id, len(risk_flags) > 0 AS positive, round(1.0::DOUBLE / (1.0::DOUBLE + length(text) / 1000.0::DOUBLE), 2) AS p
              FROM source_texts WHERE text IS NOT NULL AND risk_flags IS NOT NULL)"""
_THRESHOLDS = [0.3, 0.4, 0.5, 0.6, 0.7]


@book.add(
    "AGG-16 AGG-17",
    f"""WITH {_SCORES}, t AS (SELECT unnest([0.3, 0.4, 0.5, 0.6, 0.7])::DOUBLE AS threshold)
        SELECT threshold, count(*) FILTER (positive AND p >= threshold) AS tp, count(*) FILTER (positive AND p < threshold) AS fn,
               count(*) FILTER (NOT positive AND p >= threshold) AS fp, count(*) FILTER (NOT positive AND p < threshold) AS tn,
               round(count(*) FILTER (positive AND p < threshold) / nullif(count(*) FILTER (positive), 0), 6) AS fnr,
               round(count(*) FILTER (NOT positive AND p >= threshold) / nullif(count(*) FILTER (NOT positive), 0), 6) AS fpr
        FROM s, t GROUP BY 1""",
)
def q_threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    return _sweep(_scores(spark, d))


def _sweep(scores: DataFrame) -> DataFrame:
    """All thresholds in one scan: the thresholds are a fixed list, so each row counts for each of them in place."""
    rows = scores.withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in _THRESHOLDS])))
    hit = F.col("p") >= F.col("threshold")
    sums = rows.groupBy("threshold").agg(
        F.count_if(F.col("positive") & hit).alias("tp"),
        F.count_if(F.col("positive") & ~hit).alias("fn"),
        F.count_if(~F.col("positive") & hit).alias("fp"),
        F.count_if(~F.col("positive") & ~hit).alias("tn"),
    )
    rate = lambda a, b: F.round(Q.ratio_or_null(F.col(a), F.col(a) + F.col(b)), 6)
    return sums.select("*", rate("fn", "tp").alias("fnr"), rate("fp", "tn").alias("fpr"))


@book.add(
    "AGG-18 AGG-19 FLT-19 SRT-15",
    f"""WITH {_SCORES}, t AS (SELECT unnest([0.3, 0.4, 0.5, 0.6, 0.7])::DOUBLE AS threshold),
        c AS (SELECT threshold, round(count(*) FILTER (positive AND p < threshold) / nullif(count(*) FILTER (positive), 0), 6) AS fnr,
                round(count(*) FILTER (NOT positive AND p >= threshold) / nullif(count(*) FILTER (NOT positive), 0), 6) AS fpr
              FROM s, t WHERE text_id % 2 = 0 GROUP BY 1 ORDER BY fnr, fpr, threshold DESC LIMIT 1)
        SELECT threshold, count(*) FILTER (positive) AS positives, count(*) FILTER (NOT positive) AS negatives,
               round(count(*) FILTER (positive AND p < threshold) / nullif(count(*) FILTER (positive), 0), 6) AS fnr,
               round(avg(pow(p - positive::INT, 2)), 6) AS brier FROM s, c WHERE text_id % 2 = 1 GROUP BY 1""",
)
def q_frozen_threshold(spark: SparkSession, d: str) -> DataFrame:
    """The threshold chosen on one half is used, unchanged, on the other."""
    scores = _scores(spark, d)
    chosen = _sweep(scores.where("text_id % 2 = 0")).orderBy("fnr", "fpr", F.desc("threshold")).limit(1).select("threshold")
    rows = scores.where("text_id % 2 = 1").crossJoin(F.broadcast(chosen))  # one row
    hit = F.col("p") >= F.col("threshold")
    return rows.groupBy("threshold").agg(
        F.count_if("positive").alias("positives"),
        F.count_if(~F.col("positive")).alias("negatives"),
        F.round(Q.ratio_or_null(F.count_if(F.col("positive") & ~hit), F.count_if("positive")), 6).alias("fnr"),
        F.round(F.avg(F.pow(F.col("p") - F.col("positive").cast("int"), F.lit(2.0))), 6).alias("brier"),
    )


@book.add(
    "AGG-14 MAT-01 STR-10 STR-02",
    r"""WITH p AS (SELECT c.candidate_id, s.text AS e, c.candidate_text AS t FROM candidate_texts c JOIN source_texts s USING (text_id)
                  WHERE s.text IS NOT NULL AND c.candidate_text IS NOT NULL),
        a AS (SELECT candidate_id, w, count(*) AS n FROM (SELECT candidate_id, unnest(regexp_extract_all(lower(e), '[\p{L}\p{N}_]+(?:[./-][\p{L}\p{N}_]+)*')) AS w FROM p) GROUP BY ALL),
        b AS (SELECT candidate_id, w, count(*) AS n FROM (SELECT candidate_id, unnest(regexp_extract_all(lower(t), '[\p{L}\p{N}_]+(?:[./-][\p{L}\p{N}_]+)*')) AS w FROM p) GROUP BY ALL),
        m AS (SELECT candidate_id, sum(least(a.n, b.n)) AS matched FROM a JOIN b USING (candidate_id, w) GROUP BY 1),
        x AS (SELECT candidate_id, sum(n) AS n FROM a GROUP BY 1), y AS (SELECT candidate_id, sum(n) AS n FROM b GROUP BY 1)
        SELECT p.candidate_id, coalesce(matched, 0)::BIGINT AS matched, coalesce(x.n, 0)::BIGINT AS expected, coalesce(y.n, 0)::BIGINT AS predicted,
               round(CASE WHEN coalesce(y.n, 0) = 0 AND coalesce(x.n, 0) = 0 THEN 1 WHEN coalesce(y.n, 0) = 0 THEN 0 ELSE coalesce(matched, 0) / y.n END, 6) AS precision,
               round(CASE WHEN coalesce(x.n, 0) = 0 THEN 1 ELSE coalesce(matched, 0) / x.n END, 6) AS recall
        FROM p LEFT JOIN m USING (candidate_id) LEFT JOIN x USING (candidate_id) LEFT JOIN y USING (candidate_id)""",
)
def q_token_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Bag overlap of a candidate with its reference: each token once with its count on either side. The counts stay where the
    join has put the pair, so nothing is shuffled for them."""
    side = lambda col, e, c: F.transform(T.tokens(F.col(col)), lambda w: F.struct(w.alias("w"), F.lit(e).alias("e"), F.lit(c).alias("c")))
    # a mark of no word keeps the pairs that have none
    mark = F.array(F.struct(F.lit(None).cast("string").alias("w"), F.lit(0).alias("e"), F.lit(0).alias("c")))
    rows = _pairs(spark, d).select("text_id", "candidate_id", F.explode(F.concat(mark, side("expected", 1, 0), side("candidate", 0, 1))).alias("t"))
    words = rows.groupBy("text_id", "candidate_id", "t.w").agg(F.sum("t.e").alias("e"), F.sum("t.c").alias("c"))
    rows = words.groupBy("text_id", "candidate_id").agg(
        F.sum(F.least("e", "c")).alias("matched"), F.sum("e").alias("expected"), F.sum("c").alias("predicted")
    ).drop("text_id")
    m, p, e = F.col("matched"), F.col("predicted"), F.col("expected")
    return rows.select("*", F.round(Q.overlap_precision(m, p, e), 6).alias("precision"), F.round(Q.overlap_recall(m, e), 6).alias("recall"))


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "source_texts").where("text is not null").select("text_id", F.col("text").alias("expected"))
    cand = table(spark, d, "candidate_texts").where("candidate_text is not null")
    return cand.select("candidate_id", "text_id", "adapter", F.col("candidate_text").alias("candidate")).join(texts, "text_id")


@book.add(
    "AGG-20 AGG-24 AGG-32",
    """SELECT event_type, count(*) AS n, count(*) FILTER (value < 10) AS n_low, round(avg(value), 6) AS mean_value,
       round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.1), 6) AS p10,
       max(value) AS greatest, round(count(*) FILTER (value < 10) / count(*), 6) AS low_share,
       round(count(*) / (date_diff('second', min(ts), max(ts)) + 1), 9) AS per_second FROM events GROUP BY 1""",
)
def q_corpus_aggregate(spark: SparkSession, d: str) -> DataFrame:
    low = F.count_if(F.col("value") < 10)
    seconds = F.unix_seconds(F.max("ts").cast("timestamp")) - F.unix_seconds(F.min("ts").cast("timestamp")) + 1
    events = table(spark, d, "events")
    rows = events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        low.alias("n_low"),
        F.round(F.avg("value"), 6).alias("mean_value"),
        F.max("value").alias("greatest"),
        F.round(low / F.count(F.lit(1)), 6).alias("low_share"),
        F.round(F.count(F.lit(1)) / seconds, 9).alias("per_second"),
    )
    ranks = percentiles(events, ["event_type"], "value", p50=("linear", 0.5), p95=("linear", 0.95), p10=("linear", 0.1))
    return attach(rows, ranks, ["event_type"], "left").withColumns({c: F.round(c, 6) for c in ("p50", "p95", "p10")})


@book.add(
    "AGG-22 AGG-23 SRT-05",
    """WITH s AS (SELECT source_artifact_id, count(*) AS pages, count(*) FILTER (authority = 'ocr_text_layer') AS ocr,
                 count(*) FILTER (text IS NULL OR trim(text) = '') AS empty FROM source_texts GROUP BY 1)
       SELECT source_artifact_id, pages, ocr, empty, round(ocr / pages, 6) AS ocr_share,
              CASE WHEN ocr = 0 THEN 'native' WHEN ocr = pages THEN 'scanned' ELSE 'mixed' END AS tier,
              row_number() OVER (ORDER BY round(ocr / pages, 6) DESC, pages DESC, source_artifact_id) AS place FROM s""",
)
def q_census_summary(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "source_texts").groupBy("source_artifact_id").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("authority") == "ocr_text_layer").alias("ocr"),
        F.count_if(F.col("text").isNull() | (F.trim("text") == "")).alias("empty"),
    )
    tier = F.when(F.col("ocr") == 0, "native").when(F.col("ocr") == F.col("pages"), "scanned").otherwise("mixed")
    docs = docs.select("*", F.round(F.col("ocr") / F.col("pages"), 6).alias("ocr_share"), tier.alias("tier"))
    return placed(docs, F.desc("ocr_share"), F.desc("pages"), F.asc("source_artifact_id"))


@book.add(
    "AGG-23 AGG-52",
    """SELECT authority, count(*) AS n_texts, count(DISTINCT source_artifact_id) AS n_docs, min(page_index) AS first_page,
       count(*) FILTER (length(text) >= 1000) AS n_long, count(*) FILTER (contains(lower(text), 'considerando')) AS n_considerando,
       round(count(*) / (SELECT count(*) FROM source_texts), 6) AS share FROM source_texts GROUP BY 1""",
)
def q_census_rollup(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "source_texts")
    rows = texts.groupBy("authority").agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.count_distinct("source_artifact_id").alias("n_docs"),
        F.min("page_index").alias("first_page"),
        F.count_if(F.length("text") >= 1000).alias("n_long"),
        F.count_if(F.contains(F.lower("text"), F.lit("considerando"))).alias("n_considerando"),
    )
    total = rows.agg(F.sum("n_texts").alias("t"))
    return rows.crossJoin(F.broadcast(total)).withColumn("share", F.round(F.col("n_texts") / F.col("t"), 6)).drop("t")


@book.add(
    "AGG-25 AGG-26 AGG-50 SRC-47",
    """WITH r AS (SELECT collection, page_count, byte_count, row_number() OVER (PARTITION BY collection ORDER BY page_count) - 1 AS i,
         count(page_count) OVER (PARTITION BY collection) - 1 AS m FROM source_artifacts WHERE page_count IS NOT NULL)
       SELECT a.collection, count(*) AS n, count(*) FILTER (file_extension = 'pdf') AS n_pdf, count(*) FILTER (page_count IS NULL) AS n_unread,
         sum(page_count)::BIGINT AS pages, min(page_count) AS least, max(page_count) AS most, round(avg(page_count), 6) AS mean_pages,
         (SELECT max(page_count) FROM r WHERE r.collection = a.collection AND i = floor(0.95 * m)) AS p95_floor,
         count(*) - count(DISTINCT sha256) AS n_repeated FROM source_artifacts a GROUP BY 1""",
)
def q_inventory_summary(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "source_artifacts")
    rows = files.groupBy("collection").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("file_extension") == "pdf").alias("n_pdf"),
        F.count_if(F.col("page_count").isNull()).alias("n_unread"),
        F.sum("page_count").alias("pages"),
        F.min("page_count").alias("least"),
        F.max("page_count").alias("most"),
        F.round(F.avg("page_count"), 6).alias("mean_pages"),
        (F.count(F.lit(1)) - F.count_distinct("sha256")).alias("n_repeated"),
    )
    ranks = percentiles(files, ["collection"], "page_count", p95_floor=("floor", 0.95))
    return attach(rows, ranks, ["collection"], "left")


@book.add(
    "AGG-26 SRC-04",
    """SELECT doc_id, md5(text) AS h, n FROM (SELECT doc_id, text, count(*) OVER (PARTITION BY text) AS n,
       row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents WHERE text IS NOT NULL) WHERE r = 1 AND n > 1""",
)
def q_merge_first_wins(spark: SparkSession, d: str) -> DataFrame:
    """Repeated texts: the first id and how often; grouped by digest with partial sums, no group is ever in one place."""
    rows = table(spark, d, "documents").where("text is not null").select("doc_id", F.md5("text").alias("h"))
    return rows.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")).where("n > 1")


@book.add(
    "AGG-29 AGG-30 AGG-31 MAT-04",
    """SELECT adapter, sum(nullif(length(candidate_text), 0))::BIGINT AS known, sum(coalesce(length(candidate_text), 0))::BIGINT AS with_zero,
       round(avg(nullif(length(candidate_text), 0)), 6) AS mean_known, sum(CASE WHEN text_id IS NULL THEN 1 END)::BIGINT AS orphans
       FROM candidate_texts GROUP BY 1""",
)
def q_usage_null_sums(spark: SparkSession, d: str) -> DataFrame:
    size = F.nullif(F.length("candidate_text"), F.lit(0))
    return table(spark, d, "candidate_texts").groupBy("adapter").agg(
        F.sum(size).alias("known"),
        F.sum(F.coalesce(F.length("candidate_text"), F.lit(0))).alias("with_zero"),
        F.round(F.avg(size), 6).alias("mean_known"),
        F.sum(F.when(F.col("text_id").isNull(), 1)).alias("orphans"),
    )


@book.add(
    "AGG-33 AGG-34",
    """WITH p AS (SELECT text_id, count(*) AS n, bool_and(coalesce(length(candidate_text), 0) > 500) AS ok FROM candidate_texts
                  WHERE text_id IS NOT NULL GROUP BY 1)
       SELECT count(*) AS n_texts, count(*) FILTER (n >= 2) AS n_pairs, round(avg((n >= 2 AND ok)::INT), 6) AS pair_rate,
              coalesce(round(avg(ok::INT) FILTER (n >= 2), 6), 1.0) AS among_pairs FROM p""",
)
def q_paired_rates(spark: SparkSession, d: str) -> DataFrame:
    ok = F.bool_and(F.coalesce(F.length("candidate_text"), F.lit(0)) > 500)
    pairs = table(spark, d, "candidate_texts").where("text_id is not null").groupBy("text_id").agg(F.count(F.lit(1)).alias("n"), ok.alias("ok"))
    two = F.col("n") >= 2
    return pairs.agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.count_if(two).alias("n_pairs"),
        F.round(F.avg((two & F.col("ok")).cast("int")), 6).alias("pair_rate"),
        F.coalesce(F.round(F.avg(F.when(two, F.col("ok").cast("int"))), 6), F.lit(1.0)).alias("among_pairs"),
    )


@book.add(
    "AGG-38 FLT-15",
    """WITH p AS (SELECT unnest(['all', 'no_length', 'no_lang']) AS profile), s AS (
         SELECT profile, doc_id, greatest(0, least(1, CASE WHEN profile <> 'no_length' AND n_chars > 1500 THEN 0.5 ELSE 0 END
           + CASE WHEN profile <> 'no_lang' AND lang = 'es' THEN 0.4 ELSE 0 END + CASE WHEN source IS NULL THEN -0.3 ELSE 0.1 END)) AS score
         FROM documents, p),
       c AS (SELECT profile, doc_id, CASE WHEN score >= 0.8 THEN 'accept' WHEN score >= 0.5 THEN 'review' ELSE 'weak' END AS disposition FROM s)
       SELECT c.profile, c.disposition, count(*) AS n, count(*) FILTER (c.disposition <> b.disposition) AS n_changed
       FROM c JOIN c b ON c.doc_id = b.doc_id AND b.profile = 'all' GROUP BY ALL""",
)
def q_ablation(spark: SparkSession, d: str) -> DataFrame:
    """Dispositions with signals switched off; the profiles are a fixed list, so a row is judged for each in place."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars", "lang", "source")

    def disposition(off: str) -> Column:
        size = F.when(F.lit(off != "no_length") & (F.col("n_chars") > 1500), F.lit(0.5)).otherwise(F.lit(0.0))
        lang = F.when(F.lit(off != "no_lang") & (F.col("lang") == "es"), F.lit(0.4)).otherwise(F.lit(0.0))
        known = F.when(F.col("source").isNull(), F.lit(-0.3)).otherwise(F.lit(0.1))
        score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(size + lang + known, 6)))
        return F.when(score >= 0.8, "accept").when(score >= 0.5, "review").otherwise("weak")

    profiles = ["all", "no_length", "no_lang"]
    judged = F.explode(F.array(*[F.struct(F.lit(p).alias("profile"), disposition(p).alias("disposition")) for p in profiles]))
    rows = docs.select(disposition("all").alias("base"), judged.alias("j")).select("base", "j.*")
    return rows.groupBy("profile", "disposition").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("disposition") != F.col("base")).alias("n_changed"))


@book.add(
    "AGG-40 AGG-41 AGG-48",
    """WITH c AS (SELECT l_suppkey, l_linenumber, count(*) AS n, min(l_orderkey * 10 + l_linenumber) AS first_seen FROM lineitem GROUP BY ALL),
       r AS (SELECT *, rank() OVER (PARTITION BY l_suppkey ORDER BY n DESC) AS k,
               row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, first_seen) AS f FROM c)
       SELECT l_suppkey, CASE WHEN count(*) FILTER (k = 1) = 1 THEN max(l_linenumber) FILTER (k = 1) END AS strict_mode,
              max(l_linenumber) FILTER (f = 1) AS first_mode FROM r GROUP BY 1""",
)
def q_modes(spark: SparkSession, d: str) -> DataFrame:
    """The most usual value: null on ties, or the one seen first."""
    first = F.min(F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    counts = table(spark, d, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"), first.alias("first"))
    best = counts.groupBy("l_suppkey").agg(
        F.max("n").alias("m"), F.max_by("l_linenumber", F.struct("n", -F.col("first"))).alias("first_mode")
    )
    top = counts.join(best, "l_suppkey").where("n = m").groupBy("l_suppkey", "first_mode")
    return top.agg(F.when(F.count(F.lit(1)) == 1, F.max("l_linenumber")).alias("strict_mode")).select("l_suppkey", "strict_mode", "first_mode")


@book.add(
    "AGG-46 AGG-49",
    """SELECT collection, list_sort(list(DISTINCT file_extension)) AS extensions, list_sort(list(DISTINCT source)) AS sources,
       count(DISTINCT page_count) AS n_page_counts FROM source_artifacts GROUP BY 1""",
)
def q_field_profile(spark: SparkSession, d: str) -> DataFrame:
    """Distinct values of fields with a small domain."""
    return table(spark, d, "source_artifacts").groupBy("collection").agg(
        F.sort_array(F.collect_set("file_extension")).alias("extensions"),
        F.sort_array(F.collect_set("source")).alias("sources"),
        F.count_distinct("page_count").alias("n_page_counts"),
    )


@book.add(
    "AGG-54 AGG-56 GRF-06",
    """WITH a AS (SELECT source_identifier, count(*) AS n FROM checkpoint_snapshots WHERE snapshot_no = 1 GROUP BY 1),
            b AS (SELECT source_identifier, count(*) AS n FROM checkpoint_snapshots WHERE snapshot_no = 2 GROUP BY 1)
       SELECT CASE WHEN a.n IS NULL THEN 'added' WHEN b.n IS NULL THEN 'deleted' WHEN a.n <> b.n THEN 'modified' ELSE 'same' END AS state,
              count(*) AS n_keys, sum(coalesce(b.n, 0) - coalesce(a.n, 0))::BIGINT AS delta
       FROM a FULL JOIN b ON a.source_identifier = b.source_identifier GROUP BY 1""",
)
def q_before_after(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "checkpoint_snapshots")
    at = lambda n, name: rows.where(F.col("snapshot_no") == n).groupBy("source_identifier").agg(F.count(F.lit(1)).alias(name))
    both = at(1, "a").join(at(2, "b"), "source_identifier", "full_outer")
    state = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "deleted").when(F.col("a") != F.col("b"), "modified").otherwise("same")
    delta = F.coalesce("b", F.lit(0)) - F.coalesce("a", F.lit(0))
    return both.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n_keys"), F.sum(delta).alias("delta"))


@book.add(
    "FLT-12 FLT-13 FLT-14",
    """WITH p AS (SELECT text_id, authority, length(text) AS n, (length(text) - length(regexp_replace(text, '[0-9]', '', 'g'))) / nullif(length(text), 0) AS figures FROM source_texts)
       SELECT text_id, CASE WHEN n IS NULL OR n = 0 THEN 'no_text' WHEN n < 200 THEN 'low_information' WHEN authority = 'ocr_text_layer' AND figures > 0.06 THEN 'visual_check'
         WHEN figures > 0.08 THEN 'material_error' WHEN authority <> 'ocr_text_layer' THEN 'accept' ELSE 'sample' END AS route FROM p""",
)
def q_routing(spark: SparkSession, d: str) -> DataFrame:
    """Ordered rules: the first that holds decides."""
    text = F.col("text")
    figures = (F.length(text) - F.length(F.regexp_replace(text, "[0-9]", ""))) / F.nullif(F.length(text), F.lit(0))
    scanned = F.col("authority") == "ocr_text_layer"
    route = (
        F.when(text.isNull() | (F.length(text) == 0), "no_text")
        .when(F.length(text) < 200, "low_information")
        .when(scanned & (figures > 0.06), "visual_check")
        .when(figures > 0.08, "material_error")
        .when(~scanned, "accept")
        .otherwise("sample")
    )
    return table(spark, d, "source_texts").select("text_id", route.alias("route"))


@book.add(
    "FLT-07 FLT-08 FLT-29 FLT-10",
    """SELECT candidate_id, list_filter([CASE WHEN length(c.candidate_text) = 0 THEN 'empty_candidate' END,
         CASE WHEN length(c.candidate_text) < 0.8::DOUBLE * length(s.text) THEN 'too_short' END,
         CASE WHEN length(c.candidate_text) > 1.2::DOUBLE * length(s.text) THEN 'too_long' END,
         CASE WHEN len(s.risk_flags) > 0 THEN 'unreliable_reference' END], lambda x: x IS NOT NULL) AS reasons
       FROM candidate_texts c JOIN source_texts s USING (text_id) WHERE c.candidate_text IS NOT NULL AND s.text IS NOT NULL""",
)
def q_admission_reasons(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "source_texts").where("text is not null").select("text_id", F.length("text").alias("e"), "risk_flags")
    cand = table(spark, d, "candidate_texts").where("candidate_text is not null").select("candidate_id", "text_id", F.length("candidate_text").alias("c"))
    c, e = F.col("c"), F.col("e")
    reasons = F.array_compact(
        F.array(
            F.when(c == 0, "empty_candidate"),
            F.when(c < 0.8 * e, "too_short"),
            F.when(c > 1.2 * e, "too_long"),
            F.when(F.size("risk_flags") > 0, "unreliable_reference"),
        )
    )
    return cand.join(texts, "text_id").select("candidate_id", reasons.alias("reasons"))


@book.add(
    "FLT-17",
    """WITH w AS (SELECT unnest(['pdf_aware', 'full_ocr', 'visual_model', 'absent_model']) AS adapter),
       m AS (SELECT adapter, avg(length(candidate_text)) AS mean_chars, count(*) FILTER (candidate_text IS NULL) / count(*) AS null_share FROM candidate_texts GROUP BY 1)
       SELECT adapter, m.adapter IS NOT NULL AS present, coalesce(mean_chars >= 1000, false) AS long_enough, coalesce(null_share <= 0.01, false) AS complete,
              m.adapter IS NOT NULL AND coalesce(mean_chars >= 1000, false) AND coalesce(null_share <= 0.01, false) AS passed FROM w LEFT JOIN m USING (adapter)""",
)
def q_quality_gate(spark: SparkSession, d: str) -> DataFrame:
    wanted = spark.createDataFrame([(x,) for x in ("pdf_aware", "full_ocr", "visual_model", "absent_model")], "adapter string")
    seen = table(spark, d, "candidate_texts").groupBy("adapter").agg(
        F.avg(F.length("candidate_text")).alias("m"), (F.count_if(F.col("candidate_text").isNull()) / F.count(F.lit(1))).alias("n")
    )
    checks = {
        "present": F.col("m").isNotNull(),
        "long_enough": F.coalesce(F.col("m") >= 1000, F.lit(False)),
        "complete": F.coalesce(F.col("n") <= 0.01, F.lit(False)),
    }
    passed = reduce(lambda a, b: a & b, checks.values())
    return wanted.join(seen, "adapter", "left").select("adapter", *[c.alias(k) for k, c in checks.items()], passed.alias("passed"))


@book.add(
    "FLT-20",
    """SELECT CASE WHEN status = 'stored' THEN 'none' WHEN regexp_matches(lower(coalesce(error_type, '')), 'timeout|connection') THEN 'transient'
         WHEN contains(lower(coalesce(error_type, '')), 'http') THEN 'remote' WHEN reason IS NOT NULL THEN 'content' ELSE 'unknown' END AS kind,
       regexp_matches(lower(coalesce(error_type, '')), 'timeout|connection|http') AS retryable, count(*) AS n FROM checkpoint_snapshots GROUP BY ALL""",
)
def q_error_class(spark: SparkSession, d: str) -> DataFrame:
    e = F.lower(F.coalesce("error_type", F.lit("")))
    kind = (
        F.when(F.col("status") == "stored", "none")
        .when(e.rlike("timeout|connection"), "transient")
        .when(e.contains("http"), "remote")
        .when(F.col("reason").isNotNull(), "content")
        .otherwise("unknown")
    )
    return table(spark, d, "checkpoint_snapshots").groupBy(kind.alias("kind"), e.rlike("timeout|connection|http").alias("retryable")).agg(F.count(F.lit(1)).alias("n"))


@book.add(
    "FLT-25 TMP-07 FLT-33",
    """SELECT 'repeated_key' AS violation, count(*) AS n FROM (SELECT key FROM stored_objects GROUP BY key HAVING count(*) > 1)
       UNION ALL SELECT 'stored_without_hash', count(*) FROM checkpoint_snapshots WHERE status = 'stored' AND sha256 IS NULL
       UNION ALL SELECT 'two_sources', count(*) FROM (SELECT source_artifact_id FROM source_texts GROUP BY 1 HAVING count(DISTINCT source) > 1)
       UNION ALL SELECT 'bad_hash', count(*) FROM source_artifacts WHERE NOT regexp_full_match(sha256, '[0-9a-f]{64}')""",
)
def q_constraint_violations(spark: SparkSession, d: str) -> DataFrame:
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("violation"), "n")
    keys = table(spark, d, "stored_objects").groupBy("key").count().where("count > 1")
    hashes = table(spark, d, "checkpoint_snapshots").where("status = 'stored' and sha256 is null")
    sources = table(spark, d, "source_texts").groupBy("source_artifact_id").agg(F.count_distinct("source").alias("k")).where("k > 1")
    bad = table(spark, d, "source_artifacts").where(~F.col("sha256").rlike("^[0-9a-f]{64}$"))
    parts = [one(keys, "repeated_key"), one(hashes, "stored_without_hash"), one(sources, "two_sources"), one(bad, "bad_hash")]
    return reduce(DataFrame.unionAll, parts)
