"""Fidelity of candidate texts to their references, and evidence about two readings of a page."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.functions import fidelity as Y
from foliomill.functions import patterns as P
from foliomill.functions import text as T
from foliomill.plans.define import Book
from foliomill.runtime import table

book = Book()

#: The patterns of the SQL know ASCII only: there Spanish letters become one underscore, in texts and in patterns, others two.
_ASCII = "regexp_replace(translate({0}, 'áéíóúüñºÁÉÍÓÚÜÑ', '_______________'), '[ªÀ-ÖØ-öø-ɏͰ-ϿЀ-ӿ]', '__', 'g')"
_PLAIN = f"regexp_replace(translate({{0}}, '{T.ACCENTED}', '{T.PLAIN}'), '[ªºÀ-ÖØ-öø-ɏͰ-ϿЀ-ӿ]', 'x', 'g')"
_PAIRS = "p AS (SELECT candidate_id, s.text AS e, c.candidate_text AS t FROM candidate_texts c JOIN source_texts s USING (text_id) WHERE s.text IS NOT NULL AND c.candidate_text IS NOT NULL)"


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


def _ascii(pattern: str) -> str:
    return re.sub("[ªºÀ-ÖØ-öø-ɏ]", "_", _quoted(pattern))


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "source_texts").where("text is not null").select("text_id", F.col("text").alias("e"))
    cand = table(spark, d, "candidate_texts").where("candidate_text is not null").select("candidate_id", "text_id", F.col("candidate_text").alias("c"))
    return cand.join(texts, "text_id")


@book.add("STR-06 STR-08 STR-09 STR-12 AGG-08")
def q_fidelity_scores(spark: SparkSession, d: str) -> DataFrame:
    """Character and word errors, content overlap and order of each candidate; the recurrences have no SQL form."""
    rows = _pairs(spark, d).select("candidate_id", Y.fidelity("e", "c").alias("s"))
    return rows.select("candidate_id", *[F.round(f"s.{n}", 6).alias(n) for n in Y.NAMES])


def _critical_sql() -> str:
    one = "SELECT '{name}' AS category, candidate_id, unnest(list_transform(regexp_extract_all({text}, '{pattern}'), lambda x: lower(trim(regexp_replace(x, '\\s+', ' ', 'g'))))) AS v, {e} AS e, {c} AS c FROM p"
    parts = [
        one.format(name=n, pattern=_ascii(p), text=_ASCII.format(col), e=int(col == "e"), c=int(col == "t"))
        for n, p in P.CRITICAL.items()
        for col in ("e", "t")
    ]
    names = ", ".join(f"'{n}'" for n in P.CRITICAL)
    return f"""WITH {_PAIRS}, v AS ({" UNION ALL ".join(parts)}),
      k AS (SELECT category, candidate_id, v, sum(e) AS e, sum(c) AS c FROM v GROUP BY ALL),
      s AS (SELECT category, sum(e)::BIGINT AS expected, sum(least(e, c))::BIGINT AS matched FROM k GROUP BY 1)
      SELECT n.category, coalesce(expected, 0) AS expected, coalesce(matched, 0) AS matched,
             round(CASE WHEN coalesce(expected, 0) = 0 THEN 1.0 ELSE matched / expected END, 6) AS recall
      FROM (SELECT unnest([{names}]) AS category) n LEFT JOIN s USING (category)"""


@book.add("STR-11 STR-12", _critical_sql())
def q_critical_recall(spark: SparkSession, d: str) -> DataFrame:
    """Critical spans of the references, and how many of them the candidates kept, by category; counted inside the row."""
    rows = _pairs(spark, d)
    kinds = []
    for name, pattern in P.CRITICAL.items():
        e, c = P.folded(F.col("e"), pattern), P.folded(F.col("c"), pattern)
        kinds.append(F.struct(F.lit(name).alias("category"), F.size(e).alias("expected"), P.bag_overlap(e, c).alias("matched")))
    sums = rows.select(F.inline(F.array(*kinds))).groupBy("category").agg(F.sum("expected").alias("expected"), F.sum("matched").alias("matched"))
    names = spark.createDataFrame([(n,) for n in P.CRITICAL], "category string")
    sums = names.join(sums, "category", "left").fillna(0)
    recall = F.when(F.col("expected") == 0, F.lit(1.0)).otherwise(F.col("matched") / F.col("expected"))
    return sums.withColumn("recall", F.round(recall, 6))


def _legal_sql() -> str:
    fold = {"money": "trim(regexp_replace(x, '\\s+', ' ', 'g'))", "reference": "lower(trim(regexp_replace(x, '\\s+', ' ', 'g')))"}
    one = "SELECT candidate_id, '{n}' AS category, list_distinct(list_transform(regexp_extract_all({e}, '{p}'), lambda x: {f})) AS a, list_distinct(list_transform(regexp_extract_all({t}, '{p}'), lambda x: {f})) AS b FROM p"
    parts = [one.format(n=n, p=_quoted(p), f=fold.get(n, "x"), e=_PLAIN.format("e"), t=_PLAIN.format("t")) for n, p in P.LEGAL.items()]
    return f"""WITH {_PAIRS}, v AS ({" UNION ALL ".join(parts)}),
      x AS (SELECT candidate_id, category, list_sort(list_filter(a, lambda y: NOT list_contains(b, y))) AS first_only, list_sort(list_filter(b, lambda y: NOT list_contains(a, y))) AS second_only FROM v)
      SELECT * FROM x WHERE len(first_only) + len(second_only) > 0"""


@book.add("STR-13 SET-07", _legal_sql())
def q_legal_differences(spark: SparkSession, d: str) -> DataFrame:
    """Legal spans that only one of two readings has, by category; compared without accents."""
    kinds = []
    for name, pattern in P.LEGAL.items():
        get = P.folded if name == "reference" else P.found
        a, b = (F.array_distinct(get(T.plain_letters(F.col(c)), pattern)) for c in ("e", "c"))
        kinds.append(F.struct(F.lit(name).alias("category"), F.array_sort(F.array_except(a, b)).alias("first_only"), F.array_sort(F.array_except(b, a)).alias("second_only")))
    rows = _pairs(spark, d).select("candidate_id", F.inline(F.array(*kinds)))
    return rows.where((F.size("first_only") > 0) | (F.size("second_only") > 0))


_RUNS = "|".join(f"{c}{{{{30,}}}}" for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789áéíóúüñÁÉÍÓÚÜÑ").replace("{{", "{").replace("}}", "}")


@book.add(
    "STR-15",
    rf"""WITH l AS (SELECT text_id, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS line FROM (SELECT text_id, list_filter(list_transform(string_split_regex(text, '\r\n|\n|\r|\x0b|\f|\x1c|\x1d|\x1e|\x{{85}}|\x{{2028}}|\x{{2029}}'), lambda y: trim(y)), lambda y: y <> '') AS x FROM source_texts WHERE text IS NOT NULL)),
       f AS (SELECT *, CASE WHEN lag(line) OVER w IS NOT DISTINCT FROM line AND lag(i) OVER w IS NOT NULL THEN 0 ELSE 1 END AS fresh FROM l WINDOW w AS (PARTITION BY text_id ORDER BY i)),
       g AS (SELECT text_id, sum(fresh) OVER (PARTITION BY text_id ORDER BY i) AS k FROM f), r AS (SELECT text_id, k, count(*) AS n FROM g GROUP BY ALL), b AS (SELECT text_id, max(n) AS n FROM r GROUP BY 1)
       SELECT text_id, list_filter([CASE WHEN trim(regexp_replace(text, '[\s\x{{a0}}\x{{85}}]+', ' ', 'g')) = '' THEN 'empty' END,
         {", ".join(f"CASE WHEN regexp_matches(text, '{_quoted(p)}') THEN '{n}' END" for n, p in P.ANOMALIES.items())},
         CASE WHEN b.n >= {P.LOOP} THEN 'repetition_loop' END, CASE WHEN regexp_matches(text, '{_RUNS}') THEN 'repeated_character' END], lambda x: x IS NOT NULL) AS labels
       FROM source_texts LEFT JOIN b USING (text_id) WHERE text IS NOT NULL""",
)
def q_text_anomalies(spark: SparkSession, d: str) -> DataFrame:
    text = F.col("text")
    lines = F.filter(F.transform(T.lines(text), T.collapse), lambda x: x != "")
    labels = [F.when(T.is_blank(text), "empty")]
    labels += [F.when(text.rlike(P.unicode(p)), name) for name, p in P.ANOMALIES.items()]
    labels.append(F.when(P.longest_run(lines) >= P.LOOP, "repetition_loop"))
    labels.append(F.when(text.rlike(rf"(?U)([^\W_])\1{{{P.REPEATED - 1},}}"), "repeated_character"))
    return table(spark, d, "source_texts").where("text is not null").select("text_id", F.array_compact(F.array(*labels)).alias("labels"))


@book.add(
    "STR-14 FLT-09",
    r"""WITH s AS (SELECT text_id, text, string_split_regex(text, '\r\n|\n|\r|\x0b|\f|\x1c|\x1d|\x1e|\x{85}|\x{2028}|\x{2029}') AS x FROM source_texts WHERE text IS NOT NULL),
       l AS (SELECT text_id, text, list_transform(CASE WHEN text = '' THEN [] WHEN x[-1] = '' THEN x[:-2] ELSE x END, lambda y: trim(y, ' ' || chr(9) || chr(160))) AS x FROM s),
       n AS (SELECT text_id, length(text) AS n_chars, length(text) - length(replace(text, chr(65533), '')) AS n_lost, len(x) AS n_lines,
                    CASE WHEN len(x) = 0 THEN 1.0 ELSE len(list_filter(x, lambda y: y = '')) / len(x) END AS empty,
                    len(list_filter(x, lambda y: length(y) BETWEEN 1 AND 2 AND NOT regexp_matches(y, '^\d+$'))) AS n_fragments,
                    trim(regexp_replace(text, '[\s\x{a0}\x{85}]+', ' ', 'g')) = '' AS blank FROM l)
       SELECT text_id, n_chars, n_lost, round(empty, 6) AS empty_ratio, n_fragments, list_filter([CASE WHEN blank THEN 'empty_text' END, CASE WHEN n_chars > 0 AND n_lost / n_chars > 0.001 THEN 'replacement_characters' END,
         CASE WHEN n_lines >= 10 AND empty > 0.65 THEN 'extreme_fragmentation' END, CASE WHEN n_lines >= 10 AND n_fragments / n_lines > 0.2 THEN 'tiny_line_fragmentation' END], lambda x: x IS NOT NULL) AS flags FROM n""",
)
def q_text_quality(spark: SparkSession, d: str) -> DataFrame:
    """Lines, empty ones and fragments of each text, with the flags that follow."""
    rows = table(spark, d, "source_texts").where("text is not null")
    lines = F.transform(T.lines(F.col("text")), T.collapse)
    rows = rows.select("text_id", "text", lines.alias("x"), F.length("text").cast("bigint").alias("n_chars"))
    tiny = F.size(F.filter("x", lambda y: F.length(y).between(1, 2) & ~y.rlike(r"^\d+$")))
    rows = rows.select(
        "text_id", "n_chars", (F.length("text") - F.length(F.translate("text", "�", ""))).cast("bigint").alias("n_lost"),
        F.when(F.size("x") == 0, F.lit(1.0)).otherwise(F.size(F.filter("x", lambda y: y == "")) / F.size("x")).alias("empty"),
        tiny.cast("bigint").alias("n_fragments"), F.size("x").alias("n"), T.is_blank(F.col("text")).alias("blank"),
    )
    flags = F.array(
        F.when(F.col("blank"), "empty_text"),
        F.when((F.col("n_chars") > 0) & (F.col("n_lost") / F.col("n_chars") > 0.001), "replacement_characters"),
        F.when((F.col("n") >= 10) & (F.col("empty") > 0.65), "extreme_fragmentation"),
        F.when((F.col("n") >= 10) & (F.col("n_fragments") / F.col("n") > 0.2), "tiny_line_fragmentation"),
    )
    return rows.select("text_id", "n_chars", "n_lost", F.round("empty", 6).alias("empty_ratio"), "n_fragments", F.array_compact(flags).alias("flags"))


def _rewrites(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).where(T.change_class(F.col("e"), F.col("c")) == "substantive")


@book.add("STR-06 SRT-03 AGG-21")
def q_largest_rewrites(spark: SparkSession, d: str) -> DataFrame:
    """The twenty candidates least like their references; the likeness has no SQL form."""
    rows = _rewrites(spark, d).select("candidate_id", F.round(Y.sequence_ratio("e", "c"), 6).alias("similarity"))
    return rows.orderBy("similarity", "candidate_id").limit(20)


@book.add("STR-27")
def q_diff_segments(spark: SparkSession, d: str) -> DataFrame:
    """Where a rewritten candidate differs from its reference: the first twelve stretches of each, with what is around them."""
    return _rewrites(spark, d).select("candidate_id", F.posexplode(Y.diff_segments("e", "c")).alias("place", "x")).select("candidate_id", "place", "x.*")


def _facts_sql() -> str:
    fields = [f"struct_pack(field := '{n}', v := list_transform(regexp_extract_all({_ASCII.format('text')}, '{_ascii(p)}'), lambda x: lower(trim(regexp_replace(x, '\\s+', ' ', 'g')))))" for n, p in P.FACTS.items()]
    return f"""WITH f AS (SELECT text_id, unnest([{", ".join(fields)}]) AS x FROM source_texts WHERE text IS NOT NULL)
      SELECT text_id, x.field AS field, len(x.v) AS n, len(list_distinct(x.v)) AS n_distinct FROM f WHERE len(x.v) > 0"""


@book.add("STR-18 STR-19 UDF-09", _facts_sql())
def q_reference_facts(spark: SparkSession, d: str) -> DataFrame:
    """The twelve fields of facts of each text: one row of many spans becomes a row for each field."""
    fields = [F.struct(F.lit(n).alias("field"), P.folded(F.col("text"), p).alias("v")) for n, p in P.FACTS.items()]
    rows = table(spark, d, "source_texts").where("text is not null").select("text_id", F.inline(F.array(*fields)))
    return rows.where(F.size("v") > 0).select("text_id", "field", F.size("v").cast("bigint").alias("n"), F.size(F.array_distinct("v")).cast("bigint").alias("n_distinct"))


def _overlap_sql() -> str:
    lists = ", ".join(
        f"struct_pack(field := '{n}', e := list_distinct(list_transform(regexp_extract_all({_ASCII.format('e')}, '{_ascii(p)}'), lambda x: lower(trim(regexp_replace(x, '\\s+', ' ', 'g'))))), "
        f"t := list_distinct(list_transform(regexp_extract_all({_ASCII.format('t')}, '{_ascii(p)}'), lambda x: lower(trim(regexp_replace(x, '\\s+', ' ', 'g'))))))"
        for n, p in P.FACTS.items()
    )
    return f"""WITH {_PAIRS}, f AS (SELECT candidate_id, unnest([{lists}]) AS x FROM p),
      s AS (SELECT x.field AS field, sum(len(x.e)) AS expected, sum(len(x.t)) AS predicted, sum(len(list_intersect(x.e, x.t))) AS matched FROM f GROUP BY 1)
      SELECT field, expected::BIGINT AS expected, predicted::BIGINT AS predicted, matched::BIGINT AS matched,
        round(CASE WHEN predicted = 0 THEN CASE WHEN expected = 0 THEN 1.0 ELSE 0.0 END ELSE matched / predicted END, 6) AS precision,
        round(CASE WHEN expected = 0 THEN 1.0 ELSE matched / expected END, 6) AS recall FROM s"""


@book.add("AGG-13 AGG-15", _overlap_sql())
def q_distinct_fact_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Distinct facts of a candidate against those of its reference, by field."""
    kinds = []
    for name, pattern in P.FACTS.items():
        e, c = (F.array_distinct(P.folded(F.col(x), pattern)) for x in ("e", "c"))
        kinds.append(F.struct(F.lit(name).alias("field"), F.size(e).alias("e"), F.size(c).alias("p"), F.size(F.array_intersect(e, c)).alias("m")))
    rows = _pairs(spark, d).select(F.inline(F.array(*kinds))).groupBy("field").agg(F.sum("e").alias("expected"), F.sum("p").alias("predicted"), F.sum("m").alias("matched"))
    m, p, e = F.col("matched"), F.col("predicted"), F.col("expected")
    precision = F.when(p == 0, F.when(e == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(m / p)
    return rows.select("field", "expected", "predicted", "matched", F.round(precision, 6).alias("precision"), F.round(F.when(e == 0, F.lit(1.0)).otherwise(m / e), 6).alias("recall"))
