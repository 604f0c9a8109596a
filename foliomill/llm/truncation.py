"""Texts that lost their end, found by what their last words usually do, in pure SQL.

Each text becomes a string of tokens in which numbers, dates, names and line starts are classes. All word trigrams of
the corpus are counted, inside texts and at ends, in one partial aggregation; bigrams and single words come from the same
table. Closing lines that say nothing about the body (page numbers, running heads, sums) are set aside first. A final
trigram that is frequent inside texts but almost never ends one marks a cut. Where a trigram is too rare to tell, its
last two words decide, then its last word. A text that ends without a closing mark needs evidence that texts end that way
(signatures, places and dates); one with a closing mark is cut only if the mark belongs to an abbreviation.

Defined results: null and blank texts are no cases; ids that are null are kept and come out as null; repeated rows are
judged each. Sources that are null form one group in the report. Extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.runtime import materialize

#: Months of the language of the corpus.
MONTHS = "enero|febrero|marzo|abril|mayo|junio|julio|agosto|septiembre|octubre|noviembre|diciembre"
TAIL = 1200  # characters from the end in which the last words and the closing lines are sought at a time
ENDING = 600  # characters of what then ends the text that hold its last three words, unless these are longer
CLOSING = 0.15  # share of ends among all uses of an unmarked trigram that shows it may end a text
RARE_END = 0.004  # share of ends under which a marked trigram is the inside of a sentence
SUPPORT, MARK_SUPPORT = 3, 300  # ends, and uses, that must have been seen
FRAGMENT = 5  # times as many longer words with the same beginning

_MARKER = r"(?:\[\s*(?:\.{2,}|…)\s*\]|\(\s*(?:\.{2,}|…)\s*\)|…|\.{2,})\s*$"
#: A last line of its own that is short, begins with a capital, a figure or a sign and ends with a figure or a bracket.
_SET_ASIDE = r"(?:\n[ \t\f]*(?=[^\n]{1,70}$|[^\n]{1,70}\n)(?:[\p{Lu}\d][^\n]*\d[\])|\-—– \t]*|[\[\]|(\-—–·\d /]+)\s*)+$"


def _tokens(text: Column) -> Column:
    """The tokens of a text as one string, classes in place of names, numbers, dates and initials."""
    steps = [
        (r"[ \t\f]*\n\s*(?=[\p{Lu}(¿\[])", " ¶ "),
        (r" *[\n\t\f\r\x0b\x{a0}]\s*| {2,}", " "),
        (rf"\d{{1,2}}º? de (?:{MONTHS}) de \d{{4}}", "9D"),
        (r"\d+(?:[.,\-/]\d+)*", "0"),
        (r"(?<!9)\p{Lu}[\p{L}\p{M}\p{N}\p{So}\p{Sm}\p{Sk}\p{Cf}’'!¡}]*", "X"),
        (r"/ \p{Ll}{2,4}(?![\p{L}])", "/ 9I"),
    ]
    return F.trim(reduce(lambda c, s: F.regexp_replace(c, s[0], s[1]), steps, text))


def _ending(text: Column) -> Column:
    """The last characters of the text without what is set aside and without a mark of omission."""
    whole = F.rtrim(text, F.lit(" \t\n\r\f\x0b\xa0"))
    last = lambda c: F.substring(c, -TAIL, TAIL)
    less = lambda c: F.regexp_replace(last(c), _SET_ASIDE, "")
    # where closing lines fill most of the tail, tail after tail is set aside: a turn takes half a tail at least, or nothing is left to take
    turns = F.sequence(F.lit(0), (F.length(whole) / (TAIL // 2)).cast("int"))
    far = F.aggregate(turns, whole, lambda c, _: F.concat(F.substring(c, F.lit(1), F.length(c) - TAIL), less(c)))
    closed = lambda l: F.when((F.length(whole) > TAIL) & (F.length(l) < ENDING), far).otherwise(l)
    bare = _once(_once(less(whole), closed), lambda b: F.when(b == "", last(whole)).otherwise(b))
    short = lambda b: F.substring(b, -ENDING, ENDING)
    # words of hundreds of letters are taken whole
    cut = _once(bare, lambda b: F.when((F.length(b) <= ENDING) | short(b).rlike(r"(?:\S+\s+){4}\S"), short(b)).otherwise(b))
    return F.regexp_replace(cut, _MARKER, "")


def _once(col: Column, use) -> Column:
    """``use(col)`` with ``col`` worked out once, however often it is used."""
    return F.transform(F.array(col), use)[0]


def _records(df: DataFrame, name: str, id_col: str, text_col: str) -> DataFrame:
    return df.select(
        F.lit(name).alias("table_name"),
        F.col(id_col).cast("bigint").alias("record_id"),
        F.col("source").alias("source"),
        F.col(text_col).alias("text"),
    )


def _written(text: Column) -> Column:
    return text.isNotNull() & text.rlike(r"[^\s\x{feff}\x{a0}]")


def trigram_counts(texts: DataFrame, finals: DataFrame) -> DataFrame:
    """(w1, w2, w3, n_in, n_end): uses of each trigram in ``texts``, and among the ``finals``."""
    words = texts.select(F.split(F.concat(F.lit("^ ^ "), _tokens(F.col("text"))), " ").alias("w"))
    n = F.size("w")
    parts = [F.slice("w", i, n - 2).alias(f"w{i}") for i in (1, 2, 3)]
    inside = words.select(F.inline(F.arrays_zip(*parts)).alias("w1", "w2", "w3"))
    zero = F.lit(0).cast("bigint")
    inside = inside.groupBy("w1", "w2", "w3").agg(F.count(F.lit(1)).alias("n_in"), zero.alias("n_end"))
    ends = finals.groupBy("w1", "w2", "w3").agg(zero.alias("n_in"), F.count(F.lit(1)).alias("n_end"))
    return inside.unionAll(ends).groupBy("w1", "w2", "w3").agg(F.sum("n_in").alias("n_in"), F.sum("n_end").alias("n_end"))


def final_trigrams(texts: DataFrame, keep: list[str]) -> DataFrame:
    """(*keep, w1, w2, w3) of each text, written once: every later step reads these narrow rows."""
    words = F.slice(F.split(F.concat(F.lit("^ ^ "), _tokens(_ending(F.col("text")))), " "), -3, 3)
    rows = materialize(texts.select(*keep, words.alias("w")), "final-trigrams")
    return rows.select(*keep, *[F.element_at("w", i).alias(f"w{i}") for i in (1, 2, 3)])


def _verdicts(counts: DataFrame) -> DataFrame:
    """(w1, w2, w3, cut) for every trigram that ends a text."""
    sums = lambda *w: counts.groupBy(*w).agg(
        F.sum("n_in").alias("n_in"), F.sum("n_end").alias("n_end")
    ).where("n_end > 0")
    two, one = sums("w2", "w3"), sums("w3")
    rows = (
        counts.where("n_end > 0")
        .join(two.toDF("w2", "w3", "in2", "end2"), ["w2", "w3"])
        .join(one.toDF("w3", "in1", "end1"), "w3")
    )
    # a word of which longer ones are far more usual in its place is the beginning of one of these
    # (a class in the place of a number or a name says too little by its left neighbour, so there two words count)
    def longer(words: DataFrame, context: list[str], name: str) -> DataFrame:
        parts = F.expr("transform(sequence(1, length(w3) - 1), i -> substring(w3, 1, i))")
        words = words.where("length(w3) > 1").groupBy(*context, "w3").agg(F.sum("n_in").alias("n_in"))
        cuts = words.select(*context, "n_in", F.explode(parts).alias("w3"))
        return cuts.groupBy(*context, "w3").agg(F.sum("n_in").alias(name))

    rows = rows.join(longer(counts, ["w2"], "longer2"), ["w2", "w3"], "left")
    rows = rows.join(longer(counts.where("w3 rlike '^[X09]'"), ["w1", "w2"], "longer3"), ["w1", "w2", "w3"], "left")
    fragment = F.coalesce(F.col("longer2") >= FRAGMENT * F.greatest("in2", "end2"), F.lit(False)) | F.coalesce(
        F.col("longer3") >= FRAGMENT * F.greatest("n_in", "n_end"), F.lit(False)
    )
    # a rare word one or two letters off a closing word in the same place is that word, misread
    closers = two.where((F.col("n_end") >= SUPPORT) & (F.col("n_end") >= CLOSING * F.greatest("n_in", "n_end")))
    closers = closers.where("length(w3) >= 5 and w3 rlike '^[a-z]+$'").select("w2", F.col("w3").alias("closer"))
    odd = two.where(F.greatest("n_in", "n_end") < 10 * SUPPORT).where("length(w3) >= 5").select("w2", "w3")
    # words of one place are compared only where their first or their last letters are the same
    edges = lambda word: F.explode(F.array(F.concat(F.lit("<"), F.left(word, F.lit(2))), F.concat(F.lit(">"), F.right(word, F.lit(2))))).alias("edge")
    odd, closers = odd.select("*", edges(F.col("w3"))), closers.select("*", edges(F.col("closer")))
    misread = odd.join(closers, ["w2", "edge"]).where("w3 <> closer and levenshtein(w3, closer, 2) between 0 and 2")
    rows = rows.join(misread.select("w2", "w3", F.lit(True).alias("misread")).distinct(), ["w2", "w3"], "left")
    # inside counts hold every use, so they are at least the ends; texts with closing lines set aside count both ways
    rate = lambda e, n: F.col(e) / F.greatest(F.col(n), F.col(e))
    marked = F.col("w3").rlike(r"[.?!»\")\]’”]$") & ~F.col("w3").rlike(r"\.\.$")
    rare = lambda e, n: (F.greatest(F.col(n), F.col(e)) >= MARK_SUPPORT) & (rate(e, n) < RARE_END)
    closes = (
        F.when(F.col("n_end") >= SUPPORT, rate("n_end", "n_in") >= CLOSING)
        .when(F.greatest("n_in", "n_end") >= 10 * SUPPORT, F.lit(False))
        .when(F.col("end2") >= SUPPORT, rate("end2", "in2") >= CLOSING)
        .when(F.greatest("in2", "end2") >= 10 * SUPPORT, F.lit(False))
        .otherwise((F.col("end1") >= SUPPORT) & (rate("end1", "in1") >= CLOSING))
    )
    abbreviation = rare("n_end", "n_in") | rare("end2", "in2") | rare("end1", "in1")
    return rows.select("w1", "w2", "w3", F.when(marked, abbreviation).otherwise(fragment | ~(closes | F.coalesce("misread", F.lit(False)))).alias("cut"))


def truncated(records: DataFrame) -> DataFrame:
    """(table_name, record_id, source, cut) for every row of ``records`` (table_name, record_id, source, text)."""
    written = records.where(_written(F.col("text")))
    keep = ["table_name", "record_id", "source"]
    finals = final_trigrams(written, keep)
    counts = materialize(trigram_counts(written, finals), "trigrams")
    verdicts = materialize(_verdicts(counts).where("cut").select("w1", "w2", "w3"), "trigram-verdicts")
    # an ending may be shared by a third of all texts: the side that holds them is the left one of a left join, whose large
    # partitions Spark splits by their size at run time
    judged = finals.join(verdicts.withColumn("hit", F.lit(True)), ["w1", "w2", "w3"], "left")
    return judged.select(*keep, F.coalesce("hit", F.lit(False)).alias("cut"))


def text_records(source_texts: DataFrame, candidate_texts: DataFrame) -> DataFrame:
    return _records(source_texts, "source_texts", "text_id", "text").unionAll(
        _records(candidate_texts, "candidate_texts", "candidate_id", "candidate_text")
    )


def truncation_report(records: DataFrame) -> DataFrame:
    """(source, n_records, n_cut, cut_share) of each source; null and blank texts are records that are not cut."""
    cut = truncated(records).groupBy("source").agg(F.count_if("cut").alias("n_cut"))
    total = records.groupBy("source").agg(F.count(F.lit(1)).alias("n_records"))
    joined = total.join(cut, total["source"].eqNullSafe(cut["source"]), "left")
    n_cut = F.coalesce("n_cut", F.lit(0))
    return joined.select(total["source"], "n_records", n_cut.alias("n_cut"), F.round(n_cut / F.col("n_records"), 6).alias("cut_share"))
