"""String functions with Unicode classes; all but the ones marked Python stay inside code generation."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Fixed values.
SPANISH_MONTHS = (
    "enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre",
    "diciembre",
)
ACCENTED, PLAIN = "áéíóúüñàèìòùâêîôûäëïöçÁÉÍÓÚÜÑÀÈÌÒÙÂÊÎÔÛÄËÏÖÇ", "aeiouunaeiouaeiouaeiocAEIOUUNAEIOUAEIOUAEIOC"
#: Line ends beyond the usual ones: vertical tab, form feed, separators, next line.
LINE_END = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"
#: Facts as the texts of this corpus write them.
FACTS = {
    "laws": r"(?i)ley\s+n[uú]m\.?\s*\d+-\d+",
    "articles": r"(?i)art[ií]culo\s+\d+",
    "dockets": r"\d{3}-\d{4}-[A-Z]{4}-\d{5}",
    "dates": r"(?i)\d{1,2}\s+de\s+(?:" + "|".join(SPANISH_MONTHS) + r")\s+de\s+\d{4}",
    "amounts": r"(?:RD|US)\$\s?[\d,]+\.\d{2}",
    "decisions": r"[A-Z]{2,3}X-[A-Z]{2}-\d{2}-\d{4,5}",
}


def collapse(col: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(col, r"(?U)\s+", " "))


#: Fixed value: a word with inner dots, slashes and hyphens.
WORD = r"([\p{L}\p{N}_]+(?:[./-][\p{L}\p{N}_]+)*)"


def tokens(col: Column) -> Column:
    """Words with inner dots, slashes and hyphens, in lower case."""
    return F.regexp_extract_all(F.lower(col), F.lit(WORD), F.lit(1))


def token_set(col: Column, least: int = 2) -> Column:
    return F.array_distinct(F.filter(tokens(col), lambda t: F.length(t) >= least))


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def plain(col: Column) -> Column:
    """Without the accents of a fixed alphabet."""
    return F.translate(col, ACCENTED, PLAIN)


def plain_letters(col: Column) -> Column:
    """Without accents, and with other letters beyond ASCII as x: what patterns of plain letters can be matched on."""
    return F.regexp_replace(plain(col), "[ªºÀ-ÖØ-öø-ɏͰ-ϿЀ-ӿ]", "x")


def visible_length(col: Column) -> Column:
    return F.length(F.regexp_replace(col, r"(?U)\s", ""))


def lines(col: Column) -> Column:
    """Lines without their ends; no empty last line after a final line end, none at all for the empty string."""
    parts = F.split(col, LINE_END)
    parts = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return F.when(col == "", F.array().cast("array<string>")).otherwise(parts)


def change_class(a: Column, b: Column) -> Column:
    """How two readings differ: the first of exact, whitespace, case, accent, punctuation, digits, else substantive."""
    x, y = collapse(a), collapse(b)
    lx, ly = F.lower(x), F.lower(y)
    px, py = plain(lx), plain(ly)
    bare = lambda c: collapse(F.regexp_replace(c, r"(?U)[^\w\s]", ""))
    no_digits = lambda c: collapse(F.regexp_replace(bare(c), r"(?U)\d", ""))
    return (
        F.when(a == b, "exact")
        .when(x == y, "whitespace")
        .when(lx == ly, "case")
        .when(px == py, "accent")
        .when(bare(px) == bare(py), "punctuation")
        .when(no_digits(px) == no_digits(py), "digits")
        .otherwise("substantive")
    )


def facts(col: Column, pattern: str) -> Column:
    """Distinct normalised matches in order of first appearance."""
    found = F.regexp_extract_all(col, F.lit(f"({pattern})"), F.lit(1))
    return F.array_distinct(F.transform(found, lambda f: F.lower(collapse(f))))


def spanish_date(day: Column, month: Column, year: Column) -> Column:
    """Null where there is no such day."""
    number = F.array_position(F.array(*[F.lit(m) for m in SPANISH_MONTHS]), F.lower(month))
    text = F.concat_ws("-", year, F.lpad(number.cast("string"), 2, "0"), F.lpad(day, 2, "0"))
    return F.when(number > 0, F.try_to_date(text, "yyyy-MM-dd"))


def numeric_date(text: Column) -> Column:
    """d/m/yyyy; null where there is no such day."""
    part = lambda i: F.regexp_extract(text, r"(\d{1,2})/(\d{1,2})/(\d{4})", i)
    return F.try_to_date(F.concat_ws("-", part(3), F.lpad(part(2), 2, "0"), F.lpad(part(1), 2, "0")), "yyyy-MM-dd")


def is_blank(text: Column) -> Column:
    """Null, empty or nothing but white space; never null itself."""
    return F.coalesce(~text.rlike(r"(?U)\S"), F.lit(True))


def has_replacements(text: Column) -> Column:
    """Whether more than one in a thousand characters is a replacement character."""
    lost = F.length(text) - F.length(F.translate(text, "\ufffd", ""))
    return (F.length(text) > 0) & (lost > 0.001 * F.length(text))


def quality_flags(text: Column) -> Column:
    """Reasons why a text may be of no use: empty, replacement characters, mostly empty lines, fragments."""
    all_lines = lines(text)
    n = F.size(all_lines)
    blank = F.size(F.filter(all_lines, lambda x: F.trim(x) == ""))
    words = F.filter(F.split(collapse(text), " "), lambda w: w != "")
    tiny = F.size(F.filter(words, lambda w: F.length(w) <= 1))
    lost = F.length(text) - F.length(F.translate(text, "�", ""))
    return F.array_compact(
        F.array(
            F.when(text.isNull() | (collapse(text) == ""), "empty"),
            F.when((F.length(text) > 0) & (lost > 0.001 * F.length(text)), "replacement"),
            F.when((n >= 10) & (blank > 0.65 * n), "empty_lines"),
            F.when((F.size(words) > 0) & (tiny > 0.20 * F.size(words)), "fragments"),
        )
    )


@F.pandas_udf(StringType())
def nfkc_fold(col: pd.Series) -> pd.Series:
    """Python: compatibility form, white space collapsed, case folded."""
    return col.map(lambda s: None if s is None else " ".join(unicodedata.normalize("NFKC", s).split()).casefold())


@F.pandas_udf(StringType())
def strip_marks(col: pd.Series) -> pd.Series:
    """Python: canonical decomposition without combining marks, whatever the alphabet."""
    fold = lambda s: "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")
    return col.map(lambda s: None if s is None else fold(s))
