"""What the text operators look for, by name. All are matched with Unicode classes and boundaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliomill.functions.text import collapse

#: Spans of a legal text that a transcription must not lose.
CRITICAL = {
    "date": r"\b(?:\d{1,2}[/-]\d{1,2}[/-]\d{2,4}|\d{4}-\d{2}-\d{2})\b",
    "money": r"(?i)(?:RD\$|US\$|DOP|USD)\s*\d[\d.,]*",
    "article": r"(?i)\bart(?:í|i)culo\s+\d+(?:[.-]\d+)*\b",
    "law": r"(?i)\bley\s+(?:núm(?:ero)?\.?\s*)?\d+[\d-]*\b",
    "decree": r"(?i)\bdecreto(?:-ley)?\s+(?:núm(?:ero)?\.?\s*)?\d+[\d-]*\b",
    "resolution": r"(?i)\bresoluci[oó]n\s+(?:núm(?:ero)?\.?\s*)?\d+[\d-]*\b",
    "gaceta": r"(?i)\bgaceta\s+oficial\b",
    "rnc": r"(?i)\bRNC\b[\s:.#-]*\d{9}\b",
    "cedula": r"(?i)\bc[eé]dula\b[\s:.#-]*\d{3}-?\d{7}-?\d\b",
    "matricula": r"(?i)\bmatr[ií]cula\s+(?:núm(?:ero)?\.?\s*)?\d+[\d-]*\b",
    "cadastre": r"(?i)\b(?:parcela|distrito catastral|designaci[oó]n catastral)\b[^\n]{0,40}?\d[\d-]*",
    "case_id": r"(?i)\b(?:TC|SCJ|expediente|sentencia)[\s:.-]*[A-Z0-9./-]{3,}\b",
    "citation": r"(?i)\bTC/\d{4}/\d{2}\b|\bSCJ-[A-Z0-9-]{4,}\b",
}
#: Spans whose sets are compared between two passes over a page.
LEGAL = {
    "identifier": r"\b[A-Z][A-Z0-9]*(?:-[A-Z0-9]+){1,}\b",
    "year": r"\b(?:19|20)\d{2}\b",
    "date": r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b",
    "money": r"(?i)(?:RD\$|DOP|\$)\s?\d[\d.,]*|\d[\d.,]*\s*(?:pesos|d[oó]lares)",
    "reference": r"(?i)\b(?:art[íi]culos?|ley|resoluci[óo]n|decreto)\s+(?:n[oº°]?\s*)?\d+",
}
#: The facts of a text by field; most are critical spans under another name.
FACTS = {
    "dates": CRITICAL["date"],
    "amounts": r"(?i)(?:RD\$|US\$|DOP|USD)\s*\d[\d,]*(?:\.\d+)?",
    "articles": CRITICAL["article"],
    "laws": CRITICAL["law"],
    "decrees": CRITICAL["decree"],
    "resolutions": CRITICAL["resolution"],
    "rnc": CRITICAL["rnc"],
    "cedulas": CRITICAL["cedula"],
    "matriculas": CRITICAL["matricula"],
    "cadastral_references": CRITICAL["cadastre"],
    "case_identifiers": CRITICAL["case_id"],
    "citations": CRITICAL["citation"],
}
#: Signs that an output is no transcription of its page.
ANOMALIES = {
    "wrapper_only": r"(?i)---\s*(?:BEGIN|END)\s+OCR\s*---",
    "markdown_fence": r"```",
    "ilegible_marker": r"(?i)\[\s*ilegible\s*\]",
    "non_transcription": r"(?i)^\s*(?:i cannot|i can'?t|i'?m sorry|as an ai|lo siento|como (?:una )?ia|no puedo proporcionar|the transcription|here is the transcription)",
}
#: A letter or figure thirty times in a row, a line six times in a row.
REPEATED, LOOP = 30, 6


def unicode(pattern: str) -> str:
    return "(?U)" + pattern


def found(text: Column, pattern: str) -> Column:
    """All matches in order, white space collapsed."""
    return F.transform(F.regexp_extract_all(text, F.lit(unicode(pattern)), F.lit(0)), collapse)


def folded(text: Column, pattern: str) -> Column:
    """All matches in order, white space collapsed, in lower case."""
    return F.transform(found(text, pattern), F.lower)


def bag_overlap(a: Column, b: Column) -> Column:
    """How many elements two arrays have in common, each as often as both have it; for short arrays."""
    times = lambda xs, v: F.size(F.filter(xs, lambda x: x == v))
    return F.aggregate(F.array_distinct(a), F.lit(0), lambda n, v: n + F.least(times(a, v), times(b, v)))


def longest_run(xs: Column) -> Column:
    """The greatest number of equal neighbours."""
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s: Column, x: Column) -> Column:
        run = F.when(s["last"].eqNullSafe(x), s["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

    return F.aggregate(xs, start, step, lambda s: s["best"])
