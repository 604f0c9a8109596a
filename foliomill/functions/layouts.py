"""Which publication a page belongs to, by the headings it carries; and numbers and lines as they are printed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliomill.functions import text as T

_MONTH = "(" + "|".join([*T.SPANISH_MONTHS[:8], "septiembre", "setiembre", *T.SPANISH_MONTHS[9:]]) + ")"
#: Headings by name; groups hold what is read from them.
HEADINGS = {
    "dated_sentence": rf"(?im)^\s*(?:\d{{1,3}}[-.)]\s*)?SENTENCIA\s+DEL\s+(\d{{1,2}})\s+DE\s+{_MONTH}\s+DE\s+(\d{{4}})\s*,?\s*N[ÚU]M\.?\s*(SCJ-[A-Z]{{2,4}}-\d{{2}}-\d{{3,6}})\s*$",
    "dated_resolution": rf"(?im)^\s*(?:\d{{1,3}}[-.)]\s*)?RESOLUCI[ÓO]N\s+DEL\s+(\d{{1,2}})\s+DE\s+{_MONTH}\s+DE\s+(\d{{4}})\s*,?\s*N[ÚU]M\.?\s*(SCJ-[A-Z]{{2,4}}-\d{{2}}-\d{{2,6}})\s*$",
    "resolution": r"(?m)^\s*RESOLUCI[ÓO]N\s+N[ÚU]M\.?\s*([A-Z0-9.-]+)\s*,?\s*([^\n]*)$",
    "modern_resolution": r"(?im)^\s*Resoluci[oó]n\s+n[úu]m\.?\s*([A-Z0-9.-]+)\s*$",
    "file": r"(?im)^\s*Exp(?:s)?\.?\s*(?:n[úu]m(?:s)?\.?)?\s*:?\s*([^\n\r]+?)\s*$",
    "appeal": r"(?im)^\s*R(?:c|ec)s?\.?\s*:?\s*([^\n\r]+?)\s*$",
    "day": rf"(?im)^\s*Fecha\s*:\s*(\d{{1,2}})\s+de\s+{_MONTH}\s+de\s+(\d{{4}})\s*$",
    "matter": r"(?im)^\s*Materia\s*:\s*([^\n\r]+?)\s*$",
    "decision": r"(?im)^\s*Decisi[oó]n\s*:\s*([^\n\r]+?)\s*$",
    "parties": r"(?im)^\s*Partes\s*:\s*([^\n\r]+?)\s*$",
    "rapporteur": r"(?im)^\s*Ponente\s*:\s*([^\n\r]+?)\s*$",
    "sentence_number": r"(?im)^\s*Sentencia\s+n[úu]m\.?\s*(SCJ-[A-Z]{2,4}-\d{2}-\d{2,6})\s*$",
    "full_court_file": r"(?im)^\s*Expediente\s+n[úu]m\.?\s*:\s*([^\n\r]+?)\s*$",
    "role": r"(?im)^\s*(?:Recurrente|Recurrido)[^:\n]{0,100}:\s*.+$",
    "first_chamber_id": r"(?i)\bSCJ-PS-\d{2}-\d{3,6}\b",
    "third_chamber_id": r"(?i)\bSCJ-TS-\d{2}-\d{2,6}\b",
}
#: Characters from the top in which headings of the newer publications stand, and their identifier.
TOP, ID_TOP = 2400, 700
OLD, MODERN = "old", "modern"


@dataclass(frozen=True)
class Layout:
    """A publication: the headings a page must carry, and those that name the case, its number and its day."""

    family: str
    era: str
    needs: tuple[str, ...]
    key: tuple[tuple[str, int], ...]
    number: tuple[str, int] | None = None
    day: tuple[str, int] | None = None  # the heading and the group of the day, before month and year
    top: int | None = TOP
    some_of: tuple[str, ...] = ()
    at_least: int = 0


#: In this order; the first that fits names the page.
LAYOUTS = (
    Layout("principales_2023_2024_sentence", OLD, ("dated_sentence",), (("dated_sentence", 4),), ("dated_sentence", 4), ("dated_sentence", 1), None),
    Layout("principales_2023_2024_resolution", OLD, ("dated_resolution",), (("dated_resolution", 4),), ("dated_resolution", 4), ("dated_resolution", 1), None),
    Layout("principales_2023_2024_resolution", OLD, ("resolution",), (("resolution", 1),), None, None, None),
    Layout("principales_2025_tercera_sala", MODERN, ("file", "matter", "decision", "role"), (("file", 1),), ("third_chamber_id", 0)),
    Layout("principales_2025_segunda_sala", MODERN, ("file", "appeal", "day"), (("file", 1), ("appeal", 1), ("day", 0)), ("sentence_number", 1), ("day", 1)),
    Layout("principales_2025_pleno_resolution", MODERN, ("modern_resolution", "full_court_file"), (("modern_resolution", 1), ("full_court_file", 1))),
    Layout(
        "principales_2025_primera_sala", MODERN, ("first_chamber_id",), (("first_chamber_id", 0),), ("first_chamber_id", 0),
        some_of=("parties", "matter", "decision", "rapporteur"), at_least=3,
    ),
)


def _java(name: str) -> str:
    return "(?Ud)" + HEADINGS[name]  # (?d): only a line feed ends a line


def page_layout(text: Column) -> Column:
    """(family, era, key, number, day) of a page; family 'unknown' where no layout fits."""

    def part(layout: Layout, name: str, group: int) -> Column:
        return F.regexp_extract(where(layout, name), _java(name), group)

    def where(layout: Layout, name: str) -> Column:
        if layout.top is None:
            return text
        return F.left(text, F.lit(ID_TOP if name == "first_chamber_id" else layout.top))

    def has(layout: Layout, name: str) -> Column:
        return where(layout, name).rlike(_java(name))

    none = F.struct(
        F.lit("unknown").alias("family"), F.lit(None).cast("string").alias("era"), F.lit(None).cast("string").alias("key"),
        F.lit(None).cast("string").alias("number"), F.lit(None).cast("date").alias("day"),
    )
    out = none
    for layout in reversed(LAYOUTS):
        fits = F.lit(True)
        for name in layout.needs:
            fits = fits & has(layout, name)
        if layout.some_of:
            held = sum((has(layout, n).cast("int") for n in layout.some_of), F.lit(0))
            fits = fits & (held >= layout.at_least)
        key = F.concat_ws(" | ", *[T.collapse(part(layout, n, g)) for n, g in layout.key])
        number = F.nullif(F.upper(part(layout, *layout.number)), F.lit("")) if layout.number else F.lit(None).cast("string")
        day = F.lit(None).cast("date")
        if layout.day:
            name, g = layout.day
            month = F.when(F.lower(part(layout, name, g + 1)) == "setiembre", "septiembre").otherwise(part(layout, name, g + 1))
            day = T.spanish_date(part(layout, name, g), month, part(layout, name, g + 2))
        key = F.upper(key) if layout.number == layout.key[0] or layout.needs == ("resolution",) else key
        row = F.struct(F.lit(layout.family).alias("family"), F.lit(layout.era).alias("era"), key.alias("key"), number.alias("number"), day.alias("day"))
        out = F.when(fits, row).otherwise(out)
    return out


def places(text: Column, pattern: str) -> Column:
    """Array of (begin, end, value) of all matches, in characters from 0: the stretches between matches and the matches
    themselves are laid end to end."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int,value:string>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        begin = s["at"] + F.length(x["gap"])
        end = begin + F.length(x["hit"])
        return F.struct(end.alias("at"), F.concat(s["out"], F.array(F.struct(begin.alias("begin"), end.alias("end"), x["hit"].alias("value")))).alias("out"))

    pairs = F.transform(hits, lambda h, i: F.struct(F.get(gaps, i).alias("gap"), h.alias("hit")))
    return F.aggregate(pairs, empty, step, lambda s: s["out"])


#: A number that stands alone on its line, and the pages a volume can have.
ALONE, MOST_PAGES = r"(?m)^\s*[-–—]?\s*(\d{1,4})\s*[-–—]?\s*$", 5000


def printed_marker(text: Column) -> Column:
    """The last number standing alone in the first or last 500 characters that may be a page number, or null."""
    sample = F.concat(F.left(text, F.lit(500)), F.lit("\n"), F.right(text, F.lit(500)))
    numbers = F.transform(F.regexp_extract_all(sample, F.lit(ALONE), F.lit(1)), lambda x: x.cast("int"))
    plausible = F.filter(numbers, lambda n: (n > 0) & (n < MOST_PAGES))
    return F.try_element_at(plausible, F.lit(-1))


#: Fixed value: a title, leaders and what stands at the end of an index line.
INDEX_LINE = r"^\s*(\S.*?)\s*\.{4,}\s*(\S.*?)\s*$"
