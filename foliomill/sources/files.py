"""Readers: journals, listings, pages of markup, word tables, archives. Schemas are given, never inferred."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.operators.relational import latest

#: The fields of a journal record.
CHECKPOINT_SCHEMA = (
    "source_identifier string, document_url string, status string, recorded_at string, sha256 string, object_key string, "
    "byte_count bigint, content_type string, file_extension string, error_type string, reason string"
)
#: The columns of a table of recognised words.
TSV_SCHEMA = (
    "level int, page_num int, block_num int, par_num int, line_num int, word_num int, left int, top int, width int, "
    "height int, conf double, text string"
)


def journal_records(lines: DataFrame, line: str = "line_text", schema: str = CHECKPOINT_SCHEMA) -> DataFrame:
    """Parsed lines with ``corrupt``: whether the line is no complete JSON object. Blank lines are left out."""
    rows = lines.where(F.trim(line) != "")
    whole = F.try_parse_json(F.col(line))
    rows = rows.withColumn("corrupt", whole.isNull() | ~F.schema_of_variant(whole).startswith("OBJECT"))
    rows = rows.withColumn("r", F.when(~F.col("corrupt"), F.from_json(line, schema)))
    return rows.withColumn("recorded", F.try_to_timestamp(F.col("r.recorded_at")))


def torn_tail_only(lines: DataFrame, file: str, number: str, line: str = "line_text") -> DataFrame:
    """(file, n_corrupt, only_tail): a broken last line is what an interrupted append leaves; any other is an error."""
    rows = journal_records(lines, line).select(file, number, "corrupt")
    last = rows.groupBy(file).agg(
        F.count_if("corrupt").alias("n_corrupt"),
        F.max(F.when(F.col("corrupt"), F.col(number))).alias("worst"),
        F.min(F.when(F.col("corrupt"), F.col(number))).alias("first"),
        F.max(number).alias("last"),
    )
    return last.where("n_corrupt > 0").select(file, "n_corrupt", ((F.col("first") == F.col("last"))).alias("only_tail"))


def latest_records(lines: DataFrame, file: str = "object_key", number: str = "line_no") -> DataFrame:
    """The state of each (source_identifier, document_url): the record that was made last, then written last."""
    rows = journal_records(lines).where("not corrupt").select(
        "r.source_identifier", "r.document_url", "r.status", "r.sha256", "recorded", F.col(file).alias("file"), F.col(number).alias("number")
    )
    return latest(rows, ["source_identifier", "document_url"], F.desc_nulls_last("recorded"), F.desc("file"), F.desc("number"))


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(key, size, last_modified) of all files under a folder of any Hadoop file system; contents are not read.

    Spark plans no read for files of no bytes, so empty files are not listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("key"), F.col("length").alias("size"), F.unix_micros("modificationTime").alias("us")).select(
        "key", "size", (F.col("us") / 1e6).alias("last_modified")
    )


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(key, sha256, byte_count, kind) of each file that is not empty."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.col("path").alias("key"), F.sha2("content", 256).alias("sha256"), F.length("content").alias("byte_count"), file_kind(F.col("content")).alias("kind")
    )


def file_kind(content: Column) -> Column:
    """By the first bytes: pdf, doc, rtf, zip (docx among others), html, json, empty or unknown."""
    head = F.substring(content, 1, 512)
    magic = F.hex(F.substring(content, 1, 8))
    text = F.lower(F.trim(F.decode(head, "ISO-8859-1")))
    return (
        F.when(F.length(content) == 0, "empty")
        .when(magic.startswith("25504446"), "pdf")
        .when(magic == "D0CF11E0A1B11AE1", "doc")
        .when(magic.startswith("7B5C727466"), "rtf")
        .when(magic.startswith("504B0304"), "zip")
        .when(text.startswith("<!doctype html") | text.startswith("<html"), "html")
        .when(text.startswith("{") | text.startswith("["), "json")
        .otherwise("unknown")
    )


class _Anchors(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.found: list[dict] = []
        self.open: dict | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "a" and dict(attrs).get("href"):
            self.open = {"href": dict(attrs)["href"], "text": ""}

    def handle_data(self, data: str) -> None:
        if self.open is not None:
            self.open["text"] += data

    def handle_endtag(self, tag: str) -> None:
        if tag == "a" and self.open is not None:
            self.found.append({"href": self.open["href"], "text": " ".join(self.open["text"].split())})
            self.open = None


def anchors(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, place, href, text) of all links. Markup is no regular language, so a parser reads it in Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, page in zip(batch["key"], batch["html"]):
                parser = _Anchors()
                parser.feed(page or "")
                out += [(k, i, a["href"], a["text"]) for i, a in enumerate(parser.found)]
            yield pd.DataFrame(out, columns=["key", "place", "href", "text"])

    kind = dict(pages.dtypes)[key]
    rows = pages.select(F.col(key).alias("key"), F.col(html).alias("html"))
    return rows.mapInPandas(run, f"key {kind}, place int, href string, text string").withColumnRenamed("key", key)


def _of(links: DataFrame, host: str | None, suffix: str | None) -> DataFrame:
    if host is not None:
        links = links.where(F.lower(F.try_parse_url("href", F.lit("HOST"))) == host.lower())
    if suffix is not None:
        links = links.where(F.endswith(F.lower(F.try_parse_url("href", F.lit("PATH"))), F.lit(suffix.lower())))
    return links


def resolved(links: DataFrame, base: str) -> DataFrame:
    """Links with ``href`` made absolute against the address of their page: //host, /path and plain names."""
    href, page = F.trim("href"), F.col(base)
    root = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*:)(//[^/?#]*)", 0)
    folder = F.regexp_replace(F.regexp_replace(page, r"[?#].*$", ""), r"(?<=[^/:])/[^/]*$", "")
    absolute = (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(page, r"^[A-Za-z][A-Za-z0-9+.-]*:", 0), href))
        .when(href.startswith("/"), F.concat(root, href))
        .otherwise(F.concat(folder, F.lit("/"), href))
    )
    return links.withColumn("href", absolute)


def document_links(links: DataFrame, key: str, host: str, suffix: str, last: bool = False) -> DataFrame:
    """(url, key, place, text): links to files of one host, each url once, at its first place or, with ``last``, at its last;
    the id is the url's hash."""
    rows = _of(links, host, suffix).select(key, "place", "text", F.col("href").alias("url"))
    order = [F.desc(key), F.desc("place")] if last else [F.asc(key), F.asc("place")]
    return latest(rows, ["url"], *order).withColumn("id", F.sha2("url", 256))


def single_link(links: DataFrame, key: str, host: str | None = None, suffix: str | None = None) -> DataFrame:
    """(key, url, n): the only distinct link of a page, of one host and kind of file where these are given; null with n other
    than 1 where there is none or no one."""
    fits = _of(links, host, suffix).groupBy(key).agg(F.count_distinct("href").alias("n"), F.min("href").alias("u"))
    rows = links.select(key).distinct().join(fits, key, "left")
    n = F.coalesce("n", F.lit(0))
    return rows.select(key, F.when(n == 1, F.col("u")).alias("url"), n.alias("n"))


#: Fixed value: the characters that XML 1.0 forbids.
FORBIDDEN = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x{fffe}\x{ffff}]"


def clean_xml(text: Column) -> Column:
    """Characters that XML 1.0 forbids, replaced by U+FFFD."""
    return F.regexp_replace(text, FORBIDDEN, "\ufffd")


def forbidden_in_xml(text: Column) -> Column:
    """How many characters ``clean_xml`` replaces."""
    return F.regexp_count(text, F.lit(FORBIDDEN))


def layout_words(spark: SparkSession, path: str) -> DataFrame:
    """(file, page, x_min, y_min, x_max, word, side) of word boxes in XHTML, by the built-in XML reader; pages count from 1."""
    box = "struct<_xMin:double,_yMin:double,_xMax:double,_yMax:double,_VALUE:string>"
    schema = f"page array<struct<_width: double, _height: double, word: array<{box}>>>"
    docs = spark.read.format("xml").option("rowTag", "doc").schema(schema).load(path)
    pages = docs.select(F.col("_metadata.file_path").alias("file"), F.posexplode("page").alias("i", "p"))
    words = pages.select("file", (F.col("i") + 1).alias("page"), F.col("p._width").alias("width"), F.explode("p.word").alias("w"))
    middle = (F.col("w._xMin") + F.col("w._xMax")) / 2
    side = F.when(middle < F.col("width") / 2, "left").otherwise("right")
    return words.select(
        "file", "page", F.col("w._xMin").alias("x_min"), F.col("w._yMin").alias("y_min"), F.col("w._xMax").alias("x_max"), F.col("w._VALUE").alias("word"), side.alias("side")
    )


def word_table(spark: SparkSession, path: str) -> DataFrame:
    """Recognised words with their confidence; rows without a word or with a negative confidence say nothing."""
    rows = spark.read.schema(TSV_SCHEMA).option("sep", "\t").option("header", True).option("quote", "").csv(path)
    return rows.where((F.col("conf") >= 0) & (F.trim("text") != ""))


def recognised_lines(words: DataFrame) -> DataFrame:
    """(page_num, block_num, par_num, line_num, text, confidence): the words of a line in order, and their mean confidence."""
    place = ["page_num", "block_num", "par_num", "line_num"]
    held = F.sort_array(F.collect_list(F.struct("word_num", "text")))  # the words of one line
    rows = words.groupBy(*place).agg(held.alias("w"), F.avg("conf").alias("confidence"))
    return rows.select(*place, F.array_join("w.text", " ").alias("text"), "confidence")


def confidence_stats(words: DataFrame, low: float = 60.0) -> DataFrame:
    """(page_num, n_words, mean, low_share) of each page: the share of words below ``low``."""
    return words.groupBy("page_num").agg(
        F.count(F.lit(1)).alias("n_words"), F.avg("conf").alias("mean"), (F.count_if(F.col("conf") < low) / F.count(F.lit(1))).alias("low_share")
    )


def archive_members(files: DataFrame, key: str, content: str) -> DataFrame:
    """(key, member, payload) of tar archives, compressed or not."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, blob in zip(batch["key"], batch["content"]):
                with tarfile.open(fileobj=io.BytesIO(blob)) as archive:
                    out += [(k, m.name, archive.extractfile(m).read()) for m in archive if m.isfile()]
            yield pd.DataFrame(out, columns=["key", "member", "payload"])

    rows = files.select(F.col(key).cast("string").alias("key"), F.col(content).alias("content"))
    return rows.mapInPandas(run, "key string, member string, payload binary").withColumnRenamed("key", key)


#: The part of a page in which its number is printed, and numbers that are years.
TOP_SHARE, OUTER_SHARE, YEARS = 0.18, 0.25, (1900, 2100)


def printed_candidates(words: DataFrame) -> DataFrame:
    """(page, candidates) from ``words`` (page, side, text, x0, y0, x1, y1, width, height): whole numbers at the top of a page and
    on its outer side, left or right; neither 0 nor a year. A page without any has an empty list."""
    x, y = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    outer = F.when(F.col("side") == "left", x <= OUTER_SHARE * F.col("width")).otherwise(x >= (1 - OUTER_SHARE) * F.col("width"))
    number = F.when(F.col("text").rlike(r"^\d{1,9}$"), F.col("text").cast("int"))
    fits = (y <= TOP_SHARE * F.col("height")) & outer & (number != 0) & ~number.between(*YEARS)
    return words.groupBy("page").agg(F.sort_array(F.collect_set(F.when(fits, number))).alias("candidates"))


def member_pages(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_index, text, label) of an archive: pages by the number in the names of ``members`` (member, text), with the
    class that ``labels`` (line: JSON lines with page_index and classification) gives them; other members are no pages."""
    page = F.nullif(F.regexp_extract("member", r"(?:^|/)page-(\d+)\.txt$", 1), F.lit("")).cast("int")
    pages = members.select(page.alias("page_index"), "text").where("page_index is not null")
    given = labels.select(F.from_json("line", "page_index int, classification string").alias("x")).select("x.page_index", F.col("x.classification").alias("label"))
    return pages.join(given.where("page_index is not null").groupBy("page_index").agg(F.max("label").alias("label")), "page_index", "left")
