"""Restores text that was decoded with the wrong character encoding, by minimum description length.

A link of a chain is "written as A, read as B"; undoing it turns a garbled word back into its bytes under B and reads them
as A. For each text and each link that could have made its unusual characters, the words that the link would change are
taken with their neighbours and compressed twice, as they stand and undone, each time with the zstandard dictionary of
the language that compresses best. The link that saves most, after its own cost, is undone, and the search goes on with
the result, so that chains (a text garbled twice) and mixtures come out link by link. If no link pays, the text stays as
it is. Only words that come out wholly in the alphabet of the dictionaries' languages are changed, so correct parts of a
partly garbled text and foreign words stay untouched.

The dictionaries and the alphabet come from all labelled rows, whatever their length: characters, and words alone and with one
or two that follow, are counted exactly, and a dictionary takes the stretches that save most until it is full. So it depends
neither on the order of the rows nor on how they are partitioned. All texts are judged, whatever their length, in one pass
without a shuffle.

Defined results: null and blank texts are no cases. Replacement characters (U+FFFD) are a case even where the original
cannot be known; they stay in the text. Rows are judged each, repeated rows too. Risk flags are not consulted. Extra
columns are ignored; empty tables give no rows; no labelled text gives no dictionary and leaves every text unchanged.
"""

from __future__ import annotations

import codecs
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LANGUAGES = ("es", "en", "fr")
DICTIONARY_BYTES = 110 * 1024
STRETCH = 3  # words that are counted together at most
MATCH_BYTES = 3  # what a stretch costs where the dictionary has it
FLUSH = 1 << 22  # characters whose counts a worker holds before it hands them on
ALPHABET_SHARE = 3e-6  # of the characters of a language
LINK_COST = 2  # bytes that each link of a chain must save
DEPTH = 4  # links looked ahead where fewer do not pay; the chain itself may be longer
#: Fixed values: (written as, read as).
LINKS = (
    ("utf-8", "cp1252"),
    ("utf-8", "mac_roman"),
    ("utf-8", "cp850"),
    ("utf-8", "cp437"),
    ("utf-8", "cp1251"),
    ("utf-8", "cp1250"),
    ("cp1252", "mac_roman"),
    ("cp1252", "cp1251"),
    ("cp1252", "cp850"),
    ("cp1252", "koi8_r"),
    ("cp1252", "cp866"),
    ("cp1252", "cp1250"),
    ("cp1252", "iso8859-7"),
    ("cp850", "cp1252"),
    ("mac_roman", "cp1252"),
)
REPLACEMENT = "�"


def _table(encoding: str) -> dict[str, int]:
    """Characters of a one-byte encoding by their byte; what it leaves open, and control characters, stand for themselves."""
    table = {chr(b): b for b in range(128, 160)}
    for b in range(256):
        try:
            table[bytes([b]).decode(encoding)] = b
        except UnicodeDecodeError:
            table.setdefault(chr(b), b)
    return table


class Link:
    """One wrong decoding, and how to undo it in a word."""

    def __init__(self, written: str, read: str, alphabet: frozenset[str]):
        self.name = f"{written}>{read}"
        self.bytes_of = _table(read)
        self.alphabet = alphabet
        self.wide = codecs.lookup(written).name == "utf-8"
        if self.wide:
            self.first = {c for c, b in self.bytes_of.items() if 0xC2 <= b <= 0xC5 or b == 0xE2}
        else:
            own = _table(written)
            back = {b: c for c, b in own.items()}
            self.map = {c: back[b] for c, b in self.bytes_of.items() if b > 127 and b in back}
            wanted = {own[c] for c in alphabet if c in own}
            self.first = {c for c, b in self.bytes_of.items() if b in wanted}

    def undo(self, word: str) -> str:
        """The word as it was before, or the word itself where the link cannot have made it."""
        return self._undo_wide(word) if self.wide else self._undo_narrow(word)

    def _undo_narrow(self, word: str) -> str:
        out = [c if c < "\x80" else self.map.get(c, REPLACEMENT) for c in word]
        # one character that comes out wrong shows that the word is not of this link, and so does one on its own
        if any(c >= "\x80" and c not in self.alphabet for c in out):
            return word
        inside = any(c >= "\x80" and (word[i - 1 : i].isalnum() or word[i + 1 : i + 2].isalnum()) for i, c in enumerate(word))
        return "".join(out) if inside else word

    def sure(self, word: str) -> bool:
        """Whether the word, as it stands, is none of the languages: a character they do not have, or a capital among
        small letters."""
        return self.wide or any(
            c >= "\x80" and (c not in self.alphabet or c.isupper() and word[i - 1 : i].islower()) for i, c in enumerate(word)
        )

    def _undo_wide(self, word: str) -> str:
        out, i, n = [], 0, len(word)
        while i < n:
            lead = self.bytes_of.get(word[i], 0) if word[i] > "\x7f" else 0
            need = 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0
            if need and i + need <= n:
                rest = [self.bytes_of.get(c, 0) for c in word[i + 1 : i + need]]
                try:
                    out.append(bytes([lead, *rest]).decode("utf-8"))
                    i += need
                    continue
                except UnicodeDecodeError:
                    pass
            out.append(word[i])
            i += 1
        return "".join(out)


@dataclass(frozen=True)
class Model:
    """One dictionary for each language, and the letters beyond ASCII that their texts use."""

    dictionaries: tuple[bytes, ...]
    alphabet: frozenset[str]


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, unit, n): how often each stretch of up to STRETCH words stands in the texts, in parts to be added up."""
    counts: dict[str, Counter] = defaultdict(Counter)

    def part() -> Iterator[pd.DataFrame]:
        for lang, c in counts.items():
            items = iter(c.items())
            while rows := list(islice(items, 50_000)):
                yield pd.DataFrame(rows, columns=["unit", "n"]).assign(lang=lang)[["lang", "unit", "n"]]
        counts.clear()

    held = 0
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["t"]):
            words = text.split()
            for k in range(1, STRETCH + 1):
                counts[lang].update(map(" ".join, zip(*(words[i:] for i in range(k)))))
            held += len(text)
            if held >= FLUSH:
                yield from part()
                held = 0
    yield from part()


def _dictionary(units: list[str]) -> bytes:
    """The stretches that fit, the best ones last, where zstandard reaches them at least cost; what stands in better ones is left out."""
    content = b""
    for unit in units:
        data = b" " + unit.encode("utf-8", "replace")
        if len(content) + len(data) <= DICTIONARY_BYTES and data not in content:
            content = data + content
    return content


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on all rows of each language."""
    labelled = docs.select(F.lower(F.trim(lang_col)).alias("lang"), F.col(text_col).alias("t"))
    labelled = labelled.where(F.col("lang").isin(*LANGUAGES) & F.col("t").isNotNull())
    totals = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.sum(F.length("t")).alias("n")).collect()}
    beyond = F.explode(F.split(F.regexp_replace("t", r"[\x00-\x7f]+", ""), ""))
    counts = labelled.select("lang", beyond.alias("c")).where("c <> ''").groupBy("lang", "c").agg(F.count(F.lit(1)).alias("n"))
    alphabet: set[str] = set()
    for r in counts.where("n > 1").collect():  # a row for each character that comes twice
        c, n, least = r["c"], r["n"], max(2, ALPHABET_SHARE * totals[r["lang"]])
        if n >= least and c.isalpha():
            alphabet |= {x for x in (c, c.upper()) if len(x) == 1}
        if n >= 10 * least and c > "\x9f" and c != REPLACEMENT:
            alphabet.add(c)
    units = labelled.mapInPandas(_counted, "lang string, unit string, n bigint").groupBy("lang", "unit").agg(F.sum("n").alias("n"))
    size = F.octet_length("unit") + 1  # with the blank before it
    units = units.where((size > MATCH_BYTES) & (size <= DICTIONARY_BYTES)).withColumn("saved", F.col("n") * (1 - MATCH_BYTES / size))
    # a dictionary has room for no more stretches than this; steps of what they save tell which ones come into question
    room = DICTIONARY_BYTES // (MATCH_BYTES + 1)
    units = units.withColumn("step", F.floor(F.log2("saved") * 16))
    better = F.sum("k").over(Window.partitionBy("lang").orderBy(F.desc("step"))) - F.col("k")
    steps = units.groupBy("lang", "step").agg(F.count(F.lit(1)).alias("k")).withColumn("better", better)
    least_step = steps.where(F.col("better") < room).groupBy("lang").agg(F.min("step").alias("least"))  # a row for each language
    units = units.join(F.broadcast(least_step), "lang").where("step >= least").select("lang", "saved", "unit")
    ranked: dict[str, list[str]] = defaultdict(list)
    for r in sorted(units.collect(), key=lambda r: (-r["saved"], r["unit"])):
        ranked[r["lang"]].append(r["unit"])
    return Model(tuple(_dictionary(ranked[lang]) for lang in LANGUAGES if lang in ranked), frozenset(alphabet))


class Repairer:
    def __init__(self, model: Model):
        self.compressors = [
            zstandard.ZstdCompressor(
                level=12,
                dict_data=zstandard.ZstdCompressionDict(d),
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
            )
            for d in model.dictionaries
        ]
        self.links = [Link(a, b, model.alphabet) for a, b in LINKS]
        self.alphabet = model.alphabet

    def length(self, text: str) -> int:
        """Bytes that the text takes under the language that suits it best."""
        data = text.encode("utf-8", "surrogatepass")
        return min(len(c.compress(data)) for c in self.compressors)

    def _try(self, words: list[str], link: Link) -> tuple[int, list[str] | None]:
        """The bytes that undoing ``link`` saves, and the words then."""
        changed, sure = {}, False
        for i, w in enumerate(words):
            if not w.isascii() and not link.first.isdisjoint(w):
                undone = link.undo(w)
                if undone != w:
                    if link.sure(w):
                        sure = True
                    elif self.length(" ".join(words[max(0, i - 1) : i + 2])) <= self.length(
                        " ".join([*words[max(0, i - 1) : i], undone, *words[i + 1 : i + 2]])
                    ):
                        continue  # a word that may well be right as it stands is changed only where it gets shorter itself
                    changed[i] = undone
        if not sure:
            return 0, None
        new = list(words)
        near = set()
        for i, w in changed.items():
            new[i] = w
            near.update((i - 1, i, i + 1))
        at = sorted(i for i in near if 0 <= i < len(words))
        gain = self.length(" ".join(words[i] for i in at)) - self.length(" ".join(new[i] for i in at))
        return gain - LINK_COST, new

    def _best(self, words: list[str], depth: int) -> tuple[int, list[str] | None, list[str]]:
        """The chain of at most ``depth`` links that saves most. Only links from UTF-8 can hide others."""
        here = {c for w in words if not w.isascii() for c in w if c > "\x7f"}
        best: tuple[int, list[str] | None, list[str]] = (0, None, [])
        for link in self.links:
            if link.first.isdisjoint(here):
                continue
            gain, new = self._try(words, link)
            if new is None:
                continue
            chain = [link.name]
            if link.wide and depth > 1:
                more, newer, rest = self._best(new, depth - 1)
                if newer is not None:
                    gain, new, chain = gain + more, newer, chain + rest
            if gain > best[0]:
                best = (gain, new, chain)
        return best

    def repair(self, text: str) -> tuple[str, list[str]]:
        """The restored text and the links undone, in order."""
        if text.isascii() or not self.compressors:
            return text, []
        words, chain = text.split(" "), []
        while True:  # every turn makes the text shorter by what its links cost, so there is a last one
            new = None
            for depth in range(2, DEPTH + 1):
                _, new, links = self._best(words, depth)
                if new is not None or not self._odd(words):
                    break
            if new is None:
                break
            words, chain = new, [*chain, *links]
        return " ".join(words), chain

    def _odd(self, words: list[str]) -> bool:
        """Whether characters are left that none of the languages has."""
        return any(c > "\x7f" and c not in self.alphabet and c != REPLACEMENT for w in words if not w.isascii() for c in w)


def repaired(texts: DataFrame, model: Model, id_col: str = "text_id", text_col: str = "text") -> DataFrame:
    """(record_id, chain, restored, lost) of every record that was decoded wrongly; ``lost`` where characters are gone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        repairer = Repairer(model)
        for batch in batches:
            rows = []
            for i, text in zip(batch["i"], batch["t"]):
                out, chain = repairer.repair(text)
                lost = REPLACEMENT in out
                if chain or lost:
                    rows.append((i, chain, out, lost))
            yield pd.DataFrame(rows, columns=["record_id", "chain", "restored", "lost"])

    rows = texts.where(F.col(text_col).isNotNull() & (F.octet_length(text_col) > F.length(text_col)))
    rows = rows.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t"))
    return rows.mapInPandas(run, "record_id bigint, chain array<string>, restored string, lost boolean")
