"""Repairs text taken from scanned pages into continuous paragraphs.

One pass over the corpus counts the words (by records that hold them) and names the short lines that may be running heads.
Lines that keep breaking into sentences, or keep coming back within a record, are heads; Spark joins them back to the
records that hold them, so no list of heads is sent around. A head is named by its line with numbers made equal and with
letters that a scanner confuses made one, so a misread head has the name of the head. A second pass decodes each record:

* **Lines.** Running heads, page numbers and what is left blank by them are taken out.
* **Characters.** The remaining lines are one stream of characters with marks where lines ended. A shortest-path search goes
  over it with words as edges: an edge may drop a stray space, end a word where none stands, undo confusions, and put
  the halves of a word divided across lines together, with or without its hyphen, all at once (``decode``). Words the
  lexicon knows decode to themselves, so the search runs over what lies between them and the words beside it; a
  confusion is undone only where the reading is ``RATIO`` times as usual as what stands there.
* **Paragraphs.** A Viterbi search over the line ends chooses between joining and breaking, in a wrapped or a flat regime:
  in a wrapped one a line that ends a sentence and leaves room for the next word ends a paragraph, in a flat one each
  line is a paragraph unless the sentence goes on.

A record is a case if a line was taken out, or if the best path undoes a confusion or joins a word across a line end. Line
breaks, form feeds, lists of numbers, headings and tables alone are no traces, and neither are spaces.

Defined results: null and blank texts are no cases. Records with null ids are judged like others. Repeated rows come out
each. Extra columns are ignored; empty tables give no rows.

The lexicon is sent to all tasks. It holds words found in at least a share ``LEXICON_SHARE`` of the records, so it has at
most (words in a record / LEXICON_SHARE) entries however large the corpus; rarer words are unknown words to the search.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.runtime import materialize

LEXICON_SHARE = 1e-4
LEAST = 3  # records that must hold a word or a running head
RATIO = 40.0
HELD = 300_000  # words counted in a task before they are sent on
SHORT = 80  # characters of the longest running head
LONG = 100  # a line of this length was not wrapped
#: What stands on the page, what a scanner makes of it.
CONFUSIONS = (
    ("a", "n"), ("i", "!"), ("o", "0"), ("e", "c"), ("n", "ri"), ("c", "e"), ("t", "f"), ("s", "5"), ("d", "cl"),
    ("l", "1"), ("u", "ii"), ("p", "}"), ("l", "I"), ("m", "rn"), ("g", "q"), ("v", "y"), ("b", "h"), ("ó", "6"),
    ("C", "("), ("S", "5"), ("z", "2"), ("B", "8"), ("í", "f"), ("E", "F"), ("a", "0"), ("i", "1"), ("I", "1"),
    ("O", "0"), ("h", "b"), ("I", "l"), ("T", "F"), ("D", "O"), ("G", "6"), ("í", "!"),
)
HYPHENS = "-¬\xad"
_OUTER = ".,;:?¿()[]«»\"'…“”‘’¡"
_PAGE = re.compile(
    r"[\[(|—–\-·\s]*\d{1,5}(?:\s*(?:/|de)\s*\d{1,5})?[\])|—–\-·\s]*|P[áa]g(?:ina|s?\.)?\s*\d{1,5}(?:\s*(?:/|de)\s*\d{1,5})?"
)
_NUMBER = re.compile(r"\d+")
_BARE = re.compile(r"\s*\d{1,5}\s*")
_HEAD_TAIL = re.compile(r"(?:\s*\|\s*|\s{2,})[\d\W]*$")
_SENTENCE_END = tuple(".?!:»)”\"")


def _classes() -> dict[str, str]:
    """For each letter the first of those that it may be taken for, in any number of steps."""
    group: dict[str, set[str]] = {}
    for true, seen in CONFUSIONS:
        x, y = true.casefold(), seen.casefold()
        if len(y) == 1:
            both = group.get(x, {x}) | group.get(y, {y})
            group.update(dict.fromkeys(both, both))
    return {c: min(g) for c, g in group.items()}


_CLASS = str.maketrans(_classes())
_WIDE = [(seen, true) for true, seen in CONFUSIONS if len(seen) > 1]
_OWN_NUMBER = re.compile(r"(?<![^\W\d_])\d+(?![^\W\d_])")
_TWICE = re.compile(r"(.)\1+")


def line_names(line: str) -> list[str]:
    """Names of a line: its page number cut off, its numbers made equal, letters that are confused made one; and the same
    without the characters beyond ASCII, if there are any, which a wrong decoding may have changed."""
    name = _OWN_NUMBER.sub("#", _HEAD_TAIL.sub("", line.strip())).casefold()
    out = [name] if name.isascii() else [name, name.encode("ascii", "ignore").decode()]
    for seen, true in _WIDE:
        out = [x.replace(seen, true) for x in out]
    return [_TWICE.sub(r"\1", x.translate(_CLASS)) for x in out]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, key, n, h): words (w) with the number of records that hold them, and for each text, by its hash, the names of
    lines that may be heads: l where nothing speaks for it, s where the record shows it, c where it only may be a misread one."""
    words: Counter[str] = Counter()
    lines: list[tuple[str, str, int]] = []

    def flush() -> pa.RecordBatch:
        keep = [(w, n) for w, n in words.items() if not any(c.isdigit() for c in w) and any(map(str.isalpha, w))]
        kinds = ["w"] * len(keep) + [x[0] for x in lines]
        keys = [w for w, _ in keep] + [x[1] for x in lines]
        n = [n for _, n in keep] + [1] * len(lines)
        h = [0] * len(keep) + [x[2] for x in lines]
        words.clear()
        lines.clear()
        return pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(keys), pa.array(n, pa.int64()), pa.array(h, pa.int64())], ["kind", "key", "n", "h"])

    for batch in batches:
        for text, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words.update(set(text.split()))
            if "\n" in text:
                lines.extend((kind, key, h) for key, kind in _head_signs(text).items())
        if len(words) + len(lines) > HELD:
            yield flush()
    if words or lines:
        yield flush()


def _head_signs(text: str) -> dict[str, str]:
    """Names of the lines that may be running heads, each with how much this record says for it: c, l or s."""
    lines = [x for x in text.split("\n") if x.strip()]
    seen: dict[str, str] = {}
    count: Counter[str] = Counter()
    for i, line in enumerate(lines):
        bare = line.strip()
        if not _may_be_head(bare):
            continue
        names = line_names(bare)
        if not bare[-1].isdigit() or not (bare[0].isupper() or bare[0].isdigit()) or not _LETTERS.search(bare):
            for key in names:
                seen.setdefault(key, "c")
            continue
        breaks = (
            0 < i < len(lines) - 1
            and len(lines[i - 1]) >= LONG
            and not lines[i - 1].rstrip().endswith(_SENTENCE_END)
            and lines[i + 1].lstrip()[:1].islower()
        )
        for key in names:
            count[key] += 1
            seen[key] = max(seen.get(key, "c"), "s" if breaks else "l")
    seen.update((key, "s") for key, n in count.items() if n > 1)
    return seen


def _may_be_head(bare: str) -> bool:
    return 8 <= len(bare) <= SHORT and any(c.isdigit() for c in bare) and "...." not in bare


@dataclass
class Lexicon:
    """What the counting pass learned; ``floor`` is the count that any word left out is under."""

    words: dict[str, int]
    floor: float
    known: set[str] = field(default_factory=set)
    undo: dict[str, list[str]] = field(default_factory=dict)
    memo: dict[str, str | None] = field(default_factory=dict)
    alone: dict[str, tuple[str, frozenset[str]]] = field(default_factory=dict)

    def ready(self) -> Lexicon:
        if not self.undo:
            for true, seen in CONFUSIONS:
                self.undo.setdefault(seen, []).append(true)
            cores: Counter[str] = Counter()
            for raw, n in self.words.items():
                cores[raw.strip(_OUTER)] += n
            cores.pop("", None)
            self.cores = dict(cores)
            wrong = {w for w in self.cores if self.reading(w) is not None}
            self.total = math.log(sum(self.cores.values()) + 1.0)
            self.longest = max(map(len, self.words), default=1)
            self.known = {raw for raw in self.words if raw.strip(_OUTER) not in wrong and not raw.endswith(tuple(HYPHENS))}
        return self

    def count(self, word: str) -> int:
        return max(self.cores.get(word, 0), self.cores.get(word.lower(), 0) if word[:1].isupper() else 0)

    def one_off(self, word: str) -> set[str]:
        """The words that one confusion may have turned into ``word``."""
        out = set()
        for seen, trues in self.undo.items():
            at = word.find(seen)
            while at >= 0:
                for true in trues:
                    out.add(word[:at] + true + word[at + len(seen) :])
                at = word.find(seen, at + 1)
        return out

    def reading(self, word: str) -> str | None:
        """What ``word`` should read, if it is misread; else None."""
        if len(word) < 3:
            return None
        if word in self.memo:
            return self.memo[word]
        least = RATIO * max(self.cores.get(word, 0), self.floor)
        near = self.one_off(word)
        best = max(near, key=self.count, default=None)
        if best is not None and self.count(best) < least:
            best = None
        if best is None and len(word) >= 6 and self.cores.get(word, 0) <= self.floor:
            two = {x for n in near for x in self.one_off(n)}
            best = max(two, key=self.count, default=None)
            if best is not None and self.count(best) < RATIO * least:
                best = None
        if best == word:
            best = None
        if len(self.memo) > 500_000:
            self.memo.clear()
        self.memo[word] = best
        return best

    def misread(self, core: str) -> str | None:
        """The reading of a word without its outer marks, if it is one that a scanner made."""
        if len(core) < 3 or not _LETTERS.search(core) or core[-1] in HYPHENS or "$" in core or "-" in core:
            return None
        if not core.isalpha() and not _MIXED.search(core):
            return None
        read = self.reading(core)
        if read is None and _STRAY.fullmatch(core):
            # a sign between small letters is none of a word's own, whether the lexicon has the word (a name) or not
            read = "".join(_ALONE.get(c, c) for c in core)
        return read


def furniture(lines: list[str], heads: frozenset[str]) -> set[int]:
    """The numbers of the lines that belong to the page and not to the text; ``heads`` are names of running heads."""
    out, listed = set(), False
    for i, line in enumerate(lines):
        bare = line.strip()
        if not bare:
            continue
        if _BARE.fullmatch(bare):
            around = [x.strip() for x in (lines[i - 1] if i else "", lines[i + 1] if i + 1 < len(lines) else "")]
            listed = around[0].endswith(":") or (listed and bool(_BARE.fullmatch(around[0] or "x")))
            if not listed:
                out.add(i)
            continue
        listed = False
        if len(bare) <= SHORT and (_PAGE.fullmatch(bare) or heads and _may_be_head(bare) and not heads.isdisjoint(line_names(bare))):
            out.add(i)
    return out


_LETTERS = re.compile(r"[^\W\d_]")
_STRAY = re.compile(r"[^\W\d_]*[a-záéíóúüñ][0125!}I][a-záéíóúüñ]+")
#: What a sign among small letters most likely was.
_ALONE = {"0": "o", "1": "l", "2": "z", "5": "s", "!": "i", "}": "p", "I": "l"}
_MIXED = re.compile(r"[^\W\d_][\d!}{(|]|[\d!}{(|][^\W\d_]|[a-záéíóúñ]I")


TRACES = frozenset({"confusion", "line"})


def traces(text: str, lex: Lexicon, heads: frozenset[str] = frozenset()) -> bool:
    """Whether the text shows traces of scanning: a line taken out, or a best path that undoes what a scanner does."""
    lines = text.split("\n")
    drop = furniture(lines, heads) if len(lines) > 1 else ()
    if drop:
        return True
    return not TRACES.isdisjoint(decode(lines, lex)[1])


def decode(lines: list[str], lex: Lexicon) -> tuple[str, frozenset[str]]:
    """The best reading of the lines as one stream, and what it undid: confusion, line (a word divided across lines), space
    (a stray space within a word) and word (a missing space)."""
    tokens: list[str] = []
    begins: set[int] = set()  # tokens that begin a line
    for line in lines:
        begins.add(len(tokens))
        tokens += line.split()
    unknown = [i for i, t in enumerate(tokens) if t not in lex.known]
    if not unknown:
        return " ".join(tokens), frozenset()
    stretches: list[list[int]] = []
    for i in unknown:
        a, b = i, i + 1
        if i and _meet(tokens[i - 1], tokens[i], i in begins, lex):
            a -= 1
        if b < len(tokens) and _meet(tokens[i], tokens[b], b in begins, lex):
            b += 1
        if stretches and a < stretches[-1][1]:
            stretches[-1][1] = b
        else:
            stretches.append([a, b])
    out, done, at = [], set(), 0
    for a, b in stretches:
        out += tokens[at:a]
        if b - a > 1:
            read, undone = _search(tokens[a:b], [i in begins for i in range(a, b)], lex)
        else:
            read, undone = _single(tokens[a], lex)
        out.append(read)
        done |= undone
        at = b
    return " ".join(out + tokens[at:]), frozenset(done)


def _single(token: str, lex: Lexicon) -> tuple[str, frozenset[str]]:
    """The best reading of an unknown word whose neighbours have no part in it, kept for the next time."""
    held = lex.alone.get(token)
    if held is None:
        core = token.strip(_OUTER)
        # where no edge but the word itself can begin, there is nothing to search
        if len(core) > 1 and (lex.misread(core) is not None or not lex.count(core) and _may_split(core, lex)):
            held = _search([token], [False], lex)
        else:
            held = token, frozenset()
        if len(lex.alone) > 500_000:
            lex.alone.clear()
        lex.alone[token] = held
    return held


def _may_split(core: str, lex: Lexicon) -> bool:
    return core[:1].islower() and any(core[:k] in lex.cores and core[k:] in lex.cores for k in range(1, len(core)))


def _meet(a: str, b: str, line: bool, lex: Lexicon) -> bool:
    """Whether an edge can lead over both of two neighbours: a word divided at a line end, or halves that make a known word."""
    if a[-1] in HYPHENS:
        return line and len(a) > 1 and b[:1].isalpha()
    if not a[-1:].isalpha() or not b[:1].islower() or a in lex.known and b in lex.known:
        return False
    return (a + b).strip(_OUTER) in lex.cores


COST = math.log(RATIO)  # of a confusion, of a dropped space and of a missing one
LETTER = 0.8  # of each letter of a word that the lexicon does not have


def _search(tokens: list[str], begins: list[bool], lex: Lexicon) -> tuple[str, frozenset[str]]:
    """The best path over the characters of ``tokens``, whose edges are words (see the head of the module)."""
    text, line_ends = "", set()
    for token, begin in zip(tokens, begins):
        if text:
            if begin:
                line_ends.add(len(text))
            text += " "
        text += token
    n = len(text)
    cost: list[float] = [0.0] + [math.inf] * n
    back: list[tuple[int, str, tuple[str, ...]]] = [(0, "", ())] * (n + 1)
    ends = [i for i in range(1, n + 1) if i == n or text[i] == " "]
    for i in range(n):
        if cost[i] == math.inf or text[i] == " ":
            continue
        left = i == 0 or text[i - 1] == " "
        k = bisect_left(ends, i + 1)
        # an edge ends inside its own token, no further than a known word goes, or with its token, or with the next one
        for j in (*range(i + 1, min(ends[k], i + lex.longest + 1)), *ends[k : k + 2]):
            if j > ends[k] and not left:
                continue
            price, read, undone = _edge(text[i:j], i, left and j in (ends[k], ends[min(k + 1, len(ends) - 1)]), line_ends, lex)
            if not left:
                price, undone = price + COST, (*undone, "word")
            end = j + 1 if j < n and text[j] == " " else j
            if cost[i] + price < cost[end]:
                cost[end], back[end] = cost[i] + price, (i, read, undone)
    words: list[str] = []
    done: set[str] = set()
    at = n
    while at:
        at, word, undone = back[at]
        words.append(word)
        done.update(undone)
    return " ".join(reversed(words)), frozenset(done)


def _edge(piece: str, begin: int, whole: bool, line_ends: set[int], lex: Lexicon) -> tuple[float, str, tuple[str, ...]]:
    """(price, reading, what it undoes) of the cheapest way to read the characters of ``piece`` as one word."""
    gap = piece.find(" ")
    if gap < 0:
        return _word(piece, whole, lex)
    a, b = piece[:gap], piece[gap + 1 :]
    over = "line" if begin + gap in line_ends else "space"
    if a[-1] not in HYPHENS:
        if not a[-1].isalpha() or not b[0].islower():
            return math.inf, piece, ()
        price, read, undone = _word(a + b, whole, lex)
        return (price + COST, read, (*undone, over)) if lex.count(read.strip(_OUTER)) else (math.inf, piece, ())
    if over == "space" or len(a) < 2 or not b[0].isalpha():
        return math.inf, piece, ()
    # a compound keeps its hyphen: it is known as such, or both its halves are and their union is not
    bare, core = a[:-1], b.strip(_OUTER)
    union, kept = lex.count((bare + core).strip(_OUTER)), lex.count(f"{bare}-{core}".strip(_OUTER))
    halves = lex.count(bare.strip(_OUTER)) and lex.count(core)
    if not b[0].islower() or a[-1] == "-" and (kept > union or not union and halves) or not a[-2].isalpha():
        return 0.0, a[:-1] + "-" + b if a[-1] == "-" else a + b, ()
    price, read, undone = _word(bare + b, whole, lex)
    return min(price, lex.total), read, (*undone, "line")


def _word(word: str, whole: bool, lex: Lexicon) -> tuple[float, str, tuple[str, ...]]:
    """The price of one word: its rarity; that of what it was misread from; or, for an unknown one, its letters."""
    core = word.strip(_OUTER)
    uses = lex.count(core) if len(core) > 1 or len(word) == 1 else 0
    read = lex.misread(core) if core and word not in lex.known else None
    if read is not None:
        return lex.total - math.log(max(lex.floor, lex.count(read))) + COST, word.replace(core, read, 1), ("confusion",)
    if uses:
        return lex.total - math.log(uses), word, ()
    return (lex.total + LETTER * len(core) if whole else math.inf), word, ()


def _breaks(lines: list[str], gaps: list[bool], cuts: list[bool]) -> list[bool]:
    """For each line but the first, whether a paragraph begins there: Viterbi over two regimes, wrapped and flat."""
    if len(lines) < 2:
        return []
    near = lambda i: max(len(x) for x in lines[max(0, i - 6) : i + 7] if len(x) < LONG) if any(
        len(x) < LONG for x in lines[max(0, i - 6) : i + 7]
    ) else LONG
    switch, inf = 4.0, math.inf
    score = [0.0, 0.0]
    steps: list[list[tuple[int, bool]]] = []
    for i in range(1, len(lines)):
        a, b = lines[i - 1].rstrip(), lines[i].lstrip()
        ended = a.endswith((".", "?", "!", ":", "»", ")", "”")) or a[-1:].isdigit()
        opens = not b[:1].islower()
        goes_on = a[-1:] in HYPHENS or b.startswith("...") or not ended and b[:1].islower() or a.endswith((",", ";"))
        room = len(a) + 1 + len(b.split(" ", 1)[0]) <= near(i)
        heading = opens and not a.endswith((",", ";", "-", "¬", "\xad")) and len(a) < 0.6 * near(i)
        # costs of (join, break) in the wrapped and in the flat regime
        fits_wrap = 0.0 if len(a) < LONG else 6.0
        if goes_on:
            wrapped, flat = (0.0, 9.0), (2.0, 9.0)
        elif heading or ended and opens and room:
            wrapped, flat = (5.0, 0.0), (9.0, 0.0)
        elif ended and opens:
            wrapped, flat = (0.5, 1.5), (6.0, 0.0)
        else:
            wrapped, flat = (0.0, 5.0), (4.0, 0.5)
        if cuts[i] and not goes_on:  # a page ended here
            wrapped = (wrapped[0], min(wrapped[1], 2.0 if ended else 6.0))
        if gaps[i] and not goes_on:  # an empty line stands between
            wrapped, flat = (wrapped[0] + 4.0, 0.0), (flat[0] + 4.0, 0.0)
        new, step = [inf, inf], []
        for s, (join, split) in enumerate((wrapped, flat)):
            origin = min((0, 1), key=lambda r: score[r] + (switch if r != s else 0.0))
            base = score[origin] + (switch if origin != s else 0.0) + (fits_wrap if s == 0 else 0.0)
            begin = split < join
            new[s] = base + min(join, split)
            step.append((origin, begin))
        score = new
        steps.append(step)
    state, out = (0 if score[0] <= score[1] else 1), []
    for step in reversed(steps):
        state_before, begin = step[state]
        out.append(begin)
        state = state_before
    return out[::-1]


def repair(text: str, lex: Lexicon, heads: frozenset[str] = frozenset()) -> str:
    """The text as paragraphs parted by an empty line."""
    lines = text.replace("\r\n", "\n").replace("\r", "\n").replace("\f", "\n").split("\n")
    drop = furniture(lines, heads)
    kept, gaps, cuts = [], [], []
    gap = cut = False
    for i, line in enumerate(lines):
        if i in drop:
            cut = True
        elif not line.strip():
            gap = True
        else:
            kept.append(line.strip())
            gaps.append(gap and not cut)
            cuts.append(cut)
            gap = cut = False
    if not kept:
        return ""
    # a running head and the empty lines around it part what belongs together
    starts = _breaks(kept, gaps, cuts)
    paragraphs = [[kept[0]]]
    for line, begins in zip(kept[1:], starts):
        if begins:
            paragraphs.append([line])
        else:
            paragraphs[-1].append(line)
    return "\n\n".join(decode(p, lex)[0] for p in paragraphs)


def _written(texts: DataFrame) -> DataFrame:
    """The written texts with the hash by which their heads come back to them (a chance match only brings heads of another)."""
    return texts.where(F.col("text").isNotNull() & (F.length("text") > 0)).withColumn("h", F.xxhash64("text"))


def learn(texts: DataFrame) -> tuple[Lexicon, DataFrame]:
    """One pass over all texts: the lexicon, and (h, heads) of each text that holds running heads, by its hash."""
    written = _written(texts).select("text", "h")
    # written once: words and lines are picked from it apart
    counted = materialize(written.mapInArrow(_count, "kind string, key string, n bigint, h bigint"), "scan-counts", "kind")
    total = written.count()
    least = max(float(LEAST), LEXICON_SHARE * total)
    words = counted.where("kind = 'w'").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).collect()
    lines = counted.where("kind <> 'w'").select("key", "kind", "h")
    n, m = F.count_if(F.col("kind") != "c"), F.count_if(F.col("kind") == "s")
    # what speaks for a head is a share of its uses, so it does not depend on how many other records there are
    heads = lines.groupBy("key").agg(n.alias("n"), m.alias("m")).where((F.col("n") >= LEAST) & (F.col("m") >= 2) & (F.col("m") >= 0.02 * F.col("n")))
    held = lines.select("key", "h").join(heads.select("key"), "key").groupBy("h").agg(F.collect_set("key").alias("heads"))
    return Lexicon({r["key"]: r["n"] for r in words}, least), materialize(held, "scan-heads")


def scanned(records: DataFrame, repaired: bool = False) -> DataFrame:
    """The records (table_name, record_id, text) with traces of scanning; with ``repaired`` also their text repaired."""
    lex, held = learn(records)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = lex.ready()
        for batch in batches:
            texts = batch.column(2).to_pylist()
            heads = [frozenset(x or ()) for x in batch.column(3).to_pylist()]
            hit = [traces(t, ready, x) for t, x in zip(texts, heads)]
            rows = batch.filter(pa.array(hit, pa.bool_()))
            columns = [rows.column(0), rows.column(1)]
            if repaired:
                columns.append(pa.array([repair(t, ready, x) for t, x, y in zip(texts, heads, hit) if y], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["table_name", "record_id", "text"][: len(columns)])

    rows = _written(records.select("table_name", "record_id", "text")).join(held, "h", "left")
    rows = rows.select("table_name", "record_id", "text", "heads")
    return rows.mapInArrow(run, "table_name string, record_id bigint" + (", text string" if repaired else ""))
