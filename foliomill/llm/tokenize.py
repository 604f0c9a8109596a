"""Token ids of a whole corpus under a public byte-level BPE vocabulary.

A text falls into words at its spaces and words into pretokens. The distinct words of a stretch of rows are encoded once;
their pretokens are sorted, which is the depth-first order of their trie, and walked with a stack: each byte position
holds the last token of the encoding of the prefix that ends there. A prefix shared with the pretoken before keeps its
states, so it is computed once. The last token of a prefix is the longest vocabulary entry that ends it and that may
follow the last token of what is left (two tokens may stand side by side if merging their bytes anew gives the same two);
exactly one does. An encoding is read off by stepping back from the last state.

Nothing is shuffled, and a worker holds at most ``MEMO`` encoded words, whatever the size of the corpus.

Defined results: an empty text and a null text both have no ids (an empty list); blank texts have the ids of their white
space. The strings of special tokens are ordinary text. Rows keep their order within a partition, repeated rows are
encoded again, extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER_DIR = "/opt/tokenizers"
#: Fixed value: the pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space as the pattern sees it.
SPACES = (
    "\t\n\x0b\x0c\r \x85\xa0                　"
)
MEMO = 400_000
_BEFORE_SPACE = [c + " " for c in SPACES]


def _byte_chars() -> dict[str, int]:
    """The printable character by which the vocabulary file writes each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieEncoder:
    """Encodes pretokens by the last-token states of their prefixes."""

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))["model"]
        chars = _byte_chars()
        as_bytes = lambda s: bytes(chars[c] for c in s)
        self.ids = {as_bytes(s): i for s, i in model["vocab"].items() if all(c in chars for c in s) and s[:2] != "<|"}
        vocab = model["vocab"]
        self.joined, self.parts = {}, {}
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pair, whole = (vocab[a], vocab[b]), vocab[a + b]
            self.joined.setdefault(pair, whole)
            self.parts.setdefault(whole, pair)
        self.longest = max(map(len, self.ids))
        self.beside: dict[tuple[int, int], bool] = {}

    def may_follow(self, a: int, b: int) -> bool:
        """Whether the bytes of tokens ``a b`` encode as just these two.

        Undoes the merges of both sides, latest first; a merge across the border that would have come before the one
        undone last means that the two would have grown together.
        """
        if (known := self.beside.get((a, b))) is not None:
            return known
        left, right, limit = a, b, float("inf")
        while True:
            across = self.joined.get((left, right))
            if across is not None and across < limit:
                answer = False
                break
            undo_left, undo_right = self.parts.get(left), self.parts.get(right)
            if undo_left is not None and (undo_right is None or left > right):
                limit, left = left, undo_left[1]
            elif undo_right is not None:
                # at equal rank the merge further left comes first
                limit, right = right + 1, undo_right[0]
            else:
                answer = True
                break
        self.beside[a, b] = answer
        return answer

    def encode_sorted(self, words: Iterable[bytes]) -> Iterator[list[int]]:
        """The ids of each of the words, which must be sorted; shared prefixes are computed once."""
        before = b""
        last: list[int] = [-1]  # last[i]: the last token of the first i bytes
        step: list[int] = [0]  # step[i]: its length
        ids, longest, may_follow = self.ids, self.longest, self.may_follow
        for word in words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :], step[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for begin in range(max(0, end - longest), end):
                    token = ids.get(word[begin:end])
                    if token is not None and (begin == 0 or may_follow(last[begin], token)):
                        last.append(token)
                        step.append(end - begin)
                        break
            before = word
            out, at = [], len(word)
            while at:
                out.append(last[at])
                at -= step[at]
            yield out[::-1]


class CorpusEncoder:
    """Encodes texts; keeps the encodings of at most MEMO words."""

    def __init__(self, path: str):
        import regex

        self.trie = TrieEncoder(path)
        self.find = regex.compile(PATTERN).findall
        self.words: dict[str, bytes] = {}
        self.pretokens: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> None:
        """Encode the pretokens of ``pieces`` that are not known yet, in the order of their trie."""
        fresh = sorted((p.encode("utf-8", "surrogatepass"), p) for p in pieces if p not in self.pretokens)
        for (_, piece), ids in zip(fresh, self.trie.encode_sorted(b for b, _ in fresh)):
            self.pretokens[piece] = np.array(ids, dtype="<i8").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian 64-bit integers."""
        if len(self.words) > MEMO or len(self.pretokens) > MEMO:
            self.words, self.pretokens = {}, {}
        # a space may begin a word unless it stands inside a run of white space, which the pattern may keep whole
        split = [
            None if not t else self._split_runs(t) if any(x in t for x in _BEFORE_SPACE) else _split(t) for t in texts
        ]
        new = set()
        for words in split:
            if words:
                new.update(words)
        new.difference_update(self.words)
        found = {w: self.find(w) for w in new}
        self._learn({p for pieces in found.values() for p in pieces})
        pretokens, words = self.pretokens, self.words
        for word, pieces in found.items():
            words[word] = b"".join([pretokens[p] for p in pieces])
        return [b"".join(map(words.__getitem__, w)) if w else b"" for w in split]

    def _split_runs(self, text: str) -> list[str]:
        return self.find(text)


def _split(text: str) -> list[str]:
    """Words with the space before them."""
    return text.replace(" ", "\x00 ").split("\x00") if "\x00" not in text else [text]


@lru_cache(maxsize=2)
def encoder(path: str) -> CorpusEncoder:
    return CorpusEncoder(path)


def _ids(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            coded = enc.encode(batch.column(1).to_pylist())
            offsets = np.zeros(len(coded) + 1, dtype=np.int32)
            np.cumsum([len(c) // 8 for c in coded], out=offsets[1:])
            values = pa.array(np.frombuffer(b"".join(coded), dtype="<i8"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, values)], ["id", "ids"])

    return run


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            counts = [len(c) // 8 for c in enc.encode(batch.column(batch.num_columns - 1).to_pylist())]
            columns = [*batch.columns[:-1], pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "n_tokens"])

    return run


def tokenizer_path(folder: str = TOKENIZER_DIR, name: str = "byte_bpe_50k") -> str:
    return f"{folder}/{name}.json"


def token_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id_col, ids): every row of ``docs`` with the token ids of its text."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(_ids(path or tokenizer_path()), f"id {kind}, ids array<bigint>")
    return out.withColumnRenamed("id", id_col)


def token_counts(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """The rows of ``docs`` with ``n_tokens`` in place of their text."""
    rows = docs.select(*[c for c in docs.columns if c != text_col], text_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_counts(path or tokenizer_path()), f"{fields}{', ' if fields else ''}n_tokens bigint")
