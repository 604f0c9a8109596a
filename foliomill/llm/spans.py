"""Long exact spans shared between records, by recompression.

**Rounds inside texts.** A text is a string of symbols, at first its characters. A round names runs (equal neighbours become
one symbol) and then pairs (a symbol of the left half of the alphabet followed by one of the right half becomes one symbol;
the halves are drawn by a bit of the symbol's name). A name is a hash of what it stands for, so it is the same in every
record of the corpus without a dictionary having to be sent around. Whether two symbols part at a position depends only
on the ``REACH`` characters around it, so equal substrings get equal symbols inside.

**Blocks.** In every window of ``span - CONTEXT + 1`` positions the boundary of least name is chosen; the symbols of the
``CONTEXT`` characters around it make one block, named by what they expand to. A shared span of ``span`` characters holds a
whole window of equal boundaries in both records, so it holds a common block: no shared span goes without one.

**Rounds over the corpus.** Spark compares the names of all blocks and keeps those that stand in two different texts; the
others can be no part of a shared span. Then, round by round, neighbouring kept symbols that touch or overlap are named as
pairs, which expand to more characters, the names are compared over the whole corpus, and those of one text only are
dropped. A symbol that expands to ``span`` characters or more and stands in two texts is a long repeat.

**The rest.** A block is settled where a long repeat around it stands in exactly the same texts. Around the blocks that
are not, each window of ``span`` characters is named by 128 bits and the names are compared over the corpus. Names of
windows or long repeats that stand in the same set of texts are one passage. At the end the passages are grouped by their
own characters, so a name that two different strings should have in common links nothing.

Nothing is ever listed pair by pair before that: the operators' result is (passage, member), linear in what is shared
(``shared_passages``); a formula shorter than ``span`` in many records gives block names and windows, but no pairs. Pairs
are expanded where they are asked for (``shared_span_pairs``), as class pairs and then as record pairs.

Equal texts are one class (128 bits over the text). Within a task a name met in two texts is sent to its bucket once, with
its places beside it, so that a block that stands in a third of all records weighs no more there than in a few.

Defined results: texts are compared as stored, in code points. Null texts and texts shorter than ``span`` share nothing;
equal texts of at least ``span`` characters are a pair; ids that are null are left out; of rows with the same id and text
one counts. Extra columns are ignored, and an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliomill.runtime import materialize, shuffle_partitions

CONTEXT = 100  # characters of one block
ROUNDS = ((4, True), (6, True), (9, False), (12, False), (16, False))  # (longest symbol made, whether runs are named too)
CORPUS_ROUNDS = 3  # rounds over the corpus: symbols of two, three and four blocks
CHUNK = 1 << 19  # characters worked on at once
FLUSH = 1 << 19  # blocks held before they are sent off
BUCKET_BYTES = 4 << 20  # input bytes for each hash bucket
BLOOM_BITS = 1 << 24  # 2 MB at most, whatever the corpus; fuller only means that more texts travel
_BLOCK = np.dtype([("hash", "<u8"), ("cls", "<i8"), ("pos", "<i4")])
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_LEFT = np.uint64(0xC2B2AE3D27D4EB4F)
_RIGHT = np.uint64(0x27D4EB2F165667C5)


def _reach() -> int:
    """How far from a boundary the characters stand that decide it: each stage moves the edge by one symbol it may meet."""
    out, before = 0, 1
    for cap, runs in ROUNDS:
        out += 2 * cap if runs else before
        before = cap
    return out


REACH = _reach()
assert REACH < CONTEXT // 2


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor, shift, multiply)."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def _name_pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mix(a * np.uint64(0xD6E8FEB86659FD93) + b)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, CHUNK + 4096)
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            cls.up, cls.down = (np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size, b))]) for b in (_BASE, inverse))
        return cls.up, cls.down


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _sums(codes: np.ndarray, factor: np.uint64) -> np.ndarray:
    """Sums from which the name of any stretch follows: the name of a pair is that of its halves put together."""
    _, down = _Powers.get(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(_mix(codes.astype(np.uint64) * factor) * down[: len(codes)], out=sums[1:])
    return sums


def rounds(codes: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, names) of the symbols of ``codes`` after all rounds; no symbol spans one of the ``cuts``."""
    names = _mix((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9FB21C651E98DF25))
    starts = np.arange(len(codes), dtype=np.int32)
    fence = np.zeros(len(codes) + 1, dtype=bool)
    fence[cuts] = True
    for level, (cap, runs) in enumerate(ROUNDS):
        if runs:
            starts, names = _runs(starts, names, fence, len(codes), cap)
        starts, names = _pairs(starts, names, fence, len(codes), cap, level)
    return starts, names


def _runs(starts, names, fence, end, cap):
    same = (names[1:] == names[:-1]) & ~fence[starts[1:]]
    if not same.any():
        return starts, names
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    length = np.diff(np.append(starts[first], end))
    count = np.diff(np.append(first, len(starts)))
    fits = (count > 1) & (length <= cap)  # longer runs stay apart, so that what decides a boundary stays near it
    keep = np.ones(len(starts), dtype=bool)
    keep[1:][same & np.repeat(fits, count)[1:]] = False
    names = names.copy()
    heads = first[fits]
    names[heads] = _name_pair(names[heads], count[fits].astype(np.uint64))
    return starts[keep], names[keep]


def _pairs(starts, names, fence, end, cap, level):
    left = ((names >> np.uint64(7 + level)) & np.uint64(1)).astype(bool)
    at = np.flatnonzero(left[:-1] & ~left[1:])
    far = starts[np.minimum(at + 2, len(starts) - 1)]
    far[at + 2 >= len(starts)] = end
    at = at[~fence[starts[at + 1]] & (far - starts[at] <= cap)]
    names[at] = _name_pair(names[at], names[at + 1])
    keep = np.ones(len(starts), dtype=bool)
    keep[at + 1] = False
    return starts[keep], names[keep]


def _window_minima(keys: np.ndarray, w: int) -> np.ndarray:
    """The least key of each window of ``w`` (van Herk and Gil-Werman: one pass each way over blocks of ``w``)."""
    n = len(keys)
    block = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    block[:n] = keys
    block = block.reshape(-1, w)
    ahead = np.minimum.accumulate(block, axis=1).reshape(-1)
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


def blocks(texts: list[str], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the text, position, name) of all blocks of the texts, in order; a block reaches half of CONTEXT each way."""
    half, w = CONTEXT // 2, span - CONTEXT + 1
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    codes = _codes("".join(texts))
    ends = np.cumsum(lengths)
    begins = ends - lengths
    n = len(codes)
    if n < span:
        return none
    starts, names = rounds(codes, begins[lengths > 0])
    keys = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    around = _name_pair(names[:-1], names[1:])
    keys[starts[1:]] = (around & np.uint64(0xFFFFFFFF00000000)) | starts[1:].astype(np.uint64)
    least = _window_minima(keys, w)
    # windows whose blocks all lie inside one text start at begin + half ... end - half - w + 1
    delta = np.zeros(n + 1, dtype=np.int32)
    ok = lengths >= span
    np.add.at(delta, begins[ok] + half, 1)
    np.add.at(delta, ends[ok] - half - w + 2, -1)
    at = least[np.cumsum(delta[: len(least)]) > 0]
    if not len(at):
        return none
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]
    at = np.unique((at & np.uint64(0xFFFFFFFF)).astype(np.int64))
    up, _ = _Powers.get(n + 1)
    sums = _sums(codes, _LEFT)
    name = _mix((sums[at + half] - sums[at - half]) * up[at - half])
    which = np.searchsorted(ends, at, side="right")
    return which, at - begins[which], name


def _pieces(batch: pa.RecordBatch, span: int) -> Iterator[tuple[list[int], list[int], list[str]]]:
    """Groups of (class, offset, text) of about CHUNK characters; a longer text comes in overlapping pieces."""
    ids, offsets, texts, total = [], [], [], 0
    for cls, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        for begin in range(0, max(1, len(text) - 2 * span), CHUNK):
            piece = text if len(text) <= CHUNK else text[begin : begin + CHUNK + 2 * span]
            ids.append(cls)
            offsets.append(begin)
            texts.append(piece)
            total += len(piece)
            if total >= CHUNK:
                yield ids, offsets, texts
                ids, offsets, texts, total = [], [], [], 0
            if len(text) <= CHUNK:
                break
    if texts:
        yield ids, offsets, texts


def _sorted_blocks(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows by name, each once, and whether each one's name stands in two texts or is marked as such (pos -1)."""
    rows = rows[np.lexsort((rows["pos"], rows["cls"], rows["hash"]))]
    if not len(rows):
        return rows, np.zeros(0, dtype=bool)
    rows = rows[np.concatenate([[True], rows[1:] != rows[:-1]])]
    head = np.concatenate([[True], rows["hash"][1:] != rows["hash"][:-1]])
    other = np.zeros(len(rows), dtype=bool)
    other[1:] = ~head[1:] & (rows["cls"][1:] != rows["cls"][:-1])
    group = np.cumsum(head) - 1
    shared = np.zeros(group[-1] + 1, dtype=bool)
    shared[group[other | (rows["pos"] < 0)]] = True
    return rows, shared[group]


_PACKED = "bucket int, known boolean, rows binary"


def _pack(span: int, buckets: int):
    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        rows, known = _sorted_blocks(np.concatenate(held))
        # a name that two texts of this task hold needs no other proof: its places go along, its bucket hears of it once
        told = rows[known]
        marks = told[np.concatenate([[True], told["hash"][1:] != told["hash"][:-1]])].copy() if len(told) else told.copy()
        marks["cls"], marks["pos"] = 0, -1
        ask = np.concatenate([rows[~known], marks])
        bucket = ((ask["hash"] >> np.uint64(17)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        ask, bucket = ask[order], bucket[order]
        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(ask) else np.empty(0, np.int64)
        parts = [ask[a:b].tobytes() for a, b in zip(cut, [*cut[1:], len(ask)])]
        numbers, flags = bucket[cut].tolist(), [False] * len(parts)
        for i in range(0, len(told), 1 << 14):  # spread by content, so that a task that is run again sends the same
            parts.append(told[i : i + (1 << 14)].tobytes())
            numbers.append(int((told["hash"][i] ^ told["cls"][i].astype(np.uint64)) % np.uint64(buckets)))
            flags.append(True)
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array(flags, pa.bool_()), pa.array(parts, pa.binary())], ["bucket", "known", "rows"]
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for ids, offsets, texts in _pieces(batch, span):
                which, at, name = blocks(texts, span)
                rows = np.empty(len(at), dtype=_BLOCK)
                rows["hash"] = name
                rows["cls"] = np.asarray(ids, dtype=np.int64)[which]
                rows["pos"] = at + np.asarray(offsets, dtype=np.int64)[which]
                held.append(rows)
                size += len(rows)
                if size >= FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    return pack


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, pos, name) of the blocks whose names stand in two texts, bucket by bucket (the partition is sorted by bucket)."""

    def out(rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(rows["cls"]), pa.array(rows["pos"]), pa.array(rows["hash"].view(np.int64))], ["cls", "pos", "name"]
        )

    def close(held: list[np.ndarray]) -> pa.RecordBatch:
        rows, shared = _sorted_blocks(np.concatenate(held))
        return out(rows[shared & (rows["pos"] >= 0)])

    now, held = None, []
    for batch in batches:
        for bucket, known, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            rows = np.frombuffer(blob.as_buffer(), dtype=_BLOCK)
            if known:
                yield out(rows.copy())
                continue
            if bucket != now and held:
                yield close(held)
                held = []
            now = bucket
            held.append(rows.copy())
    if held:
        yield close(held)


def _classes(docs: DataFrame, id_col: str, text_col: str, span: int) -> DataFrame:
    """(id, cls, cls2, text): ``cls`` leads to candidates only, what links records is all 128 bits or the characters."""
    text = F.col(text_col)
    rows = docs.where(text.isNotNull() & (F.length(text) >= span))
    return rows.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("cls"), F.xxhash64(F.lit("second"), text).alias("cls2"), text.alias("text")
    )


def shared_blocks(classes: DataFrame, span: int) -> DataFrame:
    """(cls, pos, name) of all blocks that stand in two different texts of ``classes`` (cls, text)."""
    spark = classes.sparkSession
    parts = shuffle_partitions(spark)
    size = int(str(classes._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    buckets = int(min(max(parts, size // BUCKET_BYTES), 1 << 20))
    packed = classes.select("cls", "text").mapInArrow(_pack(span, buckets), _PACKED)
    # buckets are dealt out in turn: their hashes would leave some tasks with many of them
    dealt = packed.repartitionById(parts, F.pmod("bucket", F.lit(parts)).cast("int")).sortWithinPartitions("bucket")
    found = dealt.mapInArrow(_compare, "cls long, pos int, name long")
    return materialize(found.distinct(), "span-blocks")


def _sets(rows: DataFrame, *name: str) -> DataFrame:
    """(*name, n, x, y) of the names that stand in two texts: how many, and 128 bits over which ones."""
    each = rows.select(*name, "cls").distinct()
    sums = each.groupBy(*name).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64(F.lit("y"), "cls")).alias("y")
    )
    return sums.where("n > 1")


def long_repeats(found: DataFrame, span: int) -> tuple[DataFrame, DataFrame]:
    """(repeats, places): the symbols (cls, start, len, name, n, x, y) of at least ``span`` characters that stand in two texts,
    and the blocks (cls, pos, lo, hi) with the stretch of the repeats that settle them, null where none does."""
    half = CONTEXT // 2
    level = found.select("cls", (F.col("pos") - half).alias("start"), F.lit(CONTEXT).alias("len"), "name")
    base = materialize(level.join(_sets(level, "name"), "name"), "span-symbols")
    level, repeats = base.select("cls", "start", "len", "name"), None
    for _ in range(CORPUS_ROUNDS):
        after = F.lead(F.struct("start", "len", "name")).over(Window.partitionBy("cls").orderBy("start", "name"))
        pairs = level.withColumn("after", after).where("after is not null and after.start <= start + len")
        step = F.col("after.start") - F.col("start")
        pairs = pairs.select(
            "cls", "start", (step + F.col("after.len")).alias("len"), F.xxhash64("name", step, "after.name").alias("name")
        )
        pairs = materialize(pairs.join(_sets(pairs, "name"), "name"), "span-symbols")
        long = pairs.where(F.col("len") >= span)
        repeats = long if repeats is None else repeats.unionByName(long)
        level = pairs.select("cls", "start", "len", "name").where(F.col("len") < span)
    repeats = materialize(repeats.select("cls", "start", "len", "name", "n", "x", "y"), "span-repeats")
    # a block is settled by a repeat that begins or ends with it and stands in the same texts
    end = F.col("start") + F.col("len")
    side = lambda at: repeats.select("cls", "n", "x", "y", at.alias("start"), F.col("start").alias("lo"), end.alias("hi"))
    settled = side(F.col("start")).unionByName(side(end - CONTEXT)).groupBy("cls", "start", "n", "x", "y").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    places = base.join(settled, ["cls", "start", "n", "x", "y"], "left").select("cls", (F.col("start") + half).alias("pos"), "lo", "hi")
    return repeats, places


def _texts_of(wanted: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, cls2, text) of the classes in ``wanted`` (cls); of the others only the few that share a bit with one leave the scan."""
    slot = F.pmod(F.xxhash64("cls"), F.lit(BLOOM_BITS))
    bits = (
        wanted.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit"))
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    byte = F.conv(F.hex(F.expr("substring(bits, cast(place div 8 as int) + 1, 1)")), 16, 10).cast("long")
    texts = (
        classes.withColumn("bucket", F.bitmap_bucket_number(slot))
        .withColumn("place", F.bitmap_bit_position(slot))
        .join(F.broadcast(bits), "bucket")  # at most 513 rows of 4 kB
        .where(F.getbit(byte, F.expr("cast(place % 8 as int)")) == 1)
        .select("cls", "cls2", "text")
    )
    # classes that only share a bit stay in: a semi join here would be moved below the bitmap and shuffle every text
    return materialize(texts.groupBy("cls", "cls2").agg(F.first("text").alias("text")), "span-texts")


def _windows(span: int):
    """(cls, start, w1, w2) of each window around the places given with each text, but for what settles a place.

    A place is the same in every text that holds its block, and so is the stretch that settles it: what one text leaves
    out, the others leave out too.
    """

    def starts(pos: np.ndarray, lo: np.ndarray, hi: np.ndarray, n: int) -> np.ndarray:
        half = CONTEXT // 2
        first, last = pos + half - span, pos - half
        whole = hi - lo < span
        lo, hi = np.where(whole, last + 1, lo), np.where(whole, last + 1, hi - span + 1)
        mark = np.zeros(n + 2, dtype=np.int64)
        for begin, end in ((first, np.minimum(last + 1, lo)), (np.maximum(first, hi), last + 1)):
            begin, end = np.clip(begin, 0, n), np.clip(end, 0, n)
            ok = begin < end
            np.add.at(mark, begin[ok], 1)
            np.add.at(mark, end[ok], -1)
        return np.flatnonzero(np.cumsum(mark)[: max(0, n - span + 1)] > 0)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
            total = 0
            at = batch.column("at")
            cut = at.offsets.to_numpy()
            pos, lo, hi = (pc.fill_null(at.values.field(c), 0).to_numpy().astype(np.int64) for c in ("pos", "lo", "hi"))
            for i, (cls, text) in enumerate(zip(batch.column("cls").to_pylist(), batch.column("text"))):
                text, here = text.as_py(), slice(cut[i], cut[i + 1])
                start = starts(pos[here], lo[here], hi[here], len(text))
                if not len(start):
                    continue
                codes = _codes(text)
                up, _ = _Powers.get(len(codes) + 1)
                sums = _sums(codes, _LEFT), _sums(codes, _RIGHT)
                held.append((cls, start.astype(np.int32), *[_mix((s[start + span] - s[start]) * up[start]).view(np.int64) for s in sums]))
                total += len(start)
                if total > 1 << 18:
                    yield _window_rows(held)
                    held, total = [], 0
            if held:
                yield _window_rows(held)

    return windows


def _window_rows(held) -> pa.RecordBatch:
    cls = np.repeat(np.array([h[0] for h in held], dtype=np.int64), [len(h[1]) for h in held])
    rest = [np.concatenate([h[i] for h in held]) for i in (1, 2, 3)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (cls, *rest)], ["cls", "start", "w1", "w2"])


_WINDOW = "cls long, start int, w1 long, w2 long"


def _windows_of(places: DataFrame, texts: DataFrame, span: int) -> DataFrame:
    """The windows of ``span`` characters around ``places`` (cls, pos, lo, hi)."""
    # a text's places are fewer than its characters, so a row stays in proportion to its text
    at = places.groupBy("cls").agg(F.collect_set(F.struct("pos", "lo", "hi")).alias("at"))
    return texts.join(at, "cls").select("cls", "text", "at").mapInArrow(_windows(span), _WINDOW)


def _members(docs: DataFrame, classes: DataFrame, span: int) -> tuple[DataFrame, DataFrame]:
    found = shared_blocks(classes, span)
    repeats, places = long_repeats(found, span)
    texts = _texts_of(found.select("cls"), classes)
    windows = _windows_of(places.where("lo is null"), texts, span)
    # the first place of each window in each text
    windows = windows.groupBy("w1", "w2", "cls").agg(F.min("start").alias("start"))
    windows = materialize(windows, "span-windows")
    sets = _sets(windows, "w1", "w2").groupBy("n", "x", "y").agg(F.min(F.struct("w1", "w2")).alias("w")).select("w.w1", "w.w2")
    by_window = windows.join(sets, ["w1", "w2"]).select("cls", "start")
    names = repeats.groupBy("n", "x", "y").agg(F.min("name").alias("name")).select("name")
    by_repeat = repeats.join(names, "name").groupBy("name", "cls").agg(F.min("start").alias("start")).select("cls", "start")
    held = by_window.unionByName(by_repeat).distinct()
    # the passage is the characters themselves: two places are linked only if these are equal
    passage = F.expr(f"substring(text, start + 1, {span})")
    out = held.join(texts, "cls").select(passage.alias("passage"), "cls", "cls2", "start").where(F.length("passage") == span)
    return materialize(out.dropDuplicates(["passage", "cls", "cls2"]), "span-members"), texts


def shared_passages(docs: DataFrame, span: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(passage, cls, cls2, start): the texts that hold a passage of ``span`` characters, once for each set of texts that
    share one; any two texts with a span in common stand under one passage. ``cls`` and ``cls2`` name the text."""
    check(span)
    return _members(docs, _classes(docs, id_col, text_col, span), span)[0]


def check(span: int) -> None:
    least = CONTEXT + ROUNDS[-1][0]  # so that every window holds the end of a symbol
    if span < least:
        raise ValueError(f"span must be at least {least}")


def shared_span_pairs(docs: DataFrame, span: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_a, id_b), id_a < id_b, of all records that have ``span`` consecutive characters in common."""
    check(span)
    classes = _classes(docs, id_col, text_col, span)
    members, _ = _members(docs, classes, span)
    sides = members.select(F.col("passage"), F.struct("cls", "cls2").alias("c"))
    pairs = sides.withColumnRenamed("c", "c_a").join(sides.withColumnRenamed("c", "c_b"), "passage").where("c_a < c_b")
    pairs = materialize(pairs.select("c_a", "c_b").distinct(), "span-pairs")
    ids = materialize(classes.select("id", F.struct("cls", "cls2").alias("c")).where("id is not null").distinct(), "span-ids")
    a, b = ids.toDF("a", "c_a"), ids.toDF("b", "c_b")
    across = pairs.join(a, "c_a").join(b, "c_b").where("a <> b")
    across = across.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"))
    copied = ids.join(ids.groupBy("c").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("c"), "c")
    within = copied.alias("x").join(copied.alias("y"), "c").where("x.id < y.id")
    return across.unionAll(within.select(F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b"))).distinct()


def shared_characters(docs: DataFrame, span: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_chars, shared_chars): for every row, how many of its characters lie in spans that stand in another record.

    Null texts have null and 0. A text that another record holds word for word is shared as a whole from ``span`` on. No pair
    is formed: long repeats cover what they expand to, and of the windows around shared blocks only those are compared that
    stick out of it.
    """
    check(span)
    classes = _classes(docs, id_col, text_col, span)
    found = shared_blocks(classes, span)
    repeats, places = long_repeats(found, span)
    texts = _texts_of(found.select("cls"), classes)
    windows = materialize(_windows_of(places, texts, span), "span-windows")
    shared = windows.groupBy("w1", "w2").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi").select("w1", "w2")
    hits = windows.join(shared, ["w1", "w2"], "left_semi").select("cls", "start", (F.col("start") + span).alias("end"))
    stretches = hits.unionAll(repeats.select("cls", "start", (F.col("start") + F.col("len")).alias("end"))).distinct()
    # stretches are merged in order: each adds what lies beyond the furthest end before it
    order = Window.partitionBy("cls").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.withColumn("far", F.coalesce(F.max("end").over(order), F.lit(0)))
    sums = stretches.groupBy("cls").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "far"))).alias("part"))
    text = F.col(text_col)
    key = [F.xxhash64(text).alias("cls"), F.xxhash64(F.lit("second"), text).alias("cls2")]
    rows = docs.select(F.col(id_col), F.length(text).cast("bigint").alias("n_chars"), *key, (text.isNotNull() & (F.length(text) >= span)).alias("long"))
    copies = rows.where("long").groupBy("cls", "cls2").agg(F.count_distinct(id_col).alias("n")).where("n > 1").select("cls", "cls2", F.lit(True).alias("copied"))
    rows = rows.join(copies, ["cls", "cls2"], "left").join(sums, "cls", "left")
    shared = F.when(F.col("copied") & F.col("long"), F.col("n_chars")).when(F.col("long"), F.col("part"))
    return rows.select(id_col, "n_chars", F.coalesce(shared, F.lit(0)).cast("bigint").alias("shared_chars"))
