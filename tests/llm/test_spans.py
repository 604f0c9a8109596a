import random

import numpy as np
import pytest
from tests.conftest import rows

from foliomill.llm import spans


def brute(docs, span):
    out = set()
    for i, (a, x) in enumerate(docs):
        for b, y in docs[i + 1 :]:
            if a is None or b is None or a == b or not x or not y:
                continue
            windows = {x[k : k + span] for k in range(len(x) - span + 1)}
            if any(y[k : k + span] in windows for k in range(len(y) - span + 1)):
                out.add((min(a, b), max(a, b)))
    return sorted(out)


def noise(rng, n, letters="abcdefghij klmn"):
    return "".join(rng.choice(letters) for _ in range(n))


def corpus(seed):
    """Texts with planted spans about the limit, runs, copies, very short and very long ones."""
    rng = random.Random(seed)
    docs = [(i, noise(rng, rng.choice([0, 50, 199, 200, 400, 1500]))) for i in range(30)]
    for i in range(30, 60):
        n = rng.choice([150, 198, 199, 200, 201, 230, 320, 600])
        passage = noise(rng, n)
        docs.append((i, noise(rng, rng.randrange(300)) + passage + noise(rng, rng.randrange(300))))
        docs.append((i + 100, noise(rng, rng.randrange(300)) + passage + "Ñ" + noise(rng, rng.randrange(300))))
    docs += [(300, "." * 250 + noise(rng, 100)), (301, noise(rng, 100) + "." * 200), (302, noise(rng, 90) + "." * 199)]
    docs += [(303, "ab " * 100), (304, noise(rng, 30) + "ab " * 80), (305, docs[45][1]), (306, docs[45][1]), (307, "😀é" * 150), (308, "x" + "😀é" * 110)]
    docs += [(None, docs[45][1]), (309, None), (309, "")]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    docs = corpus(seed)
    df = spark.createDataFrame([(i, t, "extra") for i, t in docs], "doc_id bigint, text string, cls string")
    got = rows(spans.shared_span_pairs(df))
    assert got == sorted(brute(docs, 200), key=repr)


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    rng = random.Random(3)
    passage = noise(rng, 230)
    docs = [(1, noise(rng, 3000) + passage + noise(rng, 2000)), (2, noise(rng, 900) + passage), (3, noise(rng, 3000))]
    monkeypatch.setattr(spans, "CHUNK", 1000)
    got = set()
    for i, text in docs:
        for ids, offsets, texts in spans._pieces(__import__("pyarrow").RecordBatch.from_pydict({"c": [i], "t": [text]}), 200):
            which, at, names = spans.blocks(texts, 200)
            got |= {(h, ids[w]) for w, h in zip(which.tolist(), names.tolist())}
    shared = {h for h, i in got if i == 1} & {h for h, i in got if i == 2}
    assert shared and not {h for h, i in got if i == 3} & {h for h, i in got if i == 1}


def test_equal_inside_whatever_is_around():
    rng = random.Random(4)
    for _ in range(50):
        core = noise(rng, 400, "ab.")
        a, b = noise(rng, 77, "ab.") + core + noise(rng, 31), noise(rng, 300) + core + noise(rng, 9, "ab.")
        starts = []
        for text, shift in ((a, 77), (b, 300)):
            codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
            s, _ = spans.rounds(codes, np.array([0]))
            starts.append({x - shift for x in s.tolist() if spans.REACH <= x - shift <= 400 - spans.REACH})
        assert starts[0] == starts[1]


def test_shared_characters(spark):
    rng = random.Random(5)
    p, q = noise(rng, 250), noise(rng, 300)
    docs = [(1, noise(rng, 40) + p + noise(rng, 20) + q), (2, p + "#"), (3, "%" + q), (4, "short"), (5, None), (6, noise(rng, 300)), (7, q + "%"), (8, q + "%")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r[0]: r[2] for r in spans.shared_characters(df).collect()}
    assert got == {1: 550, 2: 250, 3: 300, 4: 0, 5: 0, 6: 0, 7: 301, 8: 301}


@pytest.mark.parametrize("length", [180, 195, 199])
def test_a_formula_below_the_span_gives_no_candidates(spark, length):
    rng = random.Random(6)
    formula = noise(rng, length)
    docs = [(i, noise(rng, 150) + chr(0x4E00 + i) + formula + chr(0x5E00 + i) + noise(rng, 150)) for i in range(1500)]
    passage = noise(rng, 260)
    docs += [(9000, formula + "%" + passage), (9001, passage + "#" + formula)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    # each text's own letters beside the formula keep its windows apart
    members = spans.shared_passages(df)
    assert members.count() <= 4 and rows(spans.shared_span_pairs(df)) == [(9000, 9001)]


def test_members_are_linear_in_a_hot_passage(spark):
    rng = random.Random(7)
    passage = noise(rng, 420)
    docs = [(i, noise(rng, 60) + passage + noise(rng, 60)) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    members = spans.shared_passages(df)
    assert members.count() <= 5 * 400 and spans.shared_span_pairs(df).count() == 400 * 399 // 2
    assert {r[2] for r in spans.shared_characters(df).collect()} <= set(range(420, 430))


def shared_brute(docs, span):
    out = {}
    for i, x in docs:
        hit = bytearray(len(x or ""))
        for j, y in docs:
            if i != j and x and y:
                windows = {y[k : k + span] for k in range(len(y) - span + 1)}
                for k in range(len(x) - span + 1):
                    if x[k : k + span] in windows:
                        hit[k : k + span] = b"\1" * span
        out[i] = sum(hit)
    return out


def test_shared_characters_against_brute_force(spark):
    rng = random.Random(8)
    base = noise(rng, 3000)
    docs = []
    for i in range(25):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            a = rng.randrange(2700)
            parts += [noise(rng, rng.randrange(120)), base[a : a + rng.choice([150, 199, 200, 205, 230, 300, 700])]]
        docs.append((i, "".join(parts)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {r[0]: r[2] for r in spans.shared_characters(df).collect()} == shared_brute(docs, 200)
    assert sorted(rows(spans.shared_span_pairs(df))) == brute(docs, 200)


@pytest.mark.parametrize("span", [116, 140])
def test_other_spans(spark, span):
    rng = random.Random(span)
    base = noise(rng, 900)
    docs = [(i, noise(rng, 70) + base[a : a + span + i - 10] + noise(rng, 70)) for i, a in enumerate([rng.randrange(600) for _ in range(30)])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert sorted(rows(spans.shared_span_pairs(df, span))) == brute(docs, span)
    with pytest.raises(ValueError):
        spans.shared_characters(df, 115)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert rows(spans.shared_span_pairs(df)) == [] and rows(spans.shared_characters(df)) == []
