import os
import random

import numpy as np
import pytest
from tests.conftest import rows

from foliomill.llm import mixing, tokenize

TARGETS = "source string, target_share double, max_repeats int"


def test_flight_keeps_both_sums():
    rng = np.random.default_rng(1)
    pi, x = rng.random(500), rng.integers(1, 4000, 500).astype(float)
    out = mixing.flight(pi, x, 7)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert abs(out.sum() - pi.sum()) < 1e-6 and abs((out * x).sum() - (pi * x).sum()) < 1e-3


def test_flight_on_ties_and_small_groups():
    assert mixing.flight(np.array([]), np.array([]), 1).tolist() == []
    assert mixing.flight(np.array([0.0, 1.0]), np.array([1.0, 1.0]), 1).tolist() == [0.0, 1.0]
    out = mixing.flight(np.full(10, 0.5), np.zeros(10), 1)
    assert abs(out.sum() - 5) < 1e-9 and ((out > 0) & (out < 1)).sum() <= 2


def sizes(spark, seed=1):
    rng = random.Random(seed)
    data = [(i, s, rng.randrange(0, 3000)) for i, s in enumerate(["big"] * 3000 + ["Mid "] * 400 + ["small-one"] * 60 + [None] * 5 + ["other"] * 9)]
    return spark.createDataFrame(data, "id bigint, source string, n_tokens bigint")


@pytest.mark.parametrize("block", [64, 4096])
def test_shares_are_met(spark, block):
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small_one", 0.1, 4), ("absent", 0.1, 2)], TARGETS)
    used = mixing._mixed(sizes(spark), targets, block).collect()
    total = sum(r["copies"] * r["n_tokens"] for r in used)
    share = lambda s: sum(r["copies"] * r["n_tokens"] for r in used if r["source"] == s) / total
    for s, want in (("big", 0.5 / 0.9), ("mid", 0.3 / 0.9), ("small_one", 0.1 / 0.9)):
        assert abs(share(s) - want) < 0.004
    assert max(r["copies"] for r in used if r["source"] == "small_one") <= 4
    assert max(r["copies"] for r in used if r["source"] == "big") == 1
    assert len({r["id"] for r in used}) == len(used)


def test_allotted():
    s = lambda share, most, n: {"target_share": share, "max_repeats": most, "n_tokens": n}
    near = lambda a, b: all(abs(x - y) < 1e-6 * max(1, y) for x, y in zip(a, b)) and len(a) == len(b)
    # every share can be met
    assert near(mixing.allotted([s(0.5, 1, 1000), s(0.5, 2, 400)], None), [800, 800])
    # a source of next to nothing falls short; the mix does not shrink to it
    assert near(mixing.allotted([s(0.95, 1, 2_000_000), s(0.05, 3, 10)], None), [1_000_005 - 30, 30])
    # the others make up in proportion, and no more than they may
    assert near(mixing.allotted([s(0.2, 1, 10), s(0.4, 1, 10_000), s(0.4, 1, 400)], 1000), [10, 590, 400])
    assert near(mixing.allotted([s(0.5, 1, 100), s(0.5, 1, 100)], 1e9), [100, 100])
    assert mixing.allotted([s(0.5, 1, None), s(0.0, 1, 5)], None) == [0, 0] and mixing.allotted([], None) == []


def test_a_nearly_empty_source(spark):
    data = [(i, "big", 1000) for i in range(2000)] + [(9999, "tiny", 10)]
    sizes = spark.createDataFrame(data, "id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("big", 0.95, 1), ("tiny", 0.05, 3)], TARGETS)
    used = mixing._mixed(sizes, targets, 256).collect()
    total = sum(r["copies"] * r["n_tokens"] for r in used)
    assert abs(total - 1_000_005) <= 1000 and [r["copies"] for r in used if r["source"] == "tiny"] == [3]
    half = mixing._mixed(sizes, targets, 256, total=500_000).collect()
    assert abs(sum(r["copies"] * r["n_tokens"] for r in half) - 500_000) <= 1000


def test_odd_targets(spark):
    targets = spark.createDataFrame([("big", None, 1), ("mid", 1.0, None), ("small_one", -1.0, 3)], TARGETS)
    used = mixing._mixed(sizes(spark), targets, 4096)
    assert {r["source"] for r in used.collect()} == {"mid"}
    none = mixing._mixed(sizes(spark).where("id < 0"), targets, 4096)
    assert rows(none) == []


@pytest.mark.skipif(not os.path.exists(tokenize.tokenizer_path()), reason="no vocabulary")
def test_on_texts(spark):
    docs = spark.createDataFrame([(i, "hola mundo " * (i % 5), "a" if i % 2 else "b", 1) for i in range(60)] + [(99, None, "a", 1)], "doc_id bigint, text string, source string, copies int")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 2)], TARGETS)
    report = {r["source"]: r["actual_share"] for r in mixing.shares(docs, targets).collect()}
    assert abs(report["a"] - 0.5) < 0.03 and abs(sum(report.values()) - 1) < 1e-9
    assert mixing.mix(docs, targets).columns == ["doc_id", "source", "n_tokens", "copies"]
