"""Orders by range against orders in one place."""

import random

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows

from foliomill.operators import ranges, sequence

SCHEMA = "g string, v double, w bigint"


def data(n, seed=1):
    rng = random.Random(seed)
    return [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, 1.0, 2.5, rng.random()]), rng.randrange(5)) for _ in range(n)]


def test_placed_within(spark):
    values = data(300)
    got = ranges.placed_within(spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i bigint, " + SCHEMA), ["g"], F.asc("i"), value=F.col("w")).collect()
    want, place, before = {}, {}, {}
    for i, (g, _, w) in enumerate(values):
        place[g] = place.get(g, 0) + 1
        want[i] = (place[g], before.get(g, 0))
        before[g] = before.get(g, 0) + w
    assert {r["i"]: (r["place"], r["before"]) for r in got} == want and len(got) == 300


@pytest.mark.parametrize("n", [0, 1, 7, 400])
def test_percentiles(spark, n):
    values = data(n, n)
    df = spark.createDataFrame(values, SCHEMA)
    got = {r["g"]: r for r in ranges.percentiles(df, ["g"], "v", lin=("linear", 0.3), low=("floor", 0.9), near=("rounded", 0.5)).collect()}
    groups = {}
    for g, v, _ in values:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, xs in groups.items():
        xs.sort()
        at = 0.3 * (len(xs) - 1)
        linear = xs[int(at)] + (xs[min(int(at) + 1, len(xs) - 1)] - xs[int(at)]) * (at - int(at))
        assert abs(got[g]["lin"] - linear) < 1e-9 and got[g]["low"] == xs[int(0.9 * (len(xs) - 1))] and got[g]["near"] == xs[round(0.5 * (len(xs) - 1))]


@pytest.mark.parametrize("chunk", [16, 4096])
def test_pack_in_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(sequence, "PACK_CHUNK", chunk)
    rng = random.Random(3)
    values = [(rng.choice(["a", "a", "a", "b", None]), i, rng.choice([None, 0, 1, 5, 40, 99, 120])) for i in range(400)]
    got = rows(sequence.pack(spark.createDataFrame(values, "g string, i bigint, c bigint"), "g", "i", "c", 100, 5))
    want, state = [], {}
    for g, i, c in values:
        batch, total, n = state.get(g, (0, 0, 0))
        if n and (total + (c or 0) > 100 or n >= 5):
            batch, total, n = batch + 1, 0, 0
        state[g] = (batch, total + (c or 0), n + 1)
        want.append((g, i, c, batch))
    assert sorted(((r[0], r[1], r[3]) for r in got), key=repr) == sorted(((g, i, b) for g, i, _, b in want), key=repr)


def test_attach_joins_nulls(spark):
    a = spark.createDataFrame([("x", 1), (None, 2), ("y", 3)], "g string, i int")
    b = spark.createDataFrame([("x", "p"), (None, "q")], "g string, t string")
    assert rows(ranges.attach(a, b, ["g"], "left")) == sorted([("x", 1, "p"), (None, 2, "q"), ("y", 3, None)], key=repr)
