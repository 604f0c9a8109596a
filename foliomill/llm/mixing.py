"""Mixes sources to target shares of all tokens by balanced sampling (the cube method).

The total of the mix is a parameter. Where it is not given, it is the largest for which every source can give its share, but
not less than ``LEAST_PART`` of the tokens there are: a source that has next to nothing falls short of its share and does not
shrink the mix. A source whose tokens, repeated at most ``max_repeats`` times, do not reach its share gives all it may, and
the others make up for it in proportion to their shares, as far as they can. A source then needs each of its records ``r``
times on average. Every record is used floor(r) times; the fraction left is an inclusion probability. The flight phase of the cube method moves these
probabilities through the null space of the constraints (tokens and number of records), two records that matter and one to
spare at a time, until each is 0 or 1 but for at most two in a block: the expected totals are kept exactly on the way.

Blocks hold ``BLOCK`` records of one source, however large the source is, and fly in parallel; what stays open in them
forms new blocks, level by level, until one block for each source is left. Its at most two open records are landed on the
side that leaves the token total nearest its target.

Defined results: records are matched to a source by its name without surrounding white space, in lower case, with ``-`` as
``_``. Records of no target source, null sources included, are not used. Null and empty texts have no tokens; they are
given like others, as copies cost nothing. A source without tokens gives nothing; the shares of the rest are kept in
proportion. Null or negative shares count as 0, null repeats as 1. Empty tables give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.llm.tokenize import token_counts
from foliomill.runtime import materialize

BLOCK = 4096
LEAST_PART = 0.5


def source_key(col: Column) -> Column:
    return F.translate(F.lower(F.trim(col)), "-", "_")


def flight(pi: np.ndarray, x: np.ndarray, seed: int) -> np.ndarray:
    """Inclusion probabilities moved to 0 or 1 but for at most two; sums of ``pi`` and of ``pi * x`` are kept.

    Three open units have a direction that changes neither sum: (x2-x3, x3-x1, x1-x2). The walk goes along it as far as
    the first unit that gets decided, to either side by chance such that no probability changes in expectation.
    """
    rng = np.random.default_rng(seed)
    out = pi.copy()
    eps = 1e-9
    todo = [i for i in np.flatnonzero((pi > eps) & (pi < 1 - eps)).tolist()]
    coins = rng.random(len(todo) + 8)
    open_units: list[int] = []
    p, xs, flip = out.tolist(), x.tolist(), 0
    while True:
        while len(open_units) < 3 and todo:
            open_units.append(todo.pop())
        if len(open_units) < 3:
            break
        a, b, c = open_units
        d = (xs[b] - xs[c], xs[c] - xs[a], xs[a] - xs[b])
        if d == (0.0, 0.0, 0.0):
            d = (1.0, -1.0, 0.0)
        up = down = math.inf
        for i, v in zip(open_units, d):
            if v > 0:
                up, down = min(up, (1 - p[i]) / v), min(down, p[i] / v)
            elif v < 0:
                up, down = min(up, p[i] / -v), min(down, (1 - p[i]) / -v)
        step = up if coins[flip % len(coins)] * (up + down) < down else -down
        flip += 1
        for i, v in zip(open_units, d):
            p[i] += step * v
            if p[i] < eps:
                p[i] = 0.0
            elif p[i] > 1 - eps:
                p[i] = 1.0
        open_units = [i for i in open_units if 0.0 < p[i] < 1.0]
    return np.array(p)


def _fly(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["id", "n_tokens", "part"], kind="stable", na_position="first").reset_index(drop=True)
    seed = (len(rows) * 1_000_003 + int(rows["n_tokens"].sum())) % (1 << 32)
    rows["pi"] = flight(rows["pi"].to_numpy(float), rows["n_tokens"].to_numpy(float), seed)
    return rows


def _land(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Fly once more, then decide the open rest so that the token total comes nearest its target."""
    goal = float((rows["pi"] * rows["n_tokens"]).sum())
    rows = _fly(key, rows)
    pi, x = rows["pi"].to_numpy(float).copy(), rows["n_tokens"].to_numpy(float)
    still = np.flatnonzero((pi > 0) & (pi < 1))
    best = None
    for choice in range(1 << len(still)):
        bits = np.array([(choice >> i) & 1 for i in range(len(still))], dtype=float)
        trial = pi.copy()
        trial[still] = bits
        miss = (abs(float((trial * x).sum()) - goal), choice)
        if best is None or miss < best[0]:
            best = (miss, trial)
    rows["pi"] = best[1]
    return rows


def sized(docs: DataFrame, path: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """(id, source, n_tokens) of every record, written once: counting tokens is the dear part."""
    rows = docs.select(F.col(id_col).alias("id"), F.col("source").alias("source"), F.col("text").alias("text"))
    return materialize(token_counts(rows, "text", path), "mix-sizes")


def targets_of(targets: DataFrame) -> DataFrame:
    return targets.groupBy(source_key(F.col("source")).alias("key")).agg(
        F.max(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))).alias("target_share"),
        F.max(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0))).alias("max_repeats"),
    )


def allotted(sources: list[dict], total: float | None) -> list[float]:
    """How many tokens each of ``sources`` (target_share, max_repeats, n_tokens) gives to a mix of ``total``."""
    able = [i for i, s in enumerate(sources) if s["n_tokens"] and s["target_share"] > 0 and s["max_repeats"] > 0]
    most = {i: float(sources[i]["max_repeats"] * sources[i]["n_tokens"]) for i in able}
    out = [0.0] * len(sources)
    if total is None and able:
        share = sum(sources[i]["target_share"] for i in able)
        met = min(most[i] * share / sources[i]["target_share"] for i in able)
        total = max(met, LEAST_PART * sum(sources[i]["n_tokens"] for i in able))
    left = min(float(total or 0.0), sum(most.values()))
    while able:
        share = sum(sources[i]["target_share"] for i in able)
        short = [i for i in able if left * sources[i]["target_share"] / share >= most[i]]
        for i in short or able:
            out[i] = most[i] if short else left * sources[i]["target_share"] / share
        if not short:
            break
        left -= sum(most[i] for i in short)
        able = [i for i in able if i not in short]
    return out


def plan(sizes: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """(key, target_share, max_repeats, n_docs, n_tokens, uses): how often a record of each source is used on average."""
    held = sizes.groupBy(source_key(F.col("source")).alias("key")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
    )
    rows = targets_of(targets).join(held, "key", "left").select("key", "target_share", "max_repeats", "n_docs", "n_tokens")
    sources = [r.asDict() for r in rows.collect()]  # a row for each target source: a parameter of fixed size
    given = allotted(sources, total)
    planned = [(*s.values(), g / s["n_tokens"] if g else 0.0) for s, g in zip(sources, given)]
    return sizes.sparkSession.createDataFrame(planned, "key string, target_share double, max_repeats int, n_docs bigint, n_tokens bigint, uses double")


def mix(
    docs: DataFrame, targets: DataFrame, path: str | None = None, block: int = BLOCK, id_col: str = "doc_id", total: float | None = None
) -> DataFrame:
    """(id_col, source, n_tokens, copies): each record that the mix of ``total`` tokens uses, and how many times."""
    return _mixed(sized(docs, path, id_col), targets, block, total).withColumnRenamed("id", id_col)


def _mixed(sizes: DataFrame, targets: DataFrame, block: int, total: float | None = None) -> DataFrame:
    planned = plan(sizes, targets, total)
    # a row for each target source: the targets are a parameter of fixed size
    rows = sizes.withColumn("key", source_key(F.col("source"))).join(F.broadcast(planned.select("key", "uses", "n_docs")), "key")
    rows = rows.where("uses > 0").select(
        "key",
        "id",
        "n_tokens",
        F.floor("uses").cast("int").alias("sure"),
        (F.col("uses") - F.floor("uses")).alias("pi"),
        F.monotonically_increasing_id().alias("part"),
        F.col("n_docs"),
    )
    rows = rows.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("n_docs") / block)))
    rows = rows.drop("n_docs")
    schema = "key string, id bigint, n_tokens bigint, sure int, pi double, part bigint, blocks bigint, block bigint"
    done = None
    largest = planned.agg(F.max("n_docs")).first()[0] or 0
    kind = dict(sizes.dtypes)["id"]
    schema = schema.replace("id bigint", f"id {kind}", 1)
    while True:
        last = largest <= block
        rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "n_tokens", "blocks"), F.col("blocks")))
        step = rows.groupBy("key", "block").applyInPandas(_land if last else _fly, schema)
        step = materialize(step, "mix-level")
        closed = step.where("pi = 0 or pi = 1")
        done = closed if done is None else done.unionAll(closed)
        if last:
            break
        # at most two of each block stay open
        largest = math.ceil(largest / block) * 2
        rows = step.where("pi > 0 and pi < 1").drop("block")
        rows = rows.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("blocks") * 2 / block)).cast("bigint"))
    used = done.select("id", F.col("key").alias("source"), "n_tokens", (F.col("sure") + F.col("pi")).cast("bigint").alias("copies"))
    return used.where("copies > 0")


def shares(
    docs: DataFrame, targets: DataFrame, path: str | None = None, block: int = BLOCK, id_col: str = "doc_id", total: float | None = None
) -> DataFrame:
    """(source, target_share, actual_share, n_docs, n_copies, n_tokens, greatest_repeat) of each target source."""
    used = _mixed(sized(docs, path, id_col), targets, block, total)
    sums = used.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("copies").alias("n_copies"),
        F.sum(F.col("copies") * F.col("n_tokens")).alias("n_tokens"),
        F.max("copies").alias("greatest_repeat"),
    )
    whole = sums.agg(F.sum("n_tokens").alias("total"))
    rows = targets_of(targets).withColumnRenamed("key", "source").join(sums, "source", "left").crossJoin(F.broadcast(whole))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    share = F.coalesce(F.try_divide("n_tokens", "total"), F.lit(0.0))
    return rows.select(
        "source", "target_share", share.alias("actual_share"), zero("n_docs"), zero("n_copies"), zero("n_tokens"), zero("greatest_repeat")
    )
