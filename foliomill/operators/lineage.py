"""Directed graphs kept as edges: closure to a fixpoint, cycles, degrees, differences."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.runtime import materialize


def closure(edges: DataFrame) -> DataFrame:
    """(src, dst, depth): shortest depth of every pair joined by a path of at least one edge.

    Each turn joins the newest pairs with the edges and keeps what is new, so cycles end by themselves, and long
    chains take as many turns as they have edges. A turn is written to the shared folder, and now and then all that is
    reached: plans stay short and a lost executor repeats one turn at most.
    """
    step = edges.select("src", "dst").where("src is not null and dst is not null").distinct()
    step = materialize(step, "edges")
    reached = materialize(step.withColumn("depth", F.lit(1)), "closure")
    newest = reached
    for depth in count(2):
        grown = newest.select("src", F.col("dst").alias("via")).join(step.toDF("via", "dst"), "via").select("src", "dst").distinct()
        grown = grown.join(reached.select("src", "dst"), ["src", "dst"], "left_anti").withColumn("depth", F.lit(depth))
        newest = materialize(grown, "closure")
        if newest.isEmpty():
            break
        reached = reached.unionAll(newest)
        if depth % 16 == 0:
            reached = materialize(reached, "closure")
    return reached


def without_cycles(old: DataFrame, new: DataFrame) -> DataFrame:
    """(src, dst, accepted) of the ``new`` edges: those that would close a cycle, alone or with one another, are rejected.

    ``old`` has no cycles. An edge lies on one if its end reaches its start over the edges of both.
    """
    fresh = new.select("src", "dst").where("src is not null and dst is not null").distinct()
    back = closure(old.select("src", "dst").unionByName(fresh)).select(F.col("src").alias("dst"), F.col("dst").alias("src"), F.lit(False).alias("accepted"))
    rows = fresh.join(back, ["src", "dst"], "left")
    free = F.coalesce("accepted", F.lit(True)) & (F.col("src") != F.col("dst"))
    return rows.select("src", "dst", free.alias("accepted"))


def on_cycles(pairs: DataFrame) -> DataFrame:
    """(node) of every node that reaches itself."""
    return pairs.where("src = dst").select(F.col("src").alias("node")).distinct()


def degrees(edges: DataFrame) -> DataFrame:
    """(node, n_out, n_in): distinct neighbours either way."""
    e = edges.select("src", "dst").distinct()
    out = e.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("n_out"))
    into = e.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("n_in"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.join(into, "node", "full_outer").select("node", zero("n_out"), zero("n_in"))


def edge_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(src, dst, change) of edges that only one side has."""
    o, n = old.select("src", "dst").distinct(), new.select("src", "dst").distinct()
    gone, come = o.join(n, ["src", "dst"], "left_anti"), n.join(o, ["src", "dst"], "left_anti")
    return gone.withColumn("change", F.lit("removed")).unionAll(come.withColumn("change", F.lit("added")))


def as_of(df: DataFrame, valid: object, known: object) -> DataFrame:
    """Rows valid on one day as known at another; intervals are half open, a null end is open."""
    inside = lambda a, b, at: (F.col(a) <= F.lit(at)) & (F.col(b).isNull() | (F.lit(at) < F.col(b)))
    return df.where(inside("valid_from", "valid_to", valid) & inside("known_from", "known_to", known))
