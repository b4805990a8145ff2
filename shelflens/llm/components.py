"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _state(edges: DataFrame):
    return edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root (the smallest node it reaches) of every node of `edges` (a, b) but the roots themselves.

    Alternates large-star and small-star steps, each a group minimum and a join, until the links no longer change: every
    node then hangs on its root. The number of rounds grows with the logarithm of the longest path. Each round is
    written to the shared folder.
    """
    now = save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    state = _state(now)
    for _ in range(rounds):
        if not state["n"]:
            break
        both = _both(now)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(down.select("a", F.col("m").alias("b"))).distinct()
        now = save(small, "components")
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError(f"components still change after {rounds} rounds")
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
