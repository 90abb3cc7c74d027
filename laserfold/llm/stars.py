"""Connected components of a graph with text keys as nodes.

Large-star and small-star rounds (Kiveris et al., 2014) on edges hi → lo, until every
component is a star around its smallest key. A round is one job whose result is
written to the shared folder. Minima are partial aggregates; the way back is a salted
join, or a broadcast when the counted edges are few, so a hub is no hot task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laserfold import runtime
from laserfold.runtime import Stored, salted_join, store

MAX_ROUNDS = 100
FEW_FILES = 4


def _star(edges: DataFrame, large: bool, few: bool) -> DataFrame:
    arcs = edges.select(F.col("hi").alias("n"), F.col("lo").alias("m"))
    if large:
        arcs = arcs.unionByName(edges.select(F.col("lo").alias("n"), F.col("hi").alias("m")))
    lowest = arcs.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("r"))
    if few:
        paired = arcs.join(F.broadcast(lowest), "n")
    else:
        paired = salted_join(arcs, lowest, ["n"], "inner", spread=("m",))
    if large:
        moved = paired.where(F.col("m") > F.col("n")).select(
            F.col("m").alias("hi"), F.col("r").alias("lo")
        )
    else:
        moved = paired.select(F.explode(F.array("m", "n")).alias("hi"), F.col("r").alias("lo"))
    return moved.where(F.col("hi") != F.col("lo")).distinct()


def _round(edges: DataFrame, few: bool = False) -> Stored:
    # Counted small rounds are written as few files.
    edges = edges.coalesce(FEW_FILES) if few else edges
    return store(
        edges, "stars", mark=F.coalesce(F.bit_xor(F.xxhash64("hi", "lo")), F.lit(0))
    )


def stars(edges: DataFrame) -> Stored:
    """Component of every node with an edge: rows (hi, lo), lo the smallest key, hi another."""
    ordered = edges.where(F.col("hi") != F.col("lo")).select(
        F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")
    )
    current = _round(ordered.distinct())
    for _ in range(MAX_ROUNDS):
        if current.rows == 0:
            return current
        # A step gives at most as many edges as it gets, and two nodes per edge.
        few = 2 * current.rows <= runtime.BROADCAST_ROWS
        following = _round(_star(_star(current.df, True, few), False, few), few)
        if (following.rows, following.metrics) == (current.rows, current.metrics):
            return following
        current = following
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def labels(edges: DataFrame, key: str = "key", root: str = "root") -> DataFrame:
    """(key, root) for every node that has an edge, the root itself included."""
    found = stars(edges).df
    return found.select(F.col("hi").alias(key), F.col("lo").alias(root)).unionByName(
        found.select(F.col("lo").alias(key), F.col("lo").alias(root)).distinct()
    )
