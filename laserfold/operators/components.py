"""Connected components of grid cells.

1. Cells are grouped in square blocks; each block is labelled inside one task (a
   block holds at most BLOCK_CELLS² cells, whatever the data looks like).
2. Only cells on block borders look for neighbours, which gives a small graph whose
   nodes are block-local components.
3. Large-star / small-star rounds (Kiveris et al., 2014) contract that graph to
   stars. Each round is written to the shared folder, which cuts the lineage.

The label is the smallest vertex key of a component, so it does not depend on
partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from laserfold import runtime
from laserfold.functions.grid import vertex_key
from laserfold.runtime import Stored, salted_join, store

BLOCK_CELLS = 64
MAX_ROUNDS = 60

FORWARD = {4: ((1, 0), (0, 1)), 8: ((1, 0), (0, 1), (1, 1), (1, -1))}
ALL_AROUND = {
    n: steps + tuple((-dx, -dy) for dx, dy in steps) for n, steps in FORWARD.items()
}


def cell_edges(
    cells: DataFrame, scope: Sequence[str], gx: str, gy: str, neighbours: int = 4
) -> DataFrame:
    """Directed adjacency list (src, dst) of the cells, each pair once per direction."""
    points = cells.select(*scope, gx, gy).distinct()
    steps = F.array(
        *(
            F.struct((F.col(gx) + dx).alias("nx"), (F.col(gy) + dy).alias("ny"))
            for dx, dy in ALL_AROUND[neighbours]
        )
    )
    looking = points.select(
        *scope, vertex_key(F.col(gx), F.col(gy)).alias("src"), F.inline(steps)
    )
    there = points.select(*scope, F.col(gx).alias("nx"), F.col(gy).alias("ny"))
    return looking.join(there, [*scope, "nx", "ny"]).select(
        *scope, "src", vertex_key(F.col("nx"), F.col("ny")).alias("dst")
    )


def _block_labels(
    cells: DataFrame, scope: Sequence[str], gx: str, gy: str, neighbours: int
) -> DataFrame:
    """Add `_local`, the smallest vertex key of the cell's component in its block."""
    steps = FORWARD[neighbours]

    def label(pdf):
        import numpy as np

        x, y = pdf[gx].to_numpy("int64"), pdf[gy].to_numpy("int64")
        x0, y0 = x.min(), y.min()
        width = int(y.max() - y0) + 3
        # Dense window with a one-cell rim; positions grow in vertex-key order.
        spot = (x - x0 + 1) * width + (y - y0 + 1)
        size = (int(x.max() - x0) + 3) * width
        empty = np.full(size, size, dtype="int64")
        best = empty.copy()
        best[spot] = spot
        shifts = [dx * width + dy for dx, dy in steps]
        while True:
            before = best[spot]
            now = before
            for shift in shifts:
                now = np.minimum(now, np.minimum(best[spot + shift], best[spot - shift]))
            best[spot] = now
            best[spot] = best[best[spot]]
            if np.array_equal(best[spot], before):
                break
        root = best[spot]
        key = (root // width - 1 + x0) * (1 << 32) + (root % width - 1 + y0)
        return pdf.assign(_local=key).drop(columns=["_bx", "_by"])

    schema = StructType([*cells.schema.fields, StructField("_local", LongType())])
    blocks = {
        name: F.floor(F.col(axis) / F.lit(BLOCK_CELLS)) for name, axis in (("_bx", gx), ("_by", gy))
    }
    return cells.withColumns(blocks).groupBy(*scope, "_bx", "_by").applyInPandas(label, schema)


def _border_edges(
    labelled: DataFrame, scope: Sequence[str], gx: str, gy: str, neighbours: int
) -> DataFrame:
    """Edges hi → lo between block-local components of touching blocks."""
    def block(v):
        return F.floor(v / F.lit(BLOCK_CELLS))

    nodes = labelled.select(*scope, gx, gy, F.col("_local").alias("b")).distinct()
    rim = F.pmod(F.col(gx), F.lit(BLOCK_CELLS)).isin(0, BLOCK_CELLS - 1) | F.pmod(
        F.col(gy), F.lit(BLOCK_CELLS)
    ).isin(0, BLOCK_CELLS - 1)
    rim_nodes = nodes.where(rim)
    steps = F.array(
        *(
            F.struct((F.col(gx) + dx).alias("nx"), (F.col(gy) + dy).alias("ny"))
            for dx, dy in FORWARD[neighbours]
        )
    )
    outward = rim_nodes.select(
        *scope, F.col("b").alias("a"), gx, gy, F.inline(steps)
    ).where((block(F.col(gx)) != block(F.col("nx"))) | (block(F.col(gy)) != block(F.col("ny"))))
    there = rim_nodes.withColumnsRenamed({gx: "nx", gy: "ny"})
    met = outward.join(there, [*scope, "nx", "ny"]).where(F.col("a") != F.col("b"))
    return met.select(
        *scope, F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    ).distinct()


def _star(edges: DataFrame, scope: Sequence[str], large: bool, few: bool) -> DataFrame:
    """One star step on edges hi → lo.

    Large star hangs the larger neighbours of a node under its smallest neighbour,
    small star the smaller ones and the node itself. The minimum is a partial
    aggregate and the way back is a salted join, so a hub node is no hot task. With
    `few` (counted) edges the minima are broadcast instead."""
    if large:
        arcs = edges.select(*scope, F.col("hi").alias("n"), F.col("lo").alias("m")).unionByName(
            edges.select(*scope, F.col("lo").alias("n"), F.col("hi").alias("m"))
        )
    else:
        arcs = edges.select(*scope, F.col("hi").alias("n"), F.col("lo").alias("m"))
    keys = [*scope, "n"]
    lowest = arcs.groupBy(*keys).agg(F.least(F.min("m"), F.col("n")).alias("r"))
    if few:
        paired = arcs.join(F.broadcast(lowest), keys)
    else:
        paired = salted_join(arcs, lowest, keys, "inner", spread=("m",))
    if large:
        moved = paired.where(F.col("m") > F.col("n")).select(
            *scope, F.col("m").alias("hi"), F.col("r").alias("lo")
        )
    else:
        moved = paired.select(
            *scope, F.explode(F.array("m", "n")).alias("hi"), F.col("r").alias("lo")
        )
    return moved.where(F.col("hi") != F.col("lo")).distinct()


def _stored_edges(edges: DataFrame, scope: Sequence[str]) -> Stored:
    """Write a round; the fingerprint tells whether it differs from the last one."""
    return store(
        edges,
        "edges",
        mark=F.coalesce(F.bit_xor(F.xxhash64(*scope, "hi", "lo")), F.lit(0)),
        total=F.coalesce(F.sum((F.col("hi") - F.col("lo")).cast("decimal(38,0)")), F.lit(0)),
    )


def contract(edges: DataFrame, scope: Sequence[str]) -> Stored:
    """Contract edges hi → lo until every component is a star around its minimum."""
    current = _stored_edges(edges, scope)
    for _ in range(MAX_ROUNDS):
        if current.rows == 0:
            return current
        # A step gives at most as many edges as it gets, and two nodes per edge.
        few = 2 * current.rows <= runtime.BROADCAST_ROWS
        lifted = _star(current.df, scope, large=True, few=few)
        following = _stored_edges(_star(lifted, scope, large=False, few=few), scope)
        if (following.rows, following.metrics) == (current.rows, current.metrics):
            return following
        current = following
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def grid_components(
    cells: DataFrame,
    scope: Sequence[str],
    gx: str,
    gy: str,
    label: str = "component",
    neighbours: int = 4,
) -> DataFrame:
    """Cells plus the smallest vertex key of their connected component."""
    if neighbours not in FORWARD:
        raise ValueError("neighbours must be 4 or 8")
    local = store(_block_labels(cells, scope, gx, gy, neighbours), "block-labels").df
    stars = contract(_border_edges(local, scope, gx, gy, neighbours), scope)
    roots = stars.df.select(*scope, F.col("hi").alias("_local"), F.col("lo").alias("_root"))
    joined = local.join(roots, [*scope, "_local"], "left")
    return joined.withColumn(label, F.coalesce("_root", "_local")).drop("_local", "_root")
