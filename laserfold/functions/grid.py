"""Grid arithmetic: tile, cell, patch and Morton keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bin_index(offset: Column, size: Column | float) -> Column:
    """Zero-based index of the bin of width `size` that holds `offset`."""
    width = size if isinstance(size, Column) else F.lit(float(size))
    return F.floor(offset / width).cast("int")


def pair_id(a: str, b: str) -> Column:
    """Text id of an index pair, `a_b`."""
    return F.concat(F.col(a).cast("string"), F.lit("_"), F.col(b).cast("string"))


def split_pair(pair: str | Column) -> tuple[Column, Column]:
    """The two indices of an `a_b` id (for imported tables without index columns)."""
    parts = F.split(F.col(pair) if isinstance(pair, str) else pair, "_")
    return parts[0].cast("int"), parts[1].cast("int")


def vertex_key(gx: Column, gy: Column) -> Column:
    """One long per global grid position; its order is (gx, gy)."""
    return gx.cast("long") * F.lit(1 << 32) + gy.cast("long")


def _spread_bits(v: Column) -> Column:
    """Move the low 31 bits of `v` to the even bit positions."""
    # The usual masks of bit interleaving.
    steps = (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    )
    out = v.cast("long").bitwiseAND(F.lit(0x7FFFFFFF))
    for shift, mask in steps:
        out = out.bitwiseOR(F.shiftleft(out, shift)).bitwiseAND(F.lit(mask))
    return out


def morton(ix: Column, iy: Column) -> Column:
    """Z-order key of two non-negative indices: neighbours get close keys."""
    return _spread_bits(ix).bitwiseOR(F.shiftleft(_spread_bits(iy), 1))


def boxes_overlap(
    box: tuple[str, str, str, str], query: tuple[float, float, float, float]
) -> Column:
    """Overlap of a row's (minX, minY, maxX, maxY) columns with a query box."""
    lo_x, lo_y, hi_x, hi_y = (F.col(c) for c in box)
    q_lo_x, q_lo_y, q_hi_x, q_hi_y = (F.lit(float(v)) for v in query)
    x_meets = (hi_x >= q_lo_x) & (lo_x <= q_hi_x)
    y_meets = (hi_y >= q_lo_y) & (lo_y <= q_hi_y)
    return x_meets & y_meets
