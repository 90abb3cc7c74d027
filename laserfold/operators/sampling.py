"""Fixed-size point samples per tile for model training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laserfold.params import SITE, GridParams
from laserfold.runtime import lookup_join, store

XYZ = ("x", "y", "z")
VOXEL = ("vx", "vy", "vz")


def voxel_downsample(
    tiled: DataFrame, params: GridParams = GridParams(), scope: Sequence[str] = SITE
) -> DataFrame:
    """Mean point of every occupied voxel of a tile."""
    voxel = {v: F.floor(F.col(a) / F.lit(params.voxel_m)) for v, a in zip(VOXEL, XYZ)}
    return (
        tiled.select(*scope, "tileId", *XYZ)
        .withColumns(voxel)
        .groupBy(*scope, "tileId", *VOXEL)
        .agg(*(F.avg(a).alias(a) for a in XYZ))
    )


BUCKET = 64


def _buckets(at, size: int) -> list:
    """Numbers of points in boxes of at most `size`, by halving along the longest side."""
    import numpy as np

    done, waiting = [], [np.arange(len(at))]
    while waiting:
        own = waiting.pop()
        if len(own) <= size:
            done.append(np.sort(own))
            continue
        axis = int(np.ptp(at[own], axis=0).argmax())
        middle = len(own) // 2
        own = own[np.argpartition(at[own, axis], middle)]
        waiting += [own[:middle], own[middle:]]
    return done


def farthest(at, wanted: int):
    """Numbers of `wanted` points, each the farthest from those before; starts at the first.

    Points lie in boxes with the largest gap of their points. A new pick can only shrink
    gaps in boxes that it is nearer to than that, so most boxes are passed over. The
    lowest number wins ties, and the picks are those of a scan over all points."""
    import numpy as np

    n = len(at)
    if n <= wanted:
        return np.arange(n)
    boxes = _buckets(at, BUCKET)
    # Short boxes are filled with their last point, which never comes before the original.
    numbers = np.stack([np.pad(own, (0, BUCKET - len(own)), mode="edge") for own in boxes])
    x, y, z = (at[numbers, i] for i in range(3))
    low, high = np.stack([c.min(1) for c in (x, y, z)]), np.stack([c.max(1) for c in (x, y, z)])
    gaps = np.full(numbers.shape, np.inf)
    widest = np.full(len(boxes), np.inf)
    chosen = np.zeros(wanted, np.int64)
    for i in range(1, wanted):
        p = at[chosen[i - 1]]
        outside = np.maximum(np.maximum(low - p[:, None], p[:, None] - high), 0.0)
        near = np.flatnonzero((outside * outside).sum(0) < widest)
        dx, dy, dz = x[near] - p[0], y[near] - p[1], z[near] - p[2]
        own = np.minimum(gaps[near], dx * dx + dy * dy + dz * dz)
        gaps[near] = own
        widest[near] = own.max(1)
        top = np.flatnonzero(widest == widest.max())
        chosen[i] = numbers[top, gaps[top].argmax(1)].min()
    return chosen


def _sampled(pdf, wanted: int):
    ordered = pdf.sort_values(list(VOXEL), ignore_index=True)
    return ordered.iloc[farthest(ordered[list(XYZ)].to_numpy("float64"), wanted)]


def farthest_points(
    voxels: DataFrame, params: GridParams = GridParams(), scope: Sequence[str] = SITE
) -> DataFrame:
    """Farthest-point sample of at most `sample_points` points per tile.

    Starts at the smallest voxel key, so the sample is reproducible; smaller tiles
    pass through whole. One task holds the voxels of one tile, a number that the
    voxel grid bounds however many points fall into the tile. `seq` is the order of
    selection."""
    wanted = params.sample_points
    schema = ", ".join([*(f"{c} string" for c in scope), "tileId string", "seq int",
                        "x double", "y double", "z double"])
    out = [*scope, "tileId", "seq", *XYZ]

    def pick(pdf):
        import numpy as np

        chosen = _sampled(pdf, wanted)
        return chosen.assign(seq=np.arange(len(chosen), dtype="int32"))[out]

    return voxels.groupBy(*scope, "tileId").applyInPandas(pick, schema)


def normalize(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Centre the points of every key and scale them into the unit ball.

    A group whose points coincide gets zero vectors. The points are stored once and then
    do not move: the centre and the reach of a key are partial aggregates, and come back
    by counted lookups."""
    keys = list(keys)
    points = store(points, "points-to-normalize").df
    centre = store(points.groupBy(*keys).agg(*(F.avg(a).alias(f"_c{a}") for a in XYZ)), "centres")
    moved = lookup_join(points, centre, keys, "inner", spread=XYZ).withColumns(
        {a: F.col(a) - F.col(f"_c{a}") for a in XYZ}
    )
    moved = moved.drop(*(f"_c{a}" for a in XYZ))
    length = F.sqrt(sum(F.col(a) * F.col(a) for a in XYZ))
    reach = store(moved.groupBy(*keys).agg(F.max(length).alias("_r")), "reaches")
    unit = {a: F.when(F.col("_r") > 0, F.col(a) / F.col("_r")).otherwise(F.lit(0.0)) for a in XYZ}
    return lookup_join(moved, reach, keys, "inner", spread=XYZ).withColumns(unit).drop("_r")


def voxel_tensors(
    voxels: DataFrame, params: GridParams = GridParams(), scope: Sequence[str] = SITE
) -> DataFrame:
    """One centred and scaled `array<array<float>>` per tile, in the order of selection.

    Sampling, centring and scaling happen in the task that holds the tile's voxels."""
    wanted = params.sample_points
    keys = [*scope, "tileId"]
    schema = ", ".join([*(f"{c} string" for c in keys), "tensor array<array<float>>"])

    def make(pdf):
        import numpy as np
        import pandas as pd

        at = _sampled(pdf, wanted)[list(XYZ)].to_numpy("float64")
        at = at - at.mean(axis=0)
        reach = np.sqrt((at * at).sum(axis=1)).max()
        unit = at / reach if reach > 0 else np.zeros_like(at)
        first = {k: [pdf[k].iloc[0]] for k in keys}
        return pd.DataFrame(first | {"tensor": [list(unit.astype("float32"))]})

    return voxels.groupBy(*keys).applyInPandas(make, schema)


def tensors(
    tiled: DataFrame, params: GridParams = GridParams(), scope: Sequence[str] = SITE
) -> DataFrame:
    """Training tensors of tiled points: voxel means, then `voxel_tensors`."""
    return voxel_tensors(voxel_downsample(tiled, params, scope), params, scope)
