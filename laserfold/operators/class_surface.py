"""Per-class surface: water and ground cells with world boxes, and tile summaries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laserfold.functions.grid import bin_index
from laserfold.functions.measures import PERCENTILE_ACCURACY
from laserfold.operators.surface import CELL
from laserfold.operators.tiling import TILE
from laserfold.params import GRID_ALGORITHM, GROUND_CLASSES, SITE_RUN, GridParams
from laserfold.runtime import Stored, lookup_join
from laserfold.sources.buckets import Buckets, meet


def candidate_tiles(boxes: DataFrame, max_tiles: int | None = None) -> DataFrame:
    """All tiles, or the `max_tiles` with most points when a cap is asked for."""
    if max_tiles is None:
        return boxes
    return boxes.orderBy(F.desc("pointCount"), *SITE_RUN, *TILE).limit(max_tiles)


def class_cells(
    tiled: DataFrame,
    tiles: Stored,
    params: GridParams = GridParams(),
    scope: Sequence[str] = SITE_RUN,
    ground_classes: Sequence[int] = GROUND_CLASSES,
) -> DataFrame:
    """Cell height by class: median for water, 10th percentile for ground.

    `tiles` is a stored tile-box table; cells count from the box corner of the tile.
    Both classes come out of one aggregate, with the class folded into the key."""
    keys = [*scope, *TILE]
    typed = tiled.where(_wanted(params, ground_classes)).select(*keys, "x", "y", "z", "classification")
    corners = replace(tiles, df=tiles.df.select(*keys, "minX", "minY"))
    placed = lookup_join(typed, corners, keys, "inner", spread=("x", "y"))
    return _fold_cells(placed, params, scope)


def class_cells_in_place(
    points: Buckets,
    boxes: DataFrame,
    params: GridParams = GridParams(),
    scope: Sequence[str] = SITE_RUN,
    ground_classes: Sequence[int] = GROUND_CLASSES,
) -> DataFrame:
    """The same from points that lie in buckets by tile: only boxes and cells are shuffled."""
    corners = boxes.select(*scope, *TILE, "minX", "minY")
    placed = meet(points, corners, where=_wanted(params, ground_classes))
    return _fold_cells(placed, params, scope)


def _wanted(params: GridParams, ground_classes: Sequence[int]) -> Column:
    return F.col("classification").isin(sorted({params.water_class, *ground_classes}))


def _fold_cells(placed: DataFrame, params: GridParams, scope: Sequence[str]) -> DataFrame:
    """Cells of points that know the corner of their tile."""
    keys = [*scope, *TILE]
    size = params.cell_size_m
    is_water = F.col("classification") == params.water_class
    placed = placed.withColumns(
        {
            "surfaceType": F.when(is_water, "water").otherwise("ground"),
            **{f"cell{a}": bin_index(F.col(a.lower()) - F.col(f"min{a}"), size) for a in ("X", "Y")},
        }
    )
    low_mid = F.percentile_approx("z", [0.1, 0.5], PERCENTILE_ACCURACY)
    return (
        placed.groupBy(*keys, *CELL, "surfaceType", "minX", "minY")
        .agg(low_mid.alias("_q"), F.count(F.lit(1)).alias("pointCountCell"))
        .withColumn("z", F.when(F.col("surfaceType") == "water", F.col("_q")[1]).otherwise(F.col("_q")[0]))
        .withColumns(
            {
                "cellMinX": F.col("minX") + F.col("cellX") * F.lit(size),
                "cellMinY": F.col("minY") + F.col("cellY") * F.lit(size),
                "tileSizeM": F.lit(float(params.tile_size_m)),
            }
        )
        .withColumns(
            {"cellMaxX": F.col("cellMinX") + F.lit(size), "cellMaxY": F.col("cellMinY") + F.lit(size)}
        )
        .drop("_q", "minX", "minY")
    )


def tile_surface_summary(
    cells: DataFrame,
    params: GridParams = GridParams(),
    scope: Sequence[str] = SITE_RUN,
    cells_uri: str | None = None,
) -> DataFrame:
    """One row per tile and surface type with extent, mean height and coverage."""
    keys = [*scope, "surfaceType", *TILE]
    capacity = (params.tile_size_m / params.cell_size_m) ** 2
    return (
        cells.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("cellCount"),
            F.sum("pointCountCell").alias("pointCountUsed"),
            # Names of the extent columns.
            F.min("cellMinX").alias("minX"),
            F.min("cellMinY").alias("minY"),
            F.max("cellMaxX").alias("maxX"),
            F.max("cellMaxY").alias("maxY"),
            F.avg("z").alias("avgZ"),
        )
        .withColumns(
            {
                "tileSizeM": F.lit(float(params.tile_size_m)),
                "cellSizeM": F.lit(float(params.cell_size_m)),
                "surfaceId": F.concat_ws("_", *scope, *TILE, "surfaceType"),
                "quality": F.col("cellCount") / F.lit(capacity),
                "cellsUri": F.lit(cells_uri).cast("string"),
                "algoVersion": F.lit(GRID_ALGORITHM),
            }
        )
    )
