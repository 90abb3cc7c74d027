"""Features of the surface: building candidates and water bodies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laserfold.functions.grid import split_pair, vertex_key
from laserfold.functions.measures import quantile
from laserfold.operators.components import grid_components
from laserfold.operators.tiling import TILE
from laserfold.params import SITE, GridParams

LOW_QUANTILE = 0.1


def ground_reference(patches: DataFrame, scope: Sequence[str] = SITE) -> DataFrame:
    """Low quantile of the ground patches of each tile."""
    ground = patches.where(F.col("surfaceType") == "ground")
    return ground.groupBy(*scope, *TILE).agg(quantile("minZ", LOW_QUANTILE).alias("groundZ_ref"))


def building_candidates(
    patches: DataFrame, params: GridParams = GridParams(), scope: Sequence[str] = SITE
) -> DataFrame:
    """Ground patches that stand above their tile, are flat and well covered.

    The reference height is a window over the patches of one tile (the grid bounds
    their number) and shares its partitioning, so nothing is joined back."""
    tile = Window.partitionBy(*scope, *TILE)
    rated = (
        patches.where(F.col("surfaceType") == "ground")
        .withColumn("groundZ_ref", quantile("minZ", LOW_QUANTILE).over(tile))
        .withColumns(
            {
                "heightAboveGround": F.col("meanZ") - F.col("groundZ_ref"),
                "heightRange": F.col("maxZ") - F.col("minZ"),
            }
        )
    )
    rules = [
        F.col("pointsUsed") >= params.min_points_used,
        F.col("heightAboveGround") >= params.min_height_above_ground,
        F.col("heightRange") <= params.max_height_range,
    ]
    if params.min_patch_area_m2 is not None:
        area = F.col("cellCount") * F.col("cellSizeM") * F.col("cellSizeM")
        rules.append(area >= params.min_patch_area_m2)
    for rule in rules:
        rated = rated.where(rule)
    return rated.select(
        *scope,
        "tileId",
        F.concat_ws("|", "tileId", "patchId").alias("buildingCandidateId"),
        "pointsUsed",
        "cellCount",
        "minZ",
        "meanZ",
        "maxZ",
        "heightAboveGround",
        "heightRange",
    )


def water_cells(
    cells: DataFrame, params: GridParams = GridParams(), scope: Sequence[str] = SITE
) -> DataFrame:
    """Cells with enough water points, on site-wide integer coordinates."""
    n = params.cells_per_tile
    wet = cells.where(F.col("waterPointRatio") >= params.water_cell_ratio)
    if not set(TILE) <= set(wet.columns):
        wet = wet.withColumns(dict(zip(TILE, split_pair("tileId"))))
    return wet.select(
        *scope,
        *((F.col(f"tile{a}") * F.lit(n) + F.col(f"cell{a}")).alias(f"globalCell{a}") for a in "XY"),
        "minZ",
        "meanZ",
        "maxZ",
        "cellSizeM",
    ).withColumn("vertexId", vertex_key(F.col("globalCellX"), F.col("globalCellY")))


def label_water(
    wet: DataFrame, scope: Sequence[str] = SITE, neighbours: int = 4
) -> DataFrame:
    """Water cells with `waterBodyId`, the smallest vertex key of their component."""
    return grid_components(
        wet, scope, gx="globalCellX", gy="globalCellY", label="waterBodyId", neighbours=neighbours
    )


def water_bodies(labelled: DataFrame, scope: Sequence[str] = SITE) -> DataFrame:
    """Size, height range and cell extent of every component."""
    size = F.max("cellSizeM")
    return labelled.groupBy(*scope, "waterBodyId").agg(
        F.count(F.lit(1)).alias("cellCount"),
        (F.count(F.lit(1)) * size * size).alias("areaM2"),
        F.min("minZ").alias("minZ"),
        F.max("maxZ").alias("maxZ"),
        F.avg("meanZ").alias("meanZ"),
        # Names of the extent columns.
        F.min("globalCellX").alias("bboxMinCellX"),
        F.min("globalCellY").alias("bboxMinCellY"),
        F.max("globalCellX").alias("bboxMaxCellX"),
        F.max("globalCellY").alias("bboxMaxCellY"),
    )


def water_totals(bodies: DataFrame, scope: Sequence[str] = SITE) -> DataFrame:
    return bodies.groupBy(*scope).agg(
        F.count(F.lit(1)).alias("waterBodies"),
        F.sum("cellCount").alias("totalCells"),
        F.sum("areaM2").alias("totalAreaM2"),
    )


def largest_water(bodies: DataFrame, n: int = 10, scope: Sequence[str] = SITE) -> DataFrame:
    order = [F.desc("areaM2"), *scope, "waterBodyId"]
    return bodies.select(*scope, "waterBodyId", "cellCount", "areaM2").orderBy(*order).limit(n)


def count_candidates(candidates: DataFrame, scope: Sequence[str] = SITE) -> DataFrame:
    return candidates.groupBy(*scope).agg(F.count(F.lit(1)).alias("candidates"))
