"""Per-tile statistics, their roll-ups, and diagnostics over point layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laserfold.functions.grid import pair_id
from laserfold.functions.measures import class_count, quantiles, share
from laserfold.operators.tiling import TILE
from laserfold.params import SITE, GridParams

Z_QUANTILES = (("z_p50", 0.50), ("z_p95", 0.95), ("z_p99", 0.99))
INTENSITY_QUANTILES = (("intensity_p50", 0.50), ("intensity_p95", 0.95))


def tile_stats(
    tiled: DataFrame, params: GridParams = GridParams(), scope: Sequence[str] = SITE
) -> DataFrame:
    """One row per tile: counts, height and intensity quantiles, water share and flag.

    All measures are mergeable, so a hot tile costs one partial row per map task."""
    keys = [*scope, *TILE]
    grouped = tiled.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("pointCount"),
        class_count(params.water_class).alias("waterPointCount"),
        F.min("z").alias("minZ"),
        F.max("z").alias("maxZ"),
        quantiles("z", [p for _, p in Z_QUANTILES]).alias("_z"),
        quantiles("intensity", [p for _, p in INTENSITY_QUANTILES]).alias("_i"),
    )
    return grouped.select(
        *scope,
        pair_id(*TILE).alias("tileId"),
        *TILE,
        "pointCount",
        "waterPointCount",
        "minZ",
        "maxZ",
        *(F.col("_z")[i].alias(name) for i, (name, _) in enumerate(Z_QUANTILES)),
        *(F.col("_i")[i].alias(name) for i, (name, _) in enumerate(INTENSITY_QUANTILES)),
        share("waterPointCount", "pointCount").alias("waterPointRatio"),
    ).withColumn("isMostlyWater", F.col("waterPointRatio") >= params.mostly_water_ratio)


def site_rollup(stats: DataFrame, scope: Sequence[str] = SITE) -> DataFrame:
    return stats.groupBy(*scope).agg(
        F.count(F.lit(1)).alias("tileCount"),
        F.sum("pointCount").alias("totalPoints"),
        F.sum("waterPointCount").alias("totalWaterPoints"),
        F.avg("waterPointRatio").alias("avgWaterRatio"),
        F.count_if("isMostlyWater").alias("mostlyWaterTiles"),
    )


def tile_boxes(
    tiled: DataFrame, params: GridParams = GridParams(), scope: Sequence[str] = SITE
) -> DataFrame:
    """Tile statistics in the bounding-box form, with a merge-safe mean height."""
    return (
        tiled.groupBy(*scope, *TILE)
        .agg(
            F.count(F.lit(1)).alias("pointCount"),
            class_count(params.water_class).alias("waterCount"),
            # Names of the extent columns.
            F.min("x").alias("minX"),
            F.max("x").alias("maxX"),
            F.min("y").alias("minY"),
            F.max("y").alias("maxY"),
            F.min("z").alias("minZ"),
            F.max("z").alias("maxZ"),
            F.sum("z").alias("_z"),
        )
        .withColumns(
            {
                "avgZ": F.col("_z") / F.col("pointCount"),
                "waterRatio": share("waterCount", "pointCount"),
                "tileSizeM": F.lit(float(params.tile_size_m)),
            }
        )
        .drop("_z")
    )


def water_mask(
    boxes: DataFrame, params: GridParams = GridParams(), scope: Sequence[str] = SITE
) -> DataFrame:
    """Only the mostly-water tiles, with their box and share of water points."""
    return boxes.where(F.col("waterRatio") >= params.mostly_water_ratio).select(
        *scope, *TILE, "waterRatio", "minX", "minY", "maxX", "maxY", "tileSizeM",
        F.lit(1).alias("isMostlyWater"),
    )


def with_mask(
    boxes: DataFrame, mask: DataFrame | None, scope: Sequence[str] = SITE
) -> DataFrame:
    """Tile boxes plus mask columns; tiles outside the mask, or no mask at all, get 0."""
    if mask is None:
        return boxes.withColumns({"isMostlyWater": F.lit(0), "waterRatioMask": F.lit(0.0)})
    keys = [*scope, *TILE]
    flags = mask.select(*keys, "isMostlyWater", F.col("waterRatio").alias("waterRatioMask"))
    return boxes.join(flags, keys, "left").fillna({"isMostlyWater": 0, "waterRatioMask": 0.0})


def busiest_tiles(tiles: DataFrame, n: int, scope: Sequence[str] = SITE) -> DataFrame:
    """The n tiles with most points, over all scopes; ties go by scope and index."""
    return tiles.orderBy(F.desc("pointCount"), *scope, *TILE).limit(n)


def height_range_quantiles(tiles: DataFrame, scope: Sequence[str] = SITE) -> DataFrame:
    names = (("p50_range", 0.5), ("p90_range", 0.9), ("p99_range", 0.99))
    sketch = quantiles(F.col("maxZ") - F.col("minZ"), [p for _, p in names])
    return tiles.groupBy(*scope).agg(sketch.alias("q")).select(
        *scope, *(F.col("q")[i].alias(name) for i, (name, _) in enumerate(names))
    )


def class_distribution(points: DataFrame, n: int) -> DataFrame:
    counted = points.groupBy("classification").agg(F.count(F.lit(1)).alias("points"))
    return counted.orderBy(F.desc("points"), "classification").limit(n)


def snapshot_check(tiled: DataFrame) -> DataFrame:
    """Rows, distinct tiles and snapshot time of every (site, run)."""
    per_tile = tiled.groupBy("siteId", "ingestRunId", "tileId").agg(
        F.count(F.lit(1)).alias("n"), F.min("snapshotAt").alias("at")
    )
    return per_tile.groupBy("siteId", "ingestRunId").agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("tiles"),
        F.min("at").alias("snapshotAt"),
    )


def column_span(tiles: DataFrame, scope: Sequence[str] = SITE) -> DataFrame:
    """How many tile columns each scope covers."""
    return tiles.groupBy(*scope).agg(F.count_distinct("tileX").alias("tileColumns"))


def fold_layer(df: DataFrame) -> DataFrame:
    """A layer folded to one row per (tile, class), with rows and ingest times.

    A layer without these columns folds to one row."""
    have = set(df.columns)
    keys = [c for c in (*TILE, "classification") if c in have]
    time = F.col("ingestTime") if "ingestTime" in have else F.lit(None)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(time).cast("timestamp").alias("first"),
        F.max(time).cast("timestamp").alias("last"),
    )


def folded_metrics(folded: DataFrame) -> DataFrame:
    """One row of whatever metrics the columns of a folded layer allow; others are null.

    The distinct counts run over the small folded set, not over an expansion of the layer."""
    have = set(folded.columns)
    nothing = F.lit(None).cast("long")
    return folded.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"),
        (F.count_distinct(*TILE) if have.issuperset(TILE) else nothing).alias("distinctTiles"),
        (F.count_distinct("classification") if "classification" in have else nothing).alias(
            "distinctClasses"
        ),
        F.min("first").alias("minIngestTime"),
        F.max("last").alias("maxIngestTime"),
    )


def folded_classes(folded: DataFrame, n: int) -> DataFrame:
    """One row: the n classes with most rows, as an array; null where a layer has no classes."""
    kind = "array<struct<classification:int,points:bigint>>"
    if "classification" not in folded.columns:
        return folded.agg(F.lit(None).cast(kind).alias("classes"))
    counted = folded.groupBy("classification").agg(F.sum("n").alias("points"))
    most = counted.orderBy(F.desc("points"), "classification").limit(n)
    rank = F.struct((-F.col("points")).alias("rank"), F.col("classification").cast("int").alias("classification"), "points")
    ranked = most.agg(F.sort_array(F.collect_list(rank)).alias("ranked"))
    pair = lambda r: F.struct(r.classification.alias("classification"), r.points.alias("points"))
    return ranked.select(F.transform("ranked", pair).cast(kind).alias("classes"))


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    """One row: n rows of a layer as JSON texts, those of the smallest hashes.

    Each task keeps its n smallest only; the choice does not depend on partitioning."""
    row = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)))
    hashed = df.select(row.alias("text")).withColumn("h", F.xxhash64("text"))
    lowest = hashed.orderBy("h", "text").limit(n)
    ranked = lowest.agg(F.sort_array(F.collect_list(F.struct("h", "text"))).alias("ranked"))
    return ranked.select(F.transform("ranked", lambda r: r.text).alias("sample"))
