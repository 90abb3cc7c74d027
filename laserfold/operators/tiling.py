"""Assign points to tiles and spread hot tiles over salt buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laserfold.functions.grid import bin_index, pair_id
from laserfold.params import SITE, GridParams
from laserfold.runtime import Stored, lookup_join, salt, store

TILE = ("tileX", "tileY")


def origins(points: DataFrame, scope: Sequence[str] = SITE) -> DataFrame:
    """South-west corner of the points of every scope."""
    return points.groupBy(*scope).agg(F.min("x").alias("originX"), F.min("y").alias("originY"))


def assign_tiles(
    points: DataFrame,
    params: GridParams = GridParams(),
    scope: Sequence[str] = SITE,
    origin: Stored | None = None,
) -> DataFrame:
    """Add origin, tile size, tile indices and tile id to every point.

    The origins are one narrow aggregate over the scan; points themselves are not
    shuffled (the join is a checked broadcast, salted by position beyond it)."""
    if origin is None:
        origin = store(origins(points, scope), "origins")
    located = lookup_join(points, origin, list(scope), "inner", spread=("x", "y"))
    size = params.tile_size_m
    return (
        located.withColumn("tileSizeM", F.lit(float(size)))
        .withColumns(
            {
                "tileX": bin_index(F.col("x") - F.col("originX"), size),
                "tileY": bin_index(F.col("y") - F.col("originY"), size),
            }
        )
        .withColumn("tileId", pair_id("tileX", "tileY"))
    )


def assign_resolved_tiles(
    points: DataFrame, resolved: DataFrame, scope: Sequence[str] = SITE
) -> DataFrame:
    """Tiles by each scope's own parameters (`tuning.resolve_params`).

    Origins and parameters are one stored row per scope, looked up together; the
    parameters stay on the points for `salt_resolved_tiles`."""
    settings = resolved.select(
        *scope, "tileSizeM", "hotTileThreshold", "saltBuckets", "enableSalt"
    )
    corners = store(origins(points, scope).join(settings, list(scope)), "origins-resolved")
    located = lookup_join(points, corners, list(scope), "inner", spread=("x", "y"))
    size = F.col("tileSizeM")
    return located.withColumns(
        {
            "tileX": bin_index(F.col("x") - F.col("originX"), size),
            "tileY": bin_index(F.col("y") - F.col("originY"), size),
        }
    ).withColumn("tileId", pair_id("tileX", "tileY"))


def salt_resolved_tiles(tiled: DataFrame, scope: Sequence[str] = SITE) -> DataFrame:
    """Like `salt_hot_tiles`, with the threshold and buckets that came with the points."""
    keys = [*scope, *TILE]
    counted = tiled.where("enableSalt").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("pointCount"), F.first("hotTileThreshold").alias("limit")
    )
    hot = store(
        counted.where("pointCount >= limit").select(*keys, F.lit(1).alias("_hot")), "hot-tiles"
    )
    flagged = lookup_join(tiled, hot, keys, "left", spread=("x", "y", "z"))
    bucket = F.pmod(F.hash("x", "y", "z"), F.col("saltBuckets")).cast("int")
    return flagged.withColumns(
        {
            "tileSalt": F.when(F.col("_hot") == 1, bucket).otherwise(F.lit(0)),
            "isHotTile": F.coalesce("_hot", F.lit(0)),
        }
    ).drop("_hot")


def tile_counts(tiled: DataFrame, scope: Sequence[str] = SITE) -> DataFrame:
    return tiled.groupBy(*scope, *TILE).agg(F.count(F.lit(1)).alias("pointCount"))


def hot_tiles(
    counts: DataFrame, threshold: int = GridParams.hot_tile_threshold
) -> DataFrame:
    return counts.where(F.col("pointCount") >= threshold)


def salt_hot_tiles(
    tiled: DataFrame, params: GridParams = GridParams(), scope: Sequence[str] = SITE
) -> DataFrame:
    """Mark points of hot tiles and give them a bucket; other points get bucket 0.

    One pass over the points: the stored keys of hot tiles are looked up by tile.
    With salting off both columns are the constant 0."""
    if not params.enable_salt:
        return tiled.withColumns({"tileSalt": F.lit(0), "isHotTile": F.lit(0)})
    keys = [*scope, *TILE]
    hot = store(
        hot_tiles(tile_counts(tiled, scope), params.hot_tile_threshold)
        .select(*keys, F.lit(1).alias("_hot")),
        "hot-tiles",
    )
    flagged = lookup_join(tiled, hot, keys, "left", spread=("x", "y", "z"))
    bucket = salt(("x", "y", "z"), params.salt_buckets)
    return flagged.withColumns(
        {
            "tileSalt": F.when(F.col("_hot") == 1, bucket).otherwise(F.lit(0)),
            "isHotTile": F.coalesce("_hot", F.lit(0)),
        }
    ).drop("_hot")


def salt_by_branches(
    tiled: DataFrame, hot: DataFrame, params: GridParams = GridParams(), scope: Sequence[str] = SITE
) -> DataFrame:
    """The same result written as a semi-join branch plus an anti-join branch.

    Scans the points twice; kept for callers that write the branches apart."""
    keys = [*scope, *TILE]
    branches = {
        "left_semi": (salt(("x", "y", "z"), params.salt_buckets), 1),
        "left_anti": (F.lit(0), 0),
    }
    parts = [
        tiled.join(hot.select(*keys), keys, kind).withColumns(
            {"tileSalt": bucket, "isHotTile": F.lit(flag)}
        )
        for kind, (bucket, flag) in branches.items()
    ]
    return parts[0].unionByName(parts[1])


def stamp_snapshot(tiled: DataFrame) -> DataFrame:
    return tiled.withColumn("snapshotAt", F.current_timestamp())


def salted_tile_ranges(salted: DataFrame, scope: Sequence[str] = SITE) -> DataFrame:
    """Count and height range per tile in two stages, bucket first, then tile."""
    buckets = salted.groupBy(*scope, *TILE, "tileSalt").agg(
        F.count(F.lit(1)).alias("n"), F.min("z").alias("lo"), F.max("z").alias("hi")
    )
    return buckets.groupBy(*scope, *TILE).agg(
        F.sum("n").alias("pointCount"), F.min("lo").alias("minZ"), F.max("hi").alias("maxZ")
    )
