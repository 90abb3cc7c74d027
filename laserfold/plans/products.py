"""From raw points to all derived products, lazily or as published tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from laserfold.operators import features, surface, tile_stats, tiling
from laserfold.operators.ingest import clean_points, runs_per_site
from laserfold.params import SITE, GridParams
from laserfold.runtime import setting, store
from laserfold.sources import snapshots
from laserfold.sources.tables import cluster, read_table, replace_partitions

# Groups that a task folds in its hash table before it sorts its rows instead. Sketches keep
# no more than the values of the task's scan split, so the table is bounded by that as well.
SKETCH_GROUPS = "32768"
SKETCH_SETTING = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"


def tiled_points(
    points: DataFrame,
    params: GridParams = GridParams(),
    scope: Sequence[str] = SITE,
    resolved: DataFrame | None = None,
) -> DataFrame:
    """Clean points with tile and salt columns, by one set of parameters or each scope's own."""
    if resolved is not None:
        own = tiling.assign_resolved_tiles(clean_points(points), resolved, scope)
        return tiling.salt_resolved_tiles(own, scope)
    tiled = tiling.assign_tiles(clean_points(points), params, scope)
    return tiling.salt_hot_tiles(tiled, params, scope)


def surface_products(
    points: DataFrame, params: GridParams = GridParams(), scope: Sequence[str] = SITE
) -> dict[str, DataFrame]:
    """Lazy products up to the building candidates; nothing runs but the origins."""
    tiled = tiled_points(points, params, scope)
    cells = surface.surface_cells(tiled, params, scope)
    patches = surface.surface_patches(cells, params, scope)
    return {
        "points_tiled": tiled,
        "tile_stats": tile_stats.tile_stats(tiled, params, scope),
        "surface_cells": cells,
        "surface_patches": patches,
        "building_candidates": features.building_candidates(patches, params, scope),
    }


def _guard(
    df: DataFrame, scopes: set[tuple], scope: Sequence[str], message: str, on_empty: str
) -> None:
    """Every asked scope, and no other, must have rows in `df`; names those that fail.

    At most one row per site (and run) reaches the driver."""
    found = {tuple(r) for r in df.select(*scope).distinct().toLocalIterator()}
    strange = found - scopes
    if strange:
        raise RuntimeError(f"rows of other scopes in the snapshot: {sorted(strange, key=str)}")
    if on_empty == "raise" and scopes - found:
        raise RuntimeError(f"{message}: {sorted(scopes - found, key=str)}")


def publish(
    spark: SparkSession,
    points: DataFrame,
    root: str,
    params: GridParams = GridParams(),
    on_empty: str = "raise",
    scope: Sequence[str] = SITE,
    resolved: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Build and write every product of all sites in `points`, stage by stage.

    Each stage reads the table the stage before has written, as separate jobs of a
    workflow would; a lost executor costs tasks of one stage only. Tables are
    partitioned by scope (not by tile: that would make one file per tile) and
    clustered by tile, so tile filters skip row groups. Every product carries the time
    of this build in `computedAt`.

    A snapshot is all of a site, or with the longer scope of a site's ingest run, and
    replaces all that the tables held of it, also where the new one has no rows. With
    the short scope a site with several runs is refused before anything is written.
    Every scope must have points, eligible tiles and (with `on_empty="raise"`) water.
    All tables are written aside; only when every check has passed do the scopes' pointers
    switch to this build, so a failed one leaves what was published. The build that a
    scope showed before stays on disk for readers that are under way; older ones go.
    With `resolved` (see `tuning.resolve`) each scope is tiled by its own parameters."""
    if on_empty not in ("raise", "empty"):
        raise ValueError("on_empty must be 'raise' or 'empty'")
    if tuple(scope) == SITE:
        mixed = runs_per_site(points).where("runs > 1").first()
        if mixed is not None:
            raise ValueError(
                f"site {mixed['siteId']} has {mixed['runs']} ingest runs, expected one"
            )
    scopes = {tuple(r) for r in points.select(*scope).distinct().toLocalIterator()}
    if not scopes and on_empty == "raise":
        raise RuntimeError("no points to process")
    at = F.lit(spark.sql("SELECT current_timestamp()").first()[0])
    build, before = snapshots.new_build(), snapshots.current(spark, root)
    schemas: dict[str, StructType] = {}

    def save(name: str, df: DataFrame, clustered: bool = True, spread: Sequence[str] = ()) -> DataFrame:
        df = df.withColumn("computedAt", at)
        df = cluster(df, scope, spread) if clustered else store(df, name).df
        path = snapshots.build_path(root, name, build)
        replace_partitions(df, path, scope, ordered=clustered)
        schemas[name] = df.schema
        return read_table(spark, path, df.schema).drop("computedAt")

    tiled = save(
        "points_tiled",
        tiling.stamp_snapshot(tiled_points(points, params, scope, resolved)),
        spread=("x", "y", "z"),
    )
    _guard(tiled, scopes, scope, "no points to process", on_empty)
    stats = save("tile_stats", tile_stats.tile_stats(tiled, params, scope))
    _guard(
        surface.eligible_tiles(stats, params),
        scopes,
        scope,
        f"no tile below water ratio {params.skip_water_ratio} with {params.min_tile_points} points",
        on_empty,
    )
    # The points are clustered by tile, so a task meets the cells of few tiles.
    with setting(spark, SKETCH_SETTING, SKETCH_GROUPS):
        cells = save("surface_cells", surface.surface_cells(tiled, params, scope, stats=stats))
    patches = save("surface_patches", surface.surface_patches(cells, params, scope, stats=stats))
    save(
        "building_candidates", features.building_candidates(patches, params, scope), clustered=False
    )
    wet = features.water_cells(cells, params, scope)
    _guard(wet, scopes, scope, f"no water cell at ratio {params.water_cell_ratio}", on_empty)
    save("water_bodies", features.water_bodies(features.label_water(wet, scope), scope), clustered=False)
    snapshots.switch(spark, root, sorted(scopes, key=str), build)
    snapshots.drop_builds(spark, root, schemas, before.values())
    shown = snapshots.current(spark, root)
    return {n: snapshots.open_table(spark, root, n, s, scope, shown) for n, s in schemas.items()}
