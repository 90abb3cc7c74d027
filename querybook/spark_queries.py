"""Every registered query in its Spark form."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laserfold.functions.events import clip_text, normalize_status
from laserfold.functions.grid import split_pair
from laserfold.operators import (
    class_surface,
    components,
    features,
    ingest,
    jobs,
    sampling,
    surface,
    tile_stats,
    tiling,
    tuning,
    upsert,
)
from laserfold.operators.tiling import TILE
from laserfold.params import ERROR_CODE_CHARS, ERROR_MESSAGE_CHARS, SITE, SITE_RUN, GridParams
from laserfold.plans import products, serving
from laserfold.runtime import scratch_path, store
from laserfold.sources import landing, tables
from laserfold.sources.buckets import write_buckets
from laserfold.streaming import arrivals, job_state
from querybook import inputs

Query = Callable[[SparkSession, str], DataFrame]

# The generated points are sparse, so the size limits are lower than in production.
GRID = GridParams(min_tile_points=500, min_points_used=20)
MASKED = replace(GRID, mostly_water_ratio=0.2)
SALTED = replace(GRID, enable_salt=True, hot_tile_threshold=2_000)
COARSE = replace(GRID, cell_size_m=1.0)
# A box that cuts all four tiles of a site, in world coordinates.
BOX = (1010.0, 2010.0, 1035.0, 2040.0)

registry: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        registry[name] = fn
        return fn

    return add


# ---- inputs -----------------------------------------------------------------


def points(spark, sf):
    return inputs.raw_points(spark, sf)


def tiled(spark, sf, scope=SITE_RUN, params=GRID):
    return tiling.assign_tiles(points(spark, sf), params, scope)


def counts(spark, sf):
    return tiling.tile_counts(tiled(spark, sf), SITE_RUN)


def stats(spark, sf, scope=SITE_RUN):
    return tile_stats.tile_stats(tiled(spark, sf, scope), GRID, scope)


def boxes(spark, sf):
    return tile_stats.tile_boxes(tiled(spark, sf), MASKED, SITE_RUN)


def cells(spark, sf, scope=SITE_RUN):
    return surface.surface_cells(tiled(spark, sf, scope), GRID, scope)


def patches(spark, sf, scope=SITE_RUN):
    return surface.surface_patches(cells(spark, sf, scope), GRID, scope)


def buildings(spark, sf, scope=SITE_RUN):
    return features.building_candidates(patches(spark, sf, scope), GRID, scope)


def wet(spark, sf, scope=SITE_RUN):
    return features.water_cells(cells(spark, sf, scope), GRID, scope)


def bodies(spark, sf, scope=SITE_RUN):
    return features.water_bodies(features.label_water(wet(spark, sf, scope), scope), scope)


def coarse_cells(spark, sf):
    base = tiled(spark, sf)
    tiles = store(tile_stats.tile_boxes(base, COARSE, SITE_RUN), "tile-boxes")
    return class_surface.class_cells(base, tiles, COARSE)


def runs(spark, sf):
    return inputs.load(spark, sf, inputs.RUNS)


def events(spark, sf):
    return inputs.load(spark, sf, inputs.EVENTS)


def day(column):
    return F.date_format(column, "yyyy-MM-dd")


def rounded(df, *names, digits=6):
    """Means of means depend on summation order in the last bits."""
    return df.withColumns({n: F.round(n, digits) for n in names})


# ---- ingest and sinks -------------------------------------------------------


@query("points_clean")
def points_clean(spark, sf):
    clean = ingest.clean_points(inputs.load(spark, sf, inputs.LANDING))
    return clean.withColumn("ingestTime", F.date_format("ingestTime", "yyyy-MM-dd HH:mm:ss"))


@query("ingest_context")
def ingest_context(spark, sf):
    bare = inputs.load(spark, sf, inputs.POINTS).drop("siteId", "ingestRunId", "ingestTime")
    stamped = ingest.add_context(bare, "site_c", "run_9")
    return stamped.withColumn("ingestTime", F.col("ingestTime").isNotNull())


@query("scope_filter")
def scope_filter(spark, sf):
    """The same scope on tables with both, one and none of its columns."""
    base = points(spark, sf)
    layers = {
        "both": base,
        "site": base.drop("ingestRunId"),
        "run": base.drop("siteId"),
        "none": base.drop("siteId", "ingestRunId"),
    }
    found = [
        ingest.scope_filter(df, "site_b", "run_1").groupBy("classification").agg(
            F.lit(name).alias("layer"), F.count(F.lit(1)).alias("points")
        )
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query("column_resolution")
def column_resolution(spark, sf):
    wanted = ["X", "y", "INTENSITY", "z", "intensity", "Classification", "colour", "x"]
    chosen, unknown = ingest.resolve_columns(inputs.load(spark, sf, inputs.POINTS), wanted)
    return chosen.withColumn("unknown", F.lit(",".join(unknown)))


def content(df):
    return df.groupBy(*SITE_RUN).agg(
        F.count(F.lit(1)).alias("points"),
        F.sum("intensity").alias("intensity"),
        F.min("x").alias("minX"),
        F.max("y").alias("maxY"),
        F.sum("z").alias("sumZ"),
        day(F.max("ingestTime")).alias("lastDay"),
    )


@query("raw_append_readback")
def raw_append_readback(spark, sf):
    path = scratch_path(spark, "raw")
    tables.append(points(spark, sf), path)
    return content(landing.read_points(spark, path))


@query("append_check")
def append_check(spark, sf):
    path = scratch_path(spark, "raw")
    tables.append(points(spark, sf), path, compression="zstd")
    return tables.run_and_total_rows(tables.read_table(spark, path))


@query("snapshot_replace")
def snapshot_replace(spark, sf):
    path = scratch_path(spark, "snapshot")
    per_tile = store(counts(spark, sf), "counts").df
    tables.replace_partitions(per_tile.where("ingestRunId = 'run_1'"), path)
    renewed = per_tile.where("ingestRunId = 'run_2' AND siteId = 'site_a'")
    tables.replace_partitions(renewed, path)
    return tables.read_table(spark, path, per_tile.schema)


@query("partition_overwrite")
def partition_overwrite(spark, sf):
    keys = ("siteId", "ingestRunId", "surfaceType")
    path = scratch_path(spark, "by-type")
    base = store(coarse_cells(spark, sf), "cells").df
    tables.replace_partitions(base, path, keys)
    tables.replace_partitions(base.where("surfaceType = 'water' AND pointCountCell > 1"), path, keys)
    return tables.read_table(spark, path, base.schema).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cells"), F.sum("pointCountCell").alias("points")
    )


@query("register_read")
def register_read(spark, sf):
    path = scratch_path(spark, "registered")
    tables.append(points(spark, sf), path)
    tables.register(spark, "laserfold_points", path)
    return spark.sql(
        "SELECT siteId, classification, count(*) AS points FROM laserfold_points "
        "GROUP BY siteId, classification"
    )


@query("stream_ingest")
def stream_ingest(spark, sf):
    folder, table = scratch_path(spark, "landing"), scratch_path(spark, "arrived")
    # Half of the points come by a batch job, the others as files that arrive in turn.
    base, early = points(spark, sf), F.col("return_number") == 1
    tables.append(base.where(early), table)
    files = landing.land(base.where(~early), folder)
    # In two turns.
    stream = arrivals.arriving_points(spark, folder, files_per_trigger=max(1, -(-files // 2)))
    arrivals.append_arrivals(stream, table, scratch_path(spark, "progress")).awaitTermination()
    return content(tables.read_table(spark, table))


@query("clustered_rewrite")
def clustered_rewrite(spark, sf):
    path = scratch_path(spark, "clustered")
    tables.rewrite_clustered(tiled(spark, sf), path, SITE_RUN, spread=("x", "y", "z"))
    return tables.read_table(spark, path).groupBy(*SITE_RUN, "tileX", "tileY").agg(
        F.count(F.lit(1)).alias("points"), F.sum("z").alias("sumZ")
    )


# ---- tiling and skew --------------------------------------------------------


@query("tile_assign")
def tile_assign(spark, sf):
    return tiled(spark, sf).drop("ingestTime", "return_number", "number_of_returns")


@query("tile_counts")
def tile_counts(spark, sf):
    return counts(spark, sf)


@query("tile_id_parse")
def tile_id_parse(spark, sf):
    x, y = split_pair("tileId")
    return tiled(spark, sf).groupBy(*SITE_RUN, x.alias("tx"), y.alias("ty")).agg(
        F.count(F.lit(1)).alias("points")
    )


@query("hot_tiles")
def hot_tiles(spark, sf):
    return tiling.hot_tiles(counts(spark, sf), SALTED.hot_tile_threshold)


@query("salted_points")
def salted_points(spark, sf):
    salted = tiling.salt_hot_tiles(tiled(spark, sf), SALTED, SITE_RUN)
    inside = F.col("tileSalt").between(0, SALTED.salt_buckets - 1)
    return salted.groupBy(*SITE_RUN, "tileX", "tileY", "isHotTile").agg(
        F.count(F.lit(1)).alias("points"),
        F.count_if(inside).alias("saltInRange"),
        F.count_if((F.col("isHotTile") == 0) & (F.col("tileSalt") != 0)).alias("saltOutsideHot"),
    )


@query("salting_off")
def salting_off(spark, sf):
    plain = tiling.salt_hot_tiles(tiled(spark, sf), GRID, SITE_RUN)
    return plain.groupBy(*SITE_RUN, "tileSalt", "isHotTile").agg(F.count(F.lit(1)).alias("points"))


@query("salted_agg")
def salted_agg(spark, sf):
    salted = tiling.salt_hot_tiles(tiled(spark, sf), SALTED, SITE_RUN)
    return tiling.salted_tile_ranges(salted, SITE_RUN)


@query("salt_equivalence")
def salt_equivalence(spark, sf):
    base = tiled(spark, sf)
    hot = tiling.hot_tiles(tiling.tile_counts(base, SITE_RUN), SALTED.hot_tile_threshold)
    marks = [*SITE_RUN, "tileX", "tileY", "tileSalt", "isHotTile"]
    one = tiling.salt_hot_tiles(base, SALTED, SITE_RUN).select(*marks, F.lit(1).alias("side"))
    two = tiling.salt_by_branches(base, hot, SALTED, SITE_RUN).select(*marks, F.lit(-1).alias("side"))
    per_mark = one.unionByName(two).groupBy(*marks).agg(
        F.sum("side").alias("gap"), F.count_if(F.col("side") == 1).alias("n")
    )
    return per_mark.groupBy(*SITE_RUN).agg(
        F.count_if(F.col("gap") != 0).alias("differing"), F.sum("n").alias("points")
    )


@query("tile_distribution")
def tile_distribution(spark, sf):
    return tuning.tile_distribution(counts(spark, sf))


@query("hot_threshold")
def hot_threshold(spark, sf):
    return tuning.recommend_threshold(counts(spark, sf), floor=1_000)


@query("salt_candidates")
def salt_candidates(spark, sf):
    return tuning.salt_candidates(
        tuning.tile_distribution(counts(spark, sf)).select(*SITE_RUN, "maxTilePoints"),
        targets=(50, 500, 1_000, 2_000, 5_000, 50_000),
    )


def choice(spark, sf):
    # Times are an input of the rule; here they follow from points per bucket.
    timed = salt_candidates(spark, sf).withColumn(
        "seconds", F.ceil(F.col("maxTilePoints") / F.col("saltBuckets")) / 10.0
    )
    return tuning.choose_candidate(timed)


@query("choose_salt")
def choose_salt(spark, sf):
    return choice(spark, sf)


def control(spark, sf):
    limits = tuning.recommend_threshold(counts(spark, sf), floor=1_000)
    rows = tuning.control_rows(limits, choice(spark, sf), GRID.tile_size_m)
    return store(rows.where("ingestRunId = 'run_1'"), "control").df


@query("control_append")
def control_append(spark, sf):
    path = scratch_path(spark, "control")
    control(spark, sf).write.mode("append").parquet(path)
    return tables.read_table(spark, path).drop("computedAt")


@query("resolve_params")
def resolve_params(spark, sf):
    first = control(spark, sf).withColumn("computedAt", F.lit("2024-01-01").cast("timestamp"))
    second = first.where("siteId = 'site_b'").withColumns(
        {"computedAt": F.lit("2024-02-01").cast("timestamp"), "targetPointsPerBucket": F.lit(10**9)}
    )
    scopes = points(spark, sf).select(*SITE_RUN).distinct()
    return tuning.resolve_params(scopes, first.unionByName(second))


@query("tiles_by_params")
def tiles_by_params(spark, sf):
    """Every run tiled and salted by its own row of the control table."""
    base = points(spark, sf)
    scopes = store(base.select(*SITE_RUN).distinct(), "scopes").df
    small = F.col("siteId") == "site_b"
    control_table = scopes.where("ingestRunId = 'run_1'").select(
        *SITE_RUN,
        F.when(small, 10.0).otherwise(20.0).alias("tileSizeM"),
        F.when(small, 100).otherwise(2_000).cast("long").alias("hotTileThreshold"),
        F.lit(5).cast("long").alias("targetPointsPerBucket"),
        F.when(small, 3).otherwise(8).cast("long").alias("saltBuckets"),
        F.lit(10).cast("long").alias("maxTilePoints"),
        F.lit("2024-01-01").cast("timestamp").alias("computedAt"),
    )
    resolved = tuning.resolve_params(scopes, control_table, GRID)
    salted = products.tiled_points(base, GRID, SITE_RUN, resolved)
    return salted.groupBy(*SITE_RUN, "tileSizeM", "tileX", "tileY", "isHotTile").agg(
        F.count(F.lit(1)).alias("points"),
        F.count_if(F.col("tileSalt").between(0, F.col("saltBuckets") - 1)).alias("saltInRange"),
    )


@query("discover_run")
def discover_run(spark, sf):
    return ingest.runs_per_site(points(spark, sf))


# ---- tile statistics --------------------------------------------------------


@query("tile_stats")
def tile_stats_query(spark, sf):
    return stats(spark, sf)


@query("site_rollup")
def site_rollup(spark, sf):
    flagged = tile_stats.tile_stats(tiled(spark, sf), MASKED, SITE_RUN)
    return rounded(tile_stats.site_rollup(flagged, SITE_RUN), "avgWaterRatio")


@query("tile_stats_bbox")
def tile_stats_bbox(spark, sf):
    return boxes(spark, sf)


@query("water_mask")
def water_mask(spark, sf):
    return tile_stats.water_mask(boxes(spark, sf), MASKED, SITE_RUN)


@query("tile_mask_join")
def tile_mask_join(spark, sf):
    base = boxes(spark, sf)
    masked = tile_stats.with_mask(base, tile_stats.water_mask(base, MASKED, SITE_RUN), SITE_RUN)
    return masked.select(*SITE_RUN, "tileX", "tileY", "pointCount", "isMostlyWater", "waterRatioMask")


@query("class_distribution")
def class_distribution(spark, sf):
    return tile_stats.class_distribution(points(spark, sf), 20)


@query("range_percentiles")
def range_percentiles(spark, sf):
    return tile_stats.height_range_quantiles(boxes(spark, sf), SITE_RUN)


@query("hottest_tiles")
def hottest_tiles(spark, sf):
    return tile_stats.busiest_tiles(boxes(spark, sf), 5, SITE_RUN).select(
        *SITE_RUN, "tileX", "tileY", "pointCount"
    )


@query("column_span")
def column_span(spark, sf):
    return tile_stats.column_span(counts(spark, sf), SITE_RUN)


@query("snapshot_check")
def snapshot_check(spark, sf):
    stamped = tiling.stamp_snapshot(tiled(spark, sf))
    checked = tile_stats.snapshot_check(stamped)
    return checked.withColumn("snapshotAt", F.col("snapshotAt").isNotNull())


@query("layer_metrics")
def layer_metrics(spark, sf):
    layers = {
        "raw": points(spark, sf),
        "processed": tiled(spark, sf),
        "aggregated": boxes(spark, sf),
        "absent": scratch_path(spark, "absent"),
    }
    found = tables.inspect_layers(spark, layers, site_id="site_a", run_id="run_1").where("readable")
    days = found.withColumns({c: day(c) for c in ("minIngestTime", "maxIngestTime")})
    return days.drop("readable", "schema", "error", "classes", "sample")


@query("layer_inspection")
def layer_inspection(spark, sf):
    """Classes and sizes of samples of every layer; one lacks the asked scope, one cannot be read."""
    layers = {
        "raw": points(spark, sf),
        "processed": tiled(spark, sf),
        "elsewhere": points(spark, sf).where("siteId = 'site_b'"),
        "aggregated": boxes(spark, sf),
        "absent": scratch_path(spark, "absent"),
    }
    found = tables.inspect_layers(spark, layers, site_id="site_a")
    pairs = F.transform("classes", lambda c: F.concat_ws(":", c.classification, c.points))
    return found.select(
        "layer", "readable", "scoped", "rows",
        F.array_join(pairs, ",").alias("classes"),
        F.size("sample").cast("long").alias("sampled"),
    )


@query("clustering_report")
def clustering_report(spark, sf):
    by_run, by_type = "siteId, ingestRunId", "siteId, ingestRunId, surfaceType"
    return tables.clustering_report(
        {
            "points_tiled": (tiled(spark, sf), "tileX, tileY", by_run),
            "tile_stats": (boxes(spark, sf), "tileX, tileY", by_run),
            "surface_cells": (coarse_cells(spark, sf), "tileX, tileY", by_type),
        }
    )


# ---- surface ----------------------------------------------------------------


@query("tile_routing")
def tile_routing(spark, sf):
    eligible = surface.eligible_tiles(stats(spark, sf), GridParams())
    return eligible.select(*SITE_RUN, "tileId", "pointCount", "waterPointRatio")


@query("surface_cells")
def surface_cells(spark, sf):
    return cells(spark, sf)


@query("surface_cells_routed")
def surface_cells_routed(spark, sf):
    """Routed by a stored tile-statistics table, with the production point limit."""
    base = tiled(spark, sf)
    table = store(tile_stats.tile_stats(base, GRID, SITE_RUN), "stats").df
    return surface.surface_cells(base, GridParams(), SITE_RUN, stats=table)


@query("cell_summary")
def cell_summary(spark, sf):
    return surface.cell_summary(cells(spark, sf), SITE_RUN)


@query("surface_patches")
def surface_patches(spark, sf):
    return rounded(patches(spark, sf), "meanZ")


@query("patches_of_known_tiles")
def patches_of_known_tiles(spark, sf):
    known = stats(spark, sf).where("waterPointCount > 0")
    found = surface.surface_patches(
        cells(spark, sf), GRID, SITE_RUN, stats=known, weighted=True
    )
    return rounded(found, "meanZ", "weightedMeanZ")


@query("patch_summary")
def patch_summary(spark, sf):
    return surface.patch_summary(patches(spark, sf), SITE_RUN)


@query("class_surface_cells")
def class_surface_cells(spark, sf):
    return coarse_cells(spark, sf).drop("cellMinX", "cellMinY", "cellMaxX", "cellMaxY")


@query("class_surface_cells_in_place")
def class_surface_cells_in_place(spark, sf):
    keys = [*SITE_RUN, *TILE]
    base = tiled(spark, sf).select(*keys, "x", "y", "z", "classification")
    name = f"tiled_points_{uuid.uuid4().hex}"
    # A tile with a thousand points is dealt to several buckets here.
    stored = write_buckets(base, name, scratch_path(spark, name), keys, ("x", "y", "z"), task_rows=1000)
    boxes = tile_stats.tile_boxes(stored.rows, COARSE, SITE_RUN)
    found = class_surface.class_cells_in_place(stored, boxes, COARSE)
    return found.drop("cellMinX", "cellMinY", "cellMaxX", "cellMaxY")


@query("cell_bbox")
def cell_bbox(spark, sf):
    return coarse_cells(spark, sf).drop("z", "pointCountCell")


@query("tile_surface_summary")
def tile_surface_summary(spark, sf):
    return rounded(class_surface.tile_surface_summary(coarse_cells(spark, sf), COARSE), "avgZ")


@query("top_tiles")
def top_tiles(spark, sf):
    return class_surface.candidate_tiles(boxes(spark, sf), 3)


@query("top_patches")
def top_patches(spark, sf):
    summary = class_surface.tile_surface_summary(coarse_cells(spark, sf), COARSE)
    return summary.orderBy(F.desc("pointCountUsed"), "surfaceId").limit(20).select(
        "surfaceId", "pointCountUsed", "cellCount"
    )


# ---- features ---------------------------------------------------------------


@query("ground_reference")
def ground_reference(spark, sf):
    return features.ground_reference(patches(spark, sf), SITE_RUN)


@query("building_candidates")
def building_candidates(spark, sf):
    return rounded(buildings(spark, sf), "meanZ", "heightAboveGround")


@query("building_by_site")
def building_by_site(spark, sf):
    return features.count_candidates(buildings(spark, sf), SITE_RUN)


@query("water_cells")
def water_cells(spark, sf):
    return wet(spark, sf)


@query("cell_edges4")
def cell_edges4(spark, sf):
    return components.cell_edges(wet(spark, sf), SITE_RUN, "globalCellX", "globalCellY", 4)


@query("cell_edges8")
def cell_edges8(spark, sf):
    return components.cell_edges(wet(spark, sf), SITE_RUN, "globalCellX", "globalCellY", 8)


@query("water_components")
def water_components(spark, sf):
    return features.label_water(wet(spark, sf), SITE_RUN).select(
        *SITE_RUN, "vertexId", "waterBodyId"
    )


@query("water_components8")
def water_components8(spark, sf):
    return features.label_water(wet(spark, sf), SITE_RUN, neighbours=8).select(
        *SITE_RUN, "vertexId", "waterBodyId"
    )


@query("water_bodies")
def water_bodies(spark, sf):
    return rounded(bodies(spark, sf), "meanZ")


@query("water_totals")
def water_totals(spark, sf):
    return features.water_totals(bodies(spark, sf), SITE_RUN)


@query("water_top10")
def water_top10(spark, sf):
    return features.largest_water(bodies(spark, sf), 10, SITE_RUN)


@query("published_tables")
def published_tables(spark, sf):
    """All products written stage by stage, a snapshot per run: rows and a total of each."""
    written = products.publish(
        spark, points(spark, sf), scratch_path(spark, "lake"), GRID, "empty", SITE_RUN
    )
    measure = {
        "points_tiled": "intensity",
        "tile_stats": "pointCount",
        "surface_cells": "pointCount",
        "surface_patches": "pointsUsed",
        "building_candidates": "pointsUsed",
        "water_bodies": "cellCount",
    }
    counted = [
        df.groupBy(*SITE_RUN).agg(
            F.lit(name).alias("tableName"),
            F.count(F.lit(1)).alias("rows"),
            F.sum(measure[name]).cast("long").alias("total"),
        )
        for name, df in written.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@query("republished_water")
def republished_water(spark, sf):
    """Water bodies after site_b was published again with its water gone: the others keep theirs."""
    root, all_points = scratch_path(spark, "lake"), points(spark, sf)
    products.publish(spark, all_points, root, GRID, "empty", SITE_RUN)
    dry = all_points.where("siteId = 'site_b'").withColumn(
        "classification", F.when(F.col("classification") == 9, 2).otherwise(F.col("classification"))
    )
    # The rows of one site, taken out of all points once; the build reads them several times.
    renewed = store(dry, "renewed").df
    written = products.publish(spark, renewed, root, GRID, "empty", SITE_RUN)
    return rounded(written["water_bodies"].drop("computedAt"), "meanZ")


# ---- sampling ---------------------------------------------------------------


@query("voxel_downsample")
def voxel_downsample(spark, sf):
    return sampling.voxel_downsample(tiled(spark, sf), GRID, SITE_RUN)


@query("fps_sizes")
def fps_sizes(spark, sf):
    voxels = sampling.voxel_downsample(tiled(spark, sf), GRID, SITE_RUN)
    return sampling.farthest_points(voxels, GRID, SITE_RUN).groupBy(*SITE_RUN, "tileId").agg(
        F.count(F.lit(1)).alias("points")
    )


@query("fps_first_points")
def fps_first_points(spark, sf):
    voxels = sampling.voxel_downsample(tiled(spark, sf), GRID, SITE_RUN)
    return sampling.farthest_points(voxels, replace(GRID, sample_points=4), SITE_RUN)


@query("normalized_points")
def normalized_points(spark, sf):
    voxels = sampling.voxel_downsample(tiled(spark, sf), GRID, SITE_RUN)
    unit = sampling.normalize(voxels, [*SITE_RUN, "tileId"])
    return rounded(unit, "x", "y", "z", digits=5)


@query("tensor_samples")
def tensor_samples(spark, sf):
    return sampling.tensors(tiled(spark, sf), GRID, SITE_RUN)


@query("tensor_first_points")
def tensor_first_points(spark, sf):
    """The tensors of samples of four points, a row per point."""
    made = sampling.tensors(tiled(spark, sf), replace(GRID, sample_points=4), SITE_RUN)
    points_of = made.select(*SITE_RUN, "tileId", F.posexplode("tensor").alias("seq", "p"))
    return points_of.select(
        *SITE_RUN,
        "tileId",
        "seq",
        *(F.round(F.col("p")[i].cast("double"), 4).alias(a) for i, a in enumerate("xyz")),
    )


# ---- serving ----------------------------------------------------------------


# Builds stamp their products with the time; here it is fixed, so that SQL can repeat it.
BUILT_AT = "2024-01-01 00:00:00"


def stamped(df):
    return df.withColumn("computedAt", F.lit(BUILT_AT))


def served(spark, sf):
    return stats(spark, sf, SITE).drop("tileX", "tileY")


TILE_PAGES = {
    "list_tiles_id": dict(order="tileId"),
    "list_tiles_points": dict(order="pointCountDesc"),
    "list_tiles_water": dict(order="waterRatioDesc"),
    "list_tiles_p99": dict(order="heightP99Desc"),
    "list_tiles_relief": dict(order="reliefDesc", min_points=100),
    "list_tiles_paged": dict(order="pointCountDesc", skip_mostly_water=True, limit=2, offset=1),
}

for _name, _page in TILE_PAGES.items():
    registry[_name] = lambda spark, sf, page=_page: serving.list_tiles(
        served(spark, sf), "site_a", **page
    )


@query("list_tiles_recent")
def list_tiles_recent(spark, sf):
    newest = tiled(spark, sf, SITE).groupBy("siteId", "tileId").agg(
        F.count(F.lit(1)).alias("pointCount"), F.max("gps_time").alias("computedAt")
    )
    return serving.list_tiles(newest, "site_a", order="computedAtDesc", limit=3)


@query("list_water")
def list_water(spark, sf):
    return rounded(
        serving.list_water(bodies(spark, sf, SITE), "site_a", min_area_m2=1.0, limit=20), "meanZ"
    )


@query("water_detail")
def water_detail(spark, sf):
    # The id of the lake is fixed by its position in the generated points.
    return rounded(serving.water_by_id(bodies(spark, sf, SITE), "site_a", LAKE_ID), "meanZ")


LAKE_ID = 10 * (1 << 32) + 62


@query("list_buildings")
def list_buildings(spark, sf):
    found = rounded(buildings(spark, sf, SITE), "meanZ", "heightAboveGround")
    return serving.list_buildings(found, "site_a", min_height=2.5, limit=30)


@query("list_buildings_range")
def list_buildings_range(spark, sf):
    found = rounded(buildings(spark, sf, SITE), "meanZ", "heightAboveGround")
    return serving.list_buildings(found, "site_a", tile_id="1_0", order="heightRangeDesc", limit=10)


@query("building_detail")
def building_detail(spark, sf):
    found = rounded(buildings(spark, sf, SITE), "meanZ", "heightAboveGround")
    return serving.building_by_id(found, "site_a", "1_0", "1_0|1_1")


@query("run_latest")
def run_latest(spark, sf):
    return serving.latest_runs(runs(spark, sf))


@query("run_by_id")
def run_by_id(spark, sf):
    return serving.run_by_id(runs(spark, sf), "site_a", "100")


@query("tiles_json")
def tiles_json(spark, sf):
    page = serving.list_tiles(stamped(served(spark, sf)), "site_a", order="tileId", limit=None)
    texts = serving.as_payload(page, serving.TILE_PAYLOAD)
    fields = (
        "siteId string, tileId string, pointCount bigint, z_p50 double, z_p95 double, z_p99 double, "
        "waterPointRatio double, isMostlyWater boolean, computedAt string"
    )
    return texts.select(F.from_json("payload", fields).alias("p")).select("p.*")


@query("water_json")
def water_json(spark, sf):
    page = serving.list_water(stamped(bodies(spark, sf, SITE)), "site_a", limit=None)
    texts = serving.as_payload(page, serving.WATER_PAYLOAD)
    fields = (
        "waterBodyId bigint, areaM2 double, cellCount bigint, meanZ double, minZ double, maxZ double, "
        "bboxMinCellX int, bboxMinCellY int, bboxMaxCellX int, bboxMaxCellY int, computedAt string"
    )
    return rounded(texts.select(F.from_json("payload", fields).alias("p")).select("p.*"), "meanZ")


@query("buildings_json")
def buildings_json(spark, sf):
    page = serving.list_buildings(stamped(buildings(spark, sf, SITE)), "site_b")
    texts = serving.as_payload(page, serving.BUILDING_PAYLOAD)
    fields = (
        "buildingCandidateId string, tileId string, heightAboveGround double, heightRange double, "
        "pointsUsed bigint, cellCount bigint, minZ double, meanZ double, maxZ double, computedAt string"
    )
    found = texts.select(F.from_json("payload", fields).alias("p")).select("p.*")
    return rounded(found, "meanZ", "heightAboveGround")


@query("run_json")
def run_json(spark, sf):
    texts = serving.as_payload(serving.latest_runs(runs(spark, sf)), serving.RUN_PAYLOAD)
    fields = (
        "siteId string, runId string, status string, startedAt string, finishedAt string, "
        "errorMessage string, producedSnapshotAt string"
    )
    return texts.select(F.from_json("payload", fields).alias("p")).select("p.*")


@query("tile_range")
def tile_range(spark, sf):
    base = tiling.tile_counts(tiled(spark, sf, SITE), SITE)
    return serving.in_tile_range(base, serving.tile_range(BOX, (1000.0, 2000.0), 25.0))


def boxed(spark, sf, rows, box, extent=("minX", "minY", "maxX", "maxY")):
    """A box query on a written, clustered table with the origins of its runs."""
    path = scratch_path(spark, "boxed")
    tables.rewrite_clustered(rows, path, SITE_RUN)
    corners = store(tiling.origins(points(spark, sf), SITE_RUN), "origins").df
    table = tables.read_table(spark, path, rows.schema)
    return serving.in_box(table, box, extent, corners, 25.0, COARSE.cell_size_m, SITE_RUN)


# Boxes inside one tile and across the border of two, in world coordinates.
ONE_TILE_BOX = (1004.5, 2004.5, 1007.0, 2008.0)
BORDER_BOX = (1025.1, 2010.0, 1025.3, 2014.0)
CELL_EXTENT = ("cellMinX", "cellMinY", "cellMaxX", "cellMaxY")
CELL_RESULT = (*SITE_RUN, "surfaceType", "tileX", "tileY", "cellX", "cellY", "z")


@query("bbox_patches")
def bbox_patches(spark, sf):
    summary = class_surface.tile_surface_summary(coarse_cells(spark, sf), COARSE)
    hits = boxed(spark, sf, summary, BOX)
    return hits.select("surfaceId", "surfaceType", "tileX", "tileY", "minX", "minY", "maxX", "maxY")


@query("bbox_cells")
def bbox_cells(spark, sf):
    return boxed(spark, sf, coarse_cells(spark, sf), BOX, CELL_EXTENT).select(*CELL_RESULT)


@query("bbox_cells_one_tile")
def bbox_cells_one_tile(spark, sf):
    found = boxed(spark, sf, coarse_cells(spark, sf), ONE_TILE_BOX, CELL_EXTENT)
    return found.select(*CELL_RESULT)


@query("bbox_cells_border")
def bbox_cells_border(spark, sf):
    return boxed(spark, sf, coarse_cells(spark, sf), BORDER_BOX, CELL_EXTENT).select(*CELL_RESULT)


# ---- keyed merges -----------------------------------------------------------


@query("keyed_upsert")
def keyed_upsert(spark, sf):
    locks, asked = (inputs.load(spark, sf, t) for t in (inputs.LOCKS, inputs.CLAIMS))
    return upsert.claims(locks, asked, F.lit("2001-06-01"))


@query("conditional_delete")
def conditional_delete(spark, sf):
    locks, done = (inputs.load(spark, sf, t) for t in (inputs.LOCKS, inputs.RELEASES))
    return upsert.conditional_delete(locks, done, ["siteId", "lockedBy"])


# ---- jobs -------------------------------------------------------------------


@query("job_first_create")
def job_first_create(spark, sf):
    created = jobs.first_creates(events(spark, sf))
    return created.withColumn("createdAt", F.date_format("createdAt", "yyyy-MM-dd HH:mm:ss"))


@query("session_lookup")
def session_lookup(spark, sf):
    made = jobs.first_creates(inputs.load(spark, sf, inputs.ORDER_CREATES))
    return jobs.latest_session(
        made.withColumn("status", F.lit("CREATED")), inputs.load(spark, sf, inputs.UPLOADS)
    )


@query("upload_complete")
def upload_complete(spark, sf):
    return jobs.complete_uploads(
        inputs.load(spark, sf, inputs.UPLOAD_STATE), inputs.load(spark, sf, inputs.COMPLETIONS)
    )


def to_second(states):
    return states.withColumn("updatedAt", F.date_format("updatedAt", "yyyy-MM-dd HH:mm:ss"))


@query("job_state_fold")
def job_state_fold(spark, sf):
    return to_second(jobs.fold_states(events(spark, sf)))


@query("job_last_event")
def job_last_event(spark, sf):
    return jobs.fold_last_wins(events(spark, sf))


@query("job_counts")
def job_counts(spark, sf):
    return jobs.job_counts(jobs.fold_states(events(spark, sf)))


@query("latest_job")
def latest_job(spark, sf):
    newest = jobs.latest_job(jobs.first_creates(events(spark, sf)))
    return newest.withColumn("createdAt", F.date_format("createdAt", "yyyy-MM-dd HH:mm:ss"))


@query("payload_fields")
def payload_fields(spark, sf):
    return jobs.parse_payloads(inputs.load(spark, sf, inputs.PAYLOADS)).drop("payload")


@query("status_normalize")
def status_normalize(spark, sf):
    return inputs.load(spark, sf, inputs.STATUS_TEXTS).withColumn("outcome", normalize_status("raw"))


@query("event_match")
def event_match(spark, sf):
    return jobs.match_jobs(
        inputs.load(spark, sf, inputs.WEBHOOKS), inputs.load(spark, sf, inputs.JOBS_BY_RUN)
    )


@query("text_truncate")
def text_truncate(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.select(
        "doc_id", clip_text("source", ERROR_CODE_CHARS).alias("code"), clip_text("text", ERROR_MESSAGE_CHARS).alias("message")
    )


def arriving(spark, sf):
    """A stream of all events, in shuffled order and three micro-batches."""
    folder = scratch_path(spark, "events")
    mixed = events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    # As many files as the cluster writes at once, so that no task writes a third of all.
    each = -(-spark.sparkContext.defaultParallelism // 3)
    mixed.repartition(3 * each, F.xxhash64("event_id")).write.parquet(folder)
    return job_state.arriving_events(spark, folder, files_per_trigger=each)


@query("stream_job_state")
def stream_job_state(spark, sf):
    states = scratch_path(spark, "states")
    progress = scratch_path(spark, "progress")
    job_state.run_states(arriving(spark, sf), states, progress).awaitTermination()
    return to_second(job_state.current_states(spark, states))


@query("stream_first_create")
def stream_first_create(spark, sf):
    out = scratch_path(spark, "created")
    progress = scratch_path(spark, "progress")
    sink = job_state.merge_first_creates(out)
    job_state.run_available(arriving(spark, sf), sink, progress).awaitTermination()
    created = job_state.current_creates(spark, out)
    return created.withColumn("createdAt", F.date_format("createdAt", "yyyy-MM-dd HH:mm:ss"))
