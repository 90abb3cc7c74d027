from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from laserfold import runtime
from laserfold.functions.grid import morton, split_pair
from laserfold.operators import surface, tile_stats, tiling, tuning
from laserfold.params import SITE, SITE_RUN, GridParams

P = GridParams(min_tile_points=1, enable_salt=True, hot_tile_threshold=3, salt_buckets=4)


def tiles_of(df):
    return [(r["tileX"], r["tileY"]) for r in df.orderBy("x", "y").collect()]


def test_borders_and_negative_coordinates(make_points):
    tiled = tiling.assign_tiles(
        make_points([(-30, -10, 0, 2), (-5, 15, 0, 2), (-5.001, 14.999, 0, 2), (20, -10, 0, 2)]), P
    )
    assert tiles_of(tiled) == [(0, 0), (0, 0), (1, 1), (2, 0)]
    assert {r["tileId"] for r in tiled.collect()} == {"0_0", "1_1", "2_0"}


def test_sites_have_their_own_origin(make_points):
    both = make_points([(0, 0, 0, 2), (60, 0, 0, 2)]).unionByName(
        make_points([(60, 0, 0, 2)], site="t")
    )
    found = {(r["siteId"], r["x"]): r["tileX"] for r in tiling.assign_tiles(both, P).collect()}
    assert found == {("s", 0.0): 0, ("s", 60.0): 2, ("t", 60.0): 0}


def test_lookup_beyond_the_broadcast_bound_gives_the_same(spark, make_points, monkeypatch):
    points = make_points([(i % 70, i % 31, i, 2) for i in range(200)])
    plain = tiling.salt_hot_tiles(tiling.assign_tiles(points, P), P).drop("ingestTime")
    want = sorted(map(tuple, plain.collect()))
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(runtime.Stored, "broadcastable", property(lambda self: False))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = tiling.salt_hot_tiles(tiling.assign_tiles(points, P), P).drop("ingestTime")
        assert "SortMergeJoin" in spread._jdf.queryExecution().toString()
        assert sorted(map(tuple, spread.select(plain.columns).collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salt_spreads_only_hot_tiles(make_points):
    points = make_points([(i / 100, 0, i, 2) for i in range(50)] + [(30, 0, 0, 2)])
    salted = tiling.salt_hot_tiles(tiling.assign_tiles(points, P), P)
    hot = salted.where("isHotTile = 1")
    assert hot.count() == 50 and hot.select("tileSalt").distinct().count() > 1
    assert salted.where("isHotTile = 0").select("tileSalt").distinct().first()[0] == 0


def test_cells_do_not_depend_on_partitions_and_keep_points(make_points):
    points = make_points([(i * 0.37 % 60, i * 0.53 % 40, i % 9, 9 if i % 4 == 0 else 2) for i in range(600)])
    results = []
    for parts in (1, 7):
        cells = surface.surface_cells(tiling.assign_tiles(points.repartition(parts), P), P)
        results.append(sorted(map(str, cells.collect())))
    assert results[0] == results[1]
    patches = surface.surface_patches(cells, P)
    assert cells.agg(F.sum("pointCount")).first()[0] == 600
    assert patches.agg(F.sum("pointsUsed"), F.sum("cellCount")).first()[:] == (600, len(results[0]))


def test_routing_by_table_equals_routing_by_cells(make_points):
    params = replace(P, min_tile_points=50, skip_water_ratio=0.5)
    points = make_points(
        [(i * 0.2 % 25, 1, i, 9) for i in range(100)]
        + [(30 + i * 0.1 % 20, 1, i, 2) for i in range(100)]
        + [(60, 1, 1, 2)]
    )
    tiled = tiling.assign_tiles(points, params)
    stats = tile_stats.tile_stats(tiled, params)
    one = sorted(map(str, surface.surface_cells(tiled, params).collect()))
    two = sorted(map(str, surface.surface_cells(tiled, params, stats=stats).collect()))
    assert one == two and all("tileX=1" in row for row in one)


def test_small_tile_table_filters_points_before_the_aggregate(spark, make_points, monkeypatch):
    tiled = tiling.assign_tiles(make_points([(1, 1, 1, 2)]), P)
    stats = tile_stats.tile_stats(tiled, P)

    def plan():
        cells = surface.surface_cells(tiled, P, stats=stats)
        assert cells.count() == 1
        return cells._jdf.queryExecution().optimizedPlan().toString()

    assert plan().index("Aggregate") < plan().index("LeftSemi")
    monkeypatch.setattr(runtime.Stored, "broadcastable", property(lambda self: False))
    assert plan().index("LeftSemi") < plan().index("Aggregate")


def test_clamp_pulls_border_points_in(make_points):
    params = GridParams(tile_size_m=0.3, cell_size_m=0.1, min_tile_points=1)
    points = make_points([(0.3 * i - 1e-17, 0, 0, 2) for i in range(40)] + [(0, 0, 0, 2)])
    cells = surface.index_cells(tiling.assign_tiles(points, params), params, clamp=True)
    assert cells.where("cellX < 0 OR cellX > 2").count() == 0


def test_eligible_window_adds_one_shuffle_only(make_points):
    tiled = tiling.assign_tiles(make_points([(1, 1, 1, 2)]), P)
    patches = surface.surface_patches(surface.surface_cells(tiled, P), P)
    plan = patches._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "CartesianProduct" not in plan and "Python" not in plan


def test_quantiles_pick_ranked_values(make_points):
    points = make_points([(1, 1, z, 2) for z in range(1, 21)])
    row = tile_stats.tile_stats(tiling.assign_tiles(points, P), P).first()
    assert (row["z_p50"], row["z_p95"], row["z_p99"], row["waterPointRatio"]) == (10.0, 19.0, 20.0, 0.0)


def test_mask_absent_gives_defaults(make_points):
    boxes = tile_stats.tile_boxes(tiling.assign_tiles(make_points([(1, 1, 1, 9)]), P), P)
    row = tile_stats.with_mask(boxes, None).first()
    assert (row["isMostlyWater"], row["waterRatioMask"]) == (0, 0.0)
    mask = tile_stats.water_mask(boxes, P)
    assert tile_stats.with_mask(boxes, mask).first()["isMostlyWater"] == 1


def test_empty_input_messages(spark, make_points):
    nothing = make_points([(1, 1, 1, 2)]).where("false")
    with pytest.raises(RuntimeError, match="no rows for 0.7"):
        runtime.require_rows(nothing, "no rows for 0.7")
    assert runtime.require_rows(nothing, "-", on_empty="empty").count() == 0
    with pytest.raises(ValueError):
        runtime.require_rows(nothing, "-", on_empty="maybe")


def test_morton_and_tile_id(spark):
    row = spark.range(1).select(
        morton(F.lit(5), F.lit(3)).alias("m"), morton(F.lit(1 << 20), F.lit(1 << 20)).alias("far"), *(c.alias(n) for c, n in zip(split_pair(F.lit("12_-3")), "xy"))
    ).first()
    assert row["m"] == int("011011", 2) and row["far"] == 3 << 40
    assert (row["x"], row["y"]) == (12, -3)


def test_resolve_params(spark):
    scopes = spark.createDataFrame([("s", "r"), ("t", "q")], "siteId string, ingestRunId string")
    control = spark.createDataFrame(
        [
            ("s", "r", 10.0, 5, 7, 3, 6, "2024-01-01"),
            ("s", "r", 20.0, 5, 7, 3, 7, "2024-01-02"),
        ],
        "siteId string, ingestRunId string, tileSizeM double, hotTileThreshold long, "
        "targetPointsPerBucket long, saltBuckets long, maxTilePoints long, computedAt string",
    )
    found = {r["siteId"]: r for r in tuning.resolve_params(scopes, control).collect()}
    assert found["s"]["tileSizeM"] == 20.0 and found["s"]["enableSalt"]
    assert found["s"]["paramSource"] == "control-table"
    assert found["t"]["tileSizeM"] == 25.0 and found["t"]["paramSource"] == "code-defaults"
    with pytest.raises(ValueError):
        tuning.resolve_params(scopes, control, allow_fallback=False)
    with pytest.raises(ValueError):
        tuning.resolve_params(scopes, None, allow_fallback=False)
    off = tuning.resolve_params(scopes, control, use_control=False)
    assert {r["paramSource"] for r in off.collect()} == {"code-defaults"}


def test_choice_rule(spark):
    timed = spark.createDataFrame(
        [("s", 50, 4, 10.0), ("s", 60, 3, 120.0), ("s", 70, 2, 121.0), ("t", 50, 4, 300.0), ("t", 60, 3, 200.0)],
        "siteId string, targetPointsPerBucket long, saltBuckets long, seconds double",
    )
    found = {r["siteId"]: r["targetPointsPerBucket"] for r in tuning.choose_candidate(timed, SITE).collect()}
    assert found == {"s": 60, "t": 60}


def test_scope_by_run_keeps_runs_apart(make_points):
    both = make_points([(0, 0, 0, 2)]).unionByName(make_points([(40, 0, 0, 2)], run="q"))
    assert {r["tileX"] for r in tiling.assign_tiles(both, P, SITE_RUN).collect()} == {0}
    assert {r["tileX"] for r in tiling.assign_tiles(both, P, SITE).collect()} == {0, 1}
