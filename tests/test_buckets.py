"""Bucketed point tables: results of the plain join, points that stay where they are."""

import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from laserfold.operators import class_surface, tile_stats, tiling
from laserfold.operators.tiling import TILE
from laserfold.params import SITE_RUN, GridParams
from laserfold.runtime import Stored, scratch_path, store
from laserfold.sources.buckets import SALT, meet, write_buckets

P = replace(GridParams(), tile_size_m=20.0, cell_size_m=5.0)
KEYS = [*SITE_RUN, *TILE]


@pytest.fixture
def shuffled_joins(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def stored(spark, tiled, task_rows):
    name = f"points_{uuid.uuid4().hex}"
    return write_buckets(
        tiled, name, scratch_path(spark, name), KEYS, ("x", "y", "z"), task_rows=task_rows
    )


def survey(make_points):
    """Two thirds of all points in one tile; classes wanted and unwanted."""
    hot = [(i % 97 * 0.2, i % 89 * 0.2, i * 0.01, (2, 9, 5)[i % 3]) for i in range(400)]
    rest = [(25 + i * 1.7 % 70, i * 0.9 % 60, i, (9, 2)[i % 2]) for i in range(200)]
    return tiling.assign_tiles(make_points(hot + rest), P, SITE_RUN)


@pytest.mark.parametrize("task_rows", [None, 50])
def test_cells_in_place_equal_cells_by_lookup(spark, make_points, task_rows):
    tiled = survey(make_points)
    boxes = tile_stats.tile_boxes(tiled, P, SITE_RUN)
    want = class_surface.class_cells(tiled, store(boxes, "boxes"), P)
    got = class_surface.class_cells_in_place(stored(spark, tiled, task_rows), boxes, P)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []


def test_points_are_not_shuffled(spark, make_points, shuffled_joins, monkeypatch):
    tiled = survey(make_points)
    table = stored(spark, tiled, 50)
    boxes = store(tile_stats.tile_boxes(tiled, P, SITE_RUN), "boxes")

    def plan(frame):
        frame.collect()
        return frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]

    placed = plan(meet(table, boxes.df.select(*KEYS, "minX", "minY")))
    assert "Join" in placed and "Bucketed: true" in placed
    # The boxes alone cross the network.
    assert placed.count("Exchange hashpartitioning") == 1
    monkeypatch.setattr(Stored, "broadcastable", property(lambda self: False))
    looked_up = plan(class_surface.class_cells(tiled, boxes, P))
    assert looked_up.count("Exchange hashpartitioning") >= 2


def test_a_hot_tile_lies_in_several_buckets_and_others_in_one(spark, make_points):
    table = stored(spark, survey(make_points), 50)
    salts = table.rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(SALT).alias("salts"))
    found = {(r.tileX, r.tileY): (r.n, r.salts) for r in salts.collect()}
    assert found[0, 0][0] >= 400 and found[0, 0][1] == -(-found[0, 0][0] // 50)
    assert {s for n, s in found.values() if n <= 50} == {1}
    assert len(table.rows.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_no_points(spark, make_points):
    tiled = survey(make_points).where("1 = 0")
    table = stored(spark, tiled, None)
    boxes = tile_stats.tile_boxes(tiled, P, SITE_RUN)
    assert class_surface.class_cells_in_place(table, boxes, P).count() == 0
    assert table.hot.rows == 0


def test_left_rows_without_partner_stay(spark, make_points):
    table = stored(spark, survey(make_points), 50)
    corner = spark.createDataFrame([("s", "r", 0, 0, 7.0)], "siteId string, ingestRunId string, tileX bigint, tileY bigint, corner double")
    met = meet(table, corner, "left")
    assert met.count() == table.rows.count()
    assert met.where("corner = 7").count() == table.rows.where("tileX = 0 and tileY = 0").count()
