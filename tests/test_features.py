import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from laserfold import runtime
from laserfold.operators import components, features, surface, tiling
from laserfold.params import SITE, GridParams
from laserfold.plans import products, serving
from laserfold.sources import snapshots

P = GridParams(min_tile_points=1, min_points_used=1)


def brute_components(cells, neighbours):
    """Flood fill over a set of (site, x, y)."""
    steps = components.ALL_AROUND[neighbours]
    label, todo = {}, set(cells)
    while todo:
        start = min(todo)
        todo.discard(start)
        group, stack = [start], [start]
        while stack:
            s, x, y = stack.pop()
            for dx, dy in steps:
                near = (s, x + dx, y + dy)
                if near in todo:
                    todo.discard(near)
                    group.append(near)
                    stack.append(near)
        key = min(x * (1 << 32) + y for _, x, y in group)
        label.update((member, key) for member in group)
    return label


def labels(spark, cells, neighbours=4):
    df = spark.createDataFrame(list(cells), "siteId string, gx int, gy int")
    found = components.grid_components(df, SITE, "gx", "gy", "c", neighbours)
    return {(r["siteId"], r["gx"], r["gy"]): r["c"] for r in found.collect()}


@pytest.mark.parametrize("neighbours", [4, 8])
def test_components_match_flood_fill(spark, neighbours):
    rng = random.Random(5)
    cells = {
        (site, x, y) for site in "ab" for x in range(-40, 160) for y in range(-70, 130) if rng.random() < 0.5
    }
    assert labels(spark, cells, neighbours) == brute_components(cells, neighbours)


def test_ring_spiral_and_diagonal(spark):
    ring = {("r", x, y) for x in range(150) for y in range(150) if x in (0, 149) or y in (0, 149)}
    spiral = set()
    x = y = 0
    for turn, length in enumerate(range(200, 0, -4)):
        dx, dy = ((1, 0), (0, 1), (-1, 0), (0, -1))[turn % 4]
        for _ in range(length):
            spiral.add(("s", x, y))
            x, y = x + dx, y + dy
    both = ring | spiral | {("d", 63, 63), ("d", 64, 64), ("d", 64, 62)}
    four, eight = labels(spark, both), labels(spark, both, 8)
    assert len({v for k, v in four.items() if k[0] == "r"}) == 1
    assert four == brute_components(both, 4) and eight == brute_components(both, 8)
    assert len({v for k, v in four.items() if k[0] == "d"}) == 3
    assert len({v for k, v in eight.items() if k[0] == "d"}) == 1


def test_repeated_cells_and_bad_neighbourhood(spark):
    assert set(labels(spark, [("a", 0, 0), ("a", 0, 0), ("a", 0, 1)]).values()) == {0}
    with pytest.raises(ValueError):
        labels(spark, [("a", 0, 0)], 6)


@pytest.mark.parametrize("bound", [100_000, 0])
def test_hub_contracts(spark, monkeypatch, bound):
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", bound)
    edges = [("s", i, 0) for i in range(1, 3000)] + [("s", i, i - 1) for i in range(3001, 3200)]
    df = spark.createDataFrame(edges, "siteId string, hi long, lo long")
    stars = components.contract(df, SITE).df.collect()
    assert {r["hi"]: r["lo"] for r in stars} == {
        **{i: 0 for i in range(1, 3000)}, **{i: 3000 for i in range(3001, 3200)}
    }


def test_water_crosses_a_tile_border(make_points):
    wet = [(24.25 + i * 0.5, 3.1, 1, 9) for i in range(4)] + [(0, 0, 5, 2), (40, 3.1, 1, 9)]
    cells = surface.surface_cells(
        tiling.assign_tiles(make_points(wet), P), replace(P, skip_water_ratio=2.0)
    )
    bodies = features.water_bodies(features.label_water(features.water_cells(cells, P)))
    assert sorted(r["cellCount"] for r in bodies.collect()) == [1, 4]
    row = bodies.where("cellCount = 4").first()
    assert row["areaM2"] == 1.0 and row["bboxMaxCellX"] - row["bboxMinCellX"] == 3
    # Tables without index columns are parsed from the tile id.
    parsed = features.water_cells(cells.drop("tileX", "tileY"), P)
    assert parsed.count() == 5 and parsed.agg(F.max("globalCellX")).first()[0] == 80


def block(height):
    """A 25 m tile of flat ground with one raised 4 m patch."""
    return [
        (x / 2, y / 2, height if x < 8 and y < 8 else 0.0, 2) for x in range(50) for y in range(50)
    ]


def test_building_rules(make_points):
    def candidates(height, **changes):
        params = replace(P, **changes)
        tiled = tiling.assign_tiles(make_points(block(height)), params)
        patches = surface.surface_patches(surface.surface_cells(tiled, params), params)
        return [r["buildingCandidateId"] for r in features.building_candidates(patches, params).collect()]

    assert candidates(5.0) == ["0_0|0_0"]
    assert candidates(2.4) == []
    assert candidates(5.0, min_points_used=65) == []
    assert candidates(5.0, min_patch_area_m2=16.0) == ["0_0|0_0"]
    assert candidates(5.0, min_patch_area_m2=16.5) == []


def test_publish_builds_all_tables(spark, make_points, tmp_path):
    lake = [(15 + x / 8, 15 + y / 8, 0.0, 9) for x in range(32) for y in range(32)]
    points = make_points(block(5.0) + lake)
    points = points.unionByName(make_points(block(0.0) + lake, site="t"))
    out = products.publish(spark, points, str(tmp_path / "lake"), P)
    found = {r["siteId"]: (r["cellCount"], r["areaM2"]) for r in out["water_bodies"].collect()}
    assert found == {"s": (64, 16.0), "t": (64, 16.0)}
    assert out["building_candidates"].where("siteId = 's'").count() == 1
    assert out["tile_stats"].groupBy("siteId").count().count() == 2
    # Publishing one site again leaves the other one alone.
    again = products.publish(spark, make_points(block(5.0) + lake), str(tmp_path / "lake"), P)
    assert again["points_tiled"].groupBy("siteId").count().count() == 2
    pruned = again["tile_stats"].where("siteId = 's'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(siteId" in pruned
    with pytest.raises(ValueError, match="2 ingest runs"):
        two_runs = make_points([(1, 1, 1, 2)]).unionByName(make_points([(1, 1, 1, 2)], run="q"))
        products.publish(spark, two_runs, str(tmp_path / "lake"), P)
    page = serving.list_tiles(again["tile_stats"], "s", order="computedAtDesc", limit=1)
    assert page.count() == 1
    # A flat and dry site keeps nothing of its old building and lake, the other one does.
    flat = make_points(block(0.0))
    later = products.publish(spark, flat, str(tmp_path / "lake"), P, on_empty="empty")
    assert later["building_candidates"].where("siteId = 's'").count() == 0
    assert [r["siteId"] for r in later["water_bodies"].collect()] == ["t"]
    assert later["tile_stats"].where("siteId = 's'").first()["waterPointCount"] == 0


def test_publish_reports_what_is_missing(spark, make_points, tmp_path):
    with pytest.raises(RuntimeError, match="5000 points"):
        products.publish(spark, make_points(block(0.0)), str(tmp_path / "x"), GridParams())
    out = products.publish(
        spark, make_points(block(0.0)), str(tmp_path / "y"), GridParams(), on_empty="empty"
    )
    assert out["tile_stats"].count() == 1


def test_failed_build_leaves_what_was_published(spark, make_points, tmp_path):
    """A site with a lake that is published again dry fails its guard; the lake stays readable."""
    root = str(tmp_path / "lake")
    lake = [(15 + x / 8, 15 + y / 8, 0.0, 9) for x in range(32) for y in range(32)]
    out = products.publish(spark, make_points(block(5.0) + lake), root, P)
    want = {n: sorted(map(str, df.collect())) for n, df in out.items()}
    with pytest.raises(RuntimeError, match="no water cell"):
        products.publish(spark, make_points(block(0.0)), root, P)
    schemas = {n: df.schema for n, df in out.items()}
    still = {n: snapshots.open_table(spark, root, n, s, ("siteId",)) for n, s in schemas.items()}
    assert {n: sorted(map(str, df.collect())) for n, df in still.items()} == want
    assert len(want["water_bodies"]) == 1
    # Without the guard the same points switch all tables at once, and failed builds go.
    later = products.publish(spark, make_points(block(0.0)), root, P, on_empty="empty")
    assert later["water_bodies"].count() == 0 and later["points_tiled"].count() == 2500
    assert len(list((tmp_path / "lake" / "tile_stats").iterdir())) == 2
    # Readers that opened the tables before still read the former build.
    assert {n: sorted(map(str, df.collect())) for n, df in still.items()} == want


def test_publish_takes_each_scope_by_its_own_parameters(spark, make_points, tmp_path):
    points = make_points(block(5.0)).unionByName(make_points(block(5.0), site="t"))
    own = spark.createDataFrame(
        [("s", 25.0, 10**9, 4, False), ("t", 50.0, 10**9, 4, False)],
        "siteId string, tileSizeM double, hotTileThreshold bigint, saltBuckets bigint, enableSalt boolean",
    )
    out = products.publish(spark, points, str(tmp_path / "own"), P, "empty", resolved=own)
    sizes = out["points_tiled"].select("siteId", "tileSizeM").distinct().collect()
    assert sorted(map(tuple, sizes)) == [("s", 25.0), ("t", 50.0)]


def test_pointers_of_scopes_with_odd_names(spark, tmp_path):
    root = str(tmp_path)
    scopes = [(None, "r"), ("a/b\u2028", "r"), ("a", None)]
    snapshots.switch(spark, root, scopes, "one")
    snapshots.switch(spark, root, scopes[:1], "two")
    assert snapshots.current(spark, root) == {scopes[0]: "two", scopes[1]: "one", scopes[2]: "one"}
    assert snapshots.current(spark, f"{root}/none") == {}


def test_cells_of_a_task_are_folded_without_sorting_its_points(spark, make_points, tmp_path, monkeypatch):
    """More cells than Spark's default of groups, and the session's own setting comes back."""
    name = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    used, write = {}, products.replace_partitions

    def noted(df, path, *rest, **more):
        used[path.split("/")[-2]] = int(spark.conf.get(name))
        write(df, path, *rest, **more)

    monkeypatch.setattr(products, "replace_partitions", noted)
    grid = GridParams(tile_size_m=32.0, cell_size_m=1.0, min_tile_points=1, min_points_used=1)
    points = make_points([(x + 0.5, y + 0.5, z, 2) for x in range(30) for y in range(30) for z in (1, 2, 4)])
    default = spark.conf.get(name)
    out = products.publish(spark, points, str(tmp_path / "lake"), grid, on_empty="empty")
    cells = out["surface_cells"].collect()
    assert len(cells) == 900 and {(c["pointCount"], c["z_p50"]) for c in cells} == {(3, 2.0)}
    assert used["surface_cells"] > 900 > used["points_tiled"]
    assert spark.conf.get(name) == default
