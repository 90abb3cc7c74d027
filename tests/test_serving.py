import json

import pytest
from pyspark.sql import functions as F

from laserfold.plans import serving

TILES = [
    ("s", "0_0", 10, 0.1, 1.0, 5.0, 6.0, False, 3),
    ("s", "0_1", 30, 0.9, 1.0, 2.0, 9.0, True, 1),
    ("s", "1_0", 20, 0.1, 1.0, 9.0, 7.0, False, 2),
    ("t", "0_0", 99, 0.0, 0.0, 0.0, 0.0, False, 9),
]


@pytest.fixture(scope="module")
def tiles(spark):
    return spark.createDataFrame(
        TILES,
        "siteId string, tileId string, pointCount long, waterPointRatio double, z_p50 double, "
        "z_p95 double, z_p99 double, isMostlyWater boolean, computedAt long",
    )


def ids(df):
    return [r["tileId"] for r in df.collect()]


@pytest.mark.parametrize(
    "order, want",
    [
        (None, ["0_0", "0_1", "1_0"]),
        ("tileId", ["0_0", "0_1", "1_0"]),
        ("pointCountDesc", ["0_1", "1_0", "0_0"]),
        ("waterRatioDesc", ["0_1", "0_0", "1_0"]),
        ("heightP99Desc", ["0_1", "1_0", "0_0"]),
        ("reliefDesc", ["1_0", "0_0", "0_1"]),
        ("computedAtDesc", ["0_0", "1_0", "0_1"]),
    ],
)
def test_orders(tiles, order, want):
    assert ids(serving.list_tiles(tiles, "s", order=order)) == want


def test_filters_and_pages(tiles):
    assert ids(serving.list_tiles(tiles, "s", skip_mostly_water=True, min_points=15)) == ["1_0"]
    assert ids(serving.list_tiles(tiles, "s", limit=1, offset=2)) == ["1_0"]


@pytest.mark.parametrize(
    "bad",
    [dict(limit=0), dict(limit=2001, most=2000), dict(most=2000), dict(offset=-1), dict(min_points=-1), dict(order="height")],
)
def test_bad_requests_fail_before_any_job(tiles, bad):
    with pytest.raises(ValueError):
        serving.list_tiles(tiles, "s", **bad)


def test_feature_limits(tiles):
    with pytest.raises(ValueError):
        serving.list_water(tiles, "s", limit=1001, most=1000)
    with pytest.raises(ValueError):
        serving.list_buildings(tiles, "s", order="areaDesc")
    with pytest.raises(ValueError):
        serving.list_buildings(tiles, "s", min_height=-0.5)


def test_page_is_a_top_n_plan(tiles):
    plan = serving.list_tiles(tiles, "s", order="reliefDesc", limit=3)._jdf.queryExecution().executedPlan()
    assert "TakeOrderedAndProject" in plan.toString()


def test_payload(tiles):
    text = serving.as_payload(serving.list_tiles(tiles, "t"), serving.TILE_PAYLOAD).first()["payload"]
    assert json.loads(text)["pointCount"] == 99 and "z_p95" in json.loads(text)


def test_tile_range_and_box(spark):
    found = serving.tile_range((-1.0, 10.0, 26.0, 49.9), (0.0, 0.0), 25.0)
    assert found == serving.TileRange(-1, 0, 1, 1)
    boxes = spark.createDataFrame(
        [(0, 0, 0.0, 0.0, 10.0, 10.0), (1, 1, 25.0, 25.0, 50.0, 50.0), (2, 0, 50.0, 0.0, 75.0, 25.0)],
        "tileX int, tileY int, minX double, minY double, maxX double, maxY double",
    )
    sites = boxes.withColumn("siteId", F.lit("s"))
    corners = spark.createDataFrame([("s", 0.0, 0.0)], "siteId string, originX double, originY double")
    hits = serving.in_box(sites, (10.0, 10.0, 30.0, 30.0), origins=corners)
    assert sorted(r["tileX"] for r in hits.collect()) == [0, 1]
    # An extent that leaves its tile is found with the margin.
    over = spark.createDataFrame(
        [("s", 1, 0, 49.4, 0.0, 50.4, 1.0), ("t", 1, 0, 49.4, 0.0, 50.4, 1.0)],
        "siteId string, tileX int, tileY int, minX double, minY double, maxX double, maxY double",
    )
    box = (50.1, 0.0, 50.3, 1.0)
    found = serving.in_box(over, box, origins=corners, margin_m=1.0).collect()
    assert [r["siteId"] for r in found] == ["s"]
    assert serving.in_box(over, box).count() == 2


def test_boxes_over_many_sites_keep_a_small_plan(spark, tmp_path, monkeypatch):
    """Sites of their own origin and tile size; literal and joined ranges give the same rows."""
    sites = [(f"s{i:03}" if i else None, 40.0 * i, 15.0 * (i % 7), 25.0 if i % 2 else 10.0) for i in range(90)]
    corners = spark.createDataFrame(sites, "siteId string, originX double, originY double, tileSizeM double")
    rows = [
        (s, x, y, x0 + x * w, y0 + y * w, x0 + x * w + w, y0 + y * w + w)
        for s, x0, y0, w in sites for x in range(6) for y in range(6)
    ]
    ddl = "siteId string, tileX int, tileY int, minX double, minY double, maxX double, maxY double"
    path = str(tmp_path / "tiles")
    spark.createDataFrame(rows, ddl).write.partitionBy("siteId").parquet(path)
    table = spark.read.parquet(path)
    box = (1701.0, 21.0, 1731.0, 61.0)
    want = sorted(str(r) for r in rows if r[3] <= box[2] and r[5] >= box[0] and r[4] <= box[3] and r[6] >= box[1])
    for terms in (0, 1000):
        monkeypatch.setattr(serving, "RANGE_TERMS", terms)
        for given in (corners, corners.where("siteId is not null")):
            hits = serving.in_box(table, box, origins=given)
            got = hits.select("siteId", "tileX", "tileY", "minX", "minY", "maxX", "maxY").collect()
            assert sorted(str(tuple(r)) for r in got) == want
            plan = hits._jdf.queryExecution().toString()
            assert terms or plan.count("s001") == 0
    assert serving.in_box(table, box, origins=corners.where("false")).count() == 0


def test_range_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "tiles")
    spark.createDataFrame([(0, 0)], "tileX int, tileY int").write.parquet(path)
    plan = serving.in_tile_range(spark.read.parquet(path), serving.TileRange(0, 0, 3, 3))
    assert "GreaterThanOrEqual(tileX,0)" in plan._jdf.queryExecution().toString()
