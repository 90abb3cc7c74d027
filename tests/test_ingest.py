import pytest
from pyspark.sql import functions as F

from laserfold.operators import ingest
from laserfold.sources import landing, tables
from laserfold.streaming import arrivals


def test_missing_columns_are_all_named(spark):
    with pytest.raises(ValueError, match="intensity, classification"):
        ingest.clean_points(spark.range(1).select(*(F.lit(1.0).alias(c) for c in "xyz")))


def test_null_geometry_is_dropped_and_text_time_cast(spark, make_points):
    points = make_points([(1, 1, None, 2), (1, 1, 1, 2)]).withColumn(
        "ingestTime", F.lit("2024-05-01 10:00:00")
    )
    clean = ingest.clean_points(points)
    assert dict(clean.dtypes)["ingestTime"] == "timestamp"
    assert clean.count() == 1


def test_null_tests_reach_the_scan(spark, make_points, tmp_path):
    path = str(tmp_path / "points")
    make_points([(1, 1, 1, 2)]).write.parquet(path)
    plan = ingest.clean_points(landing.read_points(spark, path))._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(x), IsNotNull(y), IsNotNull(z)]" in plan


def test_resolve_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4)], "X double, y double, z double, Intensity int")
    chosen, unknown = ingest.resolve_columns(df, ["intensity", "x", "INTENSITY", "z", "nope"])
    assert chosen.columns == ["Intensity", "x", "z"] and unknown == ["nope"]
    everything, _ = ingest.resolve_columns(df, keep_all=True)
    assert everything.columns == ["x", "y", "z", "Intensity"]
    default, lacking = ingest.resolve_columns(df)
    assert default.columns == ["x", "y", "z", "Intensity"] and "gps_time" in lacking
    with pytest.raises(ValueError):
        ingest.resolve_columns(df, ["nope"])


def test_scope_filter_uses_present_columns(spark, make_points):
    both = make_points([(1, 1, 1, 2)]).unionByName(make_points([(1, 1, 1, 2)], site="t", run="q"))
    assert ingest.scope_filter(both, "s", "r").count() == 1
    assert ingest.scope_filter(both.drop("ingestRunId"), "t", "r").count() == 1
    assert ingest.scope_filter(both.drop("siteId"), "t", "q").count() == 1
    assert ingest.scope_filter(both.drop("siteId", "ingestRunId"), "t", "q").count() == 2


def test_single_run(spark, make_points):
    one = make_points([(1, 1, 1, 2)])
    assert ingest.single_run(one, "s") == "r"
    with pytest.raises(ValueError, match="0 ingest runs"):
        ingest.single_run(one, "other")
    with pytest.raises(ValueError, match="2 ingest runs"):
        ingest.single_run(one.unionByName(make_points([(1, 1, 1, 2)], run="q")), "s")


def test_preview_and_counted_write(spark, tmp_path):
    head, total = landing.preview(spark.range(50), 7)
    assert head.count() == 7 and total.first()["rows"] == 50
    path = str(tmp_path / "out")
    assert tables.write_counted(spark.range(50), path, compression="zstd") == 50
    with pytest.raises(Exception, match="already exists"):
        tables.write_counted(spark.range(1), path)
    assert tables.write_counted(spark.range(3), path, overwrite=True) == 3


def test_write_if_any(spark, make_points, tmp_path):
    path = str(tmp_path / "mask")
    points = make_points([(1, 1, 1, 2)])
    assert not tables.write_if_any(points.where("false"), path, ["siteId"])
    assert tables.write_if_any(points, path, ["siteId"])
    assert spark.read.parquet(path).count() == 1


def test_snapshot_replace_drops_old_tiles_of_the_site_only(spark, tmp_path):
    path = str(tmp_path / "snap")
    schema = "siteId string, tileId string"
    old = spark.createDataFrame([("1", "0_0"), ("1", "0_1"), ("2", "0_0")], schema)
    tables.replace_partitions(old, path)
    tables.replace_partitions(spark.createDataFrame([("1", "5_5")], schema), path)
    found = tables.read_table(spark, path, old.schema)
    assert dict(found.dtypes)["siteId"] == "string"
    assert {tuple(r) for r in found.select("siteId", "tileId").collect()} == {("1", "5_5"), ("2", "0_0")}


def test_external_registration_and_statistics(spark, make_points, tmp_path):
    path = str(tmp_path / "ext")
    tables.append(make_points([(1, 1, 1, 2), (2, 2, 2, 9)]), path)
    spark.sql("DROP TABLE IF EXISTS ext_points")
    assert tables.register(spark, "ext_points", path, external=True).count() == 2
    tables.analyze(spark, "ext_points", ["z"])
    stats = spark.sql("DESCRIBE EXTENDED ext_points z").collect()
    assert {r["info_name"]: r["info_value"] for r in stats}["max"] == "2.0"
    spark.sql("DROP TABLE ext_points")


def test_cluster_gives_compact_files(spark, tmp_path):
    path = str(tmp_path / "clustered")
    tiles = spark.range(1024).select(
        F.lit("s").alias("siteId"),
        (F.col("id") % 32).cast("int").alias("tileX"),
        F.floor(F.col("id") / 32).cast("int").alias("tileY"),
    )
    tables.rewrite_clustered(tiles, path, files=16)
    boxes = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(
        ((F.max("tileX") - F.min("tileX") + 1) * (F.max("tileY") - F.min("tileY") + 1)).alias("area"),
        F.count("*").alias("n"),
    ).collect()
    assert 12 <= len(boxes) <= 16 and sum(b["n"] for b in boxes) == 1024
    assert sum(b["area"] for b in boxes) < 4 * 1024


def test_hot_tile_is_split_over_files(spark, tmp_path):
    hot = spark.range(4000).select(
        F.lit("s").alias("siteId"), F.lit(3).alias("tileX"), F.lit(3).alias("tileY"), F.rand(1).alias("x")
    )
    path = str(tmp_path / "hot")
    tables.rewrite_clustered(hot, path, spread=["x"], files=4)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 3 and max(sizes) < 2000


def test_unreadable_layer_is_skipped_and_empty_scope_reported(spark, make_points):
    points = make_points([(1, 1, 1, 2), (1, 1, 1, 9)])
    found = {
        r["layer"]: r
        for r in tables.inspect_layers(
            spark, {"raw": points, "gone": "/nowhere/at/all"}, site_id="other"
        ).collect()
    }
    assert set(found) == {"raw", "gone"}
    assert not found["gone"]["readable"] and found["gone"]["error"] and found["gone"]["rows"] is None
    assert [tuple(c) for c in found["raw"]["classes"]] == sorted(tuple(c) for c in found["raw"]["classes"])
    assert sum(c["points"] for c in found["raw"]["classes"]) == 2 and len(found["raw"]["sample"]) == 2
    assert found["raw"]["schema"].startswith("struct<")
    assert not found["raw"]["scoped"] and found["raw"]["rows"] == 2
    assert found["raw"]["distinctClasses"] == 2 and found["raw"]["distinctTiles"] is None


def test_arrivals_join_the_rows_of_batch_jobs(spark, make_points, tmp_path):
    landing_dir, table, progress = (str(tmp_path / n) for n in ("landing", "table", "progress"))
    tables.append(make_points([(7, 1, 1, 2)]), table)
    for turn in range(2):
        make_points([(turn, 1, 1, 2), (turn, 1, None, 2)]).write.mode("append").parquet(landing_dir)
        stream = arrivals.arriving_points(spark, landing_dir, files_per_trigger=1)
        arrivals.append_arrivals(stream, table, progress).awaitTermination()
    assert sorted(r["x"] for r in spark.read.parquet(table).collect()) == [0.0, 1.0, 7.0]
    # A batch that is tried again replaces its own files.
    again = make_points([(1, 1, 1, 2)])
    for _ in range(2):
        arrivals._publish_batch(again, table, "other", 0)
    assert sorted(r["x"] for r in spark.read.parquet(table).collect()) == [0.0, 1.0, 1.0, 7.0]


def test_streamed_landing_files_are_bounded(spark, monkeypatch, tmp_path):
    """What a task reads at least does not grow with the table; still two turns."""
    import pyarrow.parquet as pq

    from querybook import inputs, spark_queries

    schema = (
        "x double, y double, z double, intensity int, classification int, return_number int, "
        "number_of_returns int, gps_time double, siteId string, ingestRunId string, ingestTime timestamp"
    )
    rows = [(float(i), 1.0, 1.0, i, 2, 1 + i % 3, 3, 0.0, f"s{i % 2}", "r", None) for i in range(300)]
    rows += rows[-20:]  # repeated points are kept
    table = spark.createDataFrame(rows, schema).coalesce(2)
    monkeypatch.setattr(inputs, "raw_points", lambda *_: table)
    monkeypatch.setattr(landing, "FILE_ROWS", 15, raising=False)
    monkeypatch.setattr(spark_queries, "scratch_path", lambda _, name: str(tmp_path / name))
    found = {r["siteId"]: (r["points"], r["intensity"]) for r in spark_queries.stream_ingest(spark, "").collect()}
    want = {s: [r[3] for r in rows if r[8] == s] for s in ("s0", "s1")}
    assert found == {s: (len(v), sum(v)) for s, v in want.items()}
    sizes = [pq.read_metadata(f).num_rows for f in (tmp_path / "landing").glob("*.parquet")]
    assert sum(sizes) == sum(r[5] != 1 for r in rows) and max(sizes) <= 15
    assert len(list((tmp_path / "progress" / "commits").glob("[0-9]*"))) == 2
