from pyspark.sql import functions as F

from laserfold import runtime, session
from laserfold.sources.landing import widen


def test_store_counts_and_measures(spark):
    stored = runtime.store(spark.range(10).select(F.col("id").alias("v")), "t", top=F.max("v"))
    assert stored.rows == 10 and stored.metrics == {"top": 9} and stored.broadcastable
    assert stored.df.columns == ["v"] and stored.df.count() == 10


def test_store_of_nothing(spark):
    stored = runtime.store(spark.range(0), "none")
    assert stored.rows == 0 and stored.df.count() == 0


def test_drop_scratch_removes_the_folder(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(runtime, "_scratch_root", lambda _: str(tmp_path / "own"))
    path = runtime.scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert (tmp_path / "own").exists()
    runtime.drop_scratch(spark)
    assert not (tmp_path / "own").exists()


def test_salt_is_stable_and_in_range(spark):
    salted = spark.range(1000).select(runtime.salt(["id"], 8).alias("s"))
    found = [r[0] for r in salted.distinct().collect()]
    assert sorted(found) == list(range(8))
    assert salted.exceptAll(spark.range(1000).repartition(5).select(runtime.salt(["id"], 8))).isEmpty()


def test_widen_leaves_wide_inputs_alone(spark):
    wide = spark.range(0, 100, 1, 64)
    assert widen(wide) is wide
    assert widen(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == 4


def test_build_returns_the_session_with_settings(spark):
    same = session.build("again", spark__sql__adaptive__enabled="true")
    assert same.conf.get("spark.sql.session.timeZone") == "UTC"
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")


def test_counted_join_deals_hot_keys_by_their_rows(spark):
    """One key holds a third of all rows: it goes to tasks by its count, others stay whole."""
    from pyspark.sql import functions as F

    from laserfold import runtime

    rows = [(i % 50 if i % 3 else 7, i) for i in range(3000)] + [(None, -1), (None, -2)]
    left = spark.createDataFrame(rows, "k int, i int").repartition(6)
    right = spark.createDataFrame([(k, k * k) for k in range(0, 60, 2)] + [(7, 49)], "k int, square int")
    hot = {r["k"]: r["salts"] for r in runtime.hot_keys(left, ["k"], 200).df.collect()}
    n = sum(k == 7 for k, _ in rows)
    assert hot == {7: -(-n // 200)}
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = runtime.counted_join(left, right, ["k"], how, spread=("i",), task_rows=200)
        plain = left.join(right, ["k"], how)
        assert sorted(map(str, got.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    # The rows of the hot key come from several tasks.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = runtime.counted_join(left, right.hint("merge"), ["k"], "inner", spread=("i",), task_rows=200)
        tasks = joined.where("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks > 1
