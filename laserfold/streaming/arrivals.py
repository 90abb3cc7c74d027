"""Incremental ingest: new landing files flow into the raw point table."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from laserfold import schemas
from laserfold.operators.ingest import clean_points

KEYS = ("siteId", "ingestRunId")


def arriving_points(
    spark: SparkSession, landing: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of cleaned points out of a landing folder."""
    reader = spark.readStream.schema(schemas.POINTS_RAW)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return clean_points(reader.parquet(landing))


def _publish_batch(points: DataFrame, table: str, stream: str, batch: int) -> None:
    """Add one micro-batch to a partitioned table that batch jobs write as well.

    The batch is written aside, in a folder that readers skip, and its files are moved
    into the partitions under names made of the stream and the batch. A retried batch
    first removes the files of its earlier try, so no row comes twice."""
    spark = points.sparkSession
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root, aside = path_of(table), path_of(f"{table}/_arriving/{stream}-{batch}")
    points.write.mode("overwrite").partitionBy(*KEYS).parquet(aside.toString())
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    mark = f"part-{stream}-{batch:08d}-"
    for old in fs.globStatus(path_of(f"{table}/*/*/{mark}*")) or ():
        fs.delete(old.getPath(), False)
    files = fs.globStatus(path_of(f"{aside.toString()}/*/*/part-*")) or ()
    for number, file in enumerate(sorted(files, key=lambda f: f.getPath().toString())):
        at = file.getPath()
        partition = f"{at.getParent().getParent().getName()}/{at.getParent().getName()}"
        fs.mkdirs(path_of(f"{table}/{partition}"))
        target = path_of(f"{table}/{partition}/{mark}{number:05d}.snappy.parquet")
        if not fs.rename(at, target):
            raise OSError(f"could not move {at} to {target}")
    fs.delete(aside, True)


def append_arrivals(points: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived, then stop.

    Each micro-batch adds plain files, so the table may also have rows of batch jobs."""
    stream = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]
    return (
        points.writeStream.foreachBatch(
            lambda batch, number: _publish_batch(batch, table, stream, number)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
