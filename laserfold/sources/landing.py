"""Scan of landing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laserfold import schemas

# Rows of a landing file.
FILE_ROWS = 250_000


def read_points(spark: SparkSession, *paths: str, declared: bool = True) -> DataFrame:
    """Point files or folders in Parquet, with the declared schema.

    `declared=False` takes the schema of the files, for inputs whose columns must
    be checked or resolved first."""
    reader = spark.read.schema(schemas.POINTS_RAW) if declared else spark.read
    return reader.parquet(*paths)


def widen(df: DataFrame) -> DataFrame:
    """Deal rows out evenly when a scan has fewer splits than the cluster has cores.

    Small inputs often are one file with one row group, hence one busy task. An input
    with enough splits is returned as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def land(df: DataFrame, folder: str, file_rows: int | None = None) -> int:
    """Write landing files of at most `file_rows` rows, without a shuffle; returns their number.

    A scan cuts files only between row groups, so the files bound what a task reads at least."""
    most = file_rows or FILE_ROWS
    df.write.option("maxRecordsPerFile", most).parquet(folder)
    return len(read_points(df.sparkSession, folder).inputFiles())


def preview(df: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """The first n rows and a one-row count of the whole."""
    return df.limit(n), df.agg(F.count(F.lit(1)).alias("rows"))
