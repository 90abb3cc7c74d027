"""Table sinks on Parquet: append, snapshot replace, clustered rewrite, registration.

Snapshots replace whole partitions by dynamic overwrite. That is not atomic across
files; with a table format on the class path pass `fmt="delta"`, and the same
functions use `replaceWhere`.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from functools import partial, reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException, UnknownException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from laserfold.functions.grid import morton
from laserfold.operators.tile_stats import (
    fold_layer,
    folded_classes,
    folded_metrics,
    sample_rows,
)
from laserfold.operators.tiling import TILE
from laserfold.runtime import store


def _balanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Ask for files of even size per partition value; AQE splits large values."""
    return df.hint("rebalance", *(F.col(c) for c in by))


# Fixed value: the folder name of a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _folder_names(values: Iterable) -> tuple[str, ...]:
    """Partition values as their folders are called; null and empty text share a folder."""
    return tuple(NULL_PARTITION if v is None or v == "" else str(v) for v in values)


def drop_partitions(
    spark: SparkSession, path: str, partition_by: Sequence[str], gone: Iterable[tuple]
) -> None:
    """Delete whole partitions, given as values of the partition columns."""
    wanted = {_folder_names(values) for values in gone}
    if not wanted:
        return
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        "/".join([path, *(f"{c}=*" for c in partition_by)])
    )
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in fs.globStatus(pattern) or ():
        names = found.getPath().toString().split("/")[-len(partition_by) :]
        if tuple(unquote(n.split("=", 1)[1]) for n in names) in wanted:
            fs.delete(found.getPath(), True)


def replace_snapshot(
    df: DataFrame,
    path: str,
    scopes: Sequence[tuple],
    partition_by: Sequence[str] = ("siteId",),
    ordered: bool = False,
) -> None:
    """Make `df` the whole content of the partitions in `scopes`, keep all others.

    A scope without rows in `df` has none in the table afterwards, so a site that lost
    all its buildings keeps no old ones. Two steps: what is new replaces its partitions,
    then those of the other scopes are deleted."""
    # The list is gathered while the rows are written: at most one entry per partition.
    seen = Observation("partitions")
    keys = F.collect_set(F.to_json(F.array(*(F.col(c).cast("string") for c in partition_by))))
    laid_out = df if ordered else _balanced(df, partition_by)
    watched = laid_out.observe(seen, F.array_join(keys, "\n").alias("filled"))
    replace_partitions(watched, path, partition_by, ordered=True)
    # JSON writes a line end inside a value as an escape, but not the other separators.
    filled = {_folder_names(json.loads(x)) for x in seen.get["filled"].split("\n") if x}
    asked = {_folder_names(s) for s in scopes}
    drop_partitions(df.sparkSession, path, partition_by, asked - filled)


def append(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("siteId", "ingestRunId"),
    compression: str | None = None,
) -> None:
    """Add rows to a partitioned table, without a shuffle.

    Landing files belong to one site and run each, so tasks write few partitions; the
    small files are compacted when the products are published (`rewrite_clustered`)."""
    writer = df.write.mode("append").partitionBy(*partition_by)
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(path)


def replace_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("siteId",),
    replace_where: str | None = None,
    fmt: str = "parquet",
    ordered: bool = False,
) -> None:
    """Replace every partition that occurs in `df`, keep all others.

    Partitioned by site alone, this replaces the snapshot of a site as a whole: a
    tile that is gone from the new snapshot is gone from the table. `ordered` keeps
    the task layout of `df` (already clustered rows) instead of rebalancing."""
    laid_out = df if ordered else _balanced(df, partition_by)
    writer = laid_out.write.mode("overwrite").format(fmt).partitionBy(*partition_by)
    if fmt == "parquet":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    elif replace_where:
        writer = writer.option("replaceWhere", replace_where)
    writer.save(path)


def write_counted(
    df: DataFrame, path: str, overwrite: bool = False, compression: str = "snappy"
) -> int:
    """Write a plain Parquet folder and return the number of rows written."""
    seen = Observation("written")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    mode = "overwrite" if overwrite else "errorifexists"
    counted.write.mode(mode).option("compression", compression).parquet(path)
    return seen.get["rows"]


def write_if_any(df: DataFrame, path: str, partition_by: Sequence[str]) -> bool:
    """Append unless `df` is empty; tells whether something was written."""
    if df.isEmpty():
        return False
    append(df, path, partition_by)
    return True


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a table back; with a schema, partition columns keep their declared type."""
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def run_and_total_rows(table: DataFrame) -> DataFrame:
    """Rows of every (site, run), and of the whole table in the row without keys."""
    keys = ["siteId", "ingestRunId"]
    per_run = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_run.groupingSets([keys, []], *keys).agg(F.sum("n").alias("rows"))


def register(spark: SparkSession, name: str, path: str, external: bool = False) -> DataFrame:
    """Make a folder readable by name: a temporary view, or an external table."""
    if external:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
        if spark.sql(f"SHOW CREATE TABLE {name}").first()[0].find("PARTITIONED BY") >= 0:
            spark.sql(f"MSCK REPAIR TABLE {name}")
    else:
        read_table(spark, path).createOrReplaceTempView(name)
    return spark.table(name)


def analyze(spark: SparkSession, name: str, columns: Sequence[str] = ()) -> None:
    """Collect table statistics, and column statistics where columns are named."""
    scope = f" FOR COLUMNS {', '.join(columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS{scope}")


def cluster(
    df: DataFrame,
    scope: Sequence[str] = ("siteId",),
    spread: Sequence[str] = (),
    then_by: Sequence[str | Column] = (),
    files: int | None = None,
) -> DataFrame:
    """Order rows so that files cover compact tile ranges (Z-order within a scope).

    Range partitioning samples the keys, so a large site gets many files; the
    columns in `spread` let even a single hot tile be split over several."""
    keys = [
        *(F.col(c) for c in scope),
        morton(*(F.col(c) for c in TILE)),
        *((F.hash(*spread),) if spread else ()),
    ]
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys[: len(scope) + 1], *then_by)


def rewrite_clustered(
    df: DataFrame,
    path: str,
    scope: Sequence[str] = ("siteId",),
    spread: Sequence[str] = (),
    then_by: Sequence[str | Column] = (),
    files: int | None = None,
) -> None:
    """Compact a table into a new folder, partitioned by site and clustered by tile."""
    ordered = cluster(df, scope, spread, then_by, files)
    ordered.write.mode("overwrite").partitionBy(scope[0]).parquet(path)


def _layer_report(layer: DataFrame, site_id: str | None, run_id: str | None, sample: int, classes: int):
    """Whether the scope has rows, and one row of metrics, classes and sample."""
    from laserfold.operators.ingest import scope_filter

    total = F.coalesce(F.sum("n"), F.lit(0))
    df = scope_filter(layer, site_id, run_id)
    folded = store(fold_layer(df), "layer", total=total)
    scoped = folded.metrics["total"] > 0
    if not scoped:
        df, folded = layer, store(fold_layer(layer), "layer", total=total)
    # Each part is one row with columns of its own.
    parts = folded_metrics(folded.df), folded_classes(folded.df, classes), sample_rows(df, sample)
    stacked = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts)
    return scoped, stacked.agg(*(F.first(c, ignorenulls=True).alias(c) for c in stacked.columns))


def inspect_layers(
    spark: SparkSession,
    layers: dict[str, str | DataFrame],
    site_id: str | None = None,
    run_id: str | None = None,
    sample: int = 20,
    classes: int = 20,
) -> DataFrame:
    """One row per layer: metrics, its most frequent classes, a sample of rows, its schema.

    A layer without rows in the asked scope is reported unscoped (`scoped` false). A layer
    that cannot be read is a row with `readable` false and the reason in `error`. A layer
    is folded once to its tiles and classes; all but the sample comes from that table."""
    found: list[DataFrame] = []
    for name, layer in layers.items():
        try:
            df = spark.read.parquet(layer) if isinstance(layer, str) else layer
        except (AnalysisException, UnknownException) as reason:
            lost = reason.getCondition() or type(reason).__name__
            row = spark.range(1).select()
            head = [F.lit(False), F.lit(None).cast("boolean"), F.lit(None).cast("string"), F.lit(lost)]
        else:
            scoped, row = _layer_report(df, site_id, run_id, sample, classes)
            head = [F.lit(True), F.lit(scoped), F.lit(df.schema.simpleString()), F.lit(None).cast("string")]
        named = zip(head, ("readable", "scoped", "schema", "error"), strict=True)
        found.append(row.select(F.lit(name).alias("layer"), *(c.alias(n) for c, n in named), "*"))
    if not found:
        raise ValueError("no layer was named")
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), found)


def clustering_report(tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Clustering and partition keys of each table with its rows and tile extent."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.max("tileX").alias("maxTileX"),
            F.max("tileY").alias("maxTileY"),
        ).select(
            F.lit(name).alias("tableName"),
            F.lit(keys).alias("clusteringKeys"),
            F.lit(partitions).alias("partitionKeys"),
            "rows",
            "maxTileX",
            "maxTileY",
        )
        for name, (df, keys, partitions) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
