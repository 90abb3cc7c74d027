"""Session-side helpers: shared scratch tables and size-checked joins.

Small derived tables (origins, hot tiles, graph edges) are written to the shared
checkpoint folder and read back. That cuts lineage in a way that survives the loss
of executors, gives Catalyst true file sizes, and the row count observed during
the write decides whether a broadcast is allowed.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# A broadcast side may hold at most this many narrow rows (a few MB per executor).
BROADCAST_ROWS = 100_000
JOIN_SALTS = 8
# Rows of one key that a task may take; keys with more are dealt to as many tasks as needed.
TASK_ROWS = 1_000_000

_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """Folder for scratch tables: `spark.checkpoint.dir`, or the context's checkpoint folder.

    Only a local master may go without the setting; there one temporary folder
    per process is used."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:  # a folder that was set on the context serves as well
        configured = getattr(spark.sparkContext, "getCheckpointDir", lambda: None)()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="laserfold-")
    return _local_root


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/laserfold/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables of this application; call when its results are written."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Run the jobs inside with another value of a session setting."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


@dataclass(frozen=True)
class Stored:
    """A written table, its observed row count, and further observed metrics."""

    df: DataFrame
    rows: int
    metrics: dict

    @property
    def broadcastable(self) -> bool:
        return self.rows <= BROADCAST_ROWS


def store(df: DataFrame, name: str, **metrics: Column) -> Stored:
    """Write `df` once to the shared folder; count rows while writing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    seen = Observation(name)
    observed = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in metrics.items())
    )
    observed.write.parquet(path)
    found = dict(seen.get)
    return Stored(spark.read.schema(df.schema).parquet(path), found.pop("rows"), found)


def salt(spread: Iterable[str | Column], buckets: int) -> Column:
    """Bucket number 0..buckets-1 that is a pure function of the given columns."""
    return F.pmod(F.hash(*spread), F.lit(buckets))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    spread: Sequence[str],
    buckets: int = JOIN_SALTS,
) -> DataFrame:
    """Equi join in which rows of one hot `on` key on the left go to `buckets` tasks.

    The right side must be unique per key; it is repeated once per bucket, so the
    result is exactly that of the plain join."""
    numbers = F.sequence(F.lit(0), F.lit(buckets - 1))
    spread_right = right.withColumn("_salt", F.explode(numbers))
    return (
        left.withColumn("_salt", salt(spread, buckets))
        .join(spread_right, [*on, "_salt"], how)
        .drop("_salt")
    )


def hot_keys(df: DataFrame, on: Sequence[str], task_rows: int | None = None) -> Stored:
    """Keys with more than `task_rows` rows, with the number of tasks for each: on, salts.

    Counts are combined before they are shuffled. There are at most rows / task_rows hot
    keys, so the table is small however many keys there are."""
    bound = task_rows or TASK_ROWS
    n = F.count(F.lit(1))
    counted = df.groupBy(*on).agg(F.ceil(n / bound).cast("int").alias("salts")).where("salts > 1")
    return store(counted, "hot-keys")


def counted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    spread: Sequence[str],
    task_rows: int | None = None,
) -> DataFrame:
    """Equi join in which a key is dealt to tasks in proportion to its rows on the left.

    The right side must be unique per key. Only its rows of hot keys are repeated, once
    per task of their key; all other keys are joined as they are. Null keys find nothing."""
    hot = hot_keys(left.select(*on), on, task_rows)
    if hot.rows == 0:
        return left.join(right, list(on), how)
    few = F.broadcast(hot.df) if hot.broadcastable else hot.df
    own = F.when(F.col("salts").isNotNull(), F.pmod(F.hash(*spread), "salts")).otherwise(0)
    salted = left.join(few, list(on), "left").withColumn("_salt", own).drop("salts")
    numbers = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    repeated = right.join(few, list(on), "left").withColumn("_salt", F.explode(numbers)).drop("salts")
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def lookup_join(
    left: DataFrame, right: Stored, on: Sequence[str], how: str, spread: Sequence[str]
) -> DataFrame:
    """Join many rows with a stored table that is unique per key.

    Broadcast when the observed row count is inside the bound, else by counted salts."""
    if right.broadcastable:
        return left.join(F.broadcast(right.df), list(on), how)
    return counted_join(left, right.df, on, how, spread)


def require_rows(df: DataFrame, message: str, on_empty: str = "raise") -> DataFrame:
    """Fail with `message` on empty input unless `on_empty` is "empty"."""
    if on_empty not in ("raise", "empty"):
        raise ValueError("on_empty must be 'raise' or 'empty'")
    if on_empty == "raise" and df.isEmpty():
        raise RuntimeError(message)
    return df
