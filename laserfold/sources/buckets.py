"""Tables whose rows lie in buckets by key, so that joins on the key leave them in place.

Points that are joined with tile tables again and again are dealt to buckets once, by
tile. Each later join moves only the tile table, which has a row per tile. A key with
more rows than a task should take is dealt to several buckets by a salt; `meet` repeats
the few rows of such keys on the other side, so results are those of the plain join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laserfold.runtime import Stored, hot_keys

SALT = "bucketSalt"


@dataclass(frozen=True)
class Buckets:
    """A bucketed table, and its keys that lie in several buckets: keys, salts."""

    rows: DataFrame
    keys: tuple[str, ...]
    hot: Stored


def _few(hot: Stored) -> DataFrame:
    return F.broadcast(hot.df) if hot.broadcastable else hot.df


def write_buckets(
    df: DataFrame,
    name: str,
    path: str,
    keys: Sequence[str],
    spread: Sequence[str],
    buckets: int | None = None,
    task_rows: int | None = None,
) -> Buckets:
    """Write `df` under `path` as the table `name`, one file per bucket.

    `buckets` is the number of shuffle partitions unless given; with fewer than that,
    Spark may prefer to shuffle both sides of a join. `spread` are the columns whose hash
    deals a hot key's rows. A table of that name must not exist."""
    spark = df.sparkSession
    number = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(df, keys, task_rows)
    salt = F.coalesce(F.pmod(F.hash(*spread), "salts"), F.lit(0)).cast("int")
    salted = df.join(_few(hot), list(keys), "left").withColumn(SALT, salt).drop("salts")
    # Dealt as the buckets are, so each task writes one file.
    dealt = salted.repartition(number, *keys, SALT)
    dealt.write.bucketBy(number, *keys, SALT).option("path", path).format("parquet").saveAsTable(name)
    return Buckets(spark.table(name), tuple(keys), hot)


def meet(
    table: Buckets, right: DataFrame, how: str = "inner", where: Column | None = None
) -> DataFrame:
    """Join the bucketed rows (those that `where` lets through) with a table unique per key."""
    rows = table.rows if where is None else table.rows.where(where)
    numbers = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    repeated = right.join(_few(table.hot), list(table.keys), "left")
    repeated = repeated.withColumn(SALT, F.explode(numbers)).drop("salts")
    return rows.join(repeated, [*table.keys, SALT], how).drop(SALT)
