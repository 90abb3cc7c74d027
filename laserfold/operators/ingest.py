"""Checks and normalisation between a landing scan and the raw point table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laserfold import schemas


def check_columns(df: DataFrame, needed: Iterable[str] = schemas.POINTS_RAW.names) -> DataFrame:
    """Raise before any job runs, naming every absent column."""
    have = set(df.columns)
    absent = [name for name in needed if name not in have]
    if absent:
        raise ValueError("points lack required columns: " + ", ".join(absent))
    return df


def clean_points(df: DataFrame) -> DataFrame:
    """Raw-safe cleaning: `ingestTime` as timestamp, rows without geometry dropped.

    Plain null tests, unlike `dropna`, are pushed into the Parquet scan."""
    check_columns(df)
    for axis in ("x", "y", "z"):
        df = df.where(F.col(axis).isNotNull())
    return df.withColumn("ingestTime", F.col("ingestTime").cast("timestamp"))


def add_context(df: DataFrame, site_id: str, run_id: str) -> DataFrame:
    """Stamp points of one upload with site, run and the load time."""
    return df.withColumns(
        {
            "siteId": F.lit(site_id),
            "ingestRunId": F.lit(run_id),
            "ingestTime": F.current_timestamp(),
        }
    )


def resolve_columns(
    df: DataFrame, wanted: Iterable[str] | None = None, keep_all: bool = False
) -> tuple[DataFrame, list[str]]:
    """Select requested columns by case-insensitive name.

    x, y and z are always accepted (and come out in lower case). Repeats count once,
    order is kept, unknown names are returned as the second value. Without `wanted`
    the default point-file columns are taken; `keep_all` takes geometry and the rest.
    """
    geometry = ("x", "y", "z")
    actual = {name.lower(): name for name in reversed(df.columns)}
    if keep_all:
        asked = [*geometry, *df.columns]
    else:
        asked = list(schemas.POINT_FILE_COLUMNS if wanted is None else wanted)

    chosen: dict[str, str] = {}
    unknown: list[str] = []
    for name in asked:
        low = name.strip().lower()
        source = name if name in df.columns else actual.get(low)
        if source is None:
            unknown.append(name)
        else:
            chosen.setdefault(low if low in geometry else source, source)
    if not chosen:
        raise ValueError("none of the requested columns exists")
    picked = [F.col(f"`{source}`").alias(target) for target, source in chosen.items()]
    return df.select(*picked), unknown


def scope_filter(df: DataFrame, site_id: str | None = None, run_id: str | None = None) -> DataFrame:
    """Keep one site and/or run, using only those of the two columns that exist."""
    for column, value in (("siteId", site_id), ("ingestRunId", run_id)):
        if value is not None and column in df.columns:
            df = df.where(F.col(column) == value)
    return df


def runs_per_site(points: DataFrame) -> DataFrame:
    """Number of ingest runs of each site, and the run where it is the only one."""
    per_run = points.groupBy("siteId", "ingestRunId").agg(F.count(F.lit(1)).alias("points"))
    return per_run.groupBy("siteId").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("points").alias("points"),
        F.when(F.count(F.lit(1)) == 1, F.max("ingestRunId")).alias("onlyRunId"),
    )


def single_run(points: DataFrame, site_id: str) -> str:
    """The one ingest run of a site; raises on none or several."""
    row = runs_per_site(points.where(F.col("siteId") == site_id)).first()
    if row is None or row["runs"] != 1:
        found = 0 if row is None else row["runs"]
        raise ValueError(f"site {site_id} has {found} ingest runs, expected exactly one")
    return row["onlyRunId"]
