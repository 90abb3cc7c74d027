"""Derive tiling parameters from the tile-size distribution and resolve them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laserfold.functions.measures import quantiles
from laserfold.params import (
    ACCEPTABLE_SECONDS,
    CANDIDATE_TARGETS,
    FROM_CONTROL,
    FROM_DEFAULTS,
    SITE_RUN,
    GridParams,
)

SPREAD = (("p90", 0.90), ("p95", 0.95), ("p99", 0.99), ("p995", 0.995))


def tile_distribution(counts: DataFrame, scope: Sequence[str] = SITE_RUN) -> DataFrame:
    """Quantiles and maximum of points per tile, and the hottest tile, per scope."""
    order = F.struct("pointCount", (-F.col("tileX")).alias("nx"), (-F.col("tileY")).alias("ny"))
    summary = counts.groupBy(*scope).agg(
        quantiles("pointCount", [p for _, p in SPREAD]).alias("q"),
        F.max("pointCount").alias("maxTilePoints"),
        F.max(order).alias("top"),
    )
    return summary.select(
        *scope,
        *(F.col("q")[i].alias(name) for i, (name, _) in enumerate(SPREAD)),
        "maxTilePoints",
        (-F.col("top.nx")).alias("hotTileX"),
        (-F.col("top.ny")).alias("hotTileY"),
    )


def recommend_threshold(
    counts: DataFrame,
    scope: Sequence[str] = SITE_RUN,
    floor: int = GridParams.hot_tile_threshold,
) -> DataFrame:
    """Hot-tile threshold max(floor, p99) per scope and how many tiles reach it."""
    keys = list(scope)
    limits = tile_distribution(counts, scope).select(
        *keys,
        F.greatest(F.lit(floor).cast("long"), F.col("p99").cast("long")).alias("hotTileThreshold"),
        "maxTilePoints",
    )
    # The threshold depends on the whole scope, so hot tiles are counted in a second
    # aggregate; tiles are pre-grouped by size to keep a large scope off one task.
    sizes = counts.groupBy(*keys, "pointCount").agg(F.count(F.lit(1)).alias("tiles"))
    reach = F.coalesce(
        F.sum(F.when(F.col("pointCount") >= F.col("hotTileThreshold"), F.col("tiles"))), F.lit(0)
    )
    return (
        sizes.join(limits, keys)
        .groupBy(*keys, "hotTileThreshold", "maxTilePoints")
        .agg(reach.cast("long").alias("hotTiles"))
    )


def salt_candidates(
    distribution: DataFrame, targets: Sequence[int] = CANDIDATE_TARGETS, cap: int | None = None
) -> DataFrame:
    """Bucket counts that would bring the hottest tile down to each target size.

    `cap` bounds the counts where a caller's cluster asks for it."""
    wanted = F.explode(F.array(*(F.lit(t).cast("long") for t in targets)))
    needed = F.greatest(F.ceil(F.col("maxTilePoints") / F.col("targetPointsPerBucket")), F.lit(1))
    capped = needed if cap is None else F.least(needed, F.lit(cap))
    return distribution.withColumn("targetPointsPerBucket", wanted).withColumn(
        "saltBuckets", capped.cast("long")
    )


def choose_candidate(
    timed: DataFrame,
    scope: Sequence[str] = SITE_RUN,
    acceptable_seconds: float = ACCEPTABLE_SECONDS,
) -> DataFrame:
    """Largest target measured inside the time limit; if there is none, the fastest.

    `timed` holds `targetPointsPerBucket, saltBuckets, seconds` per scope."""
    option = F.struct("targetPointsPerBucket", "saltBuckets", "seconds")
    inside = F.col("seconds") <= acceptable_seconds
    fastest_first = F.struct("seconds", "targetPointsPerBucket")
    return (
        timed.groupBy(*scope)
        .agg(
            F.max_by(option, F.when(inside, F.col("targetPointsPerBucket"))).alias("fit"),
            F.min_by(option, fastest_first).alias("fast"),
        )
        .select(*scope, F.coalesce("fit", "fast").alias("pick"))
        .select(*scope, "pick.*")
    )


def control_rows(
    limits: DataFrame, choice: DataFrame, tile_size_m: float, scope: Sequence[str] = SITE_RUN
) -> DataFrame:
    """Rows for the append-only parameter table."""
    return limits.join(choice, list(scope)).select(
        *scope,
        F.lit(float(tile_size_m)).alias("tileSizeM"),
        "hotTileThreshold",
        "targetPointsPerBucket",
        "saltBuckets",
        "maxTilePoints",
        F.current_timestamp().alias("computedAt"),
    )


def resolve_params(
    scopes: DataFrame,
    control: DataFrame | None,
    params: GridParams = GridParams(),
    allow_fallback: bool = True,
    use_control: bool = True,
) -> DataFrame:
    """Effective tiling parameters of every (site, run).

    The newest control row wins over the defaults; salting is on when the largest
    tile reaches the bucket target. Scopes without a row get the defaults, or raise
    when fallback is off. A control table that cannot be read counts as absent."""
    names = ("tileSizeM", "hotTileThreshold", "targetPointsPerBucket", "saltBuckets", "enableSalt")
    defaults = dict(
        zip(
            names,
            (
                F.lit(float(params.tile_size_m)),
                F.lit(params.hot_tile_threshold).cast("long"),
                F.lit(params.target_points_per_bucket).cast("long"),
                F.lit(params.salt_buckets).cast("long"),
                F.lit(params.enable_salt),
            ),
        )
    )
    if not use_control or control is None:
        if use_control and not allow_fallback:
            raise ValueError("no control table and fallback is off")
        return scopes.select(
            *SITE_RUN,
            *(value.alias(name) for name, value in defaults.items()),
            F.lit(FROM_DEFAULTS).alias("paramSource"),
        )

    row = F.struct(
        "tileSizeM",
        "hotTileThreshold",
        "targetPointsPerBucket",
        "saltBuckets",
        (F.col("maxTilePoints") >= F.col("targetPointsPerBucket")).alias("enableSalt"),
    )
    newest = control.groupBy(*SITE_RUN).agg(F.max_by(row, "computedAt").alias("row"))
    joined = scopes.join(newest, list(SITE_RUN), "left")
    if not allow_fallback:
        lacking = joined.where(F.col("row").isNull()).first()
        if lacking is not None:
            raise ValueError(
                f"no control row for {lacking['siteId']}/{lacking['ingestRunId']} and fallback is off"
            )
    return joined.select(
        *SITE_RUN,
        *(F.coalesce(F.col(f"row.{name}"), value).alias(name) for name, value in defaults.items()),
        F.when(F.col("row").isNull(), FROM_DEFAULTS).otherwise(FROM_CONTROL).alias("paramSource"),
    )
