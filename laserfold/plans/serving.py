"""Read queries over the product tables: filter, order, page, and JSON payloads."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laserfold.functions.grid import boxes_overlap
from laserfold.operators.tiling import TILE
from laserfold.params import SITE
from laserfold.runtime import Stored, store

# So many scopes of a box query are literal terms.
RANGE_TERMS = 32

# Names of the orders a caller may ask for.
WATER_ORDERS = ("areaDesc",)
BUILDING_ORDERS = ("heightDesc", "heightRangeDesc")
TILE_ORDER_NAMES = (
    "tileId", "pointCountDesc", "waterRatioDesc", "heightP99Desc", "reliefDesc", "computedAtDesc",
)

# Fields of the JSON payloads.
TILE_PAYLOAD = (
    "siteId", "tileId", "pointCount", "z_p50", "z_p95", "z_p99", "waterPointRatio",
    "isMostlyWater", "computedAt",
)
WATER_PAYLOAD = (
    "waterBodyId", "areaM2", "cellCount", "meanZ", "minZ", "maxZ",
    "bboxMinCellX", "bboxMinCellY", "bboxMaxCellX", "bboxMaxCellY", "computedAt",
)
BUILDING_PAYLOAD = (
    "buildingCandidateId", "tileId", "heightAboveGround", "heightRange", "pointsUsed",
    "cellCount", "minZ", "meanZ", "maxZ", "computedAt",
)
RUN_PAYLOAD = (
    "siteId", "runId", "status", "startedAt", "finishedAt", "errorMessage", "producedSnapshotAt",
)


def _check_page(limit: int | None, most: int | None, offset: int = 0) -> None:
    """`most` is the caller's own bound on a page."""
    if limit is not None and limit < 1:
        raise ValueError("limit must be 1 or greater")
    if most is not None and (limit is None or limit > most):
        raise ValueError(f"limit must be between 1 and {most}")
    if offset < 0:
        raise ValueError("offset must be 0 or greater")


def _page(df: DataFrame, limit: int | None, offset: int = 0) -> DataFrame:
    """All rows, or a page of them."""
    shifted = df.offset(offset) if offset else df
    return shifted if limit is None else shifted.limit(limit)


def _check_minimum(name: str, value: float | None) -> None:
    if value is not None and value < 0:
        raise ValueError(f"{name} must be 0 or greater")


def _check_order(order: str | None, known: tuple[str, ...]) -> str:
    if order is None or not order.strip():
        return known[0]
    if order not in known:
        raise ValueError("order must be one of: " + ", ".join(known))
    return order


def _tile_sort(order: str) -> list[Column]:
    measure = {
        "pointCountDesc": F.col("pointCount"),
        "waterRatioDesc": F.col("waterPointRatio"),
        "heightP99Desc": F.col("z_p99"),
        "reliefDesc": F.col("z_p95") - F.col("z_p50"),
        "computedAtDesc": F.col("computedAt"),
    }
    tie = F.col("tileId").asc()
    return [tie] if order == "tileId" else [measure[order].desc(), tie]


def list_tiles(
    stats: DataFrame,
    site_id: str,
    skip_mostly_water: bool = False,
    min_points: int | None = None,
    order: str | None = None,
    limit: int | None = None,
    offset: int = 0,
    most: int | None = None,
) -> DataFrame:
    """The tiles of one site, or a page of them; equal measures are ordered by tile id."""
    name = _check_order(order, TILE_ORDER_NAMES)
    _check_page(limit, most, offset)
    _check_minimum("min_points", min_points)
    tiles = stats.where(F.col("siteId") == site_id)
    if skip_mostly_water:
        tiles = tiles.where(~F.col("isMostlyWater"))
    if min_points is not None:
        tiles = tiles.where(F.col("pointCount") >= min_points)
    return _page(tiles.orderBy(*_tile_sort(name)), limit, offset)


def list_water(
    bodies: DataFrame,
    site_id: str,
    min_area_m2: float | None = None,
    order: str | None = None,
    limit: int | None = None,
    most: int | None = None,
) -> DataFrame:
    """The water bodies of a site, largest first, or the first of them."""
    _check_order(order, WATER_ORDERS)
    _check_page(limit, most)
    _check_minimum("min_area_m2", min_area_m2)
    found = bodies.where(F.col("siteId") == site_id)
    if min_area_m2 is not None:
        found = found.where(F.col("areaM2") >= min_area_m2)
    return _page(found.orderBy(F.desc("areaM2"), "waterBodyId"), limit)


def water_by_id(bodies: DataFrame, site_id: str, water_body_id: int) -> DataFrame:
    wanted = (F.col("siteId") == site_id) & (F.col("waterBodyId") == water_body_id)
    return bodies.where(wanted).limit(1)


def list_buildings(
    candidates: DataFrame,
    site_id: str,
    tile_id: str | None = None,
    min_height: float | None = None,
    order: str | None = None,
    limit: int | None = None,
    most: int | None = None,
) -> DataFrame:
    """Building candidates of a site, highest (or most uneven) first."""
    name = _check_order(order, BUILDING_ORDERS)
    _check_page(limit, most)
    _check_minimum("min_height", min_height)
    found = candidates.where(F.col("siteId") == site_id)
    if tile_id is not None and tile_id.strip():
        found = found.where(F.col("tileId") == tile_id)
    if min_height is not None:
        found = found.where(F.col("heightAboveGround") >= min_height)
    measure = "heightRange" if name == "heightRangeDesc" else "heightAboveGround"
    return _page(found.orderBy(F.desc(measure), "buildingCandidateId"), limit)


def building_by_id(
    candidates: DataFrame, site_id: str, tile_id: str, candidate_id: str
) -> DataFrame:
    return candidates.where(
        (F.col("siteId") == site_id)
        & (F.col("tileId") == tile_id)
        & (F.col("buildingCandidateId") == candidate_id)
    ).limit(1)


def latest_runs(runs: DataFrame) -> DataFrame:
    """Newest run of every site (run id breaks ties), in one aggregate."""
    rest = [c for c in runs.columns if c not in ("siteId", "runId", "createdAt")]
    newest = F.max(F.struct("createdAt", "runId", *rest)).alias("r")
    return runs.groupBy("siteId").agg(newest).select("siteId", "r.*")


def run_by_id(runs: DataFrame, site_id: str, run_id: str) -> DataFrame:
    return runs.where((F.col("siteId") == site_id) & (F.col("runId") == run_id)).limit(1)


def as_payload(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """One JSON text per row; a field that the table lacks is an error."""
    absent = [f for f in fields if f not in df.columns]
    if absent:
        raise ValueError("the table lacks " + ", ".join(absent))
    return df.select(F.to_json(F.struct(*fields)).alias("payload"))


@dataclass(frozen=True)
class TileRange:
    """Inclusive tile index range."""

    min_x: int
    min_y: int
    max_x: int
    max_y: int


def tile_range(
    box: tuple[float, float, float, float],
    origin: tuple[float, float],
    tile_size_m: float,
) -> TileRange:
    """Tiles a query box touches, for a site whose origin is known."""
    low_x, low_y, high_x, high_y = (
        math.floor((value - origin[i % 2]) / tile_size_m) for i, value in enumerate(box)
    )
    return TileRange(low_x, low_y, high_x, high_y)


def in_tile_range(df: DataFrame, tiles: TileRange) -> DataFrame:
    """Literal range filter on the clustering columns; Parquet skips row groups by it."""
    return df.where(
        F.col(TILE[0]).between(tiles.min_x, tiles.max_x)
        & F.col(TILE[1]).between(tiles.min_y, tiles.max_y)
    )


def _scope_ranges(
    origins: DataFrame, box: tuple[float, float, float, float], tile_size_m: float, scope: Sequence[str]
) -> Stored:
    """The tiles that the box touches in each scope, by the scope's own origin and tile size.

    Tile indices count from a scope's lowest coordinates, so none is negative: scopes that
    begin beyond the box are left out."""
    own = F.col("tileSizeM") if "tileSizeM" in origins.columns else F.lit(None)
    size = F.coalesce(own.cast("double"), F.lit(float(tile_size_m)))
    sides = zip(("low_x", "low_y", "high_x", "high_y"), box, ("originX", "originY") * 2, strict=True)
    ranges = origins.select(
        *scope, *(F.floor((F.lit(float(at)) - F.col(zero)) / size).alias(side) for side, at, zero in sides)
    ).where("high_x >= 0 and high_y >= 0")
    return store(
        ranges,
        "tile-ranges",
        low_x=F.min("low_x"),
        low_y=F.min("low_y"),
        high_x=F.max("high_x"),
        high_y=F.max("high_y"),
        nulls=F.count(F.when(reduce(Column.__or__, (F.col(c).isNull() for c in scope)), 1)),
    )


def _in_site_tiles(
    df: DataFrame,
    box: tuple[float, float, float, float],
    origins: DataFrame,
    tile_size_m: float,
    margin_m: float,
    scope: Sequence[str],
) -> DataFrame:
    """Rows in the tiles that the box touches in their scope (site, or run).

    Up to RANGE_TERMS scopes are literal ranges, which skip row groups. More are joined, so
    the plan does not grow; a literal range around all of them still reaches the scan, and
    a broadcast of the ranges prunes partitions."""
    wide = (box[0] - margin_m, box[1] - margin_m, box[2] + margin_m, box[3] + margin_m)
    found = _scope_ranges(origins, wide, tile_size_m, scope)
    if found.rows <= RANGE_TERMS:
        terms = [
            reduce(
                Column.__and__,
                (
                    *(F.col(c).eqNullSafe(F.lit(row[c])) for c in scope),
                    F.col(TILE[0]).between(row["low_x"], row["high_x"]),
                    F.col(TILE[1]).between(row["low_y"], row["high_y"]),
                ),
            )
            for row in found.df.collect()
        ]
        return df.where(reduce(Column.__or__, terms) if terms else F.lit(False))
    around = TileRange(*(found.metrics[k] for k in ("low_x", "low_y", "high_x", "high_y")))
    near = in_tile_range(df, around).alias("near")
    ranges = (F.broadcast(found.df) if found.broadcastable else found.df).alias("ranges")
    # Plain equality lets partitions be pruned while the query runs.
    same = Column.eqNullSafe if found.metrics["nulls"] else Column.__eq__
    meets = reduce(
        Column.__and__,
        (
            *(same(F.col(f"near.{c}"), F.col(f"ranges.{c}")) for c in scope),
            F.col(f"near.{TILE[0]}").between(F.col("ranges.low_x"), F.col("ranges.high_x")),
            F.col(f"near.{TILE[1]}").between(F.col("ranges.low_y"), F.col("ranges.high_y")),
        ),
    )
    return near.join(ranges.where("high_x >= 0"), meets, "left_semi")


def in_box(
    df: DataFrame,
    box: tuple[float, float, float, float],
    columns: tuple[str, str, str, str] = ("minX", "minY", "maxX", "maxY"),
    origins: DataFrame | None = None,
    tile_size_m: float = 25.0,
    margin_m: float = 0.0,
    scope: Sequence[str] = SITE,
) -> DataFrame:
    """Rows whose extent overlaps a query box.

    With the table of origins, each site's own tile range prunes first; the range is
    widened by `margin_m`, the most that a row's extent leaves its tile (a cell). Where
    the table has a column tileSizeM, as resolved parameters do, it holds for its scope."""
    near = df
    if origins is not None:
        near = _in_site_tiles(df, box, origins, tile_size_m, margin_m, scope)
    return near.where(boxes_overlap(columns, box))
