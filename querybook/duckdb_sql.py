"""The SQL that checks each query, for DuckDB on the same Parquet tables."""

from __future__ import annotations

from querybook import inputs

SITE = "siteId"
RUN = "siteId, ingestRunId"

POINTS = inputs.in_sql(inputs.POINTS)
BOX = (1010.0, 2010.0, 1035.0, 2040.0)


def _chain(scope: str) -> dict[str, tuple[tuple[str, ...], str]]:
    """Named steps: what each one needs, and its text."""
    on = " AND ".join(f"a.{c.strip()} = b.{c.strip()}" for c in scope.split(","))
    return {
        "points": ((), f"SELECT * FROM {POINTS}"),
        "origin": (
            ("points",),
            f"SELECT {scope}, min(x) AS originX, min(y) AS originY FROM points GROUP BY {scope}",
        ),
        "tiled": (
            ("origin",),
            f"""
            SELECT *, CAST(tileX AS VARCHAR) || '_' || CAST(tileY AS VARCHAR) AS tileId FROM (
              SELECT a.*, b.originX, b.originY, 25e0 AS tileSizeM,
                CAST(floor((a.x - b.originX) / 25e0) AS INT) AS tileX,
                CAST(floor((a.y - b.originY) / 25e0) AS INT) AS tileY
              FROM points a JOIN origin b ON {on})""",
        ),
        "counts": (
            ("tiled",),
            f"SELECT {scope}, tileX, tileY, count(*) AS pointCount FROM tiled "
            f"GROUP BY {scope}, tileX, tileY",
        ),
        "stats": (
            ("tiled",),
            f"""
            SELECT *, waterPointRatio >= 0.6e0 AS isMostlyWater FROM (
              SELECT {scope}, tileId, tileX, tileY, count(*) AS pointCount,
                CAST(sum(CASE WHEN classification = 9 THEN 1 ELSE 0 END) AS BIGINT) AS waterPointCount,
                min(z) AS minZ, max(z) AS maxZ,
                quantile_disc(z, 0.50) AS z_p50, quantile_disc(z, 0.95) AS z_p95,
                quantile_disc(z, 0.99) AS z_p99,
                quantile_disc(intensity, 0.50) AS intensity_p50,
                quantile_disc(intensity, 0.95) AS intensity_p95,
                sum(CASE WHEN classification = 9 THEN 1e0 ELSE 0e0 END) / count(*) AS waterPointRatio
              FROM tiled GROUP BY {scope}, tileId, tileX, tileY)""",
        ),
        "boxes": (
            ("tiled",),
            f"""
            SELECT {scope}, tileX, tileY, count(*) AS pointCount,
              CAST(count(*) FILTER (classification = 9) AS BIGINT) AS waterCount,
              min(x) AS minX, max(x) AS maxX, min(y) AS minY, max(y) AS maxY,
              min(z) AS minZ, max(z) AS maxZ, sum(z) / count(*) AS avgZ,
              CAST(count(*) FILTER (classification = 9) AS DOUBLE) / count(*) AS waterRatio,
              25e0 AS tileSizeM
            FROM tiled GROUP BY {scope}, tileX, tileY""",
        ),
        "mask": (
            ("boxes",),
            f"SELECT {scope}, tileX, tileY, waterRatio, minX, minY, maxX, maxY, tileSizeM, "
            "CAST(1 AS INT) AS isMostlyWater FROM boxes WHERE waterRatio >= 0.2e0",
        ),
        "cells": (
            ("tiled", "stats"),
            f"""
            SELECT {scope}, tileX, tileY, cellX, cellY, count(*) AS pointCount,
              CAST(count(*) FILTER (classification = 9) AS BIGINT) AS waterPointCount,
              min(z) AS minZ, avg(z) AS meanZ, max(z) AS maxZ, quantile_disc(z, 0.5) AS z_p50,
              any_value(tileId) AS tileId,
              CAST(count(*) FILTER (classification = 9) AS DOUBLE) / count(*) AS waterPointRatio,
              0.5e0 AS cellSizeM
            FROM (
              SELECT a.*,
                CAST(floor((x - (originX + a.tileX * 25e0)) / 0.5e0) AS INT) AS cellX,
                CAST(floor((y - (originY + a.tileY * 25e0)) / 0.5e0) AS INT) AS cellY
              FROM tiled a JOIN stats b ON {on} AND a.tileId = b.tileId
              WHERE b.pointCount >= <<min_points>> AND b.waterPointRatio < 0.8e0)
            GROUP BY {scope}, tileX, tileY, cellX, cellY""",
        ),
        "patches": (
            ("cells",),
            f"""
            SELECT *, CASE WHEN waterPointRatio >= 0.7e0 THEN 'water' ELSE 'ground' END AS surfaceType
            FROM (
              SELECT {scope}, tileX, tileY, patchX, patchY, count(*) AS cellCount,
                CAST(sum(pointCount) AS BIGINT) AS pointsUsed,
                CAST(sum(waterPointCount) AS BIGINT) AS waterPointCount,
                min(minZ) AS minZ, max(maxZ) AS maxZ, round(avg(meanZ), 6) AS meanZ,
                avg(meanZ) AS rawMeanZ,
                sum(meanZ * pointCount) / sum(pointCount) AS rawWeighted,
                0.5e0 AS cellSizeM, any_value(tileId) AS tileId,
                CAST(patchX AS VARCHAR) || '_' || CAST(patchY AS VARCHAR) AS patchId,
                CAST(sum(waterPointCount) AS DOUBLE) / sum(pointCount) AS waterPointRatio
              FROM (SELECT *, CAST(floor(cellX / 8e0) AS INT) AS patchX,
                      CAST(floor(cellY / 8e0) AS INT) AS patchY FROM cells)
              GROUP BY {scope}, tileX, tileY, patchX, patchY)""",
        ),
        "ground": (
            ("patches",),
            f"SELECT {scope}, tileX, tileY, quantile_disc(minZ, 0.1) AS groundZ_ref FROM patches "
            f"WHERE surfaceType = 'ground' GROUP BY {scope}, tileX, tileY",
        ),
        "buildings": (
            ("patches", "ground"),
            f"""
            SELECT {', '.join('a.' + c.strip() for c in scope.split(','))}, a.tileId,
              a.tileId || '|' || a.patchId AS buildingCandidateId, a.pointsUsed, a.cellCount,
              a.minZ, a.meanZ, a.maxZ, round(a.rawMeanZ - b.groundZ_ref, 6) AS heightAboveGround,
              a.maxZ - a.minZ AS heightRange
            FROM patches a JOIN ground b ON {on} AND a.tileX = b.tileX AND a.tileY = b.tileY
            WHERE a.surfaceType = 'ground' AND a.pointsUsed >= 20
              AND a.rawMeanZ - b.groundZ_ref >= 2.5e0 AND a.maxZ - a.minZ <= 3e0""",
        ),
        "wet": (
            ("cells",),
            f"""
            SELECT {scope}, CAST(tileX * 50 + cellX AS INT) AS globalCellX,
              CAST(tileY * 50 + cellY AS INT) AS globalCellY, minZ, meanZ, maxZ, cellSizeM,
              CAST(tileX * 50 + cellX AS BIGINT) * 4294967296 + (tileY * 50 + cellY) AS vertexId
            FROM cells WHERE waterPointRatio >= 0.7e0""",
        ),
        "reach": (
            ("wet",),
            f"""
            SELECT {scope}, vertexId, vertexId AS lab FROM wet
            UNION
            SELECT {', '.join('b.' + c.strip() for c in scope.split(','))}, b.vertexId, a.lab
            FROM reach a JOIN wet b ON {on}
              AND b.vertexId IN (a.vertexId + 1, a.vertexId - 1, a.vertexId + 4294967296,
                a.vertexId - 4294967296<<diagonal>>)
              AND a.lab < b.vertexId""",
        ),
        "labelled": (
            ("wet", "reach"),
            f"SELECT {scope}, vertexId, min(lab) AS waterBodyId FROM reach GROUP BY {scope}, vertexId",
        ),
        "bodies": (
            ("labelled",),
            f"""
            SELECT {', '.join('a.' + c.strip() for c in scope.split(','))}, b.waterBodyId,
              count(*) AS cellCount, count(*) * 0.25e0 AS areaM2, min(minZ) AS minZ,
              max(maxZ) AS maxZ, round(avg(meanZ), 6) AS meanZ,
              min(globalCellX) AS bboxMinCellX, min(globalCellY) AS bboxMinCellY,
              max(globalCellX) AS bboxMaxCellX, max(globalCellY) AS bboxMaxCellY
            FROM wet a JOIN labelled b ON {on} AND a.vertexId = b.vertexId
            GROUP BY {', '.join('a.' + c.strip() for c in scope.split(','))}, b.waterBodyId""",
        ),
        "coarse": (
            ("tiled", "boxes"),
            f"""
            SELECT siteId, ingestRunId, tileX, tileY, cellX, cellY, surfaceType,
              count(*) AS pointCountCell,
              CASE WHEN surfaceType = 'water' THEN quantile_disc(z, 0.5)
                ELSE quantile_disc(z, 0.1) END AS z,
              any_value(cornerX) + cellX AS cellMinX, any_value(cornerY) + cellY AS cellMinY,
              any_value(cornerX) + cellX + 1e0 AS cellMaxX, any_value(cornerY) + cellY + 1e0 AS cellMaxY,
              25e0 AS tileSizeM
            FROM (
              SELECT a.*, b.minX AS cornerX, b.minY AS cornerY,
                CAST(floor(a.x - b.minX) AS INT) AS cellX, CAST(floor(a.y - b.minY) AS INT) AS cellY,
                CASE a.classification WHEN 9 THEN 'water' WHEN 2 THEN 'ground' END AS surfaceType
              FROM tiled a JOIN boxes b ON {on} AND a.tileX = b.tileX AND a.tileY = b.tileY)
            WHERE surfaceType IS NOT NULL
            GROUP BY siteId, ingestRunId, tileX, tileY, cellX, cellY, surfaceType""",
        ),
        "summary": (
            ("coarse",),
            """
            SELECT siteId, ingestRunId, surfaceType, tileX, tileY, count(*) AS cellCount,
              CAST(sum(pointCountCell) AS BIGINT) AS pointCountUsed, min(cellMinX) AS minX,
              min(cellMinY) AS minY, max(cellMaxX) AS maxX, max(cellMaxY) AS maxY,
              round(avg(z), 6) AS avgZ, 25e0 AS tileSizeM, 1e0 AS cellSizeM,
              siteId || '_' || ingestRunId || '_' || tileX || '_' || tileY || '_' || surfaceType AS surfaceId,
              count(*) / 625e0 AS quality, CAST(NULL AS VARCHAR) AS cellsUri,
              'mvp_grid_v1' AS algoVersion
            FROM coarse GROUP BY siteId, ingestRunId, surfaceType, tileX, tileY""",
        ),
        "voxels": (
            ("tiled",),
            f"""
            SELECT {scope}, tileId, CAST(floor(x / 0.2e0) AS BIGINT) AS vx,
              CAST(floor(y / 0.2e0) AS BIGINT) AS vy, CAST(floor(z / 0.2e0) AS BIGINT) AS vz,
              avg(x) AS x, avg(y) AS y, avg(z) AS z
            FROM tiled GROUP BY {scope}, tileId, floor(x / 0.2e0), floor(y / 0.2e0), floor(z / 0.2e0)""",
        ),
        "limits": (
            ("counts",),
            f"""
            SELECT {scope}, quantile_disc(pointCount, 0.9) AS p90,
              quantile_disc(pointCount, 0.95) AS p95, quantile_disc(pointCount, 0.99) AS p99,
              quantile_disc(pointCount, 0.995) AS p995, max(pointCount) AS maxTilePoints,
              first(tileX ORDER BY pointCount DESC, tileX, tileY) AS hotTileX,
              first(tileY ORDER BY pointCount DESC, tileX, tileY) AS hotTileY
            FROM counts GROUP BY {scope}""",
        ),
        "threshold": (
            ("counts", "limits"),
            f"""
            SELECT {', '.join('a.' + c.strip() for c in scope.split(','))},
              greatest(1000, b.p99) AS hotTileThreshold, b.maxTilePoints,
              count(*) FILTER (a.pointCount >= greatest(1000, b.p99)) AS hotTiles
            FROM counts a JOIN limits b ON {on}
            GROUP BY {', '.join('a.' + c.strip() for c in scope.split(','))}, b.p99, b.maxTilePoints""",
        ),
        "candidates": (
            ("limits",),
            f"""
            SELECT {scope}, maxTilePoints, target AS targetPointsPerBucket,
              CAST(greatest(ceil(maxTilePoints / target), 1) AS BIGINT) AS saltBuckets
            FROM limits, (SELECT unnest([50, 500, 1000, 2000, 5000, 50000]) AS target)""",
        ),
        "choice": (
            ("candidates",),
            f"""
            SELECT {scope}, CAST(targetPointsPerBucket AS BIGINT) AS targetPointsPerBucket,
              saltBuckets, seconds
            FROM (SELECT *, row_number() OVER (PARTITION BY {scope} ORDER BY
                    seconds <= 120 DESC,
                    CASE WHEN seconds <= 120 THEN -targetPointsPerBucket ELSE seconds END,
                    targetPointsPerBucket) AS rn
                  FROM (SELECT *, ceil(maxTilePoints / saltBuckets) / 10e0 AS seconds FROM candidates))
            WHERE rn = 1""",
        ),
        "control": (
            ("threshold", "choice"),
            """
            SELECT a.siteId, a.ingestRunId, 25e0 AS tileSizeM, a.hotTileThreshold,
              b.targetPointsPerBucket, b.saltBuckets, a.maxTilePoints
            FROM threshold a JOIN choice b USING (siteId, ingestRunId)
            WHERE a.ingestRunId = 'run_1'""",
        ),
    }


def chain(body: str, *steps: str, scope: str = RUN, min_points: int = 500, diagonal: bool = False) -> str:
    """`body` behind the WITH clause of all the steps it needs."""
    known = _chain(scope)
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in known[name][0]:
            visit(needed)
        if name not in order:
            order.append(name)

    for step in steps:
        visit(step)
    corners = ", ".join(f"a.vertexId {s} {1 << 32} {t} 1" for s in "+-" for t in "+-")
    text = ",\n".join(f"{name} AS ({known[name][1]})" for name in order)
    text = text.replace("<<min_points>>", str(min_points))
    text = text.replace("<<diagonal>>", ", " + corners if diagonal else "")
    return f"WITH RECURSIVE {text}\n{body}"


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def second(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


CONTENT = f"""
SELECT siteId, ingestRunId, count(*) AS points, CAST(sum(intensity) AS BIGINT) AS intensity,
  min(x) AS minX, max(y) AS maxY, sum(z) AS sumZ, {day('max(ingestTime)')} AS lastDay
FROM points GROUP BY siteId, ingestRunId"""

OVERLAP = "{0}maxX >= 1010 AND {0}minX <= 1035 AND {0}maxY >= 2010 AND {0}minY <= 2040"
CELL_OVERLAP = "cellMaxX >= {0} AND cellMinX <= {2} AND cellMaxY >= {1} AND cellMinY <= {3}"
CELL_BOXES = {
    "bbox_cells": (1010, 2010, 1035, 2040),
    "bbox_cells_one_tile": (1004.5, 2004.5, 1007, 2008),
    "bbox_cells_border": (1025.1, 2010, 1025.3, 2014),
}

FOLD = f"""
SELECT jobId, siteId,
  list_extract(['NONE', 'CREATED', 'QUEUED', 'DBX_TRIGGERED', 'PROCESSING', 'SUCCEEDED', 'FAILED'],
    CAST(e.code + 1 AS BIGINT)) AS status,
  {second('e.ts')} AS updatedAt
FROM (
  SELECT jobId, min(siteId) AS siteId,
    list_reduce(list_prepend({{'code': 0, 'ts': CAST(NULL AS TIMESTAMP)}},
        list({{'code': code, 'ts': CAST(ts AS TIMESTAMP)}} ORDER BY ts, event_id)),
      lambda s, c: CASE WHEN (s.code < 4 AND c.code = s.code + 1) OR (s.code = 4 AND c.code >= 5)
        THEN c ELSE s END) AS e
  FROM (SELECT *, CASE eventStatus WHEN 'CREATED' THEN 1 WHEN 'QUEUED' THEN 2 WHEN 'DBX_TRIGGERED' THEN 3
          WHEN 'PROCESSING' THEN 4 WHEN 'SUCCEEDED' THEN 5 ELSE 6 END AS code
        FROM {inputs.in_sql(inputs.EVENTS)})
  GROUP BY jobId)"""

CREATES = f"""
SELECT idempotencyKey, jobId, siteId, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY idempotencyKey ORDER BY ts, event_id) AS rn
  FROM {{source}} WHERE eventStatus = 'CREATED')
WHERE rn = 1"""

NORMAL = """CASE WHEN upper(trim({0})) LIKE '%SUCCESS%' OR upper(trim({0})) IN ('SUCCEEDED', 'OK', 'COMPLETED')
  THEN 'SUCCESS' WHEN regexp_matches(upper(trim({0})), 'FAIL|ERROR|CANCEL') THEN 'FAILED' END"""


def json_paths(*paths: str) -> str:
    found = ", ".join(f"json_extract_string(doc, '{p}')" for p in paths)
    return f"coalesce({found})"


def _sample_steps(n: int) -> str:
    """Steps of a farthest-point sample: pick the farthest row, then shrink the gaps."""
    parts = ["pick0 AS (SELECT k, CAST(1 AS BIGINT) AS rn, 0 AS seq FROM ranked WHERE rn = 1)"]
    gaps = "ranked"
    for i in range(1, n):
        near = "" if i == 1 else "g.gap, "
        parts.append(
            f"gap{i} AS (SELECT g.k, g.rn, g.x, g.y, g.z, least({near}(g.x - c.x) * (g.x - c.x) "
            "+ (g.y - c.y) * (g.y - c.y) + (g.z - c.z) * (g.z - c.z)) AS gap "
            f"FROM {gaps} g JOIN pick{i - 1} p ON g.k = p.k JOIN ranked c ON c.k = p.k AND c.rn = p.rn)"
        )
        parts.append(
            f"pick{i} AS (SELECT k, first(rn ORDER BY gap DESC, rn) AS rn, {i} AS seq FROM gap{i} GROUP BY k)"
        )
        gaps = f"gap{i}"
    return ",\n".join(parts)


def texts() -> dict[str, str]:
    salted = chain(
        """
        SELECT a.siteId, a.ingestRunId, a.tileX, a.tileY,
          CAST(CASE WHEN pointCount >= 2000 THEN 1 ELSE 0 END AS INT) AS isHotTile,
          pointCount AS points, pointCount AS saltInRange, CAST(0 AS BIGINT) AS saltOutsideHot
        FROM counts a""",
        "counts",
    )
    clean = f"SELECT * FROM {inputs.in_sql(inputs.LANDING)} WHERE x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL"
    pages = {
        "list_tiles_id": "ORDER BY tileId",
        "list_tiles_points": "ORDER BY pointCount DESC, tileId",
        "list_tiles_water": "ORDER BY waterPointRatio DESC, tileId",
        "list_tiles_p99": "ORDER BY z_p99 DESC, tileId",
        "list_tiles_relief": "AND pointCount >= 100 ORDER BY z_p95 - z_p50 DESC, tileId",
        "list_tiles_paged": "AND NOT isMostlyWater ORDER BY pointCount DESC, tileId LIMIT 2 OFFSET 1",
    }
    out = {
        "points_clean": clean,
        "ingest_context": "SELECT x, y, z, intensity, classification, return_number, number_of_returns, "
        f"gps_time, 'site_c' AS siteId, 'run_9' AS ingestRunId, true AS ingestTime FROM {POINTS}",
        "scope_filter": chain(
            """
            SELECT 'both' AS layer, classification, count(*) AS points FROM points
              WHERE siteId = 'site_b' AND ingestRunId = 'run_1' GROUP BY classification
            UNION ALL SELECT 'site', classification, count(*) FROM points
              WHERE siteId = 'site_b' GROUP BY classification
            UNION ALL SELECT 'run', classification, count(*) FROM points
              WHERE ingestRunId = 'run_1' GROUP BY classification
            UNION ALL SELECT 'none', classification, count(*) FROM points GROUP BY classification""",
            "points",
        ),
        "column_resolution": f"SELECT x, y, intensity, z, classification, 'colour' AS unknown FROM {POINTS}",
        "raw_append_readback": chain(CONTENT, "points"),
        "append_check": chain(
            "SELECT siteId, ingestRunId, count(*) AS rows FROM points GROUP BY siteId, ingestRunId "
            "UNION ALL SELECT NULL, NULL, count(*) FROM points",
            "points",
        ),
        "snapshot_replace": chain(
            "SELECT * FROM counts WHERE (siteId = 'site_b' AND ingestRunId = 'run_1') "
            "OR (siteId = 'site_a' AND ingestRunId = 'run_2')",
            "counts",
        ),
        "partition_overwrite": chain(
            "SELECT siteId, ingestRunId, surfaceType, count(*) AS cells, "
            "CAST(sum(pointCountCell) AS BIGINT) AS points FROM coarse "
            "WHERE surfaceType = 'ground' OR pointCountCell > 1 GROUP BY siteId, ingestRunId, surfaceType",
            "coarse",
        ),
        "register_read": chain(
            "SELECT siteId, classification, count(*) AS points FROM points GROUP BY siteId, classification",
            "points",
        ),
        "stream_ingest": chain(CONTENT, "points"),
        "clustered_rewrite": chain(
            "SELECT siteId, ingestRunId, tileX, tileY, count(*) AS points, sum(z) AS sumZ FROM tiled "
            "GROUP BY siteId, ingestRunId, tileX, tileY",
            "tiled",
        ),
        "tile_assign": chain(
            "SELECT * EXCLUDE (ingestTime, return_number, number_of_returns) FROM tiled", "tiled"
        ),
        "tile_counts": chain("SELECT * FROM counts", "counts"),
        "tile_id_parse": chain(
            "SELECT siteId, ingestRunId, tileX AS tx, tileY AS ty, pointCount AS points FROM counts", "counts"
        ),
        "hot_tiles": chain("SELECT * FROM counts WHERE pointCount >= 2000", "counts"),
        "salted_points": salted,
        "salting_off": chain(
            "SELECT siteId, ingestRunId, CAST(0 AS INT) AS tileSalt, CAST(0 AS INT) AS isHotTile, "
            "count(*) AS points FROM tiled GROUP BY siteId, ingestRunId",
            "tiled",
        ),
        "salted_agg": chain(
            "SELECT siteId, ingestRunId, tileX, tileY, count(*) AS pointCount, min(z) AS minZ, "
            "max(z) AS maxZ FROM tiled GROUP BY siteId, ingestRunId, tileX, tileY",
            "tiled",
        ),
        "salt_equivalence": chain(
            "SELECT siteId, ingestRunId, CAST(0 AS BIGINT) AS differing, count(*) AS points FROM tiled "
            "GROUP BY siteId, ingestRunId",
            "tiled",
        ),
        "tile_distribution": chain("SELECT * FROM limits", "limits"),
        "hot_threshold": chain("SELECT * FROM threshold", "threshold"),
        "salt_candidates": chain("SELECT * FROM candidates", "candidates"),
        "choose_salt": chain("SELECT * FROM choice", "choice"),
        "control_append": chain("SELECT * FROM control", "control"),
        "resolve_params": chain(
            """
            SELECT s.siteId, s.ingestRunId, 25e0 AS tileSizeM,
              coalesce(c.hotTileThreshold, 100000) AS hotTileThreshold,
              CASE WHEN c.siteId IS NULL THEN 600000 WHEN s.siteId = 'site_b' THEN 1000000000
                ELSE c.targetPointsPerBucket END AS targetPointsPerBucket,
              coalesce(c.saltBuckets, 16) AS saltBuckets,
              CASE WHEN c.siteId IS NULL THEN false WHEN s.siteId = 'site_b' THEN
                c.maxTilePoints >= 1000000000 ELSE c.maxTilePoints >= c.targetPointsPerBucket END AS enableSalt,
              CASE WHEN c.siteId IS NULL THEN 'code-defaults' ELSE 'control-table' END AS paramSource
            FROM (SELECT DISTINCT siteId, ingestRunId FROM points) s
            LEFT JOIN control c ON s.siteId = c.siteId AND s.ingestRunId = c.ingestRunId""",
            "control",
        ),
        "discover_run": chain(
            "SELECT siteId, count(DISTINCT ingestRunId) AS runs, count(*) AS points, "
            "CASE WHEN count(DISTINCT ingestRunId) = 1 THEN max(ingestRunId) END AS onlyRunId "
            "FROM points GROUP BY siteId",
            "points",
        ),
        "tile_stats": chain("SELECT * FROM stats", "stats"),
        "site_rollup": chain(
            "SELECT siteId, ingestRunId, count(*) AS tileCount, CAST(sum(pointCount) AS BIGINT) AS totalPoints, "
            "CAST(sum(waterPointCount) AS BIGINT) AS totalWaterPoints, "
            "round(avg(waterPointRatio), 6) AS avgWaterRatio, "
            "count(*) FILTER (waterPointRatio >= 0.2e0) AS mostlyWaterTiles "
            "FROM stats GROUP BY siteId, ingestRunId",
            "stats",
        ),
        "tile_stats_bbox": chain("SELECT * FROM boxes", "boxes"),
        "water_mask": chain("SELECT * FROM mask", "mask"),
        "tile_mask_join": chain(
            "SELECT a.siteId, a.ingestRunId, a.tileX, a.tileY, a.pointCount, "
            "coalesce(b.isMostlyWater, 0) AS isMostlyWater, coalesce(b.waterRatio, 0e0) AS waterRatioMask "
            "FROM boxes a LEFT JOIN mask b USING (siteId, ingestRunId, tileX, tileY)",
            "boxes", "mask",
        ),
        "class_distribution": chain(
            "SELECT classification, count(*) AS points FROM points GROUP BY classification "
            "ORDER BY points DESC, classification LIMIT 20",
            "points",
        ),
        "range_percentiles": chain(
            "SELECT siteId, ingestRunId, quantile_disc(maxZ - minZ, 0.5) AS p50_range, "
            "quantile_disc(maxZ - minZ, 0.9) AS p90_range, quantile_disc(maxZ - minZ, 0.99) AS p99_range "
            "FROM boxes GROUP BY siteId, ingestRunId",
            "boxes",
        ),
        "hottest_tiles": chain(
            "SELECT siteId, ingestRunId, tileX, tileY, pointCount FROM boxes "
            "ORDER BY pointCount DESC, siteId, ingestRunId, tileX, tileY LIMIT 5",
            "boxes",
        ),
        "column_span": chain(
            "SELECT siteId, ingestRunId, count(DISTINCT tileX) AS tileColumns FROM counts "
            "GROUP BY siteId, ingestRunId",
            "counts",
        ),
        "snapshot_check": chain(
            "SELECT siteId, ingestRunId, count(*) AS rows, count(DISTINCT tileId) AS tiles, "
            "true AS snapshotAt FROM tiled GROUP BY siteId, ingestRunId",
            "tiled",
        ),
        "layer_metrics": chain(
            f"""
            SELECT 'raw' AS layer, true AS scoped, count(*) AS rows, CAST(NULL AS BIGINT) AS distinctTiles,
              count(DISTINCT classification) AS distinctClasses, {day('min(ingestTime)')} AS minIngestTime,
              {day('max(ingestTime)')} AS maxIngestTime
            FROM points WHERE siteId = 'site_a' AND ingestRunId = 'run_1'
            UNION ALL SELECT 'processed', true, count(*), count(DISTINCT tileId),
              count(DISTINCT classification), {day('min(ingestTime)')}, {day('max(ingestTime)')}
            FROM tiled WHERE siteId = 'site_a' AND ingestRunId = 'run_1'
            UNION ALL SELECT 'aggregated', true, count(*), count(DISTINCT (tileX, tileY)), NULL, NULL, NULL
            FROM boxes WHERE siteId = 'site_a' AND ingestRunId = 'run_1'""",
            "boxes",
        ),
        "layer_inspection": chain(
            """, counted AS (
              SELECT siteId, classification AS c, count(*) AS n FROM points GROUP BY ALL),
            listed AS (
              SELECT siteId, sum(n)::BIGINT AS rows,
                string_agg(c || ':' || n, ',' ORDER BY n DESC, c) AS classes
              FROM counted GROUP BY siteId),
            shown AS (
              SELECT l.layer, true AS readable, l.scoped, rows, classes
              FROM listed JOIN (VALUES ('raw', true, 'site_a'), ('processed', true, 'site_a'),
                ('elsewhere', false, 'site_b')) l(layer, scoped, siteId) USING (siteId)
              UNION ALL SELECT 'aggregated', true, true, count(*), NULL FROM boxes WHERE siteId = 'site_a')
            SELECT *, least(rows, 20) AS sampled FROM shown
            UNION ALL SELECT 'absent', false, NULL, NULL, NULL, NULL""",
            "boxes",
        ),
        "clustering_report": chain(
            """
            SELECT 'points_tiled' AS tableName, 'tileX, tileY' AS clusteringKeys,
              'siteId, ingestRunId' AS partitionKeys, count(*) AS rows, max(tileX) AS maxTileX,
              max(tileY) AS maxTileY FROM tiled
            UNION ALL SELECT 'tile_stats', 'tileX, tileY', 'siteId, ingestRunId', count(*), max(tileX),
              max(tileY) FROM boxes
            UNION ALL SELECT 'surface_cells', 'tileX, tileY', 'siteId, ingestRunId, surfaceType', count(*),
              max(tileX), max(tileY) FROM coarse""",
            "coarse",
        ),
        "tile_routing": chain(
            "SELECT siteId, ingestRunId, tileId, pointCount, waterPointRatio FROM stats "
            "WHERE pointCount >= 5000 AND waterPointRatio < 0.8e0",
            "stats",
        ),
        "surface_cells": chain("SELECT * FROM cells", "cells"),
        "surface_cells_routed": chain("SELECT * FROM cells", "cells", min_points=5000),
        "cell_summary": chain(
            "SELECT siteId, ingestRunId, count(*) AS cellRows, CAST(sum(pointCount) AS BIGINT) AS totalPointsUsed, "
            "min(minZ) AS siteMinZ, max(maxZ) AS siteMaxZ, count(DISTINCT tileId) AS tilesWithCells "
            "FROM cells GROUP BY siteId, ingestRunId",
            "cells",
        ),
        "surface_patches": chain("SELECT * EXCLUDE (rawMeanZ, rawWeighted) FROM patches", "patches"),
        "patches_of_known_tiles": chain(
            "SELECT * EXCLUDE (rawMeanZ, rawWeighted), round(rawWeighted, 6) AS weightedMeanZ "
            "FROM patches WHERE (siteId, ingestRunId, tileX, tileY) IN "
            "(SELECT (siteId, ingestRunId, tileX, tileY) FROM stats WHERE waterPointCount > 0)",
            "patches",
        ),
        "patch_summary": chain(
            "SELECT siteId, ingestRunId, surfaceType, count(*) AS patchCount, "
            "count(DISTINCT patchId) AS localPatchIds, CAST(sum(pointsUsed) AS BIGINT) AS pointsUsed "
            "FROM patches GROUP BY siteId, ingestRunId, surfaceType",
            "patches",
        ),
        **{
            name: chain("SELECT * EXCLUDE (cellMinX, cellMinY, cellMaxX, cellMaxY) FROM coarse", "coarse")
            for name in ("class_surface_cells", "class_surface_cells_in_place")
        },
        "cell_bbox": chain("SELECT * EXCLUDE (z, pointCountCell) FROM coarse", "coarse"),
        "tile_surface_summary": chain("SELECT * FROM summary", "summary"),
        "top_tiles": chain(
            "SELECT * FROM boxes ORDER BY pointCount DESC, siteId, ingestRunId, tileX, tileY LIMIT 3", "boxes"
        ),
        "top_patches": chain(
            "SELECT surfaceId, pointCountUsed, cellCount FROM summary "
            "ORDER BY pointCountUsed DESC, surfaceId LIMIT 20",
            "summary",
        ),
        "ground_reference": chain("SELECT * FROM ground", "ground"),
        "building_candidates": chain("SELECT * FROM buildings", "buildings"),
        "building_by_site": chain(
            "SELECT siteId, ingestRunId, count(*) AS candidates FROM buildings GROUP BY siteId, ingestRunId",
            "buildings",
        ),
        "water_cells": chain("SELECT * FROM wet", "wet"),
        **{
            f"cell_edges{n}": chain(
                f"""
                SELECT a.siteId, a.ingestRunId, a.vertexId AS src, b.vertexId AS dst
                FROM wet a JOIN wet b ON a.siteId = b.siteId AND a.ingestRunId = b.ingestRunId
                  AND abs(a.globalCellX - b.globalCellX) <= 1 AND abs(a.globalCellY - b.globalCellY) <= 1
                  AND {rule}""",
                "wet",
            )
            for n, rule in (
                (4, "abs(a.globalCellX - b.globalCellX) + abs(a.globalCellY - b.globalCellY) = 1"),
                (8, "a.vertexId <> b.vertexId"),
            )
        },
        "water_components": chain("SELECT * FROM labelled", "labelled"),
        "water_components8": chain("SELECT * FROM labelled", "labelled", diagonal=True),
        "water_bodies": chain("SELECT * FROM bodies", "bodies"),
        "republished_water": chain("SELECT * FROM bodies WHERE siteId <> 'site_b'", "bodies"),
        "water_totals": chain(
            "SELECT siteId, ingestRunId, count(*) AS waterBodies, CAST(sum(cellCount) AS BIGINT) AS totalCells, "
            "sum(areaM2) AS totalAreaM2 FROM bodies GROUP BY siteId, ingestRunId",
            "bodies",
        ),
        "water_top10": chain(
            "SELECT siteId, ingestRunId, waterBodyId, cellCount, areaM2 FROM bodies "
            "ORDER BY areaM2 DESC, siteId, ingestRunId, waterBodyId LIMIT 10",
            "bodies",
        ),
        "tiles_by_params": chain(
            """
            , own AS (
              SELECT a.*, CASE WHEN ingestRunId <> 'run_1' THEN 25e0 WHEN siteId = 'site_b' THEN 10e0
                  ELSE 20e0 END AS tileSizeM,
                CASE WHEN siteId = 'site_b' THEN 100 ELSE 2000 END AS most
              FROM points a),
            placed AS (
              SELECT a.siteId, a.ingestRunId, a.tileSizeM, a.most,
                CAST(floor((a.x - b.originX) / a.tileSizeM) AS INT) AS tileX,
                CAST(floor((a.y - b.originY) / a.tileSizeM) AS INT) AS tileY
              FROM own a JOIN origin b ON a.siteId = b.siteId AND a.ingestRunId = b.ingestRunId)
            SELECT siteId, ingestRunId, tileSizeM, tileX, tileY,
              CAST(CASE WHEN ingestRunId = 'run_1' AND count(*) >= any_value(most) THEN 1 ELSE 0 END AS INT)
                AS isHotTile,
              count(*) AS points, count(*) AS saltInRange
            FROM placed GROUP BY siteId, ingestRunId, tileSizeM, tileX, tileY""",
            "origin",
        ),
        "published_tables": chain(
            " UNION ALL ".join(
                f"SELECT siteId, ingestRunId, '{name}' AS tableName, count(*) AS rows, "
                f"CAST(sum({what}) AS BIGINT) AS total FROM {step} GROUP BY siteId, ingestRunId"
                for name, step, what in (
                    ("points_tiled", "tiled", "intensity"),
                    ("tile_stats", "stats", "pointCount"),
                    ("surface_cells", "cells", "pointCount"),
                    ("surface_patches", "patches", "pointsUsed"),
                    ("building_candidates", "buildings", "pointsUsed"),
                    ("water_bodies", "bodies", "cellCount"),
                )
            ),
            "buildings", "bodies",
        ),
        "voxel_downsample": chain("SELECT * FROM voxels", "voxels"),
        "fps_sizes": chain(
            "SELECT siteId, ingestRunId, tileId, least(2048, count(*)) AS points FROM voxels "
            "GROUP BY siteId, ingestRunId, tileId",
            "voxels",
        ),
        "fps_first_points": chain(
            """
            , ranked AS (
              SELECT *, siteId || '/' || ingestRunId || '/' || tileId AS k,
                row_number() OVER (PARTITION BY siteId, ingestRunId, tileId ORDER BY vx, vy, vz) AS rn
              FROM voxels),
            """ + _sample_steps(4) + """
            SELECT r.siteId, r.ingestRunId, r.tileId, CAST(s.seq AS INT) AS seq, r.x, r.y, r.z
            FROM ranked r JOIN (SELECT * FROM pick0 UNION ALL SELECT * FROM pick1
              UNION ALL SELECT * FROM pick2 UNION ALL SELECT * FROM pick3) s ON r.k = s.k AND r.rn = s.rn""",
            "voxels",
        ),
        "tensor_first_points": chain(
            """
            , ranked AS (
              SELECT *, siteId || '/' || ingestRunId || '/' || tileId AS k,
                row_number() OVER (PARTITION BY siteId, ingestRunId, tileId ORDER BY vx, vy, vz) AS rn
              FROM voxels),
            """ + _sample_steps(4) + """,
            picked AS (
              SELECT r.siteId, r.ingestRunId, r.tileId, CAST(s.seq AS INT) AS seq,
                r.x - avg(r.x) OVER t AS x, r.y - avg(r.y) OVER t AS y, r.z - avg(r.z) OVER t AS z
              FROM ranked r JOIN (SELECT * FROM pick0 UNION ALL SELECT * FROM pick1
                UNION ALL SELECT * FROM pick2 UNION ALL SELECT * FROM pick3) s ON r.k = s.k AND r.rn = s.rn
              WINDOW t AS (PARTITION BY r.siteId, r.ingestRunId, r.tileId)),
            sized AS (
              SELECT *, max(sqrt(x * x + y * y + z * z)) OVER (PARTITION BY siteId, ingestRunId, tileId) AS r
              FROM picked)
            SELECT siteId, ingestRunId, tileId, seq, round(x / r, 4) AS x, round(y / r, 4) AS y,
              round(z / r, 4) AS z
            FROM sized""",
            "voxels",
        ),
        "normalized_points": chain(
            """
            , moved AS (
              SELECT siteId, ingestRunId, tileId, vx, vy, vz,
                x - avg(x) OVER t AS x, y - avg(y) OVER t AS y, z - avg(z) OVER t AS z
              FROM voxels WINDOW t AS (PARTITION BY siteId, ingestRunId, tileId)),
            sized AS (
              SELECT *, max(sqrt(x * x + y * y + z * z)) OVER (PARTITION BY siteId, ingestRunId, tileId) AS r
              FROM moved)
            SELECT siteId, ingestRunId, tileId, vx, vy, vz, round(CASE WHEN r > 0 THEN x / r ELSE 0 END, 5) AS x,
              round(CASE WHEN r > 0 THEN y / r ELSE 0 END, 5) AS y,
              round(CASE WHEN r > 0 THEN z / r ELSE 0 END, 5) AS z
            FROM sized""",
            "voxels",
        ),
        **{
            name: chain(
                f"SELECT * EXCLUDE (tileX, tileY) FROM stats WHERE siteId = 'site_a' {rest}", "stats", scope=SITE
            )
            for name, rest in pages.items()
        },
        "list_tiles_recent": chain(
            "SELECT siteId, tileId, count(*) AS pointCount, max(gps_time) AS computedAt FROM tiled "
            "WHERE siteId = 'site_a' GROUP BY siteId, tileId ORDER BY computedAt DESC, tileId LIMIT 3",
            "tiled", scope=SITE,
        ),
        "list_water": chain(
            "SELECT * FROM bodies WHERE siteId = 'site_a' AND areaM2 >= 1 "
            "ORDER BY areaM2 DESC, waterBodyId LIMIT 20",
            "bodies", scope=SITE,
        ),
        "water_detail": chain(
            f"SELECT * FROM bodies WHERE siteId = 'site_a' AND waterBodyId = {10 * (1 << 32) + 62} LIMIT 1",
            "bodies", scope=SITE,
        ),
        "list_buildings": chain(
            "SELECT * FROM buildings WHERE siteId = 'site_a' AND heightAboveGround >= 2.5 "
            "ORDER BY heightAboveGround DESC, buildingCandidateId LIMIT 30",
            "buildings", scope=SITE,
        ),
        "list_buildings_range": chain(
            "SELECT * FROM buildings WHERE siteId = 'site_a' AND tileId = '1_0' "
            "ORDER BY heightRange DESC, buildingCandidateId LIMIT 10",
            "buildings", scope=SITE,
        ),
        "building_detail": chain(
            "SELECT * FROM buildings WHERE siteId = 'site_a' AND buildingCandidateId = '1_0|1_1' LIMIT 1",
            "buildings", scope=SITE,
        ),
        "run_latest": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY siteId "
        f"ORDER BY createdAt DESC, runId DESC) AS rn FROM {inputs.in_sql(inputs.RUNS)}) WHERE rn = 1",
        "run_by_id": f"SELECT * FROM {inputs.in_sql(inputs.RUNS)} WHERE siteId = 'site_a' AND runId = '100'",
        "tiles_json": chain(
            "SELECT siteId, tileId, pointCount, z_p50, z_p95, z_p99, waterPointRatio, isMostlyWater, "
            "'2024-01-01 00:00:00' AS computedAt FROM stats WHERE siteId = 'site_a'",
            "stats", scope=SITE,
        ),
        "water_json": chain(
            "SELECT waterBodyId, areaM2, cellCount, meanZ, minZ, maxZ, bboxMinCellX, bboxMinCellY, bboxMaxCellX, "
            "bboxMaxCellY, '2024-01-01 00:00:00' AS computedAt FROM bodies WHERE siteId = 'site_a'",
            "bodies", scope=SITE,
        ),
        "buildings_json": chain(
            "SELECT buildingCandidateId, tileId, heightAboveGround, heightRange, pointsUsed, cellCount, "
            "minZ, meanZ, maxZ, "
            "'2024-01-01 00:00:00' AS computedAt FROM buildings "
            "WHERE siteId = 'site_b'",
            "buildings", scope=SITE,
        ),
        "run_json": "SELECT siteId, runId, status, startedAt, finishedAt, errorMessage, producedSnapshotAt FROM "
        "(SELECT *, row_number() "
        f"OVER (PARTITION BY siteId ORDER BY createdAt DESC, runId DESC) AS rn "
        f"FROM {inputs.in_sql(inputs.RUNS)}) WHERE rn = 1",
        "tile_range": chain(
            "SELECT * FROM counts WHERE tileX BETWEEN 0 AND 1 AND tileY BETWEEN 0 AND 1", "counts", scope=SITE
        ),
        "bbox_patches": chain(
            "SELECT surfaceId, surfaceType, tileX, tileY, minX, minY, maxX, maxY FROM summary WHERE "
            + OVERLAP.format(""),
            "summary",
        ),
        **{
            name: chain(
                "SELECT siteId, ingestRunId, surfaceType, tileX, tileY, cellX, cellY, z FROM coarse WHERE "
                + CELL_OVERLAP.format(*box),
                "coarse",
            )
            for name, box in CELL_BOXES.items()
        },
        "keyed_upsert": f"""
            SELECT coalesce(a.siteId, b.siteId) AS siteId,
              CASE WHEN b.siteId IS NOT NULL AND (a.siteId IS NULL OR a.expiresAt < '2001-06-01')
                THEN b.lockedBy ELSE a.lockedBy END AS lockedBy,
              CASE WHEN b.siteId IS NOT NULL AND (a.siteId IS NULL OR a.expiresAt < '2001-06-01')
                THEN b.expiresAt ELSE a.expiresAt END AS expiresAt
            FROM {inputs.in_sql(inputs.LOCKS)} a FULL JOIN {inputs.in_sql(inputs.CLAIMS)} b
              ON a.siteId = b.siteId""",
        "conditional_delete": f"""
            SELECT * FROM {inputs.in_sql(inputs.LOCKS)} a WHERE NOT EXISTS (
              SELECT 1 FROM {inputs.in_sql(inputs.RELEASES)} b
              WHERE a.siteId = b.siteId AND a.lockedBy = b.lockedBy)""",
        "job_first_create": f"SELECT idempotencyKey, jobId, siteId, {second('ts')} AS createdAt FROM ("
        + CREATES.format(source=inputs.in_sql(inputs.EVENTS)) + ")",
        "session_lookup": f"""
            SELECT j.idempotencyKey, j.jobId, j.siteId, 'CREATED' AS status, u.uploadId,
              u.createdAt AS uploadCreatedAt, u.sizeBytes
            FROM ({CREATES.format(source=inputs.in_sql(inputs.ORDER_CREATES))}) j
            JOIN (SELECT *, row_number() OVER (PARTITION BY jobId
                    ORDER BY createdAt DESC, uploadId DESC, sizeBytes DESC) AS rn
                  FROM {inputs.in_sql(inputs.UPLOADS)}) u ON j.jobId = u.jobId AND u.rn = 1""",
        "upload_complete": f"""
            SELECT uploadId, jobId,
              CASE WHEN has THEN 'COMPLETED' ELSE uploadStatus END AS uploadStatus,
              coalesce(completedAt, CASE WHEN done THEN cAt END) AS completedAt,
              CASE WHEN done THEN coalesce(cTag, blobETag) ELSE blobETag END AS blobETag,
              CASE WHEN done THEN coalesce(cSize, sizeBytes) ELSE sizeBytes END AS sizeBytes,
              CASE WHEN done AND jobStatus = 'CREATED' THEN 'QUEUED' ELSE jobStatus END AS jobStatus
            FROM (
              SELECT a.*, c.completedAt AS cAt, c.blobETag AS cTag, c.sizeBytes AS cSize,
                c.uploadId IS NOT NULL AS has,
                c.uploadId IS NOT NULL AND a.uploadStatus <> 'COMPLETED' AS done
              FROM {inputs.in_sql(inputs.UPLOAD_STATE)} a
              LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY uploadId ORDER BY completedAt,
                           blobETag NULLS FIRST, sizeBytes NULLS FIRST) AS rn
                         FROM {inputs.in_sql(inputs.COMPLETIONS)}) c
                ON a.uploadId = c.uploadId AND c.rn = 1)""",
        "job_state_fold": FOLD,
        "job_last_event": f"SELECT jobId, siteId, eventStatus AS status FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY jobId ORDER BY ts DESC, event_id DESC) AS rn FROM {inputs.in_sql(inputs.EVENTS)}) "
        "WHERE rn = 1",
        "job_counts": f"SELECT siteId, status, count(*) AS jobs FROM ({FOLD}) GROUP BY siteId, status",
        "latest_job": f"SELECT siteId, jobId, {second('ts')} AS createdAt FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY siteId ORDER BY ts DESC, jobId DESC) AS rn FROM ("
        + CREATES.format(source=inputs.in_sql(inputs.EVENTS)) + ")) WHERE rn = 1",
        "payload_fields": f"""
            SELECT event_id, TRY_CAST(rid AS BIGINT) AS runId, jid AS payloadJobId, outcome,
              CASE WHEN outcome = 'FAILED' THEN 'DBX_RUN_FAILED' END AS errorCode,
              CASE WHEN outcome = 'FAILED' AND trim(msg) <> '' THEN msg END AS errorMessage
            FROM (SELECT *, {NORMAL.format('st')} AS outcome FROM (
              SELECT event_id, {json_paths('$.run_id', '$.runId', '$.event.run.run_id', '$.tasks[1].run_id')} AS rid,
                {json_paths('$.jobId', '$.JOB_ID')} AS jid,
                {json_paths('$.status', '$.resultState', '$.event.state.result_state', '$.tasks[1].status')} AS st,
                {json_paths('$.errorMessage', '$.error', '$.event.state.state_message')} AS msg
              FROM (SELECT event_id, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS doc
                    FROM {inputs.in_sql(inputs.PAYLOADS)})))""",
        "status_normalize": f"SELECT event_id, raw, {NORMAL.format('raw')} AS outcome "
        f"FROM {inputs.in_sql(inputs.STATUS_TEXTS)}",
        "event_match": f"""
            SELECT e.*, coalesce(r.jobId, j.jobId) AS jobId,
              CASE WHEN r.jobId IS NOT NULL THEN 'run' WHEN j.jobId IS NOT NULL THEN 'job' END AS matchedBy
            FROM {inputs.in_sql(inputs.WEBHOOKS)} e
            LEFT JOIN {inputs.in_sql(inputs.JOBS_BY_RUN)} r ON e.runId = r.jobRunId
            LEFT JOIN {inputs.in_sql(inputs.JOBS_BY_RUN)} j ON e.payloadJobId = j.jobId""",
        "text_truncate": "SELECT doc_id, CASE WHEN trim(source) <> '' THEN substring(source, 1, 64) END AS code, "
        "CASE WHEN trim(text) <> '' THEN substring(text, 1, 2048) END AS message FROM documents",
        "stream_job_state": FOLD,
    }
    return out | {"stream_first_create": out["job_first_create"]}
