"""Declared schemas: reads never infer, and partition columns keep their type."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
}


def _struct(text: str) -> T.StructType:
    """Schema of a `name kind, …` list (needs no running session)."""
    fields = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in fields])


POINTS_RAW = _struct(
    "x double, y double, z double, intensity int, classification int, "
    "return_number int, number_of_returns int, gps_time double, "
    "siteId string, ingestRunId string, ingestTime timestamp"
)

# Columns a point file is converted with when nothing else is asked for.
POINT_FILE_COLUMNS = (
    "x", "y", "z", "intensity", "classification",
    "return_number", "number_of_returns", "gps_time",
)

TILING_PARAMS = _struct(
    "siteId string, ingestRunId string, tileSizeM double, hotTileThreshold bigint, "
    "targetPointsPerBucket bigint, saltBuckets bigint, maxTilePoints bigint, computedAt timestamp"
)

PIPELINE_RUNS = _struct(
    "siteId string, runId string, pipelineName string, status string, startedAt timestamp, "
    "finishedAt timestamp, errorMessage string, triggeredBy string, createdAt timestamp, "
    "producedSnapshotAt timestamp"
)

JOB_EVENTS = _struct(
    "event_id bigint, ts timestamp, jobId string, siteId string, eventStatus string, "
    "idempotencyKey string, props string"
)
