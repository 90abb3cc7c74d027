"""Input tables derived from the generated Parquet tables.

Each text runs unchanged in Spark SQL and DuckDB; `{name}` stands for a base table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from laserfold.operators.ingest import clean_points
from laserfold.runtime import store
from laserfold.sources.landing import widen

POINTS = """
SELECT
  1000e0 + xi * 0.0009765625e0 AS x,
  2000e0 + yi * 0.0009765625e0 AS y,
  CASE WHEN inWater THEN 1e0 WHEN inBlock THEN 16e0 ELSE 10e0 END
    + (l_linenumber & 7) * 0.125e0 AS z,
  CAST(l_quantity * 20 AS INT) AS intensity,
  CASE WHEN inWater AND CAST(l_quantity AS INT) % 10 <> 0 THEN 9 ELSE 2 END AS classification,
  CAST(1 + l_linenumber % 3 AS INT) AS return_number,
  CAST(3 + (l_linenumber & 1) AS INT) AS number_of_returns,
  CAST(l_orderkey AS DOUBLE) + l_linenumber * 0.125e0 AS gps_time,
  CASE WHEN (l_suppkey & 7) = 0 THEN 'site_b' ELSE 'site_a' END AS siteId,
  CASE WHEN l_linenumber = 7 THEN 'run_2' ELSE 'run_1' END AS ingestRunId,
  l_shipdate AS ingestTime
FROM (
  SELECT *,
    (cx BETWEEN 10 AND 60 AND cy BETWEEN 62 AND 80)
      OR (cx BETWEEN 75 AND 94 AND cy BETWEEN 12 AND 25) AS inWater,
    cx BETWEEN 58 AND 74 AND cy BETWEEN 8 AND 24 AS inBlock
  FROM (
    SELECT *, xi >> 9 AS cx, yi >> 9 AS cy
    FROM (
      SELECT l_orderkey, l_linenumber, l_quantity, l_suppkey, l_shipdate,
        (l_orderkey * 7919 + l_linenumber * 15485 + l_partkey * 6271) % 51200 AS xi,
        (l_orderkey * 3571 + l_linenumber * 28657 + l_suppkey * 9973 + l_partkey * 17) % 51200 AS yi
      FROM {lineitem})))
"""

# Landing points with holes: some coordinates are missing, the time is text.
LANDING = """
SELECT CASE WHEN l_linenumber = 6 AND l_quantity > 40 THEN NULL ELSE l_extendedprice / 8e0 END AS x,
  CASE WHEN l_linenumber = 5 AND l_quantity > 45 THEN NULL ELSE l_quantity END AS y,
  CASE WHEN l_quantity = 3e0 THEN NULL ELSE l_discount END AS z,
  CAST(l_quantity AS INT) AS intensity,
  CAST(2 AS INT) AS classification,
  CAST(1 AS INT) AS return_number,
  CAST(l_linenumber AS INT) AS number_of_returns,
  CAST(l_orderkey AS DOUBLE) AS gps_time,
  CASE WHEN l_suppkey % 8 = 0 THEN 'site_b' ELSE 'site_a' END AS siteId,
  'run_1' AS ingestRunId,
  CONCAT(CAST(CAST(l_shipdate AS DATE) AS STRING), ' 06:30:00') AS ingestTime
FROM {lineitem}
"""

RUNS = """
SELECT CASE WHEN o_custkey % 8 = 0 THEN 'site_b' ELSE 'site_a' END AS siteId,
  CAST(o_orderkey AS STRING) AS runId, 'surface' AS pipelineName,
  CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS startedAt,
  CASE WHEN o_orderstatus <> 'O' THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END AS finishedAt,
  CASE WHEN o_orderstatus = 'P' THEN 'stage failed' END AS errorMessage,
  'scheduler' AS triggeredBy, CAST(CAST(o_orderdate AS DATE) AS STRING) AS createdAt,
  CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END AS producedSnapshotAt
FROM {orders}
"""

EVENTS = """
SELECT event_id, ts,
  CONCAT(CAST(user_id AS STRING), '_', CAST(CAST(floor((day(ts) - 1) / 6e0) AS INT) AS STRING)) AS jobId,
  CASE WHEN user_id % 8 = 0 THEN 'site_b' ELSE 'site_a' END AS siteId,
  CASE event_type WHEN 'signup' THEN 'CREATED' WHEN 'view' THEN 'QUEUED'
    WHEN 'click' THEN 'DBX_TRIGGERED' WHEN 'purchase' THEN 'PROCESSING'
    ELSE CASE WHEN event_id % 2 = 0 THEN 'SUCCEEDED' ELSE 'FAILED' END END AS eventStatus,
  CONCAT('key_', CAST(user_id AS STRING)) AS idempotencyKey, props
FROM {events}
"""

PAYLOADS = """
SELECT event_id, CASE event_id % 6
  WHEN 0 THEN CONCAT('{"run_id": ', CAST(event_id AS STRING), ', "status": "', event_type, ' ok success"}')
  WHEN 1 THEN CONCAT('{"runId": "', CAST(event_id AS STRING), '", "jobId": "', CAST(user_id AS STRING),
    '", "resultState": "FAILED", "errorMessage": "', event_type, ' failed', repeat('.', CAST(event_id % 3000 AS INT)), '"}')
  WHEN 2 THEN CONCAT('{"event": {"run": {"run_id": ', CAST(event_id AS STRING),
    '}, "state": {"result_state": "SUCCEEDED", "state_message": "', event_type, '"}}}')
  WHEN 3 THEN CONCAT('{"JOB_ID": ', CAST(user_id AS STRING), ', "status": "canceled by user", "error": "  "}')
  WHEN 4 THEN CONCAT('{"tasks": [{"name": "a"}, {"run_id": "n/a", "status": "', event_type, '"}]}')
  ELSE CONCAT('not json ', event_type) END AS payload
FROM {events}
"""

STATUS_TEXTS = """
SELECT event_id, CASE event_id % 10 WHEN 0 THEN ' Succeeded ' WHEN 1 THEN 'ok' WHEN 2 THEN 'FAILED'
  WHEN 3 THEN 'cancelled' WHEN 4 THEN CONCAT('error in ', event_type) WHEN 5 THEN ''
  WHEN 6 THEN event_type WHEN 7 THEN 'SUCCESS_WITH_FAILURES' WHEN 8 THEN 'completed' END AS raw
FROM {events}
"""

WEBHOOKS = """
SELECT event_id,
  CASE WHEN event_id % 3 = 0 THEN event_id WHEN event_id % 3 = 1 THEN -event_id - 1 END AS runId,
  CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS STRING) ELSE 'missing' END AS payloadJobId
FROM {events}
"""

JOBS_BY_RUN = """
SELECT CAST(user_id AS STRING) AS jobId, min(event_id) AS jobRunId FROM {events} GROUP BY user_id
"""

ORDER_CREATES = """
SELECT o_orderkey AS event_id, o_orderdate AS ts, CAST(o_orderkey AS STRING) AS jobId,
  CASE WHEN o_custkey % 8 = 0 THEN 'site_b' ELSE 'site_a' END AS siteId,
  'CREATED' AS eventStatus, CONCAT('key_', CAST(o_custkey AS STRING)) AS idempotencyKey
FROM {orders}
"""

UPLOADS = """
SELECT CONCAT(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS uploadId,
  CAST(l_orderkey AS STRING) AS jobId, CAST(CAST(l_shipdate AS DATE) AS STRING) AS createdAt,
  CAST(floor(l_extendedprice) AS BIGINT) AS sizeBytes
FROM {lineitem}
"""

UPLOAD_STATE = """
SELECT CONCAT('u', CAST(o_orderkey AS STRING)) AS uploadId, CAST(o_orderkey AS STRING) AS jobId,
  CASE WHEN o_orderstatus = 'F' THEN 'COMPLETED' ELSE 'URL_ISSUED' END AS uploadStatus,
  CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END AS completedAt,
  CASE WHEN o_custkey % 3 = 0 THEN CONCAT('old', CAST(o_custkey AS STRING)) END AS blobETag,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS sizeBytes,
  CASE o_orderstatus WHEN 'O' THEN 'CREATED' WHEN 'P' THEN 'FAILED' ELSE 'QUEUED' END AS jobStatus
FROM {orders}
"""

COMPLETIONS = """
SELECT CONCAT('u', CAST(l_orderkey AS STRING)) AS uploadId,
  CAST(CAST(l_shipdate AS DATE) AS STRING) AS completedAt,
  CASE WHEN l_linenumber % 2 = 0 THEN CONCAT('tag', CAST(l_partkey AS STRING)) END AS blobETag,
  CASE WHEN l_linenumber % 3 > 0 THEN CAST(floor(l_extendedprice) AS BIGINT) END AS sizeBytes
FROM {lineitem}
"""

LOCKS = """
SELECT CONCAT('site_', CAST(o_custkey AS STRING)) AS siteId,
  CONCAT('run_', CAST(min(o_orderkey) AS STRING)) AS lockedBy,
  CAST(CAST(max(o_orderdate) AS DATE) AS STRING) AS expiresAt
FROM {orders} GROUP BY o_custkey
"""

CLAIMS = """
SELECT CONCAT('site_', CAST(c_custkey AS STRING)) AS siteId,
  CONCAT('claim_', CAST(c_custkey AS STRING)) AS lockedBy, '2030-01-01' AS expiresAt
FROM {customer}
"""

RELEASES = """
SELECT CONCAT('site_', CAST(o_custkey AS STRING)) AS siteId,
  CONCAT('run_', CAST(o_orderkey AS STRING)) AS lockedBy
FROM {orders} WHERE o_orderstatus = 'F'
"""

BASE_TABLES = ("lineitem", "orders", "events", "customer")


def fill(text: str, tables: dict[str, str]) -> str:
    """Put table expressions in place of `{name}`; other braces are JSON and stay."""
    for name, value in tables.items():
        text = text.replace("{" + name + "}", value)
    return text


def load(spark: SparkSession, folder: str, text: str) -> DataFrame:
    """The derived input as a DataFrame, read straight from the Parquet files."""
    return spark.sql(fill(text, {t: f"parquet.`{folder}/{t}.parquet`" for t in BASE_TABLES}))


_ingested: dict[tuple[str, str], DataFrame] = {}


def raw_points(spark: SparkSession, folder: str) -> DataFrame:
    """The raw point table of a data folder.

    Ingested from the base tables on first use and then read by every query of the
    session, as production queries read the table that the ingest job has written."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _ingested:
        landed = widen(load(spark, folder, POINTS))
        _ingested[key] = store(clean_points(landed), "points-raw").df
    return _ingested[key]


def in_sql(text: str) -> str:
    """The derived input as a parenthesised DuckDB subquery."""
    return "(" + fill(text, {t: t for t in BASE_TABLES}) + ")"
