"""Job events as a stream: first creates and the guarded state fold.

Both give the result of their batch forms whatever the order of arrival. First creates
are merged into a table in versions; job states are kept in the stream's state store,
several jobs under one key, so a batch opens only the keys of its own jobs. A retried
batch overwrites only its own folder.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from laserfold import schemas
from laserfold.operators.jobs import ORDER, STATE_NAMES, states_of_rank
from laserfold.params import JOB_STATES

UNKNOWN = STATE_NAMES[0]

CREATES = "idempotencyKey string, first struct<ts: timestamp, event_id: bigint, jobId: string, siteId: string>"

CREATED = "idempotencyKey string, jobId string, siteId string, createdAt timestamp"


def arriving_events(
    spark: SparkSession, folder: str, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schemas.JOB_EVENTS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def _version(path: str, batch: int) -> str:
    return f"{path}/version-{batch:08d}"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Versions that have been written completely, in order."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/version-*/_SUCCESS")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(root) or ()
    return sorted(int(f.getPath().getParent().getName().removeprefix("version-")) for f in found)


def _drop_version(spark: SparkSession, path: str, batch: int) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_version(path, batch))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def merge_first_creates(path: str) -> Callable[[DataFrame, int], None]:
    """Sink that keeps the earliest create of every idempotency key, for ever.

    A batch's minima (combined on the map side) are merged with the version before;
    older versions are deleted, so two are kept."""

    def merge(events: DataFrame, batch: int) -> None:
        spark = events.sparkSession
        created = events.where(
            (F.col("eventStatus") == JOB_STATES[0]) & F.col("idempotencyKey").isNotNull()
        ).select("idempotencyKey", F.struct(*ORDER, "jobId", "siteId").alias("first"))
        earlier = [n for n in _numbers(spark, path) if n < batch]
        if earlier:
            known = spark.read.schema(CREATES).parquet(_version(path, earlier[-1]))
            created = created.unionByName(known)
        minima = created.groupBy("idempotencyKey").agg(F.min("first").alias("first"))
        minima.write.mode("overwrite").parquet(_version(path, batch))
        for old in earlier[:-1]:
            _drop_version(spark, path, old)

    return merge


def current_creates(spark: SparkSession, path: str) -> DataFrame:
    """First creates so far, with the columns of the batch form."""
    numbers = _numbers(spark, path)
    if not numbers:
        return spark.createDataFrame([], CREATED)
    table = spark.read.schema(CREATES).parquet(_version(path, numbers[-1]))
    return table.select(
        "idempotencyKey", "first.jobId", "first.siteId", F.col("first.ts").alias("createdAt")
    )


STATES = "jobId string, siteId string, status string, updatedAt timestamp"
# Fixed value: the state store that processors with value state and forgetting need.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_RANKS = {status: rank for rank in range(1, len(JOB_STATES)) for status in states_of_rank(rank)}
# Keys of the state. A call into the state store costs far more than the ladder of a job,
# so the jobs of one hash share a key and are read and written at once.
BUCKETS = 1 << 14


class JobLadder(StatefulProcessor):
    """What the states of a bucket's jobs can still depend on, kept per job.

    The state of a job is a chain of minima: the first CREATED, the first QUEUED after it,
    and so on. Late events only move a minimum to an earlier time, so of each rank the
    events after the chosen one are let go; what stays are the chosen ones and those before
    them. With `forget_after_ms` a job without events for that long is let go as a whole."""

    def __init__(self, forget_after_ms: int | None = None):
        self.forget_after_ms = forget_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        # JSON: job -> [site, time of its last event here, kept events].
        self.jobs = handle.getValueState("jobs", "jobs string", ttlDurationMs=self.forget_after_ms)

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd

        stored = self.jobs.get()
        jobs = json.loads(stored[0]) if stored else {}
        now = timerValues.getCurrentProcessingTimeInMs() if self.forget_after_ms else 0
        if self.forget_after_ms:
            jobs = {job: held for job, held in jobs.items() if held[1] + self.forget_after_ms > now}
        found = {}  # job -> site, status, time
        for arrived in rows:  # in chunks, so that a job with very many events is not held
            news: dict[str, list] = {}
            for job, site, *event in zip(*(arrived[c].tolist() for c in EVENT_COLUMNS), strict=True):
                sites, events = news.setdefault(job, (set(), set()))
                if isinstance(site, str):
                    sites.add(site)
                if event[0] > 0:
                    events.add(tuple(event))
            for job, (sites, events) in news.items():
                site, _, kept = jobs.get(job, (None, 0, ()))
                site = min(sites | ({site} - {None}), default=None)
                kept, chain = _pruned(events.union(map(tuple, kept)))
                jobs[job] = (site, now, kept)
                top = chain[-1] if chain else (0, False, 0, False, 0, None)
                found[job] = (site, top[5] or UNKNOWN, top[2] if top[1] else None)
        self.jobs.update((json.dumps(jobs, separators=(",", ":")),))
        sites, names, times = zip(*found.values(), strict=True)
        yield pd.DataFrame(
            {
                "jobId": list(found),
                "siteId": pd.Series(sites, dtype=object),
                "status": names,
                "micros": pd.array(times, "Int64"),
            }
        )

    def close(self) -> None:
        pass


def _pruned(rows: set[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Rows that a later chain can need, and the chain of first hits, rank by rank."""
    kept, chain, open_rank = [], [], True
    for rank in range(1, len(JOB_STATES)):
        own = sorted(r for r in rows if r[0] == rank)
        hit = next((r for r in own if not chain or r[1:5] > chain[-1][1:5]), None) if open_rank else None
        if hit is None:
            open_rank = False
            kept += own
        else:
            chain.append(hit)
            kept += [r for r in own if r <= hit]
    return kept, chain


EVENT_COLUMNS = ("jobId", "siteId", "rank", "dated", "at", "numbered", "number", "status")


def fold_stream(
    events: DataFrame, forget_after_ms: int | None = None, buckets: int | None = None
) -> DataFrame:
    """Changing states of the jobs that each batch touches, by keyed state: STATES.

    `buckets` is the number of keys of the state. A stream keeps it for as long as its
    checkpoint; a batch reads the kept events of all jobs of the buckets it meets."""
    rank = F.coalesce(
        F.create_map(*(F.lit(x) for pair in _RANKS.items() for x in pair))[F.col("eventStatus")], F.lit(0)
    )
    narrow = events.where(F.col("jobId").isNotNull()).select(
        "jobId",
        "siteId",
        rank.alias("rank"),
        F.col("ts").isNotNull().alias("dated"),
        F.coalesce(F.unix_micros("ts"), F.lit(0)).alias("at"),
        F.col("event_id").isNotNull().alias("numbered"),
        F.coalesce("event_id", F.lit(0)).alias("number"),
        F.coalesce("eventStatus", F.lit("")).alias("status"),
    )
    bucket = F.pmod(F.xxhash64("jobId"), F.lit(buckets or BUCKETS)).cast("int").alias("bucket")
    found = narrow.select(bucket, *EVENT_COLUMNS).groupBy("bucket").transformWithStateInPandas(
        JobLadder(forget_after_ms),
        "jobId string, siteId string, status string, micros bigint",
        "Update",
        "ProcessingTime" if forget_after_ms else "None",
    )
    return found.select("jobId", "siteId", "status", F.timestamp_micros("micros").alias("updatedAt"))


def write_states(path: str) -> Callable[[DataFrame, int], None]:
    """Sink for `fold_stream`: a folder per batch, so a batch that is tried again replaces its own."""

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(_version(path, batch))

    return write


def run_states(stream: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Fold all available events of a stream into the states at `path`, then stop."""
    conf = stream.sparkSession.conf
    name = "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, STORE)
    try:
        return run_available(fold_stream(stream, **options), write_states(path), checkpoint, "update")
    finally:
        conf.set(name, before) if before else conf.unset(name)


def current_states(spark: SparkSession, path: str) -> DataFrame:
    """Latest state of every job: one scan of the batches' folders."""
    folders = [_version(path, n) for n in _numbers(spark, path)]
    if not folders:
        return spark.createDataFrame([], STATES)
    log = spark.read.schema(STATES).parquet(*folders)
    batch = F.regexp_extract(F.col("_metadata.file_path"), r"/version-(\d+)/", 1).cast("bigint")
    newest = F.max_by(F.struct("siteId", "status", "updatedAt"), batch).alias("s")
    return log.groupBy("jobId").agg(newest).select("jobId", "s.*")


def run_available(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Send all available micro-batches to `sink`, then stop."""
    return (
        stream.writeStream.foreachBatch(sink)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
