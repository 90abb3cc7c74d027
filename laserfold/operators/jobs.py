"""Job events folded to one state per job, and lookups over jobs and uploads."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laserfold.functions.events import (
    normalize_status,
    payload_fields,
    text_or_null,
)
from laserfold.params import JOB_STATES, RUN_FAILED_CODE
from laserfold.runtime import counted_join, lookup_join, store

ORDER = ("ts", "event_id")
# States by rank: 0 nothing, 1..4 on the way, 5 succeeded, 6 failed.
STATE_NAMES = ("NONE", *JOB_STATES)


def first_creates(events: DataFrame) -> DataFrame:
    """One job per idempotency key: the earliest create event wins.

    The minimum is combined on the map side, so a key repeated by a third of all
    events is one partial row per task."""
    earliest = F.min(F.struct(*ORDER, "jobId", "siteId")).alias("e")
    created = events.where(
        (F.col("eventStatus") == JOB_STATES[0]) & F.col("idempotencyKey").isNotNull()
    )
    return created.groupBy("idempotencyKey").agg(earliest).select(
        "idempotencyKey", "e.jobId", "e.siteId", F.col("e.ts").alias("createdAt")
    )


def latest_session(jobs: DataFrame, uploads: DataFrame) -> DataFrame:
    """Job and its newest upload per idempotency key (upload id breaks ties)."""
    rest = [c for c in uploads.columns if c not in ("jobId", "uploadId", "createdAt")]
    newest = uploads.groupBy("jobId").agg(
        F.max(F.struct("createdAt", "uploadId", *rest)).alias("u")
    )
    return jobs.join(newest, "jobId").select(
        "idempotencyKey", "jobId", "siteId", "status",
        "u.uploadId", F.col("u.createdAt").alias("uploadCreatedAt"), *(f"u.{c}" for c in rest),
    )


def complete_uploads(uploads: DataFrame, completions: DataFrame) -> DataFrame:
    """Apply completion calls: the first one counts, repeats change nothing.

    `completions` holds uploadId, completedAt, blobETag, sizeBytes (the last two may
    be null and then keep the stored values). A CREATED job moves to QUEUED."""
    first = completions.groupBy("uploadId").agg(
        F.min(F.struct("completedAt", "blobETag", "sizeBytes")).alias("c")
    )
    done = F.col("c").isNotNull() & (F.col("uploadStatus") != "COMPLETED")
    return uploads.join(first, "uploadId", "left").select(
        "uploadId",
        "jobId",
        F.when(F.col("c").isNotNull(), "COMPLETED").otherwise(F.col("uploadStatus")).alias("uploadStatus"),
        F.coalesce("completedAt", F.when(done, F.col("c.completedAt"))).alias("completedAt"),
        F.when(done, F.coalesce("c.blobETag", "blobETag")).otherwise(F.col("blobETag")).alias("blobETag"),
        F.when(done, F.coalesce("c.sizeBytes", "sizeBytes")).otherwise(F.col("sizeBytes")).alias("sizeBytes"),
        F.when(done & (F.col("jobStatus") == JOB_STATES[0]), JOB_STATES[1])
        .otherwise(F.col("jobStatus"))
        .alias("jobStatus"),
    )


def states_of_rank(rank: int) -> tuple[str, ...]:
    """Names of the states of a rank; both end states share the last one."""
    last = len(JOB_STATES) - 1
    return JOB_STATES[last - 1 :] if rank == last else (JOB_STATES[rank - 1],)


def fold_states(events: DataFrame) -> DataFrame:
    """Final state of every job under the guarded life cycle.

    An event advances a job only from the state just before it; repeats, early and
    late events are ignored and end states absorb. Greedy matching makes this a
    chain of minima: the first CREATED, the first QUEUED after it, and so on. Each link
    scans the events of its own states (a filter that Parquet gets), every minimum is combined before its shuffle,
    and each link is a stored table of one row per job that is looked up by a
    checked broadcast or a salted join. So a job with a third of all events stays
    spread, and no job's events are ever collected."""
    steps = events.select(
        "jobId",
        F.struct(*ORDER).alias("at"),
        F.col("eventStatus").alias("status"),
    )
    first_hit = F.min(F.struct("at", "status")).alias("e")
    rungs = [store(steps.where(F.col("status").isin(*states_of_rank(1))).groupBy("jobId").agg(first_hit), "rung-1")]
    last = len(JOB_STATES) - 1
    for rank in range(2, last + 1):
        below = rungs[-1]
        since = replace(below, df=below.df.select("jobId", F.col("e.at").alias("since")))
        later = lookup_join(
            steps.where(F.col("status").isin(*states_of_rank(rank))), since, ["jobId"], "inner", spread=("at",)
        ).where(F.col("at") > F.col("since"))
        rung = later.groupBy("jobId").agg(first_hit)
        if rank < last:
            rungs.append(store(rung, f"rung-{rank}"))
    # The highest rung of a job is also its latest in time.
    climbed = reduce(DataFrame.unionByName, (stored.df for stored in rungs), rung)
    state = climbed.groupBy("jobId").agg(F.max("e").alias("e"))
    jobs = events.groupBy("jobId").agg(F.min("siteId").alias("siteId"))
    return jobs.join(state, "jobId", "left").select(
        "jobId",
        "siteId",
        F.coalesce("e.status", F.lit(STATE_NAMES[0])).alias("status"),
        F.col("e.at.ts").alias("updatedAt"),
    )


def fold_last_wins(events: DataFrame) -> DataFrame:
    """State after unguarded updates: the latest event of a job decides."""
    newest = F.max_by(F.struct("eventStatus", "siteId"), F.struct(*ORDER)).alias("e")
    return events.groupBy("jobId").agg(newest).select(
        "jobId", "e.siteId", F.col("e.eventStatus").alias("status")
    )


def job_counts(states: DataFrame) -> DataFrame:
    return states.groupBy("siteId", "status").agg(F.count(F.lit(1)).alias("jobs"))


def latest_job(created: DataFrame) -> DataFrame:
    """Newest job of each site by creation time (job id breaks ties)."""
    newest = created.groupBy("siteId").agg(F.max(F.struct("createdAt", "jobId")).alias("j"))
    return newest.select("siteId", "j.jobId", "j.createdAt")


def parse_payloads(events: DataFrame, column: str = "payload") -> DataFrame:
    """Typed fields of webhook payloads, with normalised status and whole texts.

    A sink with bounded columns clips them itself (`clip_text`)."""
    parsed = events.withColumn("_p", payload_fields(column))
    status = normalize_status("_p.status")
    failed = status == "FAILED"
    return parsed.withColumns(
        {
            "runId": F.col("_p.runId").try_cast("long"),
            "payloadJobId": F.col("_p.jobId"),
            "outcome": status,
            "errorCode": F.when(failed, F.lit(RUN_FAILED_CODE)),
            "errorMessage": F.when(failed, text_or_null("_p.error")),
        }
    ).drop("_p")


def match_jobs(events: DataFrame, jobs: DataFrame) -> DataFrame:
    """Job of every event by run id, else by job id; `matchedBy` is null for neither.

    `jobs` has unique `jobId` and unique non-null `jobRunId`. In both lookups a run or
    job with very many events is dealt to as many tasks as its count asks for; events
    without a key find nothing and are not shuffled."""

    def look_up(rows: DataFrame, table: DataFrame, key: str, found: str) -> DataFrame:
        keyed = counted_join(rows.where(F.col(key).isNotNull()), table, [key], "left", spread=("event_id",))
        rest = rows.where(F.col(key).isNull()).withColumn(found, F.lit(None).cast("string"))
        return keyed.unionByName(rest)

    by_run = jobs.where(F.col("jobRunId").isNotNull()).select(
        F.col("jobRunId").alias("runId"), F.col("jobId").alias("_byRun")
    )
    by_job = jobs.select(F.col("jobId").alias("payloadJobId"), F.col("jobId").alias("_byJob"))
    found = look_up(look_up(events, by_run, "runId", "_byRun"), by_job, "payloadJobId", "_byJob")
    return found.withColumns(
        {
            "jobId": F.coalesce("_byRun", "_byJob"),
            "matchedBy": F.when(F.col("_byRun").isNotNull(), "run").when(
                F.col("_byJob").isNotNull(), "job"
            ),
        }
    ).drop("_byRun", "_byJob")
