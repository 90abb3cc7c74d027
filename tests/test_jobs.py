import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from laserfold import runtime
from laserfold.functions.events import clip_text, normalize_status
from laserfold.operators import jobs, upsert
from laserfold.params import JOB_STATES
from laserfold.streaming import job_state

EVENT_DDL = (
    "event_id long, ts timestamp, jobId string, siteId string, eventStatus string, "
    "idempotencyKey string, props string"
)


def random_events(n, n_jobs, seed=1):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        # Job 0 is hot: it has a third of all events.
        job = 0 if rng.random() < 0.33 else rng.randrange(n_jobs)
        ts = start + timedelta(seconds=rng.randrange(n // 2))
        rows.append((i, ts, f"j{job}", f"s{job % 2}", rng.choice(JOB_STATES), f"k{job % 5}", None))
    return rows


def brute_fold(rows):
    state = {}
    for _, _, job, _, status, _, _ in sorted(rows, key=lambda r: (r[1], r[0])):
        now = state.setdefault(job, "NONE")
        before = {"CREATED": "NONE", "FAILED": "PROCESSING"}.get(
            status, JOB_STATES[JOB_STATES.index(status) - 1]
        )
        if now == before:
            state[job] = status
    return state


def states(df):
    return {r["jobId"]: r["status"] for r in df.collect()}


@pytest.mark.parametrize("broadcast", [True, False])
def test_fold_matches_brute_force(spark, monkeypatch, broadcast):
    rows = random_events(3000, 400)
    events = spark.createDataFrame(rows, EVENT_DDL).repartition(7)
    if not broadcast:
        monkeypatch.setattr(runtime.Stored, "broadcastable", property(lambda self: False))
    folded = jobs.fold_states(events)
    assert states(folded) == brute_fold(rows)
    assert set(states(folded).values()) > {"NONE", "SUCCEEDED", "FAILED"}


def test_stream_of_several_batches_equals_batch(spark, tmp_path):
    rows = sorted(random_events(600, 40, seed=4), key=lambda r: (r[1], r[0]))
    random.Random(1).shuffle(rows)  # events arrive out of order
    folder, out, progress = (str(tmp_path / n) for n in ("events", "states", "progress"))
    created, progress2 = str(tmp_path / "created"), str(tmp_path / "progress2")
    for part in range(3):
        chunk = rows[part * 200 : (part + 1) * 200]
        spark.createDataFrame(chunk, EVENT_DDL).coalesce(1).write.mode("append").parquet(folder)
        stream = job_state.arriving_events(spark, folder, 1)
        job_state.run_states(stream, out, progress).awaitTermination()
        sink = job_state.merge_first_creates(created)
        job_state.run_available(stream, sink, progress2).awaitTermination()
    assert states(job_state.current_states(spark, out)) == brute_fold(rows)
    events = spark.createDataFrame(rows, EVENT_DDL)
    assert sorted(map(str, job_state.current_states(spark, out).collect())) == sorted(
        map(str, jobs.fold_states(events).collect())
    )
    want = sorted(map(str, jobs.first_creates(events).collect()))
    assert sorted(map(str, job_state.current_creates(spark, created).collect())) == want
    # A batch that is tried again changes nothing.
    job_state.merge_first_creates(created)(events.limit(0), 2)
    assert len([p for p in (tmp_path / "created").iterdir() if p.is_dir()]) == 2


def test_first_create_and_last_wins(spark):
    rows = random_events(500, 30)
    events = spark.createDataFrame(rows, EVENT_DDL)
    want = {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        if r[4] == "CREATED":
            want.setdefault(r[5], r[2])
    assert {r["idempotencyKey"]: r["jobId"] for r in jobs.first_creates(events).collect()} == want
    last = {r[2]: r[4] for r in sorted(rows, key=lambda r: (r[1], r[0]))}
    assert states(jobs.fold_last_wins(events)) == last


def test_status_words(spark):
    texts = ["SUCCEEDED", "Success", " ok ", "completed", "FAILED", "CANCELED", "error", "", None, "foo"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    found = [r[0] for r in df.select(normalize_status("t")).collect()]
    assert found == ["SUCCESS"] * 4 + ["FAILED"] * 3 + [None] * 3


def test_clip(spark):
    df = spark.createDataFrame([("x" * 3000,), ("  ",), (None,), ("ab",)], "t string").coalesce(1)
    found = [r[0] for r in df.select(clip_text("t", 2048)).collect()]
    assert [None if f is None else len(f) for f in found] == [2048, None, None, 2]


def test_payloads(spark):
    texts = [
        '{"a": {"run_id": 1}, "RunId": "7"}',
        '{"run_id": "x1", "status": "FAILED", "error": "  "}',
        '{"deep": [[{"q": {"run_id": 5, "result_state": "success"}}]]}',
        "[]", "{broken", None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "payload string").coalesce(1)
    rows = jobs.parse_payloads(df).collect()
    assert [r["runId"] for r in rows] == [7, None, 5, None, None, None]
    assert [r["outcome"] for r in rows] == [None, "FAILED", "SUCCESS", None, None, None]
    assert rows[1]["errorCode"] == "DBX_RUN_FAILED" and rows[1]["errorMessage"] is None


def test_match_by_run_then_by_job(spark):
    known = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "jobId string, jobRunId long")
    events = spark.createDataFrame(
        [(0, 1, "b"), (1, 9, "c"), (2, 9, "zz"), (3, None, None)],
        "event_id long, runId long, payloadJobId string",
    )
    found = {r["event_id"]: (r["jobId"], r["matchedBy"]) for r in jobs.match_jobs(events, known).collect()}
    assert found == {0: ("a", "run"), 1: ("c", "job"), 2: (None, None), 3: (None, None)}


def test_upsert_expired_live_and_absent(spark):
    schema = "siteId string, lockedBy string, expiresAt string"
    locks = spark.createDataFrame([("e", "old", "2000"), ("l", "old", "2040")], schema)
    asked = spark.createDataFrame([(s, "new", "2050") for s in "ela"], schema)
    after = upsert.claims(locks, asked, F.lit("2020"))
    assert {r["siteId"]: r["lockedBy"] for r in after.collect()} == {"e": "new", "l": "old", "a": "new"}
    left = upsert.conditional_delete(after, asked.where("siteId = 'l'"), ["siteId", "lockedBy"])
    assert left.count() == 3
    gone = upsert.conditional_delete(after, asked, ["siteId", "lockedBy"])
    assert [r["siteId"] for r in gone.collect()] == ["l"]
    assert upsert.conditional_delete(gone, asked, ["siteId", "lockedBy"]).count() == 1
    with pytest.raises(ValueError):
        upsert.claims(locks, asked.drop("expiresAt"), F.lit("2020"))


def test_salted_join_equals_plain_join(spark):
    left = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (7, "c")], "k long, v string")
    for how in ("inner", "left"):
        want = sorted(map(str, left.join(right, "k", how).collect()))
        got = runtime.salted_join(left, right, ["k"], how, spread=["id"]).select("k", "id", "v")
        assert sorted(map(str, got.collect())) == want


def test_shared_folder_must_be_set_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Fake:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://somewhere"})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.shared_root(Fake())
    assert runtime.shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("seed", range(20))
def test_ladder_forgets_only_what_cannot_matter(seed):
    """Events in any order, pruned after each arrival, give the chain of all events."""
    draw = random.Random(seed)
    rows = [(draw.randint(1, 5), True, draw.randint(0, 9), True, i, "s") for i in range(30)]
    kept = []
    for row in rows:
        kept, chain = job_state._pruned({*kept, row})
    whole, want = job_state._pruned(set(rows))
    assert chain == want and sorted(kept) == sorted(whole) and len(kept) <= len(rows)


def test_empty_streams_give_no_rows(spark, tmp_path):
    assert job_state.current_states(spark, str(tmp_path / "none")).count() == 0
    assert job_state.current_creates(spark, str(tmp_path / "none")).count() == 0


def test_jobs_of_a_bucket_share_a_key_of_the_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(job_state, "BUCKETS", 8, raising=False)
    rows = random_events(900, 200, seed=7) + [(10_000, None, "late", None, "CREATED", None, None)]
    random.Random(2).shuffle(rows)
    folder, out, progress = (str(tmp_path / n) for n in ("events", "states", "progress"))
    for part in range(2):
        spark.createDataFrame(rows[part::2], EVENT_DDL).coalesce(1).write.mode("append").parquet(folder)
    query = job_state.run_states(job_state.arriving_events(spark, folder, 1), out, progress)
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert held and max(held) <= 8
    found = sorted(map(str, job_state.current_states(spark, out).collect()))
    assert found == sorted(map(str, jobs.fold_states(spark.createDataFrame(rows, EVENT_DDL)).collect()))


def test_a_job_without_events_for_long_is_forgotten_alone():
    """Two jobs under one key: the idle one starts anew, the other goes on."""
    import pandas as pd

    class Value:
        held = None

        def get(self):
            return self.held

        def update(self, value):
            self.held = value

    class Times:
        def getCurrentProcessingTimeInMs(self):
            return self.now

    ladder, times = job_state.JobLadder(forget_after_ms=100), Times()
    ladder.jobs = Value()

    def send(now, *events):  # job, rank, at
        times.now = now
        chunk = pd.DataFrame(
            [(j, "s", r, True, at, True, at, job_state.STATE_NAMES[r]) for j, r, at in events],
            columns=list(job_state.EVENT_COLUMNS),
        )
        (out,) = ladder.handleInputRows((0,), iter([chunk]), times)
        return dict(zip(out["jobId"], out["status"], strict=True))

    assert send(0, ("a", 1, 1), ("b", 1, 1)) == {"a": "CREATED", "b": "CREATED"}
    assert send(60, ("a", 2, 2)) == {"a": "QUEUED"}
    assert send(120, ("a", 3, 3), ("b", 2, 2)) == {"a": "DBX_TRIGGERED", "b": "NONE"}
