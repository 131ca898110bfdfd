"""Transition matrices on small tables."""

import pytest

from millrace.errors import AlreadyRegistered, InvalidArgument, StaleAcknowledgement, StorageError, TaskNotFound, WorkerNotRegistered
from millrace.functions.scalars import CUT_MARK, cap_text, cap_text_column, new_ulid, ulid
from millrace.operators import ack, checks, claim, enqueue, listing, notify, orphans, reports, workers
from millrace.schema import JOBS, WORKERS, Filter, instant
from pyspark.sql import functions as F

NOW = "2024-05-01 12:00:00"


def jobs_table(spark, *rows):
    base = {"job": "{}", "job_type": "q", "status": "Pending", "attempts": 0, "max_attempts": 3, "run_at": "2024-05-01 11:00:00", "last_result": None, "lock_at": None, "lock_by": None, "done_at": None, "priority": 0, "metadata": None, "idempotency_key": None}
    plain = spark.createDataFrame([tuple((base | r)[f.name] for f in JOBS) for r in rows], ", ".join(f"{f.name} {'string' if 'timestamp' in f.dataType.simpleString() else f.dataType.simpleString()}" for f in JOBS))
    return plain.select(*[F.col(f.name).cast(f.dataType) for f in JOBS])


def workers_table(spark, *rows):
    base = {"worker_type": "q", "storage_name": "S", "layers": "", "last_seen": NOW, "started_at": None, "lease_token": None}
    plain = spark.createDataFrame([tuple((base | r)[f.name] for f in WORKERS) for r in rows], ", ".join(f"{f.name} string" for f in WORKERS))
    return plain.select(*[F.col(f.name).cast(f.dataType) for f in WORKERS])


def ids(df):
    return [r["id"] for r in df.collect()]


def test_claim_matrix(spark):
    jobs = jobs_table(
        spark,
        {"id": "pending"},
        {"id": "failed", "status": "Failed", "attempts": 1},
        {"id": "failed-out", "status": "Failed", "attempts": 3},
        {"id": "running", "status": "Running"},
        {"id": "queued", "status": "Queued"},
        {"id": "done", "status": "Done"},
        {"id": "killed", "status": "Killed"},
        {"id": "now", "run_at": NOW},
        {"id": "later", "run_at": "2024-05-01 12:00:01"},
        {"id": "other", "job_type": "r"},
        {"id": "urgent", "priority": 5, "run_at": "2024-05-01 11:59:00", "done_at": "2024-05-01 01:00:00"},
    )
    done = claim.claim(jobs, "q", "w", 0, NOW)
    assert ids(done.affected) == ["urgent"]
    row = done.affected.first()
    assert (row.status, row.lock_by, str(row.lock_at), row.done_at, row.attempts) == ("Running", "w", NOW, None, 0)
    assert ids(claim.claim(jobs, "q", "w", 10, NOW).affected.orderBy(*claim.order())) == ["urgent", "failed", "pending", "now"]
    assert done.after.count() == jobs.count() and done.after.where("status = 'Running'").count() == 2
    queued = claim.get_jobs(jobs, "w", "q", NOW, 1).affected.first()
    assert queued.status == "Queued" and queued.done_at is not None
    some = spark.createDataFrame([("pending",), ("running",), ("later",), ("pending",)], "id string")
    assert ids(claim.claim_by_ids(jobs, "q", some, "w", NOW).affected) == ["pending"]


def test_lock_matrix(spark):
    held = {"lock_by": "w", "lock_at": "2024-05-01 10:00:00"}
    jobs = jobs_table(
        spark,
        {"id": "pending"},
        {"id": "mine", "status": "Queued", **held},
        {"id": "mine-running", "status": "Running", **held},
        {"id": "theirs", "status": "Queued", "lock_by": "x", "lock_at": "2024-05-01 10:00:00"},
        {"id": "retry", "status": "Failed", "attempts": 1, **held},
        {"id": "out", "status": "Failed", "attempts": 3},
        {"id": "later", "run_at": "2024-05-02 00:00:00"},
        {"id": "done", "status": "Done"},
    )
    got = {r.id: str(r.lock_at) for r in claim.lock_tasks(jobs, jobs.select("id"), "w", NOW).affected.collect()}
    assert got == {"pending": NOW, "mine": held["lock_at"], "mine-running": held["lock_at"], "retry": NOW}
    with pytest.raises(TaskNotFound):
        claim.lock_task(jobs, "theirs", "w", NOW)
    with pytest.raises(TaskNotFound):
        claim.lock_task(jobs, "pending", "w", NOW, queue="r")


def test_ack_matrix(spark):
    at = "2024-05-01 11:30:00"
    run = {"status": "Running", "lock_by": "w", "lock_at": at}
    jobs = jobs_table(spark, {"id": "ok", **run}, {"id": "err", **run}, {"id": "last", **run, "attempts": 2}, {"id": "late", **run}, {"id": "lease", **run}, {"id": "done", **run, "status": "Done"})
    w = workers_table(spark, {"id": "w", "lease_token": "t"})
    rows = [("ok", at, 0, True, "t", '{"n":1}'), ("err", at, 0, False, None, "bo\"om"), ("last", at, 2, False, "t", "x"), ("late", "2024-05-01 11:29:59", 0, True, "t", None), ("lease", at, 0, True, "u", None), ("done", at, 0, True, "t", None), ("ok", at, 1, True, "t", None)]
    acks = spark.createDataFrame([(i, "q", "w", l, s, o, t, v) for i, l, s, o, t, v in rows[:6]], "task_id string, queue string, worker_id string, lock_at string, started_attempts int, ok boolean, lease_token string, value string").withColumn("lock_at", F.col("lock_at").cast("timestamp_ntz"))
    done = ack.ack_batch(jobs, w, acks, NOW)
    got = {r.id: (r.status, r.attempts, r.last_result, r.lock_by, str(r.done_at)) for r in done.affected.collect()}
    assert got == {"ok": ("Done", 1, '{"Ok":{"n":1}}', "w", NOW), "err": ("Failed", 1, '{"Err":"bo\\"om"}', "w", NOW), "last": ("Killed", 3, '{"Err":"x"}', "w", NOW)}
    assert sorted(r.task_id for r in ack.stale_acks(jobs, w, acks).collect()) == ["done", "late", "lease"]
    with pytest.raises(StaleAcknowledgement):
        ack.ack_all(jobs, w, acks, NOW)


def test_enqueue(spark):
    jobs = jobs_table(spark, {"id": "a", "idempotency_key": "k"}, {"id": "b", "idempotency_key": ""}, {"id": "c", "job_type": "r", "idempotency_key": "x"})
    make = lambda *rows: spark.createDataFrame([(i, "q", "{}", k) for i, k in rows], "id string, job_type string, job string, idempotency_key string")
    done = enqueue.enqueue(jobs, make(("n1", None), ("n2", "x"), ("n3", None)), NOW)
    assert done.after.count() == 6 and done.affected.where("status = 'Pending' and attempts = 0 and max_attempts = 25").count() == 3
    for rows in ([("n1", "k"), ("n2", None)], [("n1", "z"), ("n2", "z")], [("n1", "")]):
        with pytest.raises(InvalidArgument, match=rf"1 of {len(rows)}"):
            enqueue.enqueue(jobs, make(*rows), NOW)
    with pytest.raises(StorageError):
        enqueue.enqueue(jobs, make(("a", None)), NOW)
    assert enqueue.enqueue(jobs, make(("n", None)).limit(0), NOW).affected.count() == 0
    assert enqueue.enqueue(jobs, make(("n", "é" * 512)), NOW).affected.count() == 1
    with pytest.raises(InvalidArgument):
        enqueue.enqueue(jobs, make(("n", "é" * 512 + "x")), NOW)
    assert sorted(ids(enqueue.enqueue_dedup(jobs, make(("n1", "k"), ("n2", "z"), ("n3", "z"), ("n4", None)), NOW).affected)) == ["n2", "n4"]


def test_orphans(spark):
    lock = {"lock_by": "w", "lock_at": NOW}
    jobs = jobs_table(
        spark,
        {"id": "run", "status": "Running", **lock},
        {"id": "queued", "status": "Queued", **lock, "last_result": '{"Err":"old"}'},
        {"id": "last", "status": "Running", "attempts": 2, "last_result": '{"Err":"old"}', **lock},
        {"id": "fresh", "status": "Running", "lock_by": "v", "lock_at": NOW},
        {"id": "done", "status": "Done", **lock},
        {"id": "gone", "status": "Running", "lock_by": "nobody", "lock_at": NOW},
    )
    w = workers_table(spark, {"id": "w", "last_seen": "2024-05-01 11:58:00"}, {"id": "v", "last_seen": "2024-05-01 11:58:01"})
    got = {r.id: (r.status, r.attempts, r.last_result, r.lock_by, str(r.done_at)) for r in orphans.sweep(jobs, w, 120, NOW).affected.collect()}
    assert got == {"run": ("Pending", 1, orphans.ABANDONED, None, "None"), "queued": ("Pending", 1, '{"Err":"old"}', None, "None"), "last": ("Killed", 3, orphans.ABANDONED, None, NOW)}
    assert ids(orphans.repair_locks(jobs, w).affected) == ["gone"]


def test_workers(spark):
    w = workers_table(spark, {"id": "free"}, {"id": "same", "lease_token": "t"}, {"id": "held", "lease_token": "x"}, {"id": "stale", "lease_token": "x", "last_seen": "2024-05-01 11:58:00"})
    ask = lambda *names: spark.createDataFrame([(n, "q", "New", "L", "t") for n in names], "id string, worker_type string, storage_name string, layers string, lease_token string")
    got = {r.id: r.outcome for r in workers.outcomes(w, ask("free", "same", "held", "stale", "new"), 120, NOW).collect()}
    assert got == {"free": "updated", "same": "updated", "held": "rejected", "stale": "updated", "new": "inserted"}
    with pytest.raises(AlreadyRegistered):
        workers.register(w, ask("held"), 120, NOW)
    assert {r.id: r.outcome for r in workers.admin_register(w, ask("free", "held", "new"), NOW).collect()} == {"free": "updated", "same": "unchanged", "held": "kept", "stale": "unchanged", "new": "inserted"}
    workers.beat(w, "same", "q", "t", NOW)
    for who, lease in (("same", "other"), ("free", None), ("nobody", "t")):
        with pytest.raises(WorkerNotRegistered):
            workers.beat(w, who, "q", lease, NOW)


def test_notify(spark):
    jobs = jobs_table(spark, *[{"id": f"j{k:03d}"} for k in range(150)], {"id": "x", "job_type": "one"}, {"id": "later", "job_type": "z", "run_at": "2025-01-01 00:00:00"})
    assert sorted((r.job_type, len(r.ids)) for r in notify.notify_chunks(jobs, NOW).collect()) == [("one", 1), ("q", 50), ("q", 100)]
    both = notify.notify_batches(jobs, NOW).select("payload").union(notify.notify_each(jobs.where("id = 'x'")).select("payload")).union(spark.createDataFrame([("nonsense",), (None,), ("{}",)], "payload string"))
    assert sorted((r.job_type, len(r.ids)) for r in notify.decoded(both).collect()) == [("one", 1), ("one", 1), ("q", 50), ("q", 100)]
    assert notify.decoded(both, "one").count() == 2


def test_listing(spark):
    jobs = jobs_table(spark, {"id": "a", "status": "Done", "done_at": "2024-05-01 10:00:00"}, {"id": "b", "status": "Done"}, {"id": "c", "status": "Done", "done_at": "2024-05-01 11:00:00"}, {"id": "d", "status": "Failed", "attempts": 3}, {"id": "e"})
    assert ids(listing.list_tasks(jobs, "q", Filter("Done", 1, 2))) == ["b", "c"]
    assert ids(listing.list_tasks(jobs, "q", Filter("Done", 2, 2))) == ["a"]
    assert ids(listing.list_all_tasks(jobs, Filter())) == ["e"]
    for page in (0, 1 << 31):
        with pytest.raises(InvalidArgument):
            listing.list_tasks(jobs, "q", Filter(None, page, 10))
    asked = spark.createDataFrame([("a",), ("d",), ("e",), ("nope",)], "id string")
    assert sorted(ids(listing.check_status(jobs, asked))) == ["a", "d"]
    assert sorted(ids(listing.remaining(jobs, asked))) == ["e", "nope"]
    assert listing.fetch_by_id(jobs, "r", "a").count() == 0


def test_reports(spark):
    jobs = jobs_table(spark, {"id": "a", "run_at": "2024-05-03 07:10:00"}, {"id": "b", "run_at": "2024-05-01 07:50:00", "status": "Running", "lock_by": "w"}, {"id": "c", "status": "Killed", "lock_by": "v", "run_at": "2024-05-01 11:30:00"})
    m = {r.title: r.value for r in reports.metrics(jobs, NOW).collect()}
    assert len(m) == 27 and m["PEAK_HOUR_JOBS"] == 2 and m["JOBS_PAST_HOUR"] == 2 and m["AVG_JOB_DURATION_MINS"] == 0 and m["LONGEST_RUNNING_JOB_MINS"] == 250
    assert len(reports.report(jobs, NOW, "none").collect()) == 30
    q = {r.name: r for r in reports.list_queues(jobs, workers_table(spark, {"id": "w", "worker_type": "idle"}), NOW).collect()}
    assert q["q"].workers == ["w"] and len(q["q"].stats) == 18 and q["q"].activity == [2, 1]
    assert (q["idle"].stats, q["idle"].workers, q["idle"].activity) == ([], [], [])
    assert {s.title: s.value for s in q["q"].stats}["AVG_JOB_DURATION_MINS"] is None


def test_checks(spark):
    jobs = jobs_table(spark, {"id": "a", "attempts": 4}, {"id": "b", "status": "Odd", "priority": -1}, {"id": "c", "lock_by": "w"}, {"id": "d"})
    assert sorted(map(tuple, checks.constraint_violations(jobs).collect())) == [("a", "attempts_of_max"), ("b", "priority"), ("b", "status")]
    assert ids(checks.fk_violations(jobs, workers_table(spark, {"id": "x"}))) == ["c"]


def test_scalars(spark):
    long = "é" * 5000
    assert len(cap_text(long).encode()) <= 8192 and cap_text(long).endswith(CUT_MARK) and cap_text("abc") == "abc"
    texts = [long, "x" + long, "abc", "", "日" * 2731, "日" * 2730 + "ab"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(cap_text_column(F.col("t"))).collect()
    assert [r[0] for r in got] == [cap_text(t) for t in texts]
    assert ulid(0, bytes(10)) == "0" * 26 and ulid((1 << 48) - 1, b"\xff" * 10) == "7" + "Z" * 25
    made = [r[0] for r in spark.range(20).select(new_ulid(instant(NOW))).collect()]
    assert len(set(made)) == 20 and {m[:10] for m in made} == {ulid(1714564800000, bytes(10))[:10]} and all(len(m) == 26 for m in made)
