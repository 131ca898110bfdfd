"""Queries of the engine by name. Each takes (spark, sf_dir) and derives its tables from the events there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import claimable, terminal, due
from ..functions.scalars import result_json
from ..operators import ack, checks, claim, enqueue, incremental, listing, notify, orphans, reports, workers
from ..schema import Filter
from ..sources import derived as D
from ..sources import notifications, variants
from ..sources.folders import shared_folder
from ..sources.tables import zipped
from ..streaming import states
from ..streaming.ingest import Inbox
from ..streaming.ingest import enqueue_stream as streamed
from ..streaming.work import handled_by

NOW, AFTER = D.NOW, D.ORPHAN_SECONDS
Query = Callable[[SparkSession, str], DataFrame]
_found: dict[str, Query] = {}


def _query(f: Query) -> Query:
    _found[f.__name__] = f
    return f


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.jobs(D.events(spark, sf_dir))


def _workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.workers(D.events(spark, sf_dir))


def _ids(jobs: DataFrame) -> DataFrame:
    """The ids that by-id queries ask for: every task's, and as many that no task has."""
    return jobs.select("id").union(jobs.select(F.concat(F.lit("x"), F.substring("id", 2, 25))))


def _flat(df: DataFrame, array: str) -> DataFrame:
    return df.withColumn(array, F.array_join(F.col(array).cast("array<string>"), ","))


_JOB = ("id", "job_type", "status", "attempts", "max_attempts", "run_at", "last_result", "lock_at", "lock_by", "done_at", "priority", "idempotency_key")


@_query
def claim_next(spark, sf_dir):
    return claim.claim(_jobs(spark, sf_dir), "click", "w-new", 10, NOW).affected.select(*_JOB)


@_query
def claim_state(spark, sf_dir):
    after = claim.claim(_jobs(spark, sf_dir), "click", "w-new", 10, NOW).after
    return after.groupBy("job_type", "status", "lock_by").agg(F.count(F.lit(1)).alias("n"), F.count("done_at").alias("done"))


@_query
def claim_all_queues(spark, sf_dir):
    return claim.claim_all(_jobs(spark, sf_dir), "w-new", 10, NOW).affected.select(*_JOB)


@_query
def claim_for_workers(spark, sf_dir):
    e = D.events(spark, sf_dir)
    return claim.claim_for(D.jobs(e), D.claim_requests(D.workers(e)), NOW).affected.select(*_JOB)


@_query
def claim_by_ids(spark, sf_dir):
    jobs = _jobs(spark, sf_dir)
    return claim.claim_by_ids(jobs, "click", _ids(jobs), "w-new", NOW).affected.select(*_JOB)


@_query
def get_jobs_queued(spark, sf_dir):
    return claim.get_jobs(_jobs(spark, sf_dir), "w-new", "view", NOW).affected.select(*_JOB)


@_query
def lock_task_matrix(spark, sf_dir):
    jobs = _jobs(spark, sf_dir)
    return claim.lock_tasks(jobs, _ids(jobs), "w-3", NOW).affected.select("id", "job_type", "status", "attempts", "lock_at", "lock_by")


@_query
def lock_task_in_queue(spark, sf_dir):
    jobs = _jobs(spark, sf_dir)
    return claim.lock_tasks(jobs, _ids(jobs), "w-3", NOW, "click").affected.select("id", "status", "lock_at", "lock_by")


@_query
def ack_batch(spark, sf_dir):
    jobs = _jobs(spark, sf_dir)
    return ack.ack_batch(jobs, _workers(spark, sf_dir), D.acks(jobs), NOW).affected.select("id", "job_type", "status", "attempts", "max_attempts", "done_at", "lock_by", "lock_at")


@_query
def ack_stale(spark, sf_dir):
    jobs = _jobs(spark, sf_dir)
    return ack.stale_acks(jobs, _workers(spark, sf_dir), D.acks(jobs)).select("task_id", "queue", "worker_id", "started_attempts")


@_query
def ack_again(spark, sf_dir):
    jobs = _jobs(spark, sf_dir)
    return ack.ack_batch(jobs, _workers(spark, sf_dir), D.acks_again(jobs), NOW).affected.select("id", "job_type", "status", "attempts", "done_at", "last_result")


@_query
def ack_again_stale(spark, sf_dir):
    jobs = _jobs(spark, sf_dir)
    return ack.stale_acks(jobs, _workers(spark, sf_dir), D.acks_again(jobs)).select("task_id", "queue", "worker_id", "lock_at", "started_attempts", "ok")


@_query
def ack_seconds(spark, sf_dir):
    jobs = _jobs(spark, sf_dir)
    return ack.ack_batch(jobs, _workers(spark, sf_dir), D.acks_seconds(jobs), NOW).affected.select("id", "job_type", "status", "attempts", "max_attempts", "done_at", "lock_by", "lock_at")


@_query
def orphan_sweep(spark, sf_dir):
    return orphans.sweep(_jobs(spark, sf_dir), _workers(spark, sf_dir), AFTER, NOW).affected.select("id", "job_type", "status", "attempts", "last_result", "lock_by", "lock_at", "done_at")


@_query
def orphan_counts(spark, sf_dir):
    after = orphans.sweep(_jobs(spark, sf_dir), _workers(spark, sf_dir), AFTER, NOW).after
    return after.groupBy("job_type", "status").agg(F.count(F.lit(1)).alias("n"), F.count("lock_by").alias("locked"))


def _requests(spark, sf_dir):
    """Five registrations: a new worker, the same lease, no lease stored, a stale one, and one that another holds."""
    rows = [("w-new", "click", "t-n"), ("w-1", "click", "t-1"), ("w-7", "click", "t-x"), ("w-6", "view", "t-y"), ("w-0", "view", "t-z")]
    return spark.createDataFrame([(a, b, "Other", "L", c) for a, b, c in rows], "id string, worker_type string, storage_name string, layers string, lease_token string")


@_query
def register_worker_upsert(spark, sf_dir):
    return workers.outcomes(_workers(spark, sf_dir), _requests(spark, sf_dir), AFTER, NOW)


@_query
def admin_register_upsert(spark, sf_dir):
    return workers.admin_register(_workers(spark, sf_dir), _requests(spark, sf_dir), NOW)


@_query
def keep_alive(spark, sf_dir):
    w = _workers(spark, sf_dir)
    beats = w.withColumn("lease_token", F.when(F.col("id") == "w-2", F.lit("other")).otherwise(F.col("lease_token")))
    return workers.keep_alive(w, beats.where("id != 'w-3'"), NOW).after


@_query
def enqueue_dedup(spark, sf_dir):
    e = D.events(spark, sf_dir)
    return enqueue.enqueue_dedup(D.jobs(e), D.enqueue_batch(e), NOW).affected.select("id", "job_type", "status", "attempts", "max_attempts", "run_at", "priority", "idempotency_key")


@_query
def enqueue_conflicts(spark, sf_dir):
    e = D.events(spark, sf_dir)
    marked = enqueue.split_conflicts(D.jobs(e), enqueue.new_rows(D.enqueue_batch(e), NOW))
    return marked.where("not fresh").select("id", "job_type", "idempotency_key")


@_query
def enqueue_all(spark, sf_dir):
    e = D.events(spark, sf_dir)
    done = enqueue.enqueue(D.jobs(e), D.enqueue_batch(e).drop("idempotency_key"), NOW)
    return done.affected.select("id", "job_type", "status", "attempts", "max_attempts", "run_at", "priority", "idempotency_key")


@_query
def enqueue_stream(spark, sf_dir):
    """All events as tasks of a stream, inserted by the executors micro-batch by micro-batch."""
    inbox = Inbox(spark, shared_folder(spark, "inbox"))
    batch = D.enqueue_batch(D.event_stream(spark, sf_dir))
    streamed(batch, inbox, shared_folder(spark, "inbox-checkpoint"), _jobs(spark, sf_dir), lambda: NOW, available_now=True).awaitTermination()
    return inbox.read().select("id", "job_type", "status", "attempts", "max_attempts", "run_at", "priority", "idempotency_key")


@_query
def notify_payloads(spark, sf_dir):
    return notify.notify_batches(_jobs(spark, sf_dir).where("status = 'Pending'"), NOW)


@_query
def notify_batches(spark, sf_dir):
    return _flat(notify.notify_chunks(_jobs(spark, sf_dir).where("status = 'Pending'"), NOW), "ids")


@_query
def notify_decode(spark, sf_dir):
    return _flat(notify.decoded(D.notify_payloads(D.events(spark, sf_dir))), "ids")


@_query
def notify_legacy(spark, sf_dir):
    return notify.notify_each(_jobs(spark, sf_dir))


@_query
def notify_listen(spark, sf_dir):
    """Tasks inserted in micro-batches, and what a listener to the inbox's notifications is told of them."""
    inbox = Inbox(spark, shared_folder(spark, "inbox"))
    batch = D.enqueue_batch(D.event_stream(spark, sf_dir))
    streamed(batch, inbox, shared_folder(spark, "inbox-checkpoint"), None, lambda: NOW, available_now=True).awaitTermination()
    events = inbox.listen().select("job_type", F.explode("ids").alias("id"))
    return _told(events, spark).distinct()


@_query
def notify_source(spark, sf_dir):
    """The same by the source with offsets of its own, for two queues."""
    inbox = Inbox(spark, shared_folder(spark, "inbox"))
    batch = D.enqueue_batch(D.event_stream(spark, sf_dir))
    streamed(batch, inbox, shared_folder(spark, "inbox-checkpoint"), None, lambda: NOW, available_now=True).awaitTermination()
    notifications.register(spark)
    events = spark.readStream.format(notifications.NAME).option("path", inbox.path).option("queues", "click,view").load()
    return _told(events.select("job_type", F.explode("ids").alias("id")), spark).distinct()


@_query
def arrays_to_rows(spark, sf_dir):
    """Parallel arrays of a hundred tasks each, as a bulk insert has them, as rows again."""
    rows = _jobs(spark, sf_dir).select("job_type", "id", "run_at", "priority")
    arrays = rows.groupBy("job_type", F.expr("cast(id as long) div 100").alias("part")).agg(F.array_sort(F.collect_list(F.struct("id", "run_at", "priority"))).alias("x"))
    parallel = arrays.select("x.id", "x.run_at", "x.priority", F.transform("x", lambda _: F.col("job_type")).alias("job_type"))
    return zipped(parallel, "id", "job_type", "run_at", "priority")


@_query
def tasks_over_caps(spark, sf_dir):
    """Tasks whose queue, metadata or key would be refused, in bytes, not characters."""
    i = F.col("id").substr(2, 25).cast("string")
    digits = F.regexp_replace(i, "[^0-9]", "").cast("long")
    long = {
        "job_type": F.when(digits % 11 == 0, F.repeat(F.lit("é"), (F.lit(120) + digits % 13).cast("int"))).otherwise(F.col("job_type")),
        "metadata": F.when(digits % 7 == 0, F.repeat(F.lit("ab"), (F.lit(4090) + digits % 13).cast("int"))).otherwise(F.col("metadata")),
        "idempotency_key": F.when(digits % 5 == 0, F.repeat(F.lit("k€"), (F.lit(250) + digits % 13).cast("int"))),
    }
    rows = enqueue.new_rows(D.enqueue_batch(D.events(spark, sf_dir)), NOW).withColumns(long)
    return rows.where(enqueue.too_long()).select("id", F.octet_length("job_type").alias("queue_bytes"), F.octet_length("metadata").alias("metadata_bytes"), F.octet_length("idempotency_key").alias("key_bytes"))


@_query
def capped_errors(spark, sf_dir):
    """Failures with long errors of two-byte characters: what is stored of them."""
    i = F.col("id").cast("long")
    text = F.concat(F.when(i % 2 == 0, "a").otherwise(""), F.repeat(F.lit("é"), (F.lit(4080) + i % 40).cast("int")))
    return _jobs(spark, sf_dir).where("status = 'Failed'").select("id", result_json(F.lit(False), text).alias("last_result"))


@_query
def initial_heartbeat(spark, sf_dir):
    """What a worker's start changes: orphans taken back, and its row."""
    requests = _requests(spark, sf_dir).where("id in ('w-new', 'w-1')")
    swept, registered = workers.initial_heartbeat(_jobs(spark, sf_dir), _workers(spark, sf_dir), requests, AFTER, NOW)
    tasks = swept.affected.select("id", F.col("job_type").alias("queue"), F.col("status").alias("what"))
    return tasks.unionByName(registered.affected.select("id", F.col("worker_type").alias("queue"), F.col("lease_token").alias("what")))


@_query
def fetch_by_id(spark, sf_dir):
    jobs = _jobs(spark, sf_dir)
    found = [listing.fetch_by_id(jobs, q, "3".rjust(26, "0")).select(*_JOB) for q in ("click", "view", "purchase")]
    return found[0].unionByName(found[1]).unionByName(found[2])


@_query
def result_fields(spark, sf_dir):
    return variants.outcomes(_jobs(spark, sf_dir), "long")


@_query
def payload_fields(spark, sf_dir):
    """The queues' payloads by a field: tasks, and the attempts that they had, for each value."""
    rows = variants.parsed(_jobs(spark, sf_dir).select("job_type", "job", "metadata", "attempts"))
    k = variants.field("args", "$.k", "int")
    return rows.groupBy("job_type", k.alias("k")).agg(F.count(F.lit(1)).alias("n"), F.sum("attempts").alias("attempts"), F.count(variants.field("meta", "$.none")).alias("none"))


@_query
def handled_columns(spark, sf_dir):
    """Results of the running tasks, made of fields of their arguments in the JVM, and applied."""
    jobs = _jobs(spark, sf_dir)
    failed = lambda args: F.when(variants.field(args, "$.k", "int") % 10 == 0, F.concat(F.lit("no "), variants.field(args, "$.k")))
    acks = handled_by(jobs, lambda args: variants.field(args, "$.k", "int") + 1, failed=failed)
    return ack.ack_batch(jobs, _workers(spark, sf_dir), acks, NOW).affected.select("id", "status", "attempts", "last_result")


@_query
def waited(spark, sf_dir):
    """Every task waited for and every end, as one stream: what the waits were for, told once each."""
    jobs = D.jobs(D.event_stream(spark, sf_dir, None))
    rows = states.waits_of(D.waits(jobs)).unionByName(states.ends_of(jobs))
    return _told(states.waited(rows), spark)


@_query
def lost_workers(spark, sf_dir):
    """Workers that the stream of beats lost for good, by timers."""
    beats = D.beats(D.event_stream(spark, sf_dir, None))
    lost = _told(states.lost_workers(beats, 21_600), spark).withColumn("last_seen", F.col("last_seen").cast("timestamp_ntz"))
    last = D.beats(D.events(spark, sf_dir)).groupBy("id", "worker_type").agg(F.max("last_seen").alias("last_seen"))
    return lost.join(last, ["id", "worker_type", "last_seen"])


def _told(stream, spark):
    """The rows of a stream of what is there."""
    path = shared_folder(spark, "told")
    put = lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
    stream.writeStream.foreachBatch(put).option("checkpointLocation", shared_folder(spark, "told-checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path).select(*stream.columns)


@_query
def list_tasks_page1(spark, sf_dir):
    return listing.list_tasks(_jobs(spark, sf_dir), "click", Filter("Done", 1, 20)).select(*_JOB)


@_query
def list_tasks_page2(spark, sf_dir):
    return listing.list_tasks(_jobs(spark, sf_dir), "click", Filter(None, 2, 20)).select(*_JOB)


@_query
def list_all_tasks(spark, sf_dir):
    return listing.list_all_tasks(_jobs(spark, sf_dir), Filter("Failed", 2, 25)).select(*_JOB)


@_query
def list_tasks_late(spark, sf_dir):
    """The page in the middle of a listing."""
    jobs = _jobs(spark, sf_dir)
    stored = listing.pages(jobs, "Done")
    return listing.list_from(jobs, stored, Filter("Done", len(stored) // 50 + 1, 25)).select(*_JOB)


@_query
def list_workers(spark, sf_dir):
    return listing.running_workers(_workers(spark, sf_dir), "click")


@_query
def list_all_workers(spark, sf_dir):
    return listing.running_workers(_workers(spark, sf_dir))


@_query
def check_status(spark, sf_dir):
    jobs = _jobs(spark, sf_dir)
    return listing.check_status(jobs, _ids(jobs))


@_query
def wait_remaining(spark, sf_dir):
    jobs = _jobs(spark, sf_dir)
    return listing.remaining(jobs, _ids(jobs))


@_query
def metrics_global(spark, sf_dir):
    return reports.metrics(_jobs(spark, sf_dir), NOW)


@_query
def metrics_by_queue(spark, sf_dir):
    return reports.metrics(_jobs(spark, sf_dir), NOW, "click")


@_query
def metrics_empty_queue(spark, sf_dir):
    return reports.metrics(_jobs(spark, sf_dir), NOW, "no-such-queue")


@_query
def metrics_report(spark, sf_dir):
    """All 30 rows; of the storage's, whether there is a value, as files differ between engines."""
    r = reports.report(_jobs(spark, sf_dir), NOW)
    whole, number = F.col("stat_type") == "Number", F.col("value").cast("double")
    storage = F.col("title").startswith("DB_")
    text = F.when(storage & (number > 0), "positive").when(whole & ~storage, F.col("value"))
    return r.select("title", "stat_type", "priority", text.alias("text"), F.when(~storage, number).alias("number"))


@_query
def peak_hour(spark, sf_dir):
    return reports.peak_hour(_jobs(spark, sf_dir)).toDF("peak_hour_jobs")


@_query
def queue_rollup(spark, sf_dir):
    r = reports.queue_rollup(_jobs(spark, sf_dir), NOW)
    return r.select(*[F.col(c).alias(c.lower()) for c in r.columns])


@_query
def queue_stats_long(spark, sf_dir):
    s = reports.queue_statistics(_jobs(spark, sf_dir), NOW)
    number = F.when(F.col("stat_type") != "Timestamp", F.col("value")).cast("double")
    return s.select("job_type", "title", "stat_type", number.alias("number"), "priority")


@_query
def queue_types_union(spark, sf_dir):
    return reports.queue_names(_jobs(spark, sf_dir), _workers(spark, sf_dir))


@_query
def locked_workers(spark, sf_dir):
    return _flat(reports.locked_workers(_jobs(spark, sf_dir)), "workers")


@_query
def daily_activity(spark, sf_dir):
    return _flat(reports.daily_activity(_jobs(spark, sf_dir), NOW), "activity")


@_query
def queue_info_flat(spark, sf_dir):
    q = reports.list_queues(_jobs(spark, sf_dir), _workers(spark, sf_dir), NOW)
    names = F.array_join(F.transform("stats", lambda s: s["title"]), ",")
    return q.select("name", F.size("stats").cast("long").alias("n_stats"), names.alias("titles"), F.array_join("workers", ",").alias("workers"), F.array_join(F.col("activity").cast("array<string>"), ",").alias("activity"))


@_query
def queue_info(spark, sf_dir):
    q = reports.list_queues(_jobs(spark, sf_dir), _workers(spark, sf_dir), NOW)
    rows = q.select("name", F.array_join("workers", ",").alias("workers"), F.array_join(F.col("activity").cast("array<string>"), ",").alias("activity"), F.posexplode_outer("stats").alias("nth", "s"))
    number = F.when(F.col("s.stat_type") != "Timestamp", F.col("s.value")).cast("double")
    return rows.select("name", "workers", "activity", "nth", "s.title", "s.stat_type", number.alias("number"), "s.priority")


@_query
def snapshot(spark, sf_dir):
    return reports.snapshot(_jobs(spark, sf_dir), NOW)


@_query
def snapshot_incremental(spark, sf_dir):
    """The snapshot after acknowledgements, from that of before and the changed rows."""
    jobs = _jobs(spark, sf_dir)
    done = ack.ack_batch(jobs, _workers(spark, sf_dir), D.acks(jobs), NOW)
    before = incremental.SnapshotState.of(jobs)
    old = jobs.join(done.affected.select("id"), "id", "left_semi")
    return before.applied(old, done.affected).report(NOW, done.after)


@_query
def claimable_count(spark, sf_dir):
    return reports.claimable_count(_jobs(spark, sf_dir), NOW)


@_query
def terminal_counts(spark, sf_dir):
    return _jobs(spark, sf_dir).where(terminal()).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@_query
def delayed_jobs(spark, sf_dir):
    return _jobs(spark, sf_dir).where(claimable() & ~due(NOW)).select("id", "job_type", "run_at")


@_query
def repair_orphan_locks(spark, sf_dir):
    known = _workers(spark, sf_dir).where("id not in ('w-2', 'w-5')")
    return orphans.repair_locks(_jobs(spark, sf_dir), known).affected.select("id", "job_type", "status", "lock_by", "lock_at")


@_query
def backfill(spark, sf_dir):
    jobs = _jobs(spark, sf_dir).withColumn("priority", F.nullif("priority", F.lit(2)))
    return orphans.backfilled(jobs).groupBy("priority").agg(F.count(F.lit(1)).alias("n"), F.max("lock_at").alias("last_lock"))


@_query
def dedupe_workers(spark, sf_dir):
    return orphans.dedupe_workers(_workers(spark, sf_dir)).select("id", "worker_type", "lease_token")


def _broken(spark, sf_dir):
    """The jobs with every rule broken in some rows, so that reports have something to say."""
    i = F.col("id").cast("long")
    new = {
        "status": F.when(i % 89 == 1, "Lost").otherwise(F.col("status")),
        "attempts": F.when(i % 83 == 2, -1).when(i % 79 == 3, F.col("max_attempts") + 1).otherwise(F.col("attempts")),
        "max_attempts": F.when(i % 73 == 4, 0).otherwise(F.col("max_attempts")),
        "priority": F.when(i % 97 == 0, -1).otherwise(F.col("priority")),
        "lock_by": F.when(F.col("lock_by") == "w-4", "w-x").otherwise(F.col("lock_by")),
        "idempotency_key": F.when(i % 50 == 0, "same").otherwise(F.col("idempotency_key")),
    }
    return _jobs(spark, sf_dir).withColumns(new)


@_query
def constraint_violations(spark, sf_dir):
    return checks.constraint_violations(_broken(spark, sf_dir))


@_query
def fk_violations(spark, sf_dir):
    return checks.fk_violations(_broken(spark, sf_dir), _workers(spark, sf_dir))


@_query
def unique_violations(spark, sf_dir):
    return checks.unique_violations(_broken(spark, sf_dir))


@_query
def db_size_stats(spark, sf_dir):
    return reports.storage_statistics(D.events(spark, sf_dir))


def queries() -> dict[str, Query]:
    return dict(_found)
