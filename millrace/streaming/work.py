"""Claiming by polls and notifications, running handlers, and acknowledging."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from threading import Thread

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..errors import ListenerError, StaleAcknowledgement
from ..operators.ack import ack_batch, stale_acks
from ..operators.claim import claim_by_ids, fetch_next, lock_tasks
from ..operators.claim import order as claim_order
from ..operators.notify import decoded
from ..operators.ranks import Pages
from ..operators.workers import initial_heartbeat
from ..schema import Config
from ..sources.variants import parsed
from ..store import Store

#: Seconds that a poll waits after its strategy has ended.
ENDED_PAUSE = 0.1


def utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def register(store: Store, config: Config, worker: str, lease: str, now: datetime | None = None) -> None:
    """Sweeps orphans and registers the worker in one commit; raises AlreadyRegistered before anything is claimed."""
    now = now or utc_now()
    request = store.spark.createDataFrame([(worker, config.queue, "ParquetStore", "", lease)], "id string, worker_type string, storage_name string, layers string, lease_token string")

    def change(seen):
        swept, registered = initial_heartbeat(seen.jobs, seen.workers, request, config.reenqueue_orphaned_after, now)
        return {"jobs": swept.affected, "workers": registered.affected}

    store.transact(change, now)


def claim_once(store: Store, config: Config, worker: str, now: datetime | None = None) -> DataFrame:
    """Claims up to the buffer's size; the tasks as they were committed."""
    now = now or utc_now()
    return taken(store, lambda seen: fetch_next(seen.jobs, config, worker, now).affected, now)


def claim_ids(store: Store, config: Config, worker: str, ids: DataFrame, now: datetime | None = None) -> DataFrame:
    now = now or utc_now()
    return taken(store, lambda seen: claim_by_ids(seen.jobs, config.queue, ids, worker, now).affected, now)


def lock(store: Store, config: Config, worker: str, tasks: DataFrame, now: datetime | None = None) -> DataFrame:
    """Locks tasks that were handed out in any way; those that this worker can't lock are left out."""
    now = now or utc_now()
    return taken(store, lambda seen: lock_tasks(seen.jobs, tasks.select("id"), worker, now, config.queue).affected, now)


def taken(store: Store, change: Callable[[object], DataFrame], now: datetime) -> DataFrame:
    """Commits the jobs that ``change(version)`` gives; returns them, none if there was nothing to commit."""
    version, before, _ = store.transact(lambda seen: {"jobs": change(seen)}, now)
    return store.changed(version, before).orderBy(F.col("priority").desc(), "run_at", "id")


def polls(store: Store, config: Config, worker: str, strategy: Callable[[int], float | None] | None = None, clock: Callable[[], datetime] = utc_now) -> Iterator[DataFrame]:
    """Batches of claimed tasks, one a poll; empty ones aren't given.

    ``strategy`` gets the size of the batch before and says how long to wait, or None to end; the default waits
    ``poll_interval`` after an empty batch.
    """
    wait = strategy or (lambda n: 0.0 if n else config.poll_interval)
    n = 0
    while (pause := wait(n)) is not None:
        time.sleep(pause)
        rows = claim_once(store, config, worker, clock())
        n = rows.count()
        if n:
            yield rows
    time.sleep(ENDED_PAUSE)


def poll_stream(store: Store, config: Config, worker: str, handle: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """A streaming query that claims at every trigger and gives the tasks to ``handle``."""
    ticks = store.spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def run(_: DataFrame, batch: int) -> None:
        rows = claim_once(store, config, worker)
        if not rows.isEmpty():
            handle(rows)

    return ticks.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(processingTime=f"{config.poll_interval} seconds").start()


def listen(store: Store, handle: Callable[[DataFrame, int], None], checkpoint: str, queue: str | None = None, available_now: bool = False, files_per_trigger: int = 1000) -> StreamingQuery:
    """Notifications as they are committed: ``handle`` gets each micro-batch's (job_type, ids) and its number.

    The checkpoint makes delivery at least once. ``available_now`` ends when all that is there was handled.
    """
    lines = store.spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_trigger).text(f"{store.path}/notify")
    events = decoded(lines.select(F.col("value").alias("payload")), queue)
    writer = events.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 second")).start()


def notified(store: Store, config: Config, worker: str, handle: Callable[[DataFrame], None], checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Claims the ids of each notification of the queue and gives the tasks to ``handle``."""

    return listen(store, lambda events, _: _claimed(store, config, worker, events, handle), checkpoint, config.queue, available_now)


def _claimed(store: Store, config: Config, worker: str, events: DataFrame, handle: Callable[[DataFrame], None]) -> None:
    """Claims all the events' ids in one version and hands the tasks on, as many at a time as the buffer holds."""
    rows = claim_ids(store, config, worker, events.select(F.explode("ids").alias("id")))
    stored = Pages(rows, claim_order())
    for at in range(0, len(stored), config.capacity):
        handle(stored.page(at, config.capacity).orderBy("nth").drop("nth"))


def fetched(store: Store, config: Config, worker: str, handle: Callable[[DataFrame], None], checkpoint: str, rate: int = 1) -> StreamingQuery:
    """Notifications and polls in one stream: ids that are told are claimed at once, and ``rate`` ticks a second poll.

    What a lost notification left is found by the next poll, after the ids of the same micro-batch.
    """
    lines = store.spark.readStream.schema("value string").text(f"{store.path}/notify")
    told = decoded(lines.select(F.col("value").alias("payload")), config.queue)
    ticks = store.spark.readStream.format("rate").option("rowsPerSecond", rate).load()
    both = told.unionByName(ticks.select(F.lit(None).cast("string").alias("job_type"), F.array().cast("array<string>").alias("ids")))

    def run(events: DataFrame, _: int) -> None:
        _claimed(store, config, worker, events.where("job_type is not null"), handle)
        if not events.where("job_type is null").isEmpty():
            rows = claim_once(store, config, worker)
            if not rows.isEmpty():
                handle(rows)

    return both.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(processingTime=f"{config.poll_interval} seconds").start()


def ended(query: StreamingQuery, seconds: float) -> bool:
    """Whether a stream ends in that time; raises ListenerError if it failed."""
    try:
        return query.awaitTermination(seconds)
    except StreamingQueryException as e:
        raise ListenerError(str(e)) from e


class SharedListener:
    """One streaming query for many queues: each micro-batch goes to the consumers of its queues.

    A consumer that fails is removed, and what it raised is kept in ``failed``; the stream ends when none is left.
    """

    def __init__(self, store: Store):
        self.store = store
        self.consumers: dict[str, list[tuple[Callable[[DataFrame], None], Callable[[], None]]]] = {}
        self.failed: list[tuple[str, Exception]] = []
        self.query: StreamingQuery | None = None

    def subscribe(self, queue: str, consumer: Callable[[DataFrame], None]) -> Callable[[], None]:
        """Adds a consumer of a queue's ids; returns what removes it."""

        def leave() -> None:
            left = [c for c in self.consumers.get(queue, []) if c is not own]
            self.consumers.pop(queue, None)
            if left:
                self.consumers[queue] = left
            if not self.consumers and self.query is not None:
                Thread(target=self.query.stop, daemon=True).start()  # also from within a micro-batch

        own = (consumer, leave)
        self.consumers.setdefault(queue, []).append(own)
        return leave

    def _run(self, events: DataFrame, _: int) -> None:
        wanted = list(self.consumers)
        rows = events.where(F.col("job_type").isin(wanted)).select("job_type", F.explode("ids").alias("id")).persist()
        for queue in [r[0] for r in rows.select("job_type").distinct().collect()]:  # the subscribed ones at most
            for consumer, leave in list(self.consumers.get(queue, ())):
                try:
                    consumer(rows.where(F.col("job_type") == queue).select("id"))
                except Exception as e:  # one consumer's failure isn't the others'
                    self.failed.append((queue, e))
                    leave()
        rows.unpersist()

    def start(self, checkpoint: str, available_now: bool = False) -> StreamingQuery:
        self.query = listen(self.store, self._run, checkpoint, None, available_now)
        return self.query


def handled(tasks: DataFrame, handler: Callable[[dict], object], lease: str | None = None, decode: Callable[[str], object] = json.loads, encode: Callable[[object], str] = json.dumps) -> DataFrame:
    """Acknowledgements of locked tasks: ``handler`` gets a task's row with its decoded arguments, on the executors.

    What it returns becomes the result, as JSON; what it, or the codec, raises becomes the error. ``lease`` is sent along.
    """
    schema = "task_id string, queue string, worker_id string, lock_at timestamp_ntz, started_attempts int, ok boolean, lease_token string, value string"

    def run(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                try:
                    ok, value = True, encode(handler(row | {"args": decode(row["job"]) if row["job"] else None}))
                except Exception as e:  # a task's failure is its result
                    ok, value = False, f"{type(e).__name__}: {e}"
                out.append((row["id"], row["job_type"], row["lock_by"], row["lock_at"], row["attempts"], ok, lease, value))
            yield pd.DataFrame(out, columns=["task_id", "queue", "worker_id", "lock_at", "started_attempts", "ok", "lease_token", "value"])

    return tasks.where("lock_by is not null and lock_at is not null and status = 'Running'").mapInPandas(run, schema)


def handled_by(tasks: DataFrame, value: Callable[[Column], Column], lease: str | None = None, failed: Callable[[Column], Column] | None = None) -> DataFrame:
    """Like ``handled``, but in the JVM: ``value`` makes the result of the arguments, a VARIANT; ``failed`` the error's text or null.

    A payload that isn't JSON is a failure.
    """
    args = F.col("args")
    wrong = F.when(F.col("job").isNotNull() & args.isNull(), F.lit("DecodeError: the payload isn't JSON"))
    error = wrong if failed is None else F.coalesce(wrong, failed(args))
    rows = parsed(tasks.where("lock_by is not null and lock_at is not null and status = 'Running'")).withColumn("_error", error)
    return rows.select(
        F.col("id").alias("task_id"),
        F.col("job_type").alias("queue"),
        F.col("lock_by").alias("worker_id"),
        "lock_at",
        F.col("attempts").alias("started_attempts"),
        F.col("_error").isNull().alias("ok"),
        F.lit(lease).cast("string").alias("lease_token"),
        F.coalesce("_error", _json_of(value(args))).alias("value"),
    )


def _json_of(value: Column) -> Column:
    """A value as JSON text, a bare one as well."""
    text = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.substring(text, F.lit(2), F.length(text) - 2)


def work(store: Store, config: Config, worker: str, tasks: DataFrame, handler: Callable[[dict], object] | None, now: datetime | None = None, lease: str | None = None, columns: Callable[[DataFrame], DataFrame] | None = None, **codec) -> int:
    """Locks tasks that aren't this worker's yet, runs them and acknowledges them, unless the configuration says otherwise.

    ``columns``, in place of a handler, makes the acknowledgements of the tasks as a DataFrame (see ``handled_by``).

    Outcomes are stored before the commit, so that a retry runs no handler again. Those that fit are applied; if any
    comes too late, StaleAcknowledgement is raised afterwards. Returns how many tasks were run.
    """
    now = now or utc_now()
    mine = (F.col("status") == "Running") & (F.col("lock_by") == worker) & F.col("lock_at").isNotNull()
    free = tasks.where(~F.coalesce(mine, F.lit(False)))
    if not free.isEmpty():
        tasks = tasks.where(mine).unionByName(lock(store, config, worker, free, now))
    acks = store.put("outcomes", columns(tasks) if columns is not None else handled(tasks, handler, lease, **codec))
    n = acks.count()
    if n and config.ack:
        late = 0

        def change(seen):
            nonlocal late
            late = stale_acks(seen.jobs, seen.workers, acks).count()
            return {"jobs": ack_batch(seen.jobs, seen.workers, acks, now).affected}

        store.transact(change, now)
        if late:
            raise StaleAcknowledgement(f"{late} of {n} outcomes came too late")
    return n


def work_once(store: Store, config: Config, worker: str, handler: Callable[[dict], object], now: datetime | None = None, lease: str | None = None, **codec) -> int:
    """Claims a batch and works on it; returns how many tasks it had. An idle queue leaves the store as it is."""
    now = now or utc_now()
    tasks = claim_once(store, config, worker, now)
    return 0 if tasks.isEmpty() else work(store, config, worker, tasks, handler, now, lease, **codec)
