"""Claims and locks: which tasks a worker takes, and the table afterwards.

A claim's order is priority (high first), run_at, then id. With a limit the plan is a top-k, so that no global sort
happens; the next state meets the claimed ids by a broadcast as long as the limit says that they are few.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import TaskNotFound
from ..functions.predicates import claimable, due, in_queue, lockable
from ..schema import JOBS, Config, Transition, instant, null_of, to_second
from ..sources.folders import small, written


def order() -> tuple[Column, ...]:
    """The order in which tasks are claimed."""
    return (F.col("priority").desc(), F.col("run_at").asc(), F.col("id").asc())


#: Claimed ids that a broadcast may hold.
BROADCAST_IDS = 100_000


def _changes(worker: str, now, status: str, clear_done: bool) -> dict[str, Column]:
    new = {"status": F.lit(status), "lock_by": F.lit(worker), "lock_at": to_second(instant(now))}
    return new | {"done_at": null_of("timestamp_ntz")} if clear_done else new


def _taken(rows: DataFrame, worker: str, now, status: str, clear_done: bool) -> DataFrame:
    return rows.withColumns(_changes(worker, now, status, clear_done)).select(*[f.name for f in JOBS])


def _after(jobs: DataFrame, affected: DataFrame) -> DataFrame:
    return jobs.join(affected.select("id"), "id", "left_anti").unionByName(affected)


def claim(jobs: DataFrame, queue: str, worker: str, limit: int, now: datetime | str, status: str = "Running", clear_done: bool = True) -> Transition:
    """Takes up to ``limit`` (at least one) due, claimable tasks of a queue for a worker."""
    rows = jobs.where(in_queue(queue) & claimable() & due(now)).orderBy(*order()).limit(max(limit, 1))
    ids = rows.select("id", F.lit(True).alias("_taken"))
    marked = jobs.join(F.broadcast(ids) if limit <= BROADCAST_IDS else ids, "id", "left")
    new = {c: F.when(F.col("_taken"), x).otherwise(F.col(c)) for c, x in _changes(worker, now, status, clear_done).items()}
    return Transition(_taken(rows, worker, now, status, clear_done), marked.withColumns(new).select(*[f.name for f in JOBS]))


def fetch_next(jobs: DataFrame, config: Config, worker: str, now: datetime | str) -> Transition:
    return claim(jobs, config.queue, worker, config.capacity, now)


def get_jobs(jobs: DataFrame, worker: str, queue: str, now: datetime | str, count: int = 5) -> Transition:
    """Like a claim, but the tasks become Queued and keep done_at."""
    return claim(jobs, queue, worker, count, now, status="Queued", clear_done=False)


def _first(jobs: DataFrame, limit: int, now: datetime | str) -> DataFrame:
    """The first ``limit`` due, claimable tasks of every queue: id, job_type and their place from 1.

    Each task of the scan keeps its own first ones of a queue (a group limit) before anything moves, so a queue of any
    size sends ``limit`` rows a task. Only what the order needs is read.
    """
    slim = jobs.where(claimable() & due(now)).select("id", "job_type", "priority", "run_at")
    place = F.row_number().over(Window.partitionBy("job_type").orderBy(*order()))
    return slim.withColumn("place", place).where(F.col("place") <= max(limit, 1)).select("id", "job_type", "place")


def claim_all(jobs: DataFrame, worker: str, limit: int, now: datetime | str) -> Transition:
    """Takes up to ``limit`` tasks of every queue at once for a worker."""
    ids = small(written(_first(jobs, limit, now).select("id"), "claimed"))
    affected = _taken(jobs.join(ids, "id", "left_semi"), worker, now, "Running", clear_done=True)
    return Transition(affected, jobs.join(ids, "id", "left_anti").unionByName(affected))


def shares(requests: DataFrame) -> DataFrame:
    """A row for each task that a worker may get: job_type, place (in the queue's order, from 1), worker.

    ``requests`` has a row for each worker and queue: worker, job_type, capacity. Workers of a queue, in the order of
    their names, have consecutive places; a capacity below one asks for one. As many rows as tasks are asked for.
    """
    asked = requests.groupBy("job_type", "worker").agg(F.sum(F.greatest(F.col("capacity").cast("long"), F.lit(1))).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("job_type").orderBy("worker").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return asked.withColumn("_to", upto).select("job_type", "worker", F.explode(F.sequence(F.col("_to") - F.col("n") + 1, "_to")).alias("place"))


def claim_for(jobs: DataFrame, requests: DataFrame, now: datetime | str) -> Transition:
    """Claims for many workers in one pass: each queue's first tasks are cut into intervals by worker (see ``shares``).

    No task goes to two workers, and none is tried twice. The largest queue's request bounds what each task of the scan sends.
    """
    slots = written(shares(requests), "shares")
    most = slots.agg(F.max("place")).first()[0]
    if most is None:
        return Transition(jobs.limit(0), jobs)
    taken = written(_first(jobs, most, now).join(small(slots), ["job_type", "place"]).select("id", F.col("worker").alias("_worker")), "claimed")
    new = {"status": F.lit("Running"), "lock_by": F.col("_worker"), "lock_at": to_second(instant(now)), "done_at": null_of("timestamp_ntz")}
    names = [f.name for f in JOBS]
    affected = jobs.join(small(taken), "id").withColumns(new).select(*names)
    return Transition(affected, jobs.join(small(taken.select("id")), "id", "left_anti").select(*names).unionByName(affected))


def claim_by_ids(jobs: DataFrame, queue: str, ids: DataFrame, worker: str, now: datetime | str) -> Transition:
    """Takes those of the given ids (one column) that are due and claimable in the queue."""
    wanted = ids.toDF("id").distinct()
    rows = jobs.where(in_queue(queue) & claimable() & due(now)).join(wanted, "id", "left_semi")
    affected = _taken(rows, worker, now, "Running", clear_done=True)
    return Transition(affected, _after(jobs, affected))


def locked_rows(jobs: DataFrame, ids: DataFrame, worker: str, now: datetime | str, queue: str | None = None) -> DataFrame:
    """Those of the given ids that the worker may lock, locked: a lock it holds already keeps its time."""
    mine = F.col("status").isin("Queued", "Running") & (F.col("lock_by") == worker) & F.col("lock_at").isNotNull()
    at: Column = F.when(mine, F.col("lock_at")).otherwise(to_second(instant(now)))
    rows = jobs.where(lockable(worker, now, queue)).join(ids.toDF("id").distinct(), "id", "left_semi")
    return rows.withColumn("lock_at", at).withColumns({"status": F.lit("Running"), "lock_by": F.lit(worker)}).select(*[f.name for f in JOBS])


def lock_tasks(jobs: DataFrame, ids: DataFrame, worker: str, now: datetime | str, queue: str | None = None) -> Transition:
    affected = locked_rows(jobs, ids, worker, now, queue)
    return Transition(affected, _after(jobs, affected))


def lock_task(jobs: DataFrame, task_id: str, worker: str, now: datetime | str, queue: str | None = None) -> Transition:
    """Locks one task; raises TaskNotFound if this worker can't."""
    done = lock_tasks(jobs, jobs.sparkSession.createDataFrame([(task_id,)], "id string"), worker, now, queue)
    if done.affected.isEmpty():
        raise TaskNotFound(f"task {task_id} can't be locked by {worker}")
    return done
