"""Acknowledgements: compare-and-set of a batch of outcomes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import StaleAcknowledgement
from ..functions.scalars import next_status, result_json, timestamp_of
from ..schema import JOBS, Transition, instant

_KEY = ["id", "job_type", "lock_by", "attempts"]


def judged(jobs: DataFrame, workers: DataFrame, acks: DataFrame) -> DataFrame:
    """Every acknowledgement with its job's columns, _ok, _value, _lease, _lock_at and whether it is _applied.

    ``acks``: task_id, queue, worker_id, lock_at (a timestamp or seconds since 1970), started_attempts, ok, lease_token
    (null: not checked) and, if there, value. The task must still be Running under the same lock and attempt; a lease
    must be the worker's. Of several that fit one task, one is applied: a success before a failure, then the smallest
    value; the others are stale like those that don't fit.
    """
    value = F.col("value") if "value" in acks.columns else F.lit(None)
    lock_at = F.col("lock_at") if acks.schema["lock_at"].dataType.simpleString().startswith("timestamp") else timestamp_of(F.col("lock_at"))
    a = acks.select(
        F.col("task_id").alias("id"),
        F.col("queue").alias("job_type"),
        F.col("worker_id").alias("lock_by"),
        lock_at.alias("_lock_at"),
        F.col("started_attempts").alias("attempts"),
        F.col("ok").alias("_ok"),
        F.col("lease_token").alias("_lease"),
        value.cast("string").alias("_value"),
    )
    leases = workers.select(F.col("id").alias("lock_by"), F.col("worker_type").alias("job_type"), F.col("lease_token").alias("_held"))
    both = a.join(jobs.where("status = 'Running'"), _KEY, "left").join(leases, ["lock_by", "job_type"], "left")
    fits = F.coalesce((F.col("lock_at") == F.col("_lock_at")) & (F.col("_lease").isNull() | (F.col("_lease") == F.col("_held"))), F.lit(False))
    # dealt by the key of the join already
    order = Window.partitionBy(*_KEY, "_fits").orderBy(F.col("_ok").desc(), F.col("_value").asc_nulls_first())
    return both.withColumn("_fits", fits).withColumn("_applied", F.col("_fits") & (F.row_number().over(order) == 1)).drop("_held", "_fits")


def matched(jobs: DataFrame, workers: DataFrame, acks: DataFrame) -> DataFrame:
    """Jobs that an acknowledgement fits, with the _ok and _value of the one that is applied."""
    return judged(jobs, workers, acks).where("_applied").select(*[f.name for f in JOBS], "_ok", "_value")


def ack_batch(jobs: DataFrame, workers: DataFrame, acks: DataFrame, now: datetime | str) -> Transition:
    """Applies outcomes: attempts + 1, the next status, the result and done_at; locks stay. Others are stale."""
    attempt = F.col("attempts") + 1
    new = matched(jobs, workers, acks).withColumns(
        {
            "status": next_status(F.col("_ok"), attempt, F.col("max_attempts")),
            "attempts": attempt.cast("int"),
            "last_result": result_json(F.col("_ok"), F.col("_value")),
            "done_at": instant(now),
        }
    )
    affected = new.select(*[f.name for f in JOBS])
    return Transition(affected, jobs.join(affected.select("id"), "id", "left_anti").unionByName(affected))


def stale_acks(jobs: DataFrame, workers: DataFrame, acks: DataFrame) -> DataFrame:
    """The acknowledgements that aren't applied: they fit no task any more, or another one of the same task came first."""
    out = judged(jobs, workers, acks).where("not _applied")
    names = {"task_id": "id", "queue": "job_type", "worker_id": "lock_by", "lock_at": "_lock_at", "started_attempts": "attempts", "ok": "_ok", "lease_token": "_lease", "value": "_value"}
    return out.select(*[F.col(old).alias(new) for new, old in names.items() if new in acks.columns])


def ack_all(jobs: DataFrame, workers: DataFrame, acks: DataFrame, now: datetime | str) -> Transition:
    """``ack_batch``, but raises StaleAcknowledgement if any outcome doesn't fit."""
    if n := stale_acks(jobs, workers, acks).count():
        raise StaleAcknowledgement(f"{n} outcomes came too late")
    return ack_batch(jobs, workers, acks, now)
