"""Tasks whose worker is gone, and repairs of locks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import is_locked, stale
from ..schema import JOBS, Transition, instant, null_of, to_second

ABANDONED = '{"Err":"worker was lost; the task was taken back"}'


def orphans(jobs: DataFrame, workers: DataFrame, after: float, now: datetime | str) -> DataFrame:
    """Running or queued tasks whose worker was last seen ``after`` seconds ago or earlier."""
    gone = workers.where(stale(now, after)).select(F.col("id").alias("lock_by"), F.col("worker_type").alias("job_type"))
    return jobs.where(is_locked()).join(gone, ["lock_by", "job_type"], "left_semi")


def sweep(jobs: DataFrame, workers: DataFrame, after: float, now: datetime | str) -> Transition:
    """Gives orphans back (Pending) or, at their last attempt, ends them (Killed)."""
    over = F.col("attempts") + 1 >= F.col("max_attempts")
    affected = orphans(jobs, workers, after, now).withColumns(
        {
            "status": F.when(over, "Killed").otherwise("Pending"),
            "attempts": F.least(F.col("attempts") + 1, F.col("max_attempts")).cast("int"),
            "last_result": F.when(over | F.col("last_result").isNull(), ABANDONED).otherwise(F.col("last_result")),
            "done_at": F.when(over, instant(now)).otherwise(null_of("timestamp_ntz")),
            "lock_at": null_of("timestamp_ntz"),
            "lock_by": null_of("string"),
        }
    )
    affected = affected.select(*[f.name for f in JOBS])
    return Transition(affected, jobs.join(affected.select("id"), "id", "left_anti").unionByName(affected))


def repair_locks(jobs: DataFrame, workers: DataFrame) -> Transition:
    """Running or queued tasks locked by a worker that isn't registered become Pending."""
    known = workers.select(F.col("id").alias("lock_by"), F.col("worker_type").alias("job_type"))
    lost = jobs.where(is_locked()).join(known, ["lock_by", "job_type"], "left_anti")
    affected = lost.withColumns({"status": F.lit("Pending"), "lock_at": null_of("timestamp_ntz"), "lock_by": null_of("string")}).select(*[f.name for f in JOBS])
    return Transition(affected, jobs.join(affected.select("id"), "id", "left_anti").unionByName(affected))


def backfilled(jobs: DataFrame) -> DataFrame:
    """Jobs with lock times cut to the second and missing priorities set to 0."""
    return jobs.withColumns({"lock_at": to_second(F.col("lock_at")), "priority": F.coalesce("priority", F.lit(0))})


def dedupe_workers(workers: DataFrame) -> DataFrame:
    """One row for each worker id: that of the first worker_type."""
    first = F.row_number().over(Window.partitionBy("id").orderBy("worker_type"))
    return workers.withColumn("_nth", first).where("_nth = 1").drop("_nth")
