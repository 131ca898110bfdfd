"""Rules of the tables as reports that must be empty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import broken_rules


def constraint_violations(jobs: DataFrame) -> DataFrame:
    """id and rule of each row that breaks a rule of its own."""
    broken = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in broken_rules().items()]))
    return jobs.select("id", F.explode(broken).alias("rule"))


def fk_violations(jobs: DataFrame, workers: DataFrame) -> DataFrame:
    """id, lock_by, job_type of jobs locked by a worker that isn't in the table."""
    known = workers.select(F.col("id").alias("lock_by"), F.col("worker_type").alias("job_type"))
    return jobs.where("lock_by is not null").join(known, ["lock_by", "job_type"], "left_anti").select("id", "lock_by", "job_type")


def unique_violations(jobs: DataFrame) -> DataFrame:
    """job_type, idempotency_key, n of keys that a queue has more than once."""
    keyed = jobs.where("idempotency_key is not null").groupBy("job_type", "idempotency_key").agg(F.count(F.lit(1)).alias("n"))
    return keyed.where("n > 1")
