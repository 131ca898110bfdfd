"""Bulk enqueue with idempotency keys."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import InvalidArgument, StorageError
from ..schema import DEFAULT_MAX_ATTEMPTS, JOBS, KEY_BYTES, METADATA_BYTES, QUEUE_BYTES, Transition, instant, jobs_of, null_of

_OPTIONAL = {"priority": 0, "max_attempts": DEFAULT_MAX_ATTEMPTS, "metadata": None, "idempotency_key": None, "run_at": None}


def new_rows(batch: DataFrame, now: datetime | str) -> DataFrame:
    """A batch (id, job_type, job and any of priority, max_attempts, metadata, idempotency_key, run_at) as pending jobs."""
    have = set(batch.columns)
    column = lambda c: F.coalesce(F.col(c), F.lit(_OPTIONAL[c])) if c in have else F.lit(_OPTIONAL[c])
    made = {
        "status": F.lit("Pending"),
        "attempts": F.lit(0),
        "run_at": F.coalesce(F.col("run_at"), instant(now)) if "run_at" in have else instant(now),
        "last_result": null_of("string"),
        "lock_at": null_of("timestamp_ntz"),
        "lock_by": null_of("string"),
        "done_at": null_of("timestamp_ntz"),
    }
    made |= {c: column(c) for c in ("priority", "max_attempts", "metadata", "idempotency_key")}
    return jobs_of(batch.select(*[made[f.name].alias(f.name) if f.name in made else F.col(f.name) for f in JOBS]))


def too_long() -> Column:
    """Whether a row's queue name, metadata or key is too long, in bytes."""
    size = lambda c: F.coalesce(F.octet_length(c), F.lit(0))
    return (size("job_type") > QUEUE_BYTES) | (size("metadata") > METADATA_BYTES) | (size("idempotency_key") > KEY_BYTES)


def split_conflicts(jobs: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` with the column fresh: false for a key that the queue has already, stored or earlier (by id) in the batch.

    Of the stored side only the keys that the batch has are looked at, once each; both sides meet by (queue, key). An
    empty key is a key.
    """
    asked = rows.where("idempotency_key is not null").select("job_type", "idempotency_key")
    keys = jobs.where("idempotency_key is not null").select("job_type", "idempotency_key").join(asked, ["job_type", "idempotency_key"], "left_semi").distinct().withColumn("stored", F.lit(True))
    first = F.row_number().over(Window.partitionBy("job_type", "idempotency_key").orderBy("id"))
    keyed = rows.where("idempotency_key is not null").withColumn("nth", first).join(keys, ["job_type", "idempotency_key"], "left")
    keyed = keyed.select(*rows.columns, (F.col("stored").isNull() & (F.col("nth") == 1)).alias("fresh"))
    return rows.where("idempotency_key is null").withColumn("fresh", F.lit(True)).unionByName(keyed)


def enqueue_dedup(jobs: DataFrame, batch: DataFrame, now: datetime | str) -> Transition:
    """Inserts what conflicts with nothing and drops the rest."""
    fresh = split_conflicts(jobs, new_rows(batch, now)).where("fresh").drop("fresh")
    return Transition(fresh, jobs.unionByName(fresh))


def enqueue(jobs: DataFrame, batch: DataFrame, now: datetime | str) -> Transition:
    """Inserts the whole batch or, if a cap is passed, an id is taken or any key conflicts, nothing.

    One aggregation over the batch tells all of that. An empty batch changes nothing. Raises InvalidArgument (caps, keys) or StorageError (ids).
    """
    rows = new_rows(batch, now)
    there = jobs.select("id").join(rows.select("id"), "id", "left_semi").distinct().withColumn("_there", F.lit(True))
    marked = split_conflicts(jobs, rows).join(there, "id", "left")
    counts = marked.agg(
        F.count(F.lit(1)).alias("all"),
        F.count_if(too_long()).alias("long"),
        F.count_if("_there").alias("there"),
        F.count_if(~F.col("fresh")).alias("dropped"),
        F.count_distinct("id").alias("ids"),
    ).first()
    if counts["long"]:
        raise InvalidArgument(f"{counts['long']} of {counts['all']} tasks pass the limits: queue {QUEUE_BYTES}, metadata {METADATA_BYTES}, key {KEY_BYTES} bytes")
    if counts["ids"] < counts["all"] or counts["there"]:
        raise StorageError("an id is in the table already")
    if counts["dropped"]:
        raise InvalidArgument(f"{counts['dropped']} of {counts['all']} tasks conflict with an idempotency key")
    return Transition(rows, jobs.unionByName(rows), {"inserted": counts["all"]})
