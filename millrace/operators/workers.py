"""Registration and heartbeats of workers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import AlreadyRegistered, WorkerNotRegistered
from ..functions.predicates import lease_free
from ..schema import WORKERS, Transition, instant
from .orphans import sweep

_KEY = ["id", "worker_type"]


def outcomes(workers: DataFrame, requests: DataFrame, after: float, now: datetime | str) -> DataFrame:
    """The workers table after requests (id, worker_type, storage_name, layers, lease_token), with each row's outcome.

    inserted, updated, rejected (another lease that isn't stale) or unchanged. A full outer join by the key.
    """
    r = requests.select(*_KEY, F.col("storage_name").alias("_storage"), F.col("layers").alias("_layers"), F.col("lease_token").alias("_lease"), F.lit(True).alias("_asked")).dropDuplicates(_KEY)
    both = workers.withColumn("_stored", F.lit(True)).join(r, _KEY, "full_outer")
    asked, stored = F.col("_asked").isNotNull(), F.col("_stored").isNotNull()
    free = lease_free(F.col("_lease"), now, after)
    outcome = F.when(~asked, "unchanged").when(~stored, "inserted").when(free, "updated").otherwise("rejected")
    take = outcome.isin("inserted", "updated")
    new = {
        "storage_name": F.when(take, F.col("_storage")).otherwise(F.col("storage_name")),
        "layers": F.when(take, F.col("_layers")).otherwise(F.col("layers")),
        "last_seen": F.when(take, instant(now)).otherwise(F.col("last_seen")),
        "started_at": F.when(stored, F.col("started_at")).otherwise(instant(now)),
        "lease_token": F.when(take, F.col("_lease")).otherwise(F.col("lease_token")),
    }
    return both.select(*_KEY, *[new[f.name].alias(f.name) for f in WORKERS if f.name in new], outcome.alias("outcome"))


def register(workers: DataFrame, requests: DataFrame, after: float, now: datetime | str) -> Transition:
    """The worker's own registration; raises AlreadyRegistered if another process holds a live lease."""
    rows = outcomes(workers, requests, after, now)
    if n := rows.where("outcome = 'rejected'").count():
        raise AlreadyRegistered(f"{n} workers are held by another lease")
    columns = [f.name for f in WORKERS]
    return Transition(rows.where("outcome in ('inserted', 'updated')").select(*columns), rows.select(*columns))


def admin_register(workers: DataFrame, requests: DataFrame, now: datetime | str) -> DataFrame:
    """Registration by an operator: never touches last_seen of a row or what a leased worker says of itself.

    Result: the table with the column outcome (inserted, updated, kept or unchanged).
    """
    r = requests.select(*_KEY, F.col("storage_name").alias("_storage"), F.col("layers").alias("_layers"), F.lit(True).alias("_asked")).dropDuplicates(_KEY)
    both = workers.withColumn("_stored", F.lit(True)).join(r, _KEY, "full_outer")
    asked, stored = F.col("_asked").isNotNull(), F.col("_stored").isNotNull()
    take = asked & (~stored | F.col("lease_token").isNull())
    outcome = F.when(~asked, "unchanged").when(~stored, "inserted").when(take, "updated").otherwise("kept")
    return both.select(
        *_KEY,
        F.when(take, F.col("_storage")).otherwise(F.col("storage_name")).alias("storage_name"),
        F.when(take, F.col("_layers")).otherwise(F.col("layers")).alias("layers"),
        F.when(stored, F.col("last_seen")).otherwise(instant(now)).alias("last_seen"),
        F.when(stored, F.col("started_at")).otherwise(instant(now)).alias("started_at"),
        "lease_token",
        outcome.alias("outcome"),
    )


def keep_alive(workers: DataFrame, beats: DataFrame, now: datetime | str) -> Transition:
    """Sets last_seen where id, worker_type and lease agree; a null lease never does."""
    b = beats.select(*_KEY, "lease_token").where("lease_token is not null").distinct().withColumn("_beat", F.lit(True))
    marked = workers.join(b, [*_KEY, "lease_token"], "left")
    after = marked.select(*[(F.when(F.col("_beat"), instant(now)).otherwise(F.col("last_seen")).alias("last_seen") if f.name == "last_seen" else F.col(f.name)) for f in WORKERS], F.coalesce("_beat", F.lit(False)).alias("_beat"))
    columns = [f.name for f in WORKERS]
    return Transition(after.where("_beat").select(*columns), after.select(*columns))


def beat(workers: DataFrame, worker: str, queue: str, lease: str | None, now: datetime | str) -> Transition:
    """One worker's heartbeat; raises WorkerNotRegistered if its row or lease is gone."""
    one = workers.sparkSession.createDataFrame([(worker, queue, lease)], "id string, worker_type string, lease_token string")
    done = keep_alive(workers, one, now)
    if done.affected.isEmpty():
        raise WorkerNotRegistered(f"worker {worker} of queue {queue} has no such lease")
    return done


def initial_heartbeat(jobs: DataFrame, workers: DataFrame, requests: DataFrame, after: float, now: datetime | str) -> tuple[Transition, Transition]:
    """The sweep first, then the registration, for one commit of both tables."""
    return sweep(jobs, workers, after, now), register(workers, requests, after, now)
