"""Insert notifications: payloads for new due tasks, and their decoding."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import due
from ..schema import INSERT_EVENT
from .ranks import numbered

CHUNK = 100
#: Ids that one event may carry; later ones are left to the poll.
MOST_IDS = 65_536


def notify_chunks(new_jobs: DataFrame, now: datetime | str, size: int = CHUNK) -> DataFrame:
    """job_type, chunk, ids (ordered): the due ones of newly inserted jobs, so many consecutive ids to a chunk.

    Ids are numbered by ranges of (job_type, id) and prefix sums, so that no task sees a whole queue; then each chunk's
    few ids meet.
    """
    rows = numbered(new_jobs.where(due(now)).select("job_type", "id"), [F.col("id")], ["job_type"])
    return rows.groupBy("job_type", F.expr(f"nth div {int(size)}").alias("chunk")).agg(F.array_sort(F.collect_list("id")).alias("ids"))


def notify_batches(new_jobs: DataFrame, now: datetime | str, size: int = CHUNK) -> DataFrame:
    """job_type and payload {"job_type", "ids"} of each chunk; nothing if no new job is due."""
    return notify_chunks(new_jobs, now, size).select("job_type", F.to_json(F.struct("job_type", "ids")).alias("payload"))


def notify_each(new_jobs: DataFrame) -> DataFrame:
    """The older form: a payload {"job_type", "id", "run_at"} for each new job, due or not."""
    return new_jobs.select("job_type", F.to_json(F.struct("job_type", "id", "run_at")).alias("payload"))


def decoded(payloads: DataFrame, queue: str | None = None) -> DataFrame:
    """job_type and ids of payloads (column payload) of either form; what can't be read, or is another queue's, goes."""
    event = F.from_json("payload", INSERT_EVENT, {"mode": "PERMISSIVE"})
    sound = F.try_parse_json(F.col("payload")).isNotNull()
    out = payloads.where(sound).select(event.alias("e")).where("e.job_type is not null")
    ids = F.coalesce("e.ids", F.when(F.col("e.id").isNotNull(), F.array("e.id")), F.array().cast("array<string>"))
    out = out.select(F.col("e.job_type").alias("job_type"), F.slice(ids, 1, MOST_IDS).alias("ids"))
    return out if queue is None else out.where(F.col("job_type") == queue)
