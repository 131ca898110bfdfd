"""Paged listings, point lookups and finished tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import MissingField
from ..functions.predicates import terminal, has_status, in_queue
from ..functions.scalars import epoch_seconds
from ..schema import JOBS, Filter
from ..sources.folders import BROADCAST_ROWS
from .ranks import Pages


def _order():
    """Unfinished tasks first, then the latest; the id decides ties."""
    return (F.col("done_at").desc_nulls_first(), F.col("run_at").desc(), F.col("id").asc())


def fetch_by_id(jobs: DataFrame, queue: str, task_id: str) -> DataFrame:
    """The task of this id in this queue: one row or none."""
    return jobs.where((F.col("id") == task_id) & in_queue(queue)).limit(1)


def list_tasks(jobs: DataFrame, queue: str, page: Filter) -> DataFrame:
    return list_all_tasks(jobs.where(in_queue(queue)), page)


def list_all_tasks(jobs: DataFrame, page: Filter) -> DataFrame:
    """A page of the tasks with the filter's status; offset and limit make a top-k of the plan."""
    at = page.offset
    return jobs.where(has_status(page.status)).orderBy(*_order()).offset(at).limit(page.limit)


def pages(jobs: DataFrame, status: str | None = None, queue: str | None = None) -> Pages:
    """The listing of a status as stored pages of (done_at, run_at, id): the way to late pages, and to many.

    A page by ``list_all_tasks`` is a top-k that gathers all rows before it; here it reads the partition that holds it.
    """
    return Pages(jobs.where(has_status(status) & in_queue(queue)).select("done_at", "run_at", "id"), _order())


def list_from(jobs: DataFrame, stored: Pages, page: Filter) -> DataFrame:
    """The page's tasks, from a listing made by ``pages`` of the same jobs and status."""
    ids = stored.page(page.offset, page.limit).select("id")
    rows = jobs.where(has_status(page.status)).join(F.broadcast(ids) if page.limit <= BROADCAST_ROWS else ids, "id", "left_semi")
    return rows.select(*[f.name for f in JOBS]).orderBy(*_order())


def running_workers(workers: DataFrame, queue: str | None = None) -> DataFrame:
    """id, queue, backend, started_at, last_heartbeat (seconds since 1970), layers; the latest heartbeat first."""
    rows = workers if queue is None else workers.where(F.col("worker_type") == queue)
    return rows.orderBy(F.col("last_seen").desc(), "id", "worker_type").select(
        "id",
        F.col("worker_type").alias("queue"),
        F.col("storage_name").alias("backend"),
        epoch_seconds(F.col("started_at")).alias("started_at"),
        epoch_seconds(F.col("last_seen")).alias("last_heartbeat"),
        "layers",
    )


def check_status(jobs: DataFrame, ids: DataFrame) -> DataFrame:
    """id, status, result of those of the given ids, in any queue, that have come to their end."""
    ended = jobs.where(terminal()).join(ids.toDF("id").distinct(), "id", "left_semi")
    return ended.select("id", "status", F.col("last_result").alias("result"))


def remaining(jobs: DataFrame, ids: DataFrame) -> DataFrame:
    """Those of the given ids that haven't ended, or aren't there."""
    return ids.toDF("id").distinct().join(jobs.where(terminal()).select("id"), "id", "left_anti")


def results(ended: DataFrame) -> list[dict]:
    """The rows of ``check_status`` as records; raises MissingField for a row without a result."""
    out = []
    for r in ended.toLocalIterator():
        if r["result"] is None:
            raise MissingField(f"task {r['id']} has no result")
        out.append(r.asDict())
    return out
