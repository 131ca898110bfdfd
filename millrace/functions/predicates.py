"""Predicates over jobs and workers as columns. All push down to Parquet where a literal meets a column."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ACTIVE, STATUSES, instant, seconds


def claimable() -> Column:
    return (F.col("status") == "Pending") | ((F.col("status") == "Failed") & (F.col("attempts") < F.col("max_attempts")))


def terminal() -> Column:
    return F.col("status").isin("Done", "Killed") | ((F.col("status") == "Failed") & (F.col("attempts") >= F.col("max_attempts")))


def is_active() -> Column:
    return F.col("status").isin(*ACTIVE)


def is_locked() -> Column:
    return F.col("lock_by").isNotNull() & F.col("status").isin("Running", "Queued")


def due(now: datetime | str) -> Column:
    return F.col("run_at") <= instant(now)


def in_queue(queue: str | None) -> Column:
    """The queue's rows; every row if no queue is given."""
    return F.lit(True) if queue is None else F.col("job_type") == queue


def has_status(status: str | None) -> Column:
    return F.col("status") == (status or "Pending")


def lockable(worker: str, now: datetime | str, queue: str | None = None) -> Column:
    mine = F.col("status").isin("Queued", "Running") & (F.col("lock_by") == worker)
    return due(now) & in_queue(queue) & (claimable() | mine)


def stale(now: datetime | str, after: float) -> Column:
    """Whether a worker was last seen ``after`` seconds ago or earlier."""
    return F.col("last_seen") <= instant(now) - seconds(after)


def lease_free(new_token: Column, now: datetime | str, after: float) -> Column:
    """Whether a worker's row may be taken: no lease, the same lease, or a stale row."""
    return F.col("lease_token").isNull() | F.coalesce(F.col("lease_token") == new_token, F.lit(False)) | stale(now, after)


def since(now: datetime | str, back: float) -> Column:
    """run_at within the last ``back`` seconds or in the future: the window has no upper bound."""
    return F.col("run_at") >= instant(now) - seconds(back)


def today(now: datetime | str) -> Column:
    return F.to_date("run_at") == F.to_date(instant(now))


def broken_rules() -> dict[str, Column]:
    """Each rule of the jobs table by name, as the condition under which a row breaks it."""
    return {
        "status": ~F.col("status").isin(*STATUSES),
        "attempts": F.col("attempts") < 0,
        "max_attempts": F.col("max_attempts") <= 0,
        "attempts_of_max": F.col("attempts") > F.col("max_attempts"),
        "priority": F.col("priority") < 0,
    }
