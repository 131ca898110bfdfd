"""Heartbeats, sweeps and waiting for tasks to end."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame

from ..errors import StorageError
from ..operators.listing import check_status
from ..operators.orphans import sweep
from ..operators.workers import beat
from ..schema import Config
from ..store import Store
from .work import utc_now

#: Seconds between looks at waited-for tasks: first, and at most; failures in a row that end the wait.
FIRST_PAUSE, LONGEST_PAUSE, FAILURES = 0.1, 2.0, 3


def keep_alive(store: Store, config: Config, worker: str, lease: str, now: datetime | None = None) -> None:
    now = now or utc_now()
    store.transact(lambda seen: {"workers": beat(seen.workers, worker, config.queue, lease, now).affected}, now)


def sweep_orphans(store: Store, config: Config, now: datetime | None = None) -> int:
    """Takes back the tasks of lost workers; returns how many."""
    now = now or utc_now()
    count = {}

    def change(seen):
        rows = sweep(seen.jobs, seen.workers, config.reenqueue_orphaned_after, now).affected
        count["n"] = rows.count()
        return {"jobs": rows if count["n"] else None}

    store.transact(change, now)
    return count["n"]


def heartbeat(store: Store, config: Config, worker: str, lease: str, beats: int | None = None, pause: Callable[[float], None] = time.sleep) -> Iterator[int]:
    """A heartbeat and a sweep every ``keep_alive`` seconds; gives the number of tasks taken back each time."""
    k = 0
    while beats is None or k < beats:
        keep_alive(store, config, worker, lease)
        yield sweep_orphans(store, config)
        k += 1
        pause(config.keep_alive)


def wait_for(store: Store, ids: DataFrame, pause: Callable[[float], None] = time.sleep) -> Iterator[DataFrame]:
    """Tables (id, status, result) of the given tasks as they end, until all have.

    The pause doubles while nothing ends, or looking fails, and starts anew when something ends. The third failure in a
    row is raised. What is told, and the ids that are left, are kept in the store's folder.
    """
    left, wait, failures = store.put("waits", ids.toDF("id")), FIRST_PAUSE, 0
    while True:
        try:
            jobs = store.read().jobs
            ended = store.put("waits", check_status(jobs, left))
            found = not ended.isEmpty()
            if found:
                left = store.put("waits", left.join(ended.select("id"), "id", "left_anti"))
            over = left.isEmpty()
        except (PySparkException, StorageError):
            failures += 1
            if failures >= FAILURES:
                raise
            pause(wait)
            wait = min(wait * 2, LONGEST_PAUSE)
            continue
        failures = 0
        if found:
            yield ended
            wait = FIRST_PAUSE
        if over:
            return
        pause(wait)
        wait = min(wait * 2, LONGEST_PAUSE)
