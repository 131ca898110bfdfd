"""A buffered sink of new tasks, and pushes of single ones."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..errors import SinkBufferFull
from ..functions.scalars import ulid
from ..operators.enqueue import enqueue
from ..schema import DEFAULT_MAX_ATTEMPTS, Config
from ..store import Store

BATCH = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("job_type", T.StringType()),
        T.StructField("job", T.StringType()),
        T.StructField("priority", T.IntegerType()),
        T.StructField("max_attempts", T.IntegerType()),
        T.StructField("run_at", T.TimestampNTZType()),
        T.StructField("metadata", T.StringType()),
        T.StructField("idempotency_key", T.StringType()),
    ]
)


def task(queue: str, args, **options) -> dict:
    """A task with its arguments as JSON; options are the fields of the batch, the id among them."""
    return {"id": ulid(), "priority": 0, "max_attempts": DEFAULT_MAX_ATTEMPTS, "run_at": None, "metadata": None, "idempotency_key": None} | options | {"job_type": queue, "job": json.dumps(args)}


def push_tasks(store: Store, tasks: list[dict], now: datetime | str, also: dict[str, DataFrame] | None = None) -> list[str]:
    """Inserts all tasks in one commit, or none (see ``enqueue``); returns their ids.

    ``also``: rows of the caller's own tables that are appended in the same commit, or not (an outbox).
    """
    if not tasks:
        return []
    batch = store.spark.createDataFrame([tuple(t[f.name] for f in BATCH) for t in tasks], BATCH)
    store.transact(lambda seen: {"jobs": enqueue(seen.jobs, batch, now).affected, "inserted": True, "also": also}, now)
    return [t["id"] for t in tasks]


def push(store: Store, queue: str, args, now: datetime | str, **options) -> str:
    return push_tasks(store, [task(queue, args, **options)], now)[0]


class Sink:
    """Collects tasks on the driver and inserts them by one commit a flush."""

    def __init__(self, store: Store, config: Config):
        self.store, self.config, self.buffer = store, config, []

    def ready(self) -> bool:
        return len(self.buffer) < self.config.capacity

    def send(self, args, **options) -> str:
        if not self.ready():
            raise SinkBufferFull(f"{len(self.buffer)} tasks wait for a flush")
        self.buffer.append(task(self.config.queue, args, **options))
        return self.buffer[-1]["id"]

    def flush(self, now: datetime | str) -> list[str]:
        """Inserts what is buffered. The buffer is empty afterwards, also if the insert fails."""
        tasks, self.buffer = self.buffer, []
        return push_tasks(self.store, tasks, now)

    close = flush

    def clone(self) -> Sink:
        """Another sink of the same queue; it starts empty."""
        return Sink(self.store, self.config)
