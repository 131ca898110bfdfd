"""The two tables of a job queue, their states and the records built from them.

Timestamps have no zone and mean UTC. ``now`` is always an argument: a transition sees one instant.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .errors import InvalidArgument

STATUSES = ("Pending", "Queued", "Running", "Done", "Failed", "Killed")
ACTIVE = ("Pending", "Queued", "Running")
FINISHED = ("Done", "Failed", "Killed")
DEFAULT_MAX_ATTEMPTS = 25
#: Bytes that a queue's name, a task's metadata, a key and an error's text may have.
QUEUE_BYTES, METADATA_BYTES, KEY_BYTES, ERROR_BYTES = 255, 8192, 1024, 8192

JOBS = T.StructType(
    [
        T.StructField("job", T.StringType()),
        T.StructField("id", T.StringType(), False),
        T.StructField("job_type", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("attempts", T.IntegerType(), False),
        T.StructField("max_attempts", T.IntegerType(), False),
        T.StructField("run_at", T.TimestampNTZType(), False),
        T.StructField("last_result", T.StringType()),
        T.StructField("lock_at", T.TimestampNTZType()),
        T.StructField("lock_by", T.StringType()),
        T.StructField("done_at", T.TimestampNTZType()),
        T.StructField("priority", T.IntegerType(), False),
        T.StructField("metadata", T.StringType()),
        T.StructField("idempotency_key", T.StringType()),
    ]
)
WORKERS = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("worker_type", T.StringType(), False),
        T.StructField("storage_name", T.StringType(), False),
        T.StructField("layers", T.StringType(), False),
        T.StructField("last_seen", T.TimestampNTZType(), False),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("lease_token", T.StringType()),
    ]
)
INSERT_EVENT = T.StructType([T.StructField("job_type", T.StringType()), T.StructField("id", T.StringType()), T.StructField("ids", T.ArrayType(T.StringType()))])
STATISTIC = T.StructType([T.StructField("title", T.StringType()), T.StructField("stat_type", T.StringType()), T.StructField("value", T.StringType()), T.StructField("priority", T.IntegerType())])


@dataclass(frozen=True)
class Config:
    """Settings of one queue's storage."""

    queue: str
    buffer_size: int = 10
    keep_alive: float = 30.0
    reenqueue_orphaned_after: float = 300.0
    poll_interval: float = 0.1
    ack: bool = True

    @property
    def capacity(self) -> int:
        return max(self.buffer_size, 1)


@dataclass(frozen=True)
class Filter:
    """A page of a listing: status (Pending unless given), page from 1, rows a page."""

    status: str | None = None
    page: int = 1
    page_size: int | None = None

    @property
    def limit(self) -> int:
        return 10 if self.page_size is None else self.page_size

    @property
    def offset(self) -> int:
        if self.page < 1:
            raise InvalidArgument("pages are numbered from 1")
        at = (self.page - 1) * self.limit
        if at >= 1 << 32 or not 0 <= self.limit < 1 << 32:
            raise InvalidArgument("the page lies beyond the largest offset")
        return at


@dataclass(frozen=True)
class Transition:
    """What a transition changed (rows in their new form) and the whole table after it."""

    affected: DataFrame
    after: DataFrame
    details: dict = field(default_factory=dict)


def instant(now: datetime | str) -> Column:
    """A timestamp literal without zone."""
    text = now if isinstance(now, str) else now.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(text).cast("timestamp_ntz")


def seconds(n: float) -> Column:
    return F.make_dt_interval(secs=F.lit(float(n)).cast("decimal(18,6)"))


def to_second(at: Column) -> Column:
    return F.date_trunc("second", at).cast("timestamp_ntz")


def null_of(kind: str) -> Column:
    return F.lit(None).cast(kind)


def jobs_of(df: DataFrame) -> DataFrame:
    """``df`` with the columns of the jobs table in order, and counts below zero set to zero."""
    out = df.select(*[F.col(f.name).cast(f.dataType) for f in JOBS])
    return out.withColumns({c: F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(0)) for c in ("attempts", "max_attempts", "priority")})
