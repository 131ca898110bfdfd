"""New tasks from tables and streams: executors write them, the driver only says that a micro-batch is done.

Tasks lie in a folder for each micro-batch. A micro-batch that runs again, after a failure, writes its own folder anew and
sees the folders before it only, so each task is inserted once.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalars import new_ulid
from ..operators.enqueue import enqueue_dedup
from ..operators.notify import decoded, notify_batches
from ..schema import JOBS, instant
from .work import utc_now

_STORED = T.StructType([*JOBS.fields, T.StructField("batch", T.LongType())])


def tasks(rows: DataFrame, queue: str | Column, *args: str, now: datetime | str | None = None, **options: Column) -> DataFrame:
    """A batch of tasks made of ``rows``: their columns ``args`` (all, if none is named) as JSON are the arguments.

    ``options`` are columns for the fields of a batch: id (else new ULIDs), priority, max_attempts, run_at, metadata,
    idempotency_key. A stream whose micro-batches may run again needs an id or a key that comes from the row.
    """
    made = {"job_type": F.lit(queue) if isinstance(queue, str) else queue, "job": F.to_json(F.struct(*(args or rows.columns)), {"ignoreNullFields": "false"})}
    made["id"] = options.pop("id") if "id" in options else new_ulid(instant(now) if now is not None else F.current_timestamp())
    return rows.select(*[c.alias(n) for n, c in (made | options).items()])


class Inbox:
    """Inserted tasks below ``path``: a folder for each micro-batch, and the notifications of those that are due."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _stored(self) -> DataFrame:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/tasks")
        there = at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)
        return self.spark.read.schema(_STORED).parquet(f"{self.path}/tasks") if there else self.spark.createDataFrame([], _STORED)

    def read(self) -> DataFrame:
        """The tasks as jobs."""
        return self._stored().select(*JOBS.names)

    def insert(self, batch: DataFrame, number: int, now: datetime | str, known: DataFrame | None = None) -> DataFrame:
        """Inserts what conflicts with no key of ``known`` jobs, of the micro-batches before, or of the batch; returns it."""
        before = self._stored().where(F.col("batch") < number).select(*JOBS.names)
        rows = enqueue_dedup(before if known is None else known.select(*JOBS.names).unionByName(before), batch, now).affected
        at = f"{self.path}/tasks/batch={number}"
        rows.write.mode("overwrite").parquet(at)
        new = self.spark.read.schema(JOBS).parquet(at)
        told = notify_batches(new, now).select(F.col("payload").alias("value"), "job_type")
        told.write.mode("overwrite").partitionBy("job_type").text(f"{self.path}/notify/batch={number}")
        return new

    def listen(self, queue: str | None = None, files: int = 1000) -> DataFrame:
        """The notifications as a stream of files: job_type, ids; of one queue or all, so many files to a micro-batch.

        ``notifications`` has a source that opens some queues' files only.
        """
        lines = self.spark.readStream.schema("value string").option("maxFilesPerTrigger", files).text(f"{self.path}/notify")
        return decoded(lines.select(F.col("value").alias("payload")), queue)


def enqueue_stream(stream: DataFrame, inbox: Inbox, checkpoint: str, known: DataFrame | None = None, clock: Callable[[], datetime | str] = utc_now, available_now: bool = False) -> StreamingQuery:
    """A streaming query that inserts a stream of tasks (see ``tasks``); ``available_now`` ends when what is there is inserted."""

    def run(batch: DataFrame, number: int) -> None:
        inbox.insert(batch, number, clock(), known)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 second")).start()
