"""Jobs, workers and requests derived from an ``events`` table, so that both engines can make the same rows.

The event's number decides status, attempts, priority, keys and locks; its time is run_at. NOW lies within the events'
range, so that some tasks are delayed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import instant

NOW = "2024-01-30 12:00:00"
ORPHAN_SECONDS = 120


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def event_stream(spark: SparkSession, sf_dir: str, files: int | None = 8) -> DataFrame:
    """The events as a stream of their files, so many to a micro-batch, or all."""
    path = f"{sf_dir}/events.parquet"
    # a pattern, as a stream's own path must be a folder, and the table may be one file
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    rows = (reader if files is None else reader.option("maxFilesPerTrigger", files)).parquet(f"{path[:-1]}[t]")
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _text(c: Column) -> Column:
    return c.cast("string")


def _between(low: int, high: int) -> Column:
    return (F.col("event_id") % 20).between(low, high)


def jobs(e: DataFrame) -> DataFrame:
    i, most = F.col("event_id"), (1 + F.col("event_id") % 7)
    status = F.when(_between(0, 5), "Pending").when(_between(6, 7), "Queued").when(_between(8, 9), "Running").when(_between(10, 14), "Done").when(_between(15, 17), "Failed").otherwise("Killed")
    return e.select(
        F.col("props").alias("job"),
        F.lpad(_text(i), 26, "0").alias("id"),
        F.col("event_type").alias("job_type"),
        status.alias("status"),
        F.when(_between(0, 5), 0).when(_between(17, 19), most).otherwise((i % 11) % most).cast("int").alias("attempts"),
        most.cast("int").alias("max_attempts"),
        F.col("ts").alias("run_at"),
        F.when(_between(10, 14), F.concat(F.lit('{"Ok":'), _text(i), F.lit("}"))).when(_between(15, 19), F.lit('{"Err":"boom"}')).alias("last_result"),
        F.when(_between(6, 19), F.date_trunc("second", "ts").cast("timestamp_ntz")).alias("lock_at"),
        F.when(_between(6, 19), F.concat(F.lit("w-"), _text(F.col("user_id") % 8))).alias("lock_by"),
        F.when(_between(10, 19), F.col("ts") + F.make_dt_interval(secs=F.floor(F.col("value") * 60).cast("decimal(18,6)"))).alias("done_at"),
        (F.col("user_id") % 4).cast("int").alias("priority"),
        F.col("props").alias("metadata"),
        F.when(i % 3 == 0, F.concat(F.lit("k-"), _text(i))).alias("idempotency_key"),
    )


def workers(e: DataFrame) -> DataFrame:
    slot, now = F.col("user_id") % 8, instant(NOW)
    rows = e.select("user_id", "event_type").select(slot.alias("slot"), "event_type").distinct()
    slot = F.col("slot")
    rows = rows.select(
        F.concat(F.lit("w-"), _text(slot)).alias("id"),
        F.col("event_type").alias("worker_type"),
        F.lit("ParquetStore").alias("storage_name"),
        F.lit("").alias("layers"),
        (now - F.make_dt_interval(secs=(slot * 37).cast("decimal(18,6)"))).alias("last_seen"),
        (now - F.make_dt_interval(days=F.lit(30))).alias("started_at"),
        F.when(slot != 7, F.concat(F.lit("t-"), _text(slot))).alias("lease_token"),
    )
    idle = e.sparkSession.range(1).select(
        F.lit("w-idle").alias("id"), F.lit("idle-queue").alias("worker_type"), F.lit("ParquetStore").alias("storage_name"), F.lit("").alias("layers"), now.alias("last_seen"), F.lit(None).cast("timestamp_ntz").alias("started_at"), F.lit(None).cast("string").alias("lease_token")
    )
    return rows.unionByName(idle)


def enqueue_batch(e: DataFrame) -> DataFrame:
    i = F.col("event_id")
    key = F.when(i % 4 == 0, F.concat(F.lit("k-"), _text(i))).when(i % 4 == 1, F.concat(F.lit("b-"), _text(i % 90)))
    return e.select(
        F.lpad(F.concat(F.lit("n"), _text(i)), 26, "0").alias("id"),
        F.col("event_type").alias("job_type"),
        F.col("props").alias("job"),
        (1 + i % 7).cast("int").alias("max_attempts"),
        F.col("ts").alias("run_at"),
        (F.col("user_id") % 4).cast("int").alias("priority"),
        F.col("props").alias("metadata"),
        key.alias("idempotency_key"),
    )


def claim_requests(all_workers: DataFrame) -> DataFrame:
    """Three to six tasks for each worker of each queue."""
    return all_workers.select(F.col("id").alias("worker"), F.col("worker_type").alias("job_type"), (3 + F.ascii(F.right("id", F.lit(1))) % 4).alias("capacity"))


def acks(all_jobs: DataFrame) -> DataFrame:
    lease = F.when(F.col("lock_by") == "w-5", "wrong").when(F.col("lock_by") == "w-6", F.lit(None)).otherwise(F.concat(F.lit("t-"), F.right("lock_by", F.lit(1))))
    return all_jobs.where("status = 'Running'").select(
        F.col("id").alias("task_id"),
        F.col("job_type").alias("queue"),
        F.col("lock_by").alias("worker_id"),
        F.when(F.col("attempts") % 3 == 2, F.col("lock_at") - F.make_dt_interval(secs=F.lit(1).cast("decimal(18,6)"))).otherwise(F.col("lock_at")).alias("lock_at"),
        F.when(F.col("priority") == 3, F.col("attempts") + 1).otherwise(F.col("attempts")).cast("int").alias("started_attempts"),
        (F.col("max_attempts") > 3).alias("ok"),
        lease.alias("lease_token"),
    )


def acks_again(all_jobs: DataFrame) -> DataFrame:
    """``acks`` with a stale one besides each, and for every second task one more that says the opposite."""
    a = acks(all_jobs).withColumn("value", F.lit(None).cast("string"))
    early = a.withColumn("lock_at", F.col("lock_at") - F.make_dt_interval(hours=F.lit(1)))
    more = a.where("started_attempts % 2 = 0").withColumn("ok", ~F.col("ok"))
    return early.unionByName(a).unionByName(more)


def acks_seconds(all_jobs: DataFrame) -> DataFrame:
    """``acks`` with the lock's time in seconds since 1970."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), "lock_at")
    return acks(all_jobs).withColumn("lock_at", micros / F.lit(1e6))


def waits(all_jobs: DataFrame) -> DataFrame:
    """A wait for every task from its run_at on; every second one gives up ten minutes later."""
    until = F.when(F.col("id").cast("long") % 2 == 0, F.col("run_at") + F.make_dt_interval(mins=F.lit(10)))
    return all_jobs.select("id", F.col("run_at").alias("at"), until.alias("until"))


def beats(e: DataFrame) -> DataFrame:
    """Every event as a heartbeat of a worker in the event's queue."""
    return e.select(F.concat(F.lit("w-"), _text(F.col("user_id"))).alias("id"), F.col("event_type").alias("worker_type"), F.col("ts").alias("last_seen"))


def notify_payloads(e: DataFrame) -> DataFrame:
    i = F.col("event_id")
    head, key = F.concat(F.lit('{"job_type":"'), F.col("event_type"), F.lit('",')), F.lpad(_text(i), 26, "0")
    many = F.concat(head, F.lit('"ids":["'), key, F.lit('"]}'))
    one = F.concat(head, F.lit('"id":"'), key, F.lit('"}'))
    return e.select(F.when(i % 4 == 0, many).when(i % 4 == 1, one).when(i % 4 == 2, F.lit("")).otherwise(F.lit('{"job_type":')).alias("payload"))
