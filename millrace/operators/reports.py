"""Statistics: one aggregation over the jobs table each, unpivoted afterwards.

Every report prunes the scan to status, run_at, done_at, job_type (and lock_by, where it needs it); counts are combined
before the shuffle, so that what a queue of any size sends is a row for each task of the scan.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import claimable, is_active, due, in_queue, since, today
from ..functions.scalars import minutes_between, ratio
from ..schema import FINISHED, STATISTIC, instant

HOUR, DAY, WEEK = 3600, 86_400, 604_800
PAGE_SIZE = 8192

# Titles of statistics with type, priority in a queue's dashboard and priority in the metrics report.
CATALOGUE = (
    ("RUNNING_JOBS", "Number", 1, 1),
    ("PENDING_JOBS", "Number", 1, 1),
    ("FAILED_JOBS", "Number", 1, 2),
    ("ACTIVE_JOBS", "Number", 2, 2),
    ("STALE_RUNNING_JOBS", "Number", 2, 2),
    ("KILL_RATE", "Percentage", 2, 2),
    ("JOBS_PAST_HOUR", "Number", 3, 3),
    ("JOBS_TODAY", "Number", 3, 3),
    ("KILLED_JOBS_TODAY", "Number", 3, 3),
    ("AVG_JOBS_PER_MINUTE_PAST_HOUR", "Decimal", 3, 3),
    ("TOTAL_JOBS", "Number", 4, 4),
    ("DONE_JOBS", "Number", 4, 4),
    ("COMPLETED_JOBS", "Number", None, 4),
    ("KILLED_JOBS", "Number", 4, 4),
    ("SUCCESS_RATE", "Percentage", 4, 4),
    ("AVG_JOB_DURATION_MINS", "Decimal", 5, 5),
    ("LONGEST_RUNNING_JOB_MINS", "Decimal", 5, 5),
    ("QUEUE_BACKLOG", "Number", None, 5),
    ("JOBS_PAST_24_HOURS", "Number", None, 6),
    ("JOBS_PAST_7_DAYS", "Number", 6, 6),
    ("KILLED_JOBS_PAST_7_DAYS", "Number", None, 6),
    ("SUCCESS_RATE_PAST_24H", "Percentage", None, 6),
    ("AVG_JOBS_PER_HOUR_PAST_24H", "Decimal", None, 7),
    ("AVG_JOBS_PER_DAY_PAST_7D", "Decimal", None, 7),
    ("MOST_RECENT_JOB", "Timestamp", 8, 8),
    ("OLDEST_PENDING_JOB", "Timestamp", None, 8),
    ("PEAK_HOUR_JOBS", "Number", None, 8),
    ("DB_PAGE_SIZE", "Number", None, 9),
    ("DB_PAGE_COUNT", "Number", None, 9),
    ("DB_SIZE", "Number", None, 9),
)


def _is(status: str) -> Column:
    return F.col("status") == status


def measures(now: datetime | str) -> dict[str, Column]:
    """The statistics that one pass gives, by title; times as timestamps."""
    n = lambda condition: F.count_if(condition)
    total, hour, day, week = F.count(F.lit(1)), since(now, HOUR), since(now, DAY), since(now, WEEK)
    ended = F.col("status").isin(*FINISHED) & F.col("done_at").isNotNull()
    pending_due = _is("Pending") & due(now)
    return {
        "RUNNING_JOBS": n(_is("Running")),
        "PENDING_JOBS": n(_is("Pending")),
        "FAILED_JOBS": n(_is("Failed")),
        "ACTIVE_JOBS": n(is_active()),
        "STALE_RUNNING_JOBS": n(_is("Running") & ~hour),
        "KILL_RATE": ratio(n(_is("Killed")), total),
        "JOBS_PAST_HOUR": n(hour),
        "JOBS_TODAY": n(today(now)),
        "KILLED_JOBS_TODAY": n(_is("Killed") & today(now)),
        "AVG_JOBS_PER_MINUTE_PAST_HOUR": F.round(n(hour) / 60.0, 2),
        "TOTAL_JOBS": total,
        "DONE_JOBS": n(_is("Done")),
        "COMPLETED_JOBS": n(F.col("status").isin(*FINISHED)),
        "KILLED_JOBS": n(_is("Killed")),
        "SUCCESS_RATE": ratio(n(_is("Done")), total),
        "AVG_JOB_DURATION_MINS": F.round(F.avg(F.when(ended, minutes_between(F.col("run_at"), F.col("done_at")))), 2),
        "LONGEST_RUNNING_JOB_MINS": F.round(F.coalesce(F.max(F.when(_is("Running"), minutes_between(F.col("run_at"), instant(now)))), F.lit(0.0)), 2),
        "QUEUE_BACKLOG": n(pending_due),
        "JOBS_PAST_24_HOURS": n(day),
        "JOBS_PAST_7_DAYS": n(week),
        "KILLED_JOBS_PAST_7_DAYS": n(_is("Killed") & week),
        "SUCCESS_RATE_PAST_24H": ratio(n(_is("Done") & day), n(day)),
        "AVG_JOBS_PER_HOUR_PAST_24H": F.round(n(day) / 24.0, 2),
        "AVG_JOBS_PER_DAY_PAST_7D": F.round(n(week) / 7.0, 2),
        "PEAK_HOUR_JOBS": F.greatest(*[n(F.hour("run_at") == h) for h in range(24)]),
        "MOST_RECENT_JOB": F.max("run_at"),
        "OLDEST_PENDING_JOB": F.min(F.when(pending_due, F.col("run_at"))),
    }


def _epoch(at: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), at) / F.lit(1e6)


def peak_hour(jobs: DataFrame, queue: str | None = None) -> DataFrame:
    """PEAK_HOUR_JOBS: the most jobs of any hour of the day, over all days; 0 without jobs."""
    hours = jobs.where(in_queue(queue)).groupBy(F.hour("run_at").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return hours.agg(F.coalesce(F.max("n"), F.lit(0)).alias("PEAK_HOUR_JOBS"))


def metrics(jobs: DataFrame, now: datetime | str, queue: str | None = None, as_real: bool = False) -> DataFrame:
    """title, stat_type, value (double; 0 where there is none), priority: the 27 statistics of all queues or one.

    Times are seconds since 1970. ``as_real`` rounds values to single precision. An empty queue has all rows, too.
    """
    rows = jobs.where(in_queue(queue))
    wide = rows.agg(*[m.alias(k) for k, m in measures(now).items()])
    listed = [(t, kind, p) for t, kind, _, p in CATALOGUE if not t.startswith("DB_")]
    value = lambda t, kind: (_epoch(F.col(t)) if kind == "Timestamp" else F.col(t)).cast("double")
    stats = F.array(*[F.struct(F.lit(t).alias("title"), F.lit(kind).alias("stat_type"), F.coalesce(value(t, kind), F.lit(0.0)).alias("value"), F.lit(p).alias("priority")) for t, kind, p in listed])
    out = wide.select(F.inline(stats))
    return out.withColumn("value", F.col("value").cast("float").cast("double")) if as_real else out


def storage_statistics(jobs: DataFrame) -> DataFrame:
    """DB_PAGE_SIZE, DB_PAGE_COUNT and DB_SIZE of the files that hold ``jobs``, as metrics rows.

    The scan tells each row's file and its size, and reads no column for that; every file counts once. Where several
    tables are joined to ``jobs``, so that no row has one file, the files are listed instead.
    """
    size = F.coalesce(F.sum("size"), F.lit(0))
    try:
        files = jobs.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).distinct()
    except AnalysisException as e:
        if e.getCondition() is None or not e.getCondition().startswith("UNRESOLVED_COLUMN"):
            raise
        files = _listed(jobs)
    wide = files.agg(size.cast("double").alias("DB_SIZE")).select(F.lit(float(PAGE_SIZE)).alias("DB_PAGE_SIZE"), F.ceil(F.col("DB_SIZE") / PAGE_SIZE).cast("double").alias("DB_PAGE_COUNT"), "DB_SIZE")
    listed = [(t, kind, p) for t, kind, _, p in CATALOGUE if t.startswith("DB_")]
    return wide.select(F.inline(F.array(*[F.struct(F.lit(t).alias("title"), F.lit(kind).alias("stat_type"), F.col(t).alias("value"), F.lit(p).alias("priority")) for t, kind, p in listed])))


def _listed(jobs: DataFrame) -> DataFrame:
    spark = jobs.sparkSession
    conf, files, size = spark._jsc.hadoopConfiguration(), set(jobs.inputFiles()), 0
    for folder in sorted({name.rsplit("/", 1)[0] for name in files}):  # one call a folder
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        size += sum(s.getLen() for s in at.getFileSystem(conf).listStatus(at) if s.getPath().toUri().toString() in files)
    return spark.range(1).select(F.lit(size).alias("size"))


def report(jobs: DataFrame, now: datetime | str, queue: str | None = None) -> DataFrame:
    """The whole metrics report of 30 rows, values as text, by priority and title."""
    rows = metrics(jobs, now, queue).unionByName(storage_statistics(jobs))
    whole = F.col("stat_type") == "Number"
    text = F.when(whole, F.col("value").cast("long").cast("string")).otherwise(F.col("value").cast("string"))
    return rows.select("title", "stat_type", text.alias("value"), "priority").orderBy("priority", "title")


def queue_rollup(jobs: DataFrame, now: datetime | str) -> DataFrame:
    """A row for each queue with jobs: job_type and every statistic of the dashboard in a column of its own."""
    found = measures(now)
    return jobs.groupBy("job_type").agg(*[found[t].alias(t) for t, _, lq, _ in CATALOGUE if lq is not None])


def _as_text(title: str, kind: str) -> Column:
    return F.col(title).cast("string")


def queue_statistics(jobs: DataFrame, now: datetime | str) -> DataFrame:
    """job_type, title, stat_type, value (text; null where there is none), priority: 18 rows for each queue."""
    listed = [(t, kind, lq) for t, kind, lq, _ in CATALOGUE if lq is not None]
    stats = F.array(*[F.struct(F.lit(t).alias("title"), F.lit(kind).alias("stat_type"), _as_text(t, kind).alias("value"), F.lit(p).alias("priority")) for t, kind, p in listed])
    return queue_rollup(jobs, now).select("job_type", F.inline(stats))


def queue_names(jobs: DataFrame, workers: DataFrame) -> DataFrame:
    """Every queue that has a job or a worker."""
    return jobs.select("job_type").distinct().union(workers.select(F.col("worker_type").alias("job_type")).distinct()).distinct()


def locked_workers(jobs: DataFrame) -> DataFrame:
    """job_type, workers: the ordered ids of those that hold active tasks."""
    pairs = jobs.where(is_active() & F.col("lock_by").isNotNull()).select("job_type", "lock_by").distinct()
    return pairs.groupBy("job_type").agg(F.array_sort(F.collect_list("lock_by")).alias("workers"))


def daily_activity(jobs: DataFrame, now: datetime | str) -> DataFrame:
    """job_type, activity: jobs of each day with any in the last week, in the days' order."""
    days = jobs.where(since(now, WEEK)).groupBy("job_type", F.to_date("run_at").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.groupBy("job_type").agg(F.transform(F.array_sort(F.collect_list(F.struct("day", "n"))), lambda x: x["n"]).alias("activity"))


def queue_details(jobs: DataFrame, now: datetime | str) -> DataFrame:
    """job_type, workers and activity, as ``locked_workers`` and ``daily_activity`` tell them, from one pass."""
    week = F.when(since(now, WEEK), F.to_date("run_at")).alias("day")
    days = jobs.groupBy("job_type", week).agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.when(is_active(), F.col("lock_by"))).alias("locked"))
    counts = F.array_sort(F.collect_list(F.when(F.col("day").isNotNull(), F.struct("day", "n"))))
    return days.groupBy("job_type").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("locked")))).alias("workers"), F.transform(counts, lambda x: x["n"]).alias("activity"))


def list_queues(jobs: DataFrame, workers: DataFrame, now: datetime | str) -> DataFrame:
    """name, stats, workers, activity of every queue, by name; what a queue lacks is an empty array.

    Two passes over the jobs: one for the statistics, one for what is listed by day and worker. The sides have a row
    for each queue, so that the joins are small whatever the jobs' number.
    """
    listed = sorted(((t, kind, lq) for t, kind, lq, _ in CATALOGUE if lq is not None), key=lambda x: x[2])
    stats = F.array(*[F.struct(F.lit(t).alias("title"), F.lit(kind).alias("stat_type"), _as_text(t, kind).alias("value"), F.lit(p).alias("priority")) for t, kind, p in listed])
    known = queue_rollup(jobs, now).select("job_type", stats.alias("stats")).join(queue_details(jobs, now), "job_type")
    out = known.join(workers.select(F.col("worker_type").alias("job_type")).distinct(), "job_type", "full_outer")
    empty = lambda kind: F.array().cast(f"array<{kind}>")
    return out.select(
        F.col("job_type").alias("name"),
        F.coalesce("stats", empty(STATISTIC.simpleString())).alias("stats"),
        F.coalesce("workers", empty("string")).alias("workers"),
        F.coalesce("activity", empty("bigint")).alias("activity"),
    ).orderBy("name")


def snapshot(jobs: DataFrame, now: datetime | str) -> DataFrame:
    """A row for each queue: counts by state and window, latest times, and when it was taken."""
    n = lambda condition: F.count_if(condition)
    return jobs.groupBy("job_type").agg(
        F.count(F.lit(1)).alias("total_jobs"),
        n(_is("Pending")).alias("pending_jobs"),
        n(_is("Queued")).alias("queued_jobs"),
        n(_is("Running")).alias("running_jobs"),
        n(_is("Done")).alias("done_jobs"),
        n(_is("Failed")).alias("failed_jobs"),
        n(_is("Killed")).alias("killed_jobs"),
        n(is_active()).alias("active_jobs"),
        n(since(now, HOUR)).alias("jobs_past_hour"),
        n(since(now, DAY)).alias("jobs_past_day"),
        n(since(now, WEEK)).alias("jobs_past_7_days"),
        F.max("run_at").alias("most_recent_run_at"),
        F.max("done_at").alias("most_recent_done_at"),
        F.first(instant(now)).alias("snapshot_at"),
    )


def claimable_count(jobs: DataFrame, now: datetime | str) -> DataFrame:
    """job_type and how many tasks a worker could claim now."""
    return jobs.where(claimable() & due(now)).groupBy("job_type").agg(F.count(F.lit(1)).alias("claimable"))
