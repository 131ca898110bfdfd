"""The queues' snapshot kept up to date from changed rows alone.

The state are mergeable sums: tasks by queue, status and minute of run_at (*cells*), and the newest values of run_at and
done_at of each queue with how often they are there (*marks*). A transition's rows count with a minus as they were and with
a plus as they are; sums that are zero go. Of a queue's values only the newest KEEP stand by themselves, older ones are
a number; should all of the newest be taken back, that queue, and no other, is read again.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import InvalidArgument
from ..schema import ACTIVE, STATUSES, instant
from ..sources.folders import small, written
from .reports import DAY, HOUR, WEEK, snapshot

#: Values of a queue's run_at and done_at each that stand by themselves.
KEEP = 500
_CELL, _MARK = ["job_type", "status", "minute"], ["job_type", "kind", "at"]


def _cells(jobs: DataFrame, sign: int = 1) -> DataFrame:
    return jobs.groupBy("job_type", "status", F.date_trunc("minute", "run_at").cast("timestamp_ntz").alias("minute")).agg((F.count(F.lit(1)) * sign).alias("n"))


def _marks(jobs: DataFrame, sign: int = 1) -> DataFrame:
    both = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("at")) for kind in ("run_at", "done_at")])
    values = jobs.select("job_type", F.inline(both)).where("at is not null")
    return values.groupBy(*_MARK).agg((F.count(F.lit(1)) * sign).alias("n"))


def _summed(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.sum("n").alias("n")).where("n <> 0")


def _trimmed(marks: DataFrame, keep: int) -> DataFrame:
    """The newest ``keep`` values of each queue and kind; the others' number under the value null.

    The newest ones are found by a group limit, before rows move; the others are a difference of sums.
    """
    marks = written(marks, "all-marks")
    place = F.row_number().over(Window.partitionBy("job_type", "kind").orderBy(F.col("at").desc()))
    kept = written(marks.where("at is not null").withColumn("place", place).where(F.col("place") <= keep).drop("place"), "kept-marks")
    older = marks.unionByName(kept.withColumn("n", -F.col("n"))).groupBy("job_type", "kind").agg(F.sum("n").alias("n")).where("n <> 0")
    return kept.unionByName(older.select("job_type", "kind", F.lit(None).cast("timestamp_ntz").alias("at"), "n"))


@dataclass(frozen=True)
class SnapshotState:
    """cells: job_type, status, minute, n. marks: job_type, kind, at (null: older values), n."""

    cells: DataFrame
    marks: DataFrame
    keep: int = KEEP

    @classmethod
    def of(cls, jobs: DataFrame, keep: int = KEEP) -> SnapshotState:
        """The state of a whole table."""
        return cls(written(_cells(jobs), "cells"), written(_trimmed(_marks(jobs), keep), "marks"), keep)

    def applied(self, old: DataFrame, new: DataFrame) -> SnapshotState:
        """The state after a transition: ``old`` are the changed jobs as they were (none of an insert), ``new`` as they are."""
        cells = _summed(self.cells.unionByName(_cells(new)).unionByName(_cells(old, -1)), _CELL)
        floors = self.marks.groupBy("job_type", "kind").agg(F.min("at").alias("floor"), F.sum(F.when(F.col("at").isNull(), F.col("n"))).alias("older"))
        floors = small(written(floors.where("older > 0"), "floors"))
        changes = _summed(_marks(new).unionByName(_marks(old, -1)), _MARK).join(floors, ["job_type", "kind"], "left")
        below = F.col("older").isNotNull() & (F.col("floor").isNull() | (F.col("at") < F.col("floor")))
        changes = changes.select("job_type", "kind", F.when(~below, F.col("at")).alias("at"), "n")
        return SnapshotState(written(cells, "cells"), written(_trimmed(_summed(self.marks.unionByName(changes), _MARK), self.keep), "marks"), self.keep)

    def report(self, now: datetime | str, jobs: DataFrame) -> DataFrame:
        """What ``reports.snapshot(jobs, now)`` gives, for a ``now`` of a whole minute. ``jobs`` is read for queues
        whose newest values are all gone, by their names, and not otherwise."""
        if str(now)[16:].strip(":0."):
            raise InvalidArgument("windows are made of whole minutes; give a whole minute")
        n, at = F.col("n"), instant(now)
        since = lambda back: F.coalesce(F.sum(F.when(F.col("minute") >= at - F.make_dt_interval(secs=F.lit(back).cast("decimal(18,6)")), n)), F.lit(0))
        of = lambda *statuses: F.coalesce(F.sum(F.when(F.col("status").isin(*statuses), n)), F.lit(0))
        counts = self.cells.groupBy("job_type").agg(
            F.sum("n").alias("total_jobs"), *[of(s).alias(f"{s.lower()}_jobs") for s in STATUSES], of(*ACTIVE).alias("active_jobs"), since(HOUR).alias("jobs_past_hour"), since(DAY).alias("jobs_past_day"), since(WEEK).alias("jobs_past_7_days")
        )
        newest = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("at")))
        lost = lambda kind: F.coalesce(F.bool_or((F.col("kind") == kind) & F.col("at").isNull()), F.lit(False)) & newest(kind).isNull()
        marks = written(self.marks.groupBy("job_type").agg(newest("run_at").alias("most_recent_run_at"), newest("done_at").alias("most_recent_done_at"), (lost("run_at") | lost("done_at")).alias("again")), "newest")
        known = counts.join(marks.where("not again").drop("again"), "job_type").withColumn("snapshot_at", at)
        again = marks.where("again").select("job_type")
        if again.isEmpty():
            return known
        return known.unionByName(snapshot(jobs.join(small(again), "job_type", "left_semi"), now).select(*known.columns))
