"""The snapshot from changed rows equals the recomputed one after any sequence of transitions."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.errors import InvalidArgument
from millrace.operators import incremental, reports
from millrace.schema import JOBS, jobs_of
from millrace.sources import derived as D
from millrace.sources.folders import written

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect())


@pytest.mark.parametrize("keep", [500, 3])
def test_random_transitions(spark, keep):
    """Claims, ends, deletions' opposites (inserts), times that go back; also where few of the newest values are kept."""
    r = random.Random(keep)
    jobs = written(jobs_of(D.jobs(D.events(spark, SF))), "jobs")
    state = incremental.SnapshotState.of(jobs, keep)
    for step in range(4):
        chance = F.xxhash64("id", F.lit(step)) % r.choice([3, 7, 40])
        newest = F.col("run_at") >= F.lit("2024-01-30 00:00:00").cast("timestamp_ntz") if step % 2 else F.lit(False)
        old = written(jobs.where((chance == 0) | newest), "old")
        i = F.xxhash64("id", F.lit("new"), F.lit(step))
        moved = {
            "status": F.element_at(F.array(*[F.lit(s) for s in ("Pending", "Queued", "Running", "Done", "Failed", "Killed")]), (F.pmod(i, F.lit(6)) + 1).cast("int")),
            "done_at": F.when(i % 3 == 0, None).otherwise(F.col("run_at") + F.make_dt_interval(mins=F.pmod(i, F.lit(100)).cast("int"))),
            "run_at": F.when(i % 5 == 0, F.col("run_at") - F.make_dt_interval(days=F.lit(3))).otherwise(F.col("run_at")),
        }
        new = old.withColumns(moved)
        if step == 2:
            new = new.unionByName(old.limit(5).withColumns({"id": F.concat(F.lit("n"), "id"), "job_type": F.lit("fresh")}))
        new = written(jobs_of(new), "new")
        jobs = written(jobs.join(old.select("id"), "id", "left_anti").select(*JOBS.names).unionByName(new), "jobs")
        state = state.applied(old, new)
        assert state.marks.where("at is not null").groupBy("job_type", "kind").count().where(f"count > {keep}").isEmpty()
        assert rows(state.report(D.NOW, jobs)) == rows(reports.snapshot(jobs, D.NOW))


def test_reads_changed_rows_only(spark):
    """With a state, the report's plan doesn't read the jobs."""
    jobs = D.jobs(D.events(spark, SF))
    state = incremental.SnapshotState.of(jobs)
    old = jobs.where("status = 'Running'")
    after = state.applied(old, old.withColumn("status", F.lit("Done")))
    text = after.report(D.NOW, jobs)._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in text
    assert after.report(D.NOW, jobs).where("running_jobs > 0").isEmpty()
    with pytest.raises(InvalidArgument):
        state.report("2024-01-30 12:00:01", jobs)
