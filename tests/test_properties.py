"""Random sequences of transitions: what must hold after each, and a small model of claims and acknowledgements."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.functions.scalars import clamp_i32, i32_from_u32, timestamp_of
from millrace.operators import ack, checks, claim, enqueue, orphans
from millrace.schema import JOBS, STATUSES
from millrace.sources.tables import JsonCodec, from_arrays, read_jobs, read_workers, write_jobs, zipped
from millrace.operators.listing import results
from millrace.errors import DecodeError, InvalidArgument, MissingField

from .test_transitions import jobs_table, workers_table

NOW = "2024-05-01 12:00:00"
NAMES = [f.name for f in JOBS]


def frozen(spark, df):
    """The table as plain rows again, so that plans stay small."""
    return spark.createDataFrame(df.collect(), df.schema)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_sequences_keep_the_rules(spark, seed):
    r = random.Random(seed)
    workers = workers_table(spark, {"id": "a", "lease_token": "ta"}, {"id": "b", "last_seen": "2024-05-01 11:00:00"})
    jobs = jobs_table(spark, *[{"id": f"j{k}", "priority": r.randint(0, 3), "max_attempts": r.randint(1, 3), "run_at": f"2024-05-01 11:{r.randint(0, 59):02}:00"} for k in range(12)])
    for step in range(8):
        before = {x.id: x for x in jobs.select(*NAMES).collect()}
        kind = r.choice(["claim", "ack", "sweep", "push"])
        if kind == "claim":
            limit = r.randint(1, 4)
            done = claim.claim(jobs, "q", r.choice("ab"), limit, NOW)
            free = [x for x in before.values() if x.status == "Pending" or (x.status == "Failed" and x.attempts < x.max_attempts)]
            want = [x.id for x in sorted(free, key=lambda x: (-x.priority, x.run_at, x.id))][:limit]
            assert sorted(x.id for x in done.affected.collect()) == sorted(want)
        elif kind == "ack":
            running = [x for x in before.values() if x.status == "Running"]
            rows = [(x.id, "q", x.lock_by, x.lock_at, x.attempts + late, r.random() < 0.5, None) for x in running for late in r.choice([(0,), (1,), (1, 0), (0, 1)])]
            acks = spark.createDataFrame(rows, "task_id string, queue string, worker_id string, lock_at timestamp_ntz, started_attempts int, ok boolean, lease_token string")
            done = ack.ack_batch(jobs, workers, acks, NOW)
            fit = {x[0]: x[5] for x in rows if x[4] == before[x[0]].attempts}
            assert {x.id: x.status == "Done" for x in done.affected.collect()} == fit
            assert ack.stale_acks(jobs, workers, acks).count() == len(rows) - len(fit)
        elif kind == "sweep":
            done = orphans.sweep(jobs, workers, 60, NOW)
            assert {x.id for x in done.affected.collect()} == {x.id for x in before.values() if x.lock_by == "b" and x.status in ("Running", "Queued")}
        else:
            batch = spark.createDataFrame([(f"s{step}-{k}", "q", "{}", f"k{r.randint(0, 3)}") for k in range(3)], "id string, job_type string, job string, idempotency_key string")
            done = enqueue.enqueue_dedup(jobs, batch, NOW)
            stored = {x.idempotency_key for x in before.values()}
            assert {x.idempotency_key for x in done.affected.collect()} == {x.idempotency_key for x in batch.collect()} - stored
        jobs = frozen(spark, done.after)
        after = {x.id: x for x in jobs.select(*NAMES).collect()}
        assert set(before) <= set(after) and jobs.count() == len(after)
        changed = {x.id for x in done.affected.collect()}
        assert all(after[i] == before[i] for i in set(before) - changed)
        assert checks.constraint_violations(jobs).isEmpty() and checks.unique_violations(jobs).isEmpty()
        assert all(x.status in STATUSES and (x.status != "Running" or x.lock_by) for x in after.values())


def test_acks_of_one_task_in_any_order(spark):
    """A stale and a valid outcome of one task: one is applied, one is told, whichever comes first."""
    jobs = jobs_table(spark, {"id": "x", "status": "Running", "lock_by": "w", "lock_at": "2024-05-01 10:00:00", "attempts": 1})
    workers = workers_table(spark, {"id": "w", "lease_token": "t"})
    rows = [("x", "q", "w", 1714557600.0, 1, True, "t"), ("x", "q", "w", 1714557599.0, 1, False, "t"), ("x", "q", "w", 1714557600.0, 1, False, "other")]
    for order in (rows, rows[::-1]):
        acks = spark.createDataFrame(order, "task_id string, queue string, worker_id string, lock_at double, started_attempts int, ok boolean, lease_token string").coalesce(1)
        assert [r.status for r in ack.ack_batch(jobs, workers, acks, NOW).affected.collect()] == ["Done"]
        assert ack.stale_acks(jobs, workers, acks).count() == 2


def test_readers_writers_and_codecs(spark, tmp_path):
    jobs = jobs_table(spark, *[{"id": f"j{k}", "job_type": f"q{k % 3}", "job": f'{{"to": {k}}}'} for k in range(9)])
    write_jobs(jobs, f"file://{tmp_path}/jobs")
    back = read_jobs(spark, f"file://{tmp_path}/jobs").select(*jobs.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, jobs.collect()))
    workers_table(spark, {"id": "a"}).write.parquet(f"file://{tmp_path}/workers")
    assert read_workers(spark, f"file://{tmp_path}/workers").first().id == "a"
    codec = JsonCodec("to int")
    assert {r.args.to for r in codec.decode_all(jobs).collect()} == set(range(9))
    assert codec.encode(spark.createDataFrame([(1, None)], "to int, more string"), "to", "more").first().job == '{"to":1,"more":null}'
    with pytest.raises(DecodeError):
        codec.decode_all(jobs.withColumn("job", F.lit("{")))
    assert [tuple(r) for r in from_arrays(spark, id=["a", "b"], priority=[1, 2]).collect()] == [("a", 1), ("b", 2)]
    with pytest.raises(ValueError):
        from_arrays(spark, id=["a"], priority=[])
    pairs = zipped(spark.createDataFrame([([1, 2], ["a", "b"])], "n array<int>, s array<string>"), "n", "s")
    assert [tuple(r) for r in pairs.collect()] == [(1, "a"), (2, "b")]
    ended = spark.createDataFrame([("a", "Done", '{"Ok":1}'), ("b", "Done", None)], "id string, status string, result string")
    assert results(ended.limit(1)) == [{"id": "a", "status": "Done", "result": '{"Ok":1}'}]
    with pytest.raises(MissingField):
        results(ended)


def test_numbers(spark):
    assert clamp_i32(1 << 40) == (1 << 31) - 1 and clamp_i32(-(1 << 40)) == -(1 << 31) and i32_from_u32(7) == 7
    with pytest.raises(InvalidArgument):
        i32_from_u32(1 << 31)
    at = spark.range(1).select(timestamp_of(F.lit(1714557600.25)).alias("t")).first().t
    assert str(at) == "2024-05-01 10:00:00.250000"
