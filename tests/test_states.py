"""Waiting and liveness as stream state, with restarts from the checkpoint."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import orphans
from millrace.sources import derived as D
from millrace.streaming import states

SF = "/root/testdata/sf0.001"
ROWS = "id string, kind string, at timestamp, until timestamp, status string, result string"


def sink(df, path, check):
    """Runs a stream over what is there; rows go to a folder for each micro-batch."""

    def put(batch, number):
        batch.write.mode("overwrite").parquet(f"{path}/{number}")

    query = df.writeStream.foreachBatch(put).option("checkpointLocation", check).trigger(availableNow=True).start()
    assert query.awaitTermination(180)


def told(spark, path):
    return [tuple(r) for r in spark.read.option("recursiveFileLookup", "true").parquet(path).collect()]


def test_waits(spark, tmp_path):
    """Ends before and after waits, twice, late and never: each is told once, also after restarts."""
    at = lambda s: f"2024-05-01 12:{s // 60:02}:{s % 60:02}"
    end = lambda i, s, status="Done", result="r": (i, "end", at(s), None, status, result)
    wait = lambda i, s, until=None: (i, "wait", at(s), until and at(until), None, None)
    steps = [
        [wait("a", 1), end("b", 2), wait("c", 3, 30), wait("d", 3, 500), wait("e", 4), end("nobody", 5)],
        [end("a", 10, "Failed", None), wait("b", 11), wait("a", 12), end("e", 13), end("e", 13, "Killed")],
        [end("a", 20), wait("b", 60), end("f", 60)],
        [end("c", 70), end("d", 80), wait("f", 81, 400)],
        [end("d", 90), end("z", 600)],
    ]
    path, out, check = (f"file://{tmp_path}/{x}" for x in ("in", "out", "check"))
    cast = ["id", "kind", F.col("at").cast("timestamp").alias("at"), F.col("until").cast("timestamp").alias("until"), "status", "result"]
    for rows in steps:
        spark.createDataFrame(rows, "id string, kind string, at string, until string, status string, result string").select(*cast).coalesce(1).write.mode("append").parquet(path)
        sink(states.waited(spark.readStream.schema(ROWS).parquet(path)), out, check)
    assert sorted(told(spark, out)) == sorted([("a", "Failed", None), ("b", "Done", "r"), ("c", "Expired", None), ("d", "Done", "r"), ("e", "Done", "r"), ("f", "Done", "r")])


def test_rows_of_waits_and_jobs(spark):
    jobs = D.jobs(D.events(spark, SF))
    ends = states.ends_of(jobs)
    assert ends.count() == jobs.where("status in ('Done', 'Killed') or (status = 'Failed' and attempts >= max_attempts)").count()
    assert states.waits_of(jobs.select("id", F.col("run_at").alias("at"))).unionByName(ends).columns == [f.split()[0] for f in ROWS.split(", ")]


@pytest.mark.parametrize("seed", [1, 2])
def test_lost_workers(spark, tmp_path, seed):
    """Deaths by timers are those of the table of beats, and take back the orphans that a sweep takes back."""
    r = random.Random(seed)
    start = 1_700_000_000
    beats = [(f"w-{w}", q, start + t * 10 + r.random()) for w in range(8) for q in ("click", "view") for t in range(r.randint(1, 40)) if r.random() < 0.8]
    beats += [("w-last", "click", start + 500.0)]
    beats.sort(key=lambda b: b[2])
    path, out, check = (f"file://{tmp_path}/{x}" for x in ("in", "out", "check"))
    for part in range(3):  # a restart between them
        rows = beats[len(beats) * part // 3 : len(beats) * (part + 1) // 3]
        spark.createDataFrame(rows, "id string, worker_type string, s double").select("id", "worker_type", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")).cast("timestamp_ntz").alias("last_seen")).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema("id string, worker_type string, last_seen timestamp_ntz").parquet(path)
        sink(states.lost_workers(stream, 60), out, check)
    every = spark.read.parquet(path)
    lost = spark.read.option("recursiveFileLookup", "true").parquet(out)
    last = lost.groupBy("id", "worker_type").agg(F.max("last_seen").cast("timestamp_ntz").alias("last_seen"))
    want = states.beaten(every, 60)
    key = lambda df: sorted((x.id, x.worker_type, str(x.last_seen)) for x in df.collect())
    final = last.join(every.groupBy("id", "worker_type").agg(F.max("last_seen").alias("last_seen")), ["id", "worker_type", "last_seen"])
    assert key(final) == key(want) and 0 < want.count() < 17
    gone = [x for x in told(spark, out)]
    assert len(gone) == len(set(gone))
    jobs, now = D.jobs(D.events(spark, SF)), every.agg(F.max("last_seen")).first()[0]
    workers = every.groupBy("id", "worker_type").agg(F.max("last_seen").alias("last_seen"))
    a, b = (sorted(x.id for x in t.affected.collect()) for t in (states.orphans_of(jobs, final, 60, now), orphans.sweep(jobs, workers, 60, now)))
    assert a == b and a


def _keys(df, path, check):
    """Runs a stream like ``sink``; returns the most rows that its first stateful step kept."""
    put = lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/{number}")
    query = df.writeStream.foreachBatch(put).option("checkpointLocation", check).trigger(availableNow=True).start()
    assert query.awaitTermination(180)
    return max(o.numRowsTotal for p in query.recentProgress for o in p.stateOperators if o.operatorName.startswith("transformWithState"))


def test_waits_by_buckets(spark, tmp_path, monkeypatch):
    """Many tasks share a key of the state, so Python isn't called for each; each is told as if it had its own."""
    monkeypatch.setattr(states, "BUCKETS", 3, raising=False)
    r, start, waits, ends, want, now = random.Random(5), 1_700_000_000, {}, {}, {}, 0
    path, out, check = (f"file://{tmp_path}/{x}" for x in ("in", "out", "check"))
    kept = []
    for part in range(3):
        rows = []
        for _ in range(150):
            i, now = f"t-{r.randrange(200)}", now + 1
            if r.random() < 0.5:
                until = now + r.choice([5, 60, 400]) + 0.5 if r.random() < 0.7 else None
                rows.append((i, "wait", float(start + now), until and start + until, None, None))
            else:
                rows.append((i, "end", float(start + now), None, r.choice(["Done", "Killed"]), r.choice([None, "r"])))
        for i in {x[0] for x in rows}:
            asked = [x[3] or 0 for x in rows if x[0] == i and x[1] == "wait"]
            ended = [x[4:] for x in rows if x[0] == i and x[1] == "end"]
            waits.setdefault(i, max(asked)) if asked else None
            ends.setdefault(i, ended[0]) if ended else None
            if i in waits and i in ends:
                want.setdefault(i, (i, *ends[i]))
        for i, until in waits.items():
            if i not in want and 0 < until < start + now:
                want[i] = (i, "Expired", None)
        cast = ["id", "kind", F.timestamp_millis((F.col("at") * 1000).cast("long")).alias("at"), F.timestamp_millis((F.col("until") * 1000).cast("long")).alias("until"), "status", "result"]
        spark.createDataFrame(rows, "id string, kind string, at double, until double, status string, result string").select(*cast).coalesce(1).write.mode("append").parquet(path)
        kept.append(_keys(states.waited(spark.readStream.schema(ROWS).parquet(path)), out, check))
    assert sorted(told(spark, out), key=repr) == sorted(want.values(), key=repr)
    assert {"Done", "Killed", "Expired"} == {x[1] for x in want.values()} and max(kept) <= 4 * 3


def test_lost_workers_by_buckets(spark, tmp_path, monkeypatch):
    """Many workers share a key of the state and its timer; each is told by its own last beat, and again after a new one."""
    monkeypatch.setattr(states, "BUCKETS", 3, raising=False)
    steps = [[(f"w-{k}", q, 1_000 + k) for k in range(100) for q in ("click", "view")] + [(None, "click", 1_005)], [("w-7", "view", 1_150), ("w-1", "click", 1_151)], [("w-8", "click", 1_500)]]
    path, out, check = (f"file://{tmp_path}/{x}" for x in ("in", "out", "check"))
    kept = []
    for rows in steps:
        spark.createDataFrame([*rows, ("none", "click", None)], "id string, worker_type string, s long").select("id", "worker_type", F.timestamp_seconds("s").alias("last_seen")).coalesce(1).write.mode("append").parquet(path)
        kept.append(_keys(states.lost_workers(spark.readStream.schema("id string, worker_type string, last_seen timestamp").parquet(path), 60), out, check))
    lost = spark.read.option("recursiveFileLookup", "true").parquet(out).selectExpr("id", "worker_type", "unix_seconds(last_seen) AS s").collect()
    every = [x for rows in steps for x in rows]
    assert sorted(map(repr, map(tuple, lost))) == sorted(map(repr, every[:-1]))
    assert max(kept) <= 3 * 3
