"""Numbers by range partitions, late pages, claims for many queues and workers, streamed inserts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.errors import InvalidArgument
from millrace.operators import claim, listing, notify
from millrace.operators.ranks import Pages, numbered
from millrace.schema import Filter
from millrace.sources import derived as D
from millrace.streaming import ingest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def jobs(spark):
    return D.jobs(D.events(spark, SF))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def test_numbers(spark):
    r = random.Random(3)
    rows = [(g, v, k) for k, (g, v) in enumerate((r.choice("aaaaaaab"), r.choice([None, *range(40)])) for _ in range(3000))]
    df = spark.createDataFrame(rows, "g string, v int, k int").repartition(7)
    order = [F.col("v").asc_nulls_first(), F.col("k").desc()]
    key = lambda x: (x[1] is not None, x[1] or 0, -x[2])
    got = {r.k: r.nth for r in numbered(df, order, ["g"]).collect()}
    assert got == {x[2]: n for g in "ab" for n, x in enumerate(sorted((x for x in rows if x[0] == g), key=key))}
    assert {r.k: r.nth for r in numbered(df, order).collect()} == {x[2]: n for n, x in enumerate(sorted(rows, key=key))}
    assert numbered(df.limit(0), order, ["g"]).count() == 0


def test_no_task_sees_a_whole_queue(jobs):
    """Rows are dealt by ranges of (job_type, id); no window and no exchange by job_type stand in the plan of the chunks."""
    text = plan(notify.notify_chunks(jobs, D.NOW))
    assert "Window" not in text
    assert all("chunk" in x or "div" in x or x.count(",") > 1 for x in re.findall(r"hashpartitioning\((.*?)\)", text))


def test_chunks_have_consecutive_ids(jobs):
    chunks = notify.notify_chunks(jobs, D.NOW, 10).orderBy("job_type", "chunk").collect()
    told = {}
    for r in chunks:
        told.setdefault(r.job_type, []).append((r.chunk, r.ids))
    for queue, parts in told.items():
        ids = sorted(r.id for r in jobs.where((F.col("job_type") == queue) & (F.col("run_at") <= F.lit(D.NOW).cast("timestamp_ntz"))).collect())
        assert [p for _, p in parts] == [ids[k : k + 10] for k in range(0, len(ids), 10)] and [c for c, _ in parts] == list(range(len(parts)))


def test_pages(jobs):
    """Every page of a listing, the last and one beyond it, as the top-k has them; a late page reads few rows."""
    stored = listing.pages(jobs, "Done")
    assert len(stored) == jobs.where("status = 'Done'").count()
    for n in (1, 2, len(stored) // 7 + 1, len(stored)):
        page = Filter("Done", n, 7)
        assert [r.id for r in listing.list_from(jobs, stored, page).collect()] == [r.id for r in listing.list_all_tasks(jobs, page).collect()]
    assert "BroadcastHashJoin" in plan(listing.list_from(jobs, stored, Filter("Done", 9, 7)))
    late = plan(stored.page(len(stored) - 3, 3))
    assert "PushedFilters: [IsNotNull(_at), GreaterThanOrEqual(_at" in late and "Sort" not in late and "Exchange" not in late
    with pytest.raises(InvalidArgument):
        stored.page(-1, 3)
    assert [len(Pages(jobs.limit(0), [F.col("id")])), Pages(jobs.limit(0), [F.col("id")]).page(0, 5).count()] == [0, 0]


def test_all_queues_at_once(jobs):
    done = claim.claim_all(jobs, "w", 3, D.NOW)
    got = {r.id for r in done.affected.collect()}
    want = {r.id for q in ("click", "view", "purchase", "signup", "error") for r in claim.claim(jobs, q, "w", 3, D.NOW).affected.collect()}
    assert want <= got and len(got) <= 3 * jobs.select("job_type").distinct().count()
    assert done.after.count() == jobs.count() and done.after.where("lock_by = 'w'").count() == len(got)
    place = plan(claim._first(jobs, 3, D.NOW))
    assert place.index("WindowGroupLimit", place.index("Exchange")) > place.index("Exchange")  # one below the exchange
    assert "props" not in re.search(r"ReadSchema: \S+", place)[0]


def test_claims_for_many_workers(spark, jobs):
    """Consecutive shares in the queue's order, no task twice, also when more is asked for than there is."""
    asked = [("a", "click", 2), ("b", "click", 3), ("b", "view", 1), ("c", "click", 10**4), ("d", "none", 5), ("a", "click", 1), ("e", "view", -4)]
    requests = spark.createDataFrame(asked, "worker string, job_type string, capacity int")
    done = claim.claim_for(jobs, requests, D.NOW)
    got = done.affected.collect()
    assert len({r.id for r in got}) == len(got) and done.after.count() == jobs.count()
    first = [r.id for r in claim.claim(jobs, "click", "x", 10**4, D.NOW).affected.orderBy(*claim.order()).collect()]
    by = {w: sorted(first.index(r.id) for r in got if r.job_type == "click" and r.lock_by == w) for w in "abc"}
    assert by == {"a": [0, 1, 2], "b": [3, 4, 5], "c": list(range(6, len(first)))}
    assert sorted(r.lock_by for r in got if r.job_type == "view") == ["b", "e"]
    assert claim.claim_for(jobs, requests.limit(0), D.NOW).affected.count() == 0


def test_a_stream_of_tasks(spark, tmp_path):
    """100,000 tasks in several micro-batches: keys conflict within and across them; a micro-batch that runs again adds nothing."""
    rows = spark.range(100_000).select(F.col("id").alias("n"), F.concat(F.lit("key-"), F.col("id") % 70_000).alias("k"))
    for part in range(4):
        rows.where(F.col("n") % 4 == part).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
    made = ingest.tasks(stream, "q", "n", id=F.lpad(F.col("n").cast("string"), 26, "0"), idempotency_key=F.col("k"), priority=F.lit(2))
    inbox = ingest.Inbox(spark, f"file://{tmp_path}/inbox")
    known = ingest.tasks(rows.where("n < 10"), "q", "n", id=F.concat(F.lit("old"), F.col("n")), idempotency_key=F.col("k"))
    from millrace.operators.enqueue import new_rows

    query = ingest.enqueue_stream(made, inbox, f"file://{tmp_path}/check", new_rows(known, D.NOW), lambda: D.NOW, available_now=True)
    assert query.awaitTermination(240)
    got = inbox.read()
    assert got.count() == 70_000 - 10 == got.select("idempotency_key").distinct().count()
    assert got.where("priority = 2 AND status = 'Pending' AND job = concat('{\"n\":', cast(id AS long), '}')").count() == got.count()
    told = notify.decoded(spark.read.text(f"file://{tmp_path}/inbox/notify").select(F.col("value").alias("payload")))
    assert told.select(F.explode("ids")).distinct().count() == got.count()
    last = spark.read.parquet(f"file://{tmp_path}/inbox/tasks").where("batch = 3")
    n = last.count()
    again = ingest.tasks(rows.where("n % 4 = 3"), "q", "n", id=F.lpad(F.col("n").cast("string"), 26, "0"), idempotency_key=F.col("k"))
    assert inbox.insert(again, 3, D.NOW, new_rows(known, D.NOW)).count() == n and inbox.read().count() == 70_000 - 10


def test_tasks_of_a_table(spark):
    rows = ingest.tasks(spark.range(3).withColumn("none", F.lit(None).cast("string")), F.concat(F.lit("q"), F.col("id") % 2), now=D.NOW).collect()
    assert [(r.job_type, r.job) for r in rows] == [(f"q{k % 2}", f'{{"id":{k},"none":null}}') for k in range(3)]
    assert len({r.id for r in rows}) == 3 and {len(r.id) for r in rows} == {26}
