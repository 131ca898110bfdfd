"""The notification source: offsets, bounds, queues, restarts."""

import pytest
from pyspark.sql import functions as F

from millrace.sources import notifications
from millrace.streaming import ingest

NOW = "2024-05-01 12:00:00"


@pytest.fixture
def inbox(spark, tmp_path):
    return ingest.Inbox(spark, f"file://{tmp_path}/inbox")


def put(spark, inbox, number, queues, n=250):
    rows = spark.range(n).select(F.lit(number).alias("b"), "id")
    for_queue = [ingest.tasks(rows, q, id=F.concat(F.lit(f"{number}-{k}-"), F.lpad(F.col("id").cast("string"), 4, "0")), now=NOW) for k, q in enumerate(queues)]
    batch = for_queue[0]
    for more in for_queue[1:]:
        batch = batch.unionByName(more)
    inbox.insert(batch, number, NOW)


def read(spark, inbox, check, **options):
    """What a query with this checkpoint is told until nothing is left: (micro-batch, queue, ids)."""
    notifications.register(spark)
    stream = spark.readStream.format(notifications.NAME).option("path", inbox.path)
    for k, v in options.items():
        stream = stream.option(k, v)
    got = []
    query = stream.load().writeStream.foreachBatch(lambda df, n: got.extend((n, r.job_type, tuple(r.ids)) for r in df.collect())).option("checkpointLocation", check).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return got


def test_queues_offsets_and_restarts(spark, inbox, tmp_path):
    check = f"file://{tmp_path}/check"
    assert read(spark, inbox, check, queues="a,odd queue/é") == []
    put(spark, inbox, 0, ["a", "b", "odd queue/é"])
    put(spark, inbox, 1, ["a"])
    first = read(spark, inbox, check, queues="a,odd queue/é")
    assert {q for _, q, _ in first} == {"a", "odd queue/é"} and all(len(ids) <= 100 for _, _, ids in first)
    assert sorted(i for _, q, ids in first if q == "a" for i in ids) == [f"{b}-0-{k:04}" for b in (0, 1) for k in range(250)]
    put(spark, inbox, 2, ["b", "a"])
    again = read(spark, inbox, check, queues="a,odd queue/é")
    assert sorted(i for _, _, ids in again for i in ids) == [f"2-1-{k:04}" for k in range(250)]
    assert len(read(spark, inbox, f"{check}-all")) == 9 + 3 + 6


def test_bounded_triggers(spark, inbox, tmp_path):
    """One folder a trigger, also after a restart; what isn't complete waits."""
    for k in range(3):
        put(spark, inbox, k, ["a"], 20)
    check = f"file://{tmp_path}/check"
    got = read(spark, inbox, check, batchesPerTrigger=1, reader="r")
    assert [ids[0][0] for _, _, ids in got] == ["0", "1", "2"] and len({n for n, _, _ in got}) == 3
    put(spark, inbox, 3, ["a"], 20)
    put(spark, inbox, 5, ["a"], 20)
    (tmp_path / "inbox/notify/batch=4/job_type=a").mkdir(parents=True)
    assert [ids[0][0] for _, _, ids in read(spark, inbox, check, batchesPerTrigger=1, reader="r")] == ["3"]
    put(spark, inbox, 4, ["a"], 20)
    assert [ids[0][0] for _, _, ids in read(spark, inbox, check, batchesPerTrigger=1, reader="r")] == ["4", "5"]
    with pytest.raises(Exception, match="reader"):
        read(spark, inbox, f"{check}-none", batchesPerTrigger=1)
