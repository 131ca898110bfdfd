"""How often plans read their tables and what they shuffle."""

import re

import pytest

from millrace.operators import claim, enqueue, reports
from millrace.plans import registry
from millrace.sources import derived as D

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def scans(df):
    return len(re.findall(r"FileScan parquet", plan(df)))


@pytest.fixture(scope="module")
def events(spark):
    return D.events(spark, SF)


def test_reports_read_their_table_once(spark, events):
    jobs = D.jobs(events)
    assert scans(reports.metrics(jobs, D.NOW)) == 1 and scans(reports.metrics(jobs, D.NOW, "click")) == 1
    assert scans(reports.queue_rollup(jobs, D.NOW)) == 1 and scans(reports.snapshot(jobs, D.NOW)) == 1
    assert scans(registry.queue_info(spark, SF)) == 3  # two of the jobs, one of the workers, which come from the same file here


def test_claims_read_the_top_once(events):
    done = claim.claim(D.jobs(events), "click", "w", 10, D.NOW)
    assert scans(done.affected) == 1 and "TakeOrderedAndProject" in plan(done.affected)
    assert scans(done.after) == 2 and "BroadcastHashJoin" in plan(done.after)


def test_scans_are_pruned_to_what_reports_need(events):
    text = plan(reports.snapshot(D.jobs(events), D.NOW))
    assert "props" not in re.search(r"ReadSchema: \S+", text)[0]


def test_enqueue_asks_for_the_batchs_keys_only(events):
    text = plan(enqueue.enqueue_dedup(D.jobs(events), D.enqueue_batch(events), D.NOW).affected)
    assert "LeftSemi" in text
