"""Waiting and liveness as state of a stream: keyed state with event-time timers, kept in the checkpoint.

A restart goes on from the checkpoint: what was told isn't told again, and timers that were set still fire.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.predicates import terminal
from ..operators.orphans import sweep
from ..schema import Transition, seconds

#: The state store that timers and several states a key need.
_ROCKS = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
EXPIRED = "Expired"


#: Keys of the state. A key has the tasks (or workers) whose hash it is, so that Python is called, and asks for state, once
#: for them all; a micro-batch reads the state of the keys that it has. A checkpoint goes on with its number only.
BUCKETS = 2048


def _bucketed(df: DataFrame, *columns: str) -> GroupedData:
    """``df`` by buckets of the columns' hash, for states and timers."""
    df.sparkSession.conf.set(*_ROCKS)
    return df.withColumn("bucket", F.pmod(F.xxhash64(*columns), F.lit(BUCKETS))).groupBy("bucket")


def _lists(state) -> tuple[list, ...] | None:
    return state.get() if state.exists() else None


def _keep(state, *lists) -> None:
    """Keeps lists of one length as a bucket's state; nothing, if they are empty."""
    if lists[0]:
        state.update(tuple(lists))
    elif state.exists():
        state.clear()


def _alarm(handle: StatefulProcessorHandle, at: int | None) -> None:
    """Makes ``at`` the only timer of the bucket."""
    timers = list(handle.listTimers())
    for timer in timers:
        if timer != at:
            handle.deleteTimer(timer)
    if at is not None and at not in timers:
        handle.registerTimer(at)


def _passed(timerValues, expiredTimerInfo) -> int:
    """The latest time whose timer fires when this one does."""
    return max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)


class _Waits(StatefulProcessor):
    """Of the tasks of a bucket: which are waited for without an end, and which have ended without a wait.

    The bucket's timer stands at the first time that one of its waits gives up.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waits = handle.getValueState("waits", "id array<string>, until array<bigint>")
        self.ends = handle.getValueState("ends", "id array<string>, status array<string>, result array<string>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(rows)
        asked = new[new["kind"] == "wait"].sort_values("ms").drop_duplicates("id", keep="last")
        first = new[new["kind"] != "wait"].sort_values(["at", "status", "result"]).drop_duplicates("id")
        ids, status, result = _lists(self.ends) or ((), (), ())
        ended = dict(zip(ids, zip(status, result, strict=True), strict=True))
        for i, s, r in zip(first["id"], first["status"], first["result"], strict=True):
            ended.setdefault(i, (s, None if pd.isna(r) else r))
        waits = dict(zip(*(_lists(self.waits) or ((), ())), strict=True))
        for i, ms in zip(asked["id"], asked["ms"], strict=True):
            waits.setdefault(i, int(ms))
        met = [(i, *ended.pop(i)) for i in waits if i in ended]
        for i, _, _ in met:
            del waits[i]
        _keep(self.ends, list(ended), [s for s, _ in ended.values()], [r for _, r in ended.values()])
        self._wait(waits)
        _alarm(self.handle, min((ms for ms in waits.values() if ms), default=None))
        if met:
            yield pd.DataFrame(met, columns=["id", "status", "result"])

    def _wait(self, waits: dict[str, int]) -> None:
        _keep(self.waits, list(waits), list(waits.values()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed, waits = _passed(timerValues, expiredTimerInfo), dict(zip(*(_lists(self.waits) or ((), ())), strict=True))
        given_up = [i for i, ms in waits.items() if 0 < ms <= passed]
        for i in given_up:
            del waits[i]
        self._wait(waits)
        following = min((ms for ms in waits.values() if ms), default=None)
        if following is not None:
            self.handle.registerTimer(following)
        if given_up:
            yield pd.DataFrame({"id": given_up, "status": EXPIRED, "result": None})

    def close(self) -> None:
        pass


def ends_of(jobs: DataFrame, at: Column | str = "done_at") -> DataFrame:
    """Ended jobs, from a stream of changed jobs, as rows for ``waited``."""
    rows = jobs.where(terminal())
    return rows.select("id", F.lit("end").alias("kind"), (F.col(at) if isinstance(at, str) else at).cast("timestamp").alias("at"), F.lit(None).cast("timestamp").alias("until"), "status", F.col("last_result").alias("result"))


def waits_of(asked: DataFrame) -> DataFrame:
    """Waits (id, at and, if there, until: when to give up) as rows for ``waited``."""
    until = F.col("until").cast("timestamp") if "until" in asked.columns else F.lit(None).cast("timestamp")
    none = F.lit(None).cast("string")
    return asked.select("id", F.lit("wait").alias("kind"), F.col("at").cast("timestamp").alias("at"), until.alias("until"), none.alias("status"), none.alias("result"))


def waited(rows: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """A stream of waits and ends (see ``waits_of``, ``ends_of``; a union of both) as a stream of what waits were for.

    Each task that is waited for is told once: id, status and result of its first end, whether that came before or after
    the wait; or the status Expired, once the stream's time, less ``delay``, has passed the wait's ``until``.
    """
    timed = rows.withColumn("ms", F.coalesce(F.unix_millis("until"), F.lit(0))).withWatermark("at", delay)
    met = _bucketed(timed, "id").transformWithStateInPandas(_Waits(), "id string, status string, result string", "Append", "EventTime")
    return met.dropDuplicates(["id"])  # of what later waits and ends tell, Spark's own state drops what was told


class _Liveness(StatefulProcessor):
    """Of the workers of a bucket, each in one queue: when they were seen last, in microseconds.

    The bucket's timer stands ``after`` milliseconds past the first of these times.
    """

    def __init__(self, after: int):
        self.after = after

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "id array<string>, worker_type array<string>, us array<bigint>")

    def _last(self) -> dict[tuple[str, str], int]:
        ids, queues, us = _lists(self.seen) or ((), (), ())
        return dict(zip(zip(ids, queues, strict=True), us, strict=True))

    def _keep(self, last: dict[tuple[str, str], int]) -> int | None:
        """Keeps the times; returns when the first of them is over."""
        _keep(self.seen, [i for i, _ in last], [q for _, q in last], list(last.values()))
        return self._over(min(last.values())) if last else None

    def _over(self, us: int) -> int:
        return -(-us // 1000) + self.after

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = self._last()
        new = pd.concat(rows).sort_values("us").drop_duplicates(["id", "worker_type"], keep="last")
        for *worker, us in zip(new["id"], new["worker_type"], new["us"].tolist(), strict=True):
            last[*worker] = max(last.get((*worker,), us), us)
        _alarm(self.handle, self._keep(last))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed, last = _passed(timerValues, expiredTimerInfo), self._last()
        lost = [(*worker, us) for worker, us in last.items() if self._over(us) <= passed]
        following = self._keep({worker: us for worker, us in last.items() if self._over(us) > passed})
        if following is not None:
            self.handle.registerTimer(following)
        if lost:
            yield pd.DataFrame(lost, columns=["id", "worker_type", "us"])

    def close(self) -> None:
        pass


def lost_workers(beats: DataFrame, after: float, delay: str = "0 seconds") -> DataFrame:
    """A stream of heartbeats (id, worker_type, last_seen) as a stream of workers that were lost: id, worker_type, last_seen.

    A worker is told once the stream's time, less ``delay``, is ``after`` seconds past its last beat; a later beat begins anew.
    No table is scanned: beats meet the state of their workers' buckets only.
    """
    rows = beats.select("id", "worker_type", F.col("last_seen").cast("timestamp").alias("last_seen")).where("last_seen is not null")
    timed = rows.withColumn("us", F.unix_micros("last_seen")).withWatermark("last_seen", delay)
    lost = _bucketed(timed, "id", "worker_type").transformWithStateInPandas(_Liveness(int(after * 1000)), "id string, worker_type string, us long", "Append", "EventTime")
    return lost.select("id", "worker_type", F.timestamp_micros("us").alias("last_seen"))


def orphans_of(jobs: DataFrame, lost: DataFrame, after: float, now) -> Transition:
    """Takes back what the lost workers of a micro-batch hold, like a sweep, but by their names only."""
    return sweep(jobs, lost.withColumn("last_seen", F.col("last_seen").cast("timestamp_ntz")), after, now)


def beaten(beats: DataFrame, after: float) -> DataFrame:
    """The same by a table of beats: workers whose last beat is ``after`` seconds older than the latest of all."""
    last = beats.groupBy("id", "worker_type").agg(F.max("last_seen").alias("last_seen"))
    latest = last.agg(F.max("last_seen").alias("latest"))
    return last.join(F.broadcast(latest)).where(F.col("last_seen") <= F.col("latest") - seconds(after)).drop("latest")
