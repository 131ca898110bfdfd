"""Numbers of rows in an order, without a task that sees a whole group.

Rows are put in order by a range partition; Spark numbers them within each partition, and the partitions' counts (a
histogram of the order) turn that into numbers over all, or within each group, by prefix sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import InvalidArgument
from ..sources.folders import small, written

#: Spark's running numbers have the partition above this bit.
_BIT = 33


def _ordered(rows: DataFrame, by: Sequence[Column]) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    return written(spread.withColumn("_at", F.monotonically_increasing_id()), "ordered")


def _histogram(ordered: DataFrame, within: Sequence[str]) -> DataFrame:
    """A row for each partition (and group that it has rows of): the first running number, rows, rows before."""
    counts = ordered.groupBy(F.shiftright("_at", _BIT).cast("int").alias("_part"), *within).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    return counts.withColumn("_before", F.coalesce(before, F.lit(0)))


def numbered(rows: DataFrame, order: Sequence[Column], within: Sequence[str] = (), name: str = "nth") -> DataFrame:
    """``rows`` with ``name``: their number from 0 by ``order``, within groups of the columns ``within`` (not null).

    Rows move once, by ranges of (group, order); a group of any size spreads over partitions. The histogram has a row for
    each partition and group at most, and is broadcast as long as it is small.
    """
    ordered = _ordered(rows, [*[F.col(c) for c in within], *order])
    starts = small(written(_histogram(ordered, within), "histogram"))
    placed = ordered.withColumn("_part", F.shiftright("_at", _BIT).cast("int")).join(starts, ["_part", *within])
    return placed.select(*rows.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias(name))


class Pages:
    """Rows in a total order, stored once; a page then reads what holds it, however late it is."""

    def __init__(self, rows: DataFrame, order: Sequence[Column]):
        self.rows = _ordered(rows, order)
        #: first running number, rows and rows before of each partition: a few numbers a partition
        self.histogram = sorted((r["_before"], r["_first"], r["_n"]) for r in _histogram(self.rows, ()).collect())

    def __len__(self) -> int:
        return sum(n for _, _, n in self.histogram)

    def page(self, offset: int, limit: int) -> DataFrame:
        """The rows numbered from ``offset`` on (from 0), ``limit`` at most, with ``nth``; order them by it."""
        if offset < 0 or limit < 0:
            raise InvalidArgument("a page starts at 0 or later and has no negative size")
        wanted, nth = F.lit(False), F.lit(None).cast("long")
        for before, first, n in self.histogram:
            low, high = max(offset, before), min(offset + limit, before + n)
            if low < high:
                here = F.col("_at").between(first + low - before, first + high - before - 1)
                wanted, nth = wanted | here, F.when(here, F.col("_at") - first + before).otherwise(nth)
        return self.rows.where(wanted).select(*[c for c in self.rows.columns if c != "_at"], nth.alias("nth"))
