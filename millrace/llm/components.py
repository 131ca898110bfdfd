"""Connected components of a table of links, without a hub's links ever meeting in one task.

Links (a, b) become (child, parent) with child > parent. Spark gathers each child's distinct parents and stores them (at
first under salts, as a child may have any number of links; later it has one parent from each task at most). A task then
joins what it reads, many children, with a union-find and hands on a forest: one parent for each vertex but the roots. A
vertex that got two parents in different tasks has them joined in the next round. When every child has one parent, the
links are a forest with one root for each component, and pointer jumping flattens it, a parent's own parent being looked
up once for all its children. Links never grow in number; each round is written to the shared folder. The Python tasks
are as many as the stored links fill, not as the shuffle has partitions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import SALTS, SMALL, attach, cut, ship


class Forest:
    """Union-find over any hashable ids that can be ordered; the smallest of a tree is its root."""

    def __init__(self):
        self.parent = {}

    def root(self, x):
        parent = self.parent
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x], x = top, up
        return top

    def join(self, a, b) -> bool:
        """Whether the two were apart."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True

    def flat(self):
        """Batches child, parent: the root of every vertex (64-bit ids) but the roots themselves."""
        children = [x for x in self.parent if self.root(x) != x]
        for i in range(0, len(children), 65536):
            part = children[i : i + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([self.root(x) for x in part], pa.int64())], names=["child", "parent"])


def _forest(batches):
    f = Forest()
    for batch in batches:
        for a, parents in zip(batch.column("child").to_pylist(), batch.column("parents").to_pylist(), strict=True):
            for b in parents:
                f.join(a, b)
    yield from f.flat()


def lifted(edges: DataFrame) -> DataFrame | None:
    """``edges`` (child, parent: one parent a child, in shared storage) with each parent replaced by its own, if any has one."""
    up = edges.select(F.col("child").alias("parent"), F.col("parent").alias("top"))
    tops = cut(edges.groupBy("parent").agg(F.count(F.lit(1)).alias("n")).join(up, "parent"), "tops")
    if tops.isEmpty():
        return None
    return cut(attach(edges, tops, ["parent"], "child", whole=SMALL).select("child", F.coalesce("top", "parent").alias("parent")), "jump")


def components(links: DataFrame, few: bool = False) -> DataFrame:
    """id and component (the smallest id it reaches) of every vertex of ``links`` (two long columns) but the smallest ones.

    Links of a vertex with itself or with null are none. Vertices that aren't in the result are their own component.
    ``few``: no vertex has more links to smaller ones than there are tasks, about, so that salts are needless at first, too.
    """
    ship(links.sparkSession)
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("child"), F.least(a, b).alias("parent")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    by = ["child"] if few else ["child", F.pmod(F.xxhash64("parent"), F.lit(SALTS)).alias("salt")]
    while True:
        met = cut(edges.groupBy(*by).agg(F.collect_set("parent").alias("parents")).select("child", "parents"), "met")
        several = met.agg(F.max(F.size("parents"))).first()[0]
        if several is None or several == 1 and len(by) == 1:
            break
        edges, by = cut(met.mapInArrow(_forest, "child long, parent long"), "hook"), ["child"]
    edges = met.select("child", F.col("parents")[0].alias("parent"))
    while (up := lifted(edges)) is not None:
        edges = up
    return edges.select(F.col("child").alias("id"), F.col("parent").alias("component"))


def whole_runs(batches, keys: list[str], rows: int = 20_000):
    """Tables of whole runs of equal ``keys`` from batches sorted by them, with the rows at which runs begin (and the end).

    A table has about ``rows`` rows, or one longer run.
    """
    held, n = [], 0

    def edges_of(table):
        change = np.zeros(max(table.num_rows - 1, 0), bool)
        for k in keys:
            c = table.column(k).to_numpy()
            change |= c[1:] != c[:-1]
        return np.concatenate([[0], np.flatnonzero(change) + 1, [table.num_rows]])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held)
            edges = edges_of(table)
            if len(edges) > 2:
                yield table.slice(0, edges[-2]).combine_chunks(), edges[:-1]
                held = table.slice(edges[-2]).to_batches()
            else:
                held = table.to_batches()
            n = sum(b.num_rows for b in held)
            rows = max(rows, 2 * n)
    if n:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, edges_of(table)


def blocks(n, least: int = 64, most: int = 512):
    """Column: in how many blocks a group of ``n`` rows is cut, so that a pair of blocks is a bounded piece of work."""
    return F.greatest(F.ceil(n / most), F.least(F.lit(32), F.ceil(n / least)), F.lit(1)).cast("int")


def block_pairs(df: DataFrame, key: str, n: str) -> DataFrame:
    """Each row once for each pair of blocks of its group that holds its own: columns own, i and j (i <= j) come in.

    A row of a group of one block comes once. ``key`` spreads rows over blocks; ``n`` is the group's size.
    """
    m = blocks(F.col(n))
    own = F.pmod(F.xxhash64(key, F.lit("block")), m.cast("long")).cast("int")
    out = df.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), m - 1)))
    return out.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other")
