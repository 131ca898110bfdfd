"""Near-duplicate embeddings by collision-counting projections.

Vectors are compared within a label. Exact copies become one class first. Independent Gaussian lines project each
class's unit vector. To bring near vectors to the same task, TABLES groups of ROUTE lines are cut into
cells of a width that near vectors rarely straddle; a vector goes to its cell in each table, and a cell of any size is
cut into pairs of blocks. There, the values on PROJECTIONS further lines are sorted, each query counts how often each
other vector falls into the window around its own value, pairs with enough collisions are candidates, and their cosine
is computed in double precision. A pair that meets in several tables is counted in the first of them only.

Windows and the count are calibrated from the threshold: the difference of two unit vectors at cosine c, projected on
a Gaussian line, is normal with variance 2 - 2c. ``recall`` gives the probability that a pair at the threshold is found.

A task hands on, not pairs, but counts of links by vector and a forest of links.

Defined results: null, zero and non-finite vectors, those with null components and those with a null label link with
nothing; vectors of different lengths link with nothing, either; repeated rows (equal vec_id, label and vector) count
once; rows that share a vec_id with different vectors are one vertex of the components, each with the links of its own
vector; a row whose vector can't link has its own id as component; a null vec_id links with nothing, has a null component and is kept; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import Forest, block_pairs, components, whole_runs
from .shared import attach, cut, ship

LEAST = 0.93
TABLES, ROUTE, CELL = 16, 6, 1.6
PROJECTIONS, WINDOW, COLLISIONS = 32, 0.45, 16
SEED = 20240229


def lines(dim: int) -> np.ndarray:
    """Gaussian directions as columns: PROJECTIONS for counting, then TABLES * ROUTE for the cells."""
    return np.random.RandomState(SEED + dim).standard_normal((dim, PROJECTIONS + TABLES * ROUTE))


def shifts() -> np.ndarray:
    return np.random.RandomState(SEED).uniform(0, CELL, TABLES * ROUTE)


def recall(cosine: float = LEAST) -> float:
    """Probability that a pair at this cosine shares a cell in some table and reaches the count of collisions."""
    sd = math.sqrt(2 - 2 * cosine)
    x = np.linspace(-8 * sd, 8 * sd, 20001)
    density = np.exp(-0.5 * (x / sd) ** 2) / (sd * math.sqrt(2 * math.pi))
    cell = float(np.sum(np.maximum(0, 1 - np.abs(x) / CELL) * density) * (x[1] - x[0])) ** ROUTE
    hit = math.erf(WINDOW / (sd * math.sqrt(2)))
    enough = sum(math.comb(PROJECTIONS, k) * hit**k * (1 - hit) ** (PROJECTIONS - k) for k in range(COLLISIONS, PROJECTIONS + 1))
    return (1 - (1 - cell) ** TABLES) * enough


def cells(unit: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """A 64-bit cell of each vector in each table."""
    at = np.floor((unit @ directions[:, PROJECTIONS:] + shifts()) / CELL).astype(np.int64).view(np.uint64)
    key = np.tile(np.arange(1, TABLES + 1, dtype=np.uint64) << np.uint64(48), (len(unit), 1))
    with np.errstate(over="ignore"):
        for k in range(ROUTE):
            key = (key ^ at[:, k::ROUTE][:, :TABLES]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
            key *= np.uint64(0xBF58476D1CE4E5B9)
            key ^= key >> np.uint64(32)
    return key.view(np.int64)


def collisions(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many of the lines have a right vector's value in the window around a left vector's; rows are values by line."""
    counts = np.zeros((len(left), len(right)), np.uint8)
    steps = np.zeros((len(left), len(right) + 1), np.int8)
    rows = np.arange(len(left))
    for k in range(left.shape[1]):
        order = np.argsort(right[:, k], kind="stable")
        value = right[order, k]
        low, high = np.searchsorted(value, left[:, k] - WINDOW, "left"), np.searchsorted(value, left[:, k] + WINDOW, "right")
        steps[:] = 0
        steps[rows, low] += 1
        steps[rows, high] -= 1
        counts[:, order] += np.cumsum(steps[:, :-1], axis=1, dtype=np.int8).view(np.uint8)
    return counts


def _unit(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    v = flat.reshape(len(column), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _digest(*columns):
    return [F.xxhash64(F.lit(k), *columns) for k in (1, 2)]


def keyed(vectors: DataFrame) -> DataFrame:
    """vec_id, label (as text), embedding and d1, d2: a digest of label and vector, null where the vector can't link."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & sound, F.lit(False))
    d1, d2 = _digest("label", "embedding")
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding", F.when(usable, d1).alias("d1"), F.when(usable, d2).alias("d2"))


def _routed(reps: DataFrame) -> DataFrame:
    """vec_id, cell, place (number of the table): a row for each vector and table."""
    ship(reps.sparkSession)

    def run(batches):
        for batch in batches:
            sizes = np.asarray(batch.column("embedding").value_lengths())
            for dim in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == dim)))
                keys = cells(_unit(part.column("embedding")), lines(int(dim)))
                with np.errstate(over="ignore"):
                    keys = keys ^ (part.column("kind").to_numpy()[:, None] + np.int64(dim))
                ids = np.repeat(part.column("vec_id").to_numpy(), TABLES)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys.ravel()), pa.array(np.tile(np.arange(TABLES, dtype=np.int32), part.num_rows))], names=["vec_id", "cell", "place"])

    return reps.select("vec_id", F.xxhash64("label").alias("kind"), "embedding").mapInArrow(run, "vec_id long, cell long, place int")


#: Up to so many rows, a group's pairs are counted line by line at once; above, by sorted lines.
_FEW = 24


def _candidates(values: np.ndarray, edges: np.ndarray, own: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs that collide on enough lines, each within its group and between its two blocks."""
    left, right = [], []
    size = np.diff(edges)
    for n in np.unique(size[(size > 1) & (size <= _FEW)]):
        first = edges[:-1][size == n]
        p, q = np.triu_indices(n, 1)
        for s in range(0, len(first), max(1, 200_000 // len(p))):
            at = first[s : s + max(1, 200_000 // len(p)), None]
            x, y = (at + p).ravel(), (at + q).ravel()
            good = np.where(i[x] == j[x], True, own[x] != own[y])
            x, y = x[good], y[good]
            enough = (np.abs(values[x] - values[y]) <= WINDOW).sum(axis=1) >= COLLISIONS
            left.append(x[enough]), right.append(y[enough])
    for a, b in zip(edges[:-1][size > _FEW].tolist(), edges[1:][size > _FEW].tolist(), strict=True):
        rows = np.arange(a, b)
        one, two = rows[own[a:b] == i[a]], rows[own[a:b] == j[a]]
        if len(one) and len(two):
            x, y = np.nonzero(collisions(values[one], values[two]) >= COLLISIONS)
            x, y = one[x], two[y]
            good = (x < y) | (i[a] != j[a])
            left.append(x[good]), right.append(y[good])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def linked(reps: DataFrame, least: float = LEAST) -> DataFrame:
    """Links among distinct vectors (vec_id, copies, label, embedding), told as rows of two sorts.

    (a, null, n): n further vectors, copies counted, are linked with a. (a, b, 0): an edge of a forest of links.
    """
    ship(reps.sparkSession)
    routed = cut(_routed(reps), "cells")
    sizes = cut(routed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "cell-sizes")
    met = attach(routed, sizes, ["cell"], "vec_id").where("n is not null")
    dealt = block_pairs(met, "vec_id", "n").join(reps, "vec_id")
    dealt = dealt.select("cell", "i", "j", "own", "place", "vec_id", "copies", "label", "embedding").repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")

    def run(batches):
        for table, edges in whole_runs(batches, ["cell", "i", "j"], rows=8192):
            ids, own, i, j, place, copies = (table.column(c).to_numpy() for c in ("vec_id", "own", "i", "j", "place", "copies"))
            label = table.column("label").combine_chunks().dictionary_encode()
            label = (label.combine_chunks() if isinstance(label, pa.ChunkedArray) else label).indices.to_numpy()
            column = table.column("embedding").combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            sizes = np.asarray(column.value_lengths())
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                # groups of this length; where hashes of two lengths agree, each is cut to its own rows
                group = np.searchsorted(edges, rows, side="right")
                limits = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(rows)]])
                unit, directions = _unit(column.take(pa.array(rows))), lines(int(dim))
                x, y = _candidates(unit @ directions[:, :PROJECTIONS], limits, own[rows], i[rows], j[rows])
                good = label[rows[x]] == label[rows[y]]
                x, y = x[good], y[good]
                good = np.concatenate([np.empty(0, bool), *[np.einsum("ij,ij->i", unit[x[s : s + 65536]], unit[y[s : s + 65536]]) >= least for s in range(0, len(x), 65536)]])
                x, y = x[good], y[good]
                if not len(x):
                    continue
                keys = cells(unit, directions)
                good = np.argmax(keys[x] == keys[y], axis=1) == place[rows[x]]
                x, y = rows[x[good]], rows[y[good]]
                ends, many = np.concatenate([ids[x], ids[y]]), np.concatenate([copies[y], copies[x]])
                some, at = np.unique(ends, return_inverse=True)
                n = np.bincount(at, weights=many, minlength=len(some)).astype(np.int64)
                forest = Forest()
                edge = [p for p in zip(ids[x].tolist(), ids[y].tolist(), strict=True) if forest.join(*p)]
                a = pa.array(np.concatenate([some, np.array([p[0] for p in edge], np.int64)]))
                b = pa.array([None] * len(some) + [p[1] for p in edge], pa.int64())
                yield pa.RecordBatch.from_arrays([a, b, pa.array(np.concatenate([n, np.zeros(len(edge), np.int64)]))], names=["a", "b", "n"])

    return dealt.mapInArrow(run, "a long, b long, n long")


def _same_vertex(usable: DataFrame) -> DataFrame:
    """Links a, b between the classes (by d1) of vec_ids that come with several vectors: such rows are one vertex."""
    several = usable.groupBy("vec_id").agg(F.min("d1").alias("a"), F.max("d1").alias("hi"), F.count(F.lit(1)).alias("n")).where("a != hi").select("vec_id", "a", "n")
    met = attach(usable.select("vec_id", "d1"), cut(several, "several-vectors"), ["vec_id"], "d1")
    return met.where("a is not null").select("a", F.col("d1").alias("b")).distinct()


def near_duplicates(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding, label)."""
    known = cut(keyed(vectors), "vectors")
    usable = known.where("d1 is not null")
    groups = usable.select("vec_id", "d1", "d2").distinct().groupBy("d1", "d2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    groups = cut(groups, "copies")
    firsts = attach(usable.select("vec_id", "d1", "d2", "label", "embedding"), groups, ["d1", "d2"], "vec_id", n="copies").where("vec_id = rep")
    # a class goes by its digest, as one vec_id may stand for several
    reps = cut(firsts.dropDuplicates(["d1", "d2"]).select(F.col("d1").alias("vec_id"), "copies", "label", "embedding"), "vector-classes")
    told = cut(linked(reps, least), "vector-links")
    counted = told.where("b is null").groupBy(F.col("a").alias("d1")).agg(F.sum("n").alias("n"))
    near = components(told.where("b is not null").select("a", "b").union(_same_vertex(usable))).toDF("d1", "root")
    placed = groups.join(counted, "d1", "left").join(near, "d1", "left")
    placed = cut(placed.select("d1", "d2", "rep", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "d1").alias("root"), F.col("copies").alias("n")), "rooted")
    smallest = cut(placed.groupBy("root").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("m")), "smallest")
    placed = cut(attach(placed, smallest, ["root"], "d1", n="m").select("d1", "d2", "n_links", "component_id", "n"), "placed")
    out = attach(usable.select("vec_id", "d1", "d2"), placed, ["d1", "d2"], "vec_id").select("vec_id", "n_links", "component_id")
    bare = known.where("d1 is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(bare).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
