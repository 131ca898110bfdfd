"""Near-duplicate documents: MinHash bands propose, odd sketches sift, full shingle sets decide.

1. Each document's distinct 5-word shingles become 64-bit hashes; 128 MinHash values give 32 band keys of four values
   and an odd sketch: a bitmap of 1024 parity bits, one toggled by each (place, value). The population count of two
   sketches' XOR estimates how many of the 128 values differ.
2. Documents with equal sets become one class, stood for by its smallest doc_id.
3. Classes that share a band key are compared by sketch: first each with the smallest of its bucket, so that most know
   a common root, then those of other roots than the bucket's commonest with all of it. A bucket of any size is cut into blocks, and a task hands on
   a forest of the pairs that may reach the similarity (five standard errors of the estimate are allowed). Together
   they give the clusters: no pair outside a cluster can be a link.
4. A cluster's documents are dealt in blocks, each with the cluster's smallest; pairs are taken in the order of their
   sketches and checked on the full sets, but for those that earlier links in the task already connect. A document is in
   one block, so that its root there needs no further round. What that leaves apart in a cluster of several blocks is
   compared as in 3, on full sets. The links' components are the result.

A pair at the least similarity shares no band with probability (1 - 0.75 ** 4) ** 32, about 5e-6.

Defined results: null, empty and blank texts have no shingles and link with nothing; fewer than five words are one
shingle; rows that share a doc_id are one vertex, also with different texts (n_shingles is the row's own; a row
without shingles has its own id as component); a null doc_id links with nothing, has a null component and is kept;
an empty table gives an empty result; other columns are ignored; very long texts are taken whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import Forest, components, lifted, whole_runs
from .shared import SMALL, attach, cut, light, ship
from .tokens import slices

WORDS = 5
VALUES, PER_BAND, BITS = 128, 4, 1024
BANDS = VALUES // PER_BAND
#: Members of a bucket or cluster in a block.
BLOCK = 128
#: Least similarity as a fraction.
LEAST = (75, 100)
_ODD = np.random.RandomState(20240131)
_A = _ODD.randint(0, 1 << 31, VALUES).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_B = _ODD.randint(0, 1 << 31, VALUES).astype(np.uint32)
#: Lower-cases A-Z; zero in _WORD marks white space.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n at least."""
    if len(_powers[0]) < n:
        n = max(n + n // 8, 1 << 18)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(n, np.uint64(base))
            p[0] = 1
            with np.errstate(over="ignore"):
                _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts (UTF-8 bytes in), and how many words the texts have up to each one's end."""
    joined = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)] if texts else np.empty(0, np.uint8)
    inside = _WORD[joined]
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=np.int8(0)))
    start, end = edge[0::2], edge[1::2]
    up, down = _power(len(joined) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * up[: len(joined)], dtype=np.uint64)])
        words = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    return words, np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles (UTF-8 bytes in)."""
    words, last = hashed_words(texts)
    with np.errstate(over="ignore"):
        five = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
        for k in range(WORDS):
            five = five * np.uint64(_BASE) + words[k : k + len(five)]
        five = mix(five)
        out, at = [], 0
        for to in last.tolist():
            if to - at >= WORDS:
                own = np.sort(five[at : to - WORDS + 1])
                out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
            elif to > at:
                h = 0
                for w in words[at:to].tolist():
                    h = (h * _BASE + w) % (1 << 64)
                out.append(mix(np.array([(h + to - at) % (1 << 64)], np.uint64)))
            else:
                out.append(np.empty(0, np.uint64))
            at = to
    return out


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """VALUES MinHash values (uint32) of each set; all ones for an empty one."""
    out = np.full((len(sets), VALUES), 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for k, s in enumerate(sets):
            h = (s >> np.uint64(32)).astype(np.uint32)
            for a in range(0, len(h), 2048):
                out[k] = np.minimum(out[k], (h[a : a + 2048, None] * _A + _B).min(axis=0))
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """BANDS 64-bit keys a row; the band's number is part of the key."""
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(_BASE)
    with np.errstate(over="ignore"):
        for k in range(PER_BAND):
            key = mix(key ^ (values[:, k::PER_BAND].astype(np.uint64) + np.uint64(0x51ED270B)))
    return key.view(np.int64)


def odd_sketches(values: np.ndarray) -> np.ndarray:
    """A row of BITS parity bits as 64-bit words for each row of MinHash values."""
    n = len(values)
    with np.errstate(over="ignore"):
        spot = mix(values.astype(np.uint64) + np.arange(1, VALUES + 1, dtype=np.uint64)[None, :] * np.uint64(_BASE)) % np.uint64(BITS)
    parity = np.bincount((spot.astype(np.int64) + np.arange(n)[:, None] * BITS).ravel(), minlength=n * BITS) & 1
    return np.packbits(parity.astype(np.uint8).reshape(n, BITS), axis=1).view(np.uint64)


def most_bits(least: float, errors: float = 5.0) -> int:
    """The XOR population count up to which two sketches may belong to sets of the least similarity.

    The values that differ are binomial; m toggles that differ set BITS * (1 - (1 - 2 / BITS) ** m) / 2 bits.
    """
    low = max(0.0, least - errors * ((least * (1 - least) / VALUES) + (0.012**2)) ** 0.5)
    toggles = 2 * VALUES * (1 - low)
    return int(BITS * (1 - (1 - 2 / BITS) ** toggles) / 2)


def close_pairs(a: np.ndarray, b: np.ndarray | None, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of the sketches ``a`` and ``b`` (or within ``a``) of at most so many differing bits, nearest first."""
    left, right, bits = [], [], []
    other = a if b is None else b
    step = max(1, (1 << 18) // max(1, len(other)))
    for s in range(0, len(a), step):
        x = np.bitwise_count(a[s : s + step, None, :] ^ other[None, :, :]).sum(axis=2, dtype=np.int32)
        i, j = np.nonzero(x <= most)
        keep = slice(None) if b is not None else j > i + s
        left.append(i[keep] + s), right.append(j[keep]), bits.append(x[i, j][keep])
    order = np.argsort(np.concatenate(bits), kind="stable")
    return np.concatenate(left)[order], np.concatenate(right)[order]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def similar(a: np.ndarray, b: np.ndarray, least: tuple[int, int] = LEAST) -> bool:
    small, large = sorted((len(a), len(b)))
    if not small or least[1] * small < least[0] * large:
        return False
    both = overlap(a, b)
    return least[1] * both >= least[0] * (small + large - both)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, d1 and d2 (digest of the set), bands, sketch, row (a number) of every row, in shared storage."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for a, b in slices(batch):
                rows = batch.slice(a, b - a)
                sets = shingle_sets([t or b"" for t in rows.column("text").cast(pa.binary()).to_pylist()])
                values = minhashes(sets)
                with np.errstate(over="ignore"):
                    d1 = np.array([mix(s ^ np.uint64(1)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                    d2 = np.array([mix(s ^ np.uint64(_BASE)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                keys, sketch = band_keys(values), odd_sketches(values)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id").cast(pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(d1),
                        pa.array(d2),
                        pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), pa.array(keys.ravel())),
                        _sketch_column(sketch),
                    ],
                    names=["doc_id", "n_shingles", "d1", "d2", "bands", "sketch"],
                )

    signed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sketch array<long>")
    return cut(signed.withColumn("row", F.monotonically_increasing_id()), "minhash")


def _sketch_column(sketches: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(0, sketches.size + 1, BITS // 64, dtype=np.int32), pa.array(sketches.view(np.int64).ravel()))


def _sketch_rows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.asarray(pc.list_flatten(column)).view(np.uint64).reshape(-1, BITS // 64)


def buckets(reps: DataFrame) -> DataFrame:
    """band, doc_id, n, hub: class representatives in buckets of two and more, with the bucket's size and smallest id.

    Sizes are counted before the shuffle, and a hot band's rows get theirs where they are.
    """
    rows = reps.select("doc_id", F.explode("bands").alias("band"))
    sizes = cut(rows.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("hub")).where("n > 1"), "bands")
    return cut(attach(rows, sizes, ["band"], "doc_id", whole=SMALL).where("n is not null"), "buckets")


def star_links(shared: DataFrame, sketches: DataFrame, least: tuple[int, int] = LEAST) -> DataFrame:
    """child, parents: the smallest of each document's buckets, as far as the sketches may reach the similarity; in shared storage.

    They connect most of a large group at once, so that comparing all members later has little left to say.
    """
    most = most_bits(least[0] / least[1])
    pairs = cut(shared.where("doc_id != hub").select("doc_id", "hub").distinct(), "star-pairs")
    hubs = cut(pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).join(sketches.toDF("hub", "of_hub"), "hub"), "hubs")
    both = attach(pairs, hubs, ["hub"], "doc_id", whole=SMALL).join(sketches, "doc_id")
    differ = sum((F.bit_count(F.col("sketch")[k].bitwiseXOR(F.col("of_hub")[k])) for k in range(BITS // 64)), F.lit(0))
    # one document has BANDS hubs at most, and they meet by its id already
    return cut(both.where(differ <= most).groupBy(F.col("doc_id").alias("child")).agg(F.collect_set("hub").alias("parents")), "stars")


def star_roots(stars: DataFrame) -> DataFrame:
    """id, component: a document that links connect each document with, the same one for most of a group.

    It is the smallest hub, or that one's own smallest: a group can know several, which comparing its members mends.
    """
    first = stars.select("child", F.array_min("parents").alias("parent"))
    up = lifted(first)
    return (first if up is None else up).toDF("id", "component")


def _meetings(rows: DataFrame, group: str) -> DataFrame:
    """``rows`` (with group, doc_id, root, first, n, n_other) dealt so that every member of a group meets every other one.

    The others are those whose root isn't the group's first. Members and others are cut into blocks of about BLOCK; a
    task gets a block of either: columns i, j and asks (whether a row comes as one of the others) come in.
    """
    m, q = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("n", "n_other"))
    spot = lambda of: F.pmod(F.xxhash64("doc_id", F.lit("spot")), of.cast("long")).cast("int")
    all_ = lambda of: F.explode(F.sequence(F.lit(0), of - 1))
    columns = [group, "doc_id", "root"]
    members = rows.select(*columns, spot(m).alias("i"), all_(q).alias("j"), F.lit(False).alias("asks"))
    return members.union(rows.where("root != first").select(*columns, all_(m).alias("i"), spot(q).alias("j"), F.lit(True).alias("asks")))


def _firsts(rows: DataFrame, group: str) -> DataFrame:
    """group, first (its commonest root), n and n_other (members, and those of other roots) of groups with several roots."""
    counts = rows.groupBy(group, "root").agg(F.count(F.lit(1)).alias("c"))
    tops = counts.groupBy(group).agg(F.max_by("root", F.struct("c", -F.col("root"))).alias("first"), F.sum("c").alias("n"), F.max("c").alias("c"))
    return cut(tops.where("n > c").select(group, "first", "n", (F.col("n") - F.col("c")).alias("n_other")), "firsts")


def candidate_forest(shared: DataFrame, sketches: DataFrame, known: DataFrame, least: tuple[int, int] = LEAST) -> DataFrame | None:
    """Links child, parent between the roots of ``known`` (id, component), or single documents: what bands and sketches connect.

    In a bucket, only members of other roots than its commonest (the others) still have something to say: each is
    compared with every member. None if no bucket has others.
    """
    ship(shared.sparkSession)
    most = most_bits(least[0] / least[1])
    rooted = shared.where("n > 2").select("band", "doc_id").join(known.toDF("doc_id", "root"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    rooted = cut(rooted, "rooted")
    firsts = _firsts(rooted, "band")
    if firsts.isEmpty():
        return None
    met = attach(rooted, firsts, ["band"], "doc_id", whole=SMALL).where("n is not null")
    dealt = _meetings(met, "band").join(sketches, "doc_id").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")

    def run(batches):
        told = Forest()
        for table, edges in whole_runs(batches, ["band", "i", "j"]):
            root, asks = (table.column(c).to_numpy() for c in ("root", "asks"))
            sketch = _sketch_rows(table.column("sketch"))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                left, right = a + np.flatnonzero(~asks[a:b]), a + np.flatnonzero(asks[a:b])
                if not len(left) or not len(right):
                    continue
                x, y = close_pairs(sketch[left], sketch[right], most)
                p, q = root[left[x]], root[right[y]]
                apart = p != q
                for e in zip(p[apart].tolist(), q[apart].tolist(), strict=True):
                    told.join(*e)
        yield from told.flat()

    return dealt.mapInArrow(run, "child long, parent long")


def verified_blocks(texts: DataFrame, least: tuple[int, int] = LEAST) -> DataFrame:
    """child, parent: the smallest document that links, checked on full sets, connect each one of a block with, if not itself.

    ``texts`` has doc_id, text, cluster, n. A cluster is cut into blocks of about BLOCK documents, each with the
    cluster's smallest document besides: a text is sent once, and a cluster of one block is done. As no other document
    is in two blocks, and the smallest is nobody's child, a child comes once and its parent is nobody's child.
    """
    ship(texts.sparkSession)
    most = most_bits(least[0] / least[1])
    m = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("doc_id", F.lit("block")), m.cast("long")).cast("int")
    block = F.when(F.col("doc_id") == F.col("cluster"), F.sequence(F.lit(0), m - 1)).otherwise(F.array(own))
    dealt = texts.select("doc_id", "text", "cluster", F.explode(block).alias("block")).repartition("cluster", "block").sortWithinPartitions("cluster", "block", "doc_id")

    def run(batches):
        told = Forest()
        for table, edges in whole_runs(batches, ["cluster", "block"], rows=512):
            ids, texts = table.column("doc_id").to_numpy(), table.column("text")
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if b - a < 2:
                    continue
                sets = shingle_sets([t or b"" for t in texts.slice(a, b - a).cast(pa.binary()).to_pylist()])
                x, y = close_pairs(odd_sketches(minhashes(sets)), None, most)
                for p, q in zip(x.tolist(), y.tolist(), strict=True):
                    u, v = int(ids[a + p]), int(ids[a + q])
                    if told.root(u) != told.root(v) and similar(sets[p], sets[q], least):
                        told.join(u, v)
        yield from told.flat()

    return cut(dealt.mapInArrow(run, "child long, parent long"), "blocks")


def verified_rest(texts: DataFrame, sized: DataFrame, known: DataFrame, least: tuple[int, int] = LEAST) -> DataFrame | None:
    """Links child, parent, checked on full sets, between the roots that ``known`` (id, component) leaves apart in clusters of several blocks.

    Only documents outside the largest component of their cluster ask, each every member. The sets of hashes travel,
    made once a document. None if nothing is left apart; ``sized`` is ``texts`` without the texts.
    """
    ship(texts.sparkSession)
    most = most_bits(least[0] / least[1])
    large = sized.where(F.col("n") > BLOCK).select("doc_id", "cluster").join(known.toDF("doc_id", "root"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    large = cut(large, "large-clusters")
    firsts = _firsts(large, "cluster")
    if firsts.isEmpty():
        return None
    met = cut(attach(large, firsts, ["cluster"], "doc_id", whole=SMALL).where("n is not null"), "left-apart")

    def hashed(batches):
        for batch in batches:
            for a, b in slices(batch):
                rows = batch.slice(a, b - a)
                sets = shingle_sets([t or b"" for t in rows.column("text").cast(pa.binary()).to_pylist()])
                sketch = odd_sketches(minhashes(sets))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary()), _sketch_column(sketch)], names=["doc_id", "hashes", "sketch"])

    sets = texts.select("doc_id", "text").join(light(met.select("doc_id")), "doc_id", "left_semi").mapInArrow(hashed, "doc_id long, hashes binary, sketch array<long>")
    dealt = _meetings(met, "cluster").join(cut(sets, "sets"), "doc_id").repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")

    def run(batches):
        told = Forest()
        for table, edges in whole_runs(batches, ["cluster", "i", "j"], rows=512):
            root, asks = (table.column(c).to_numpy() for c in ("root", "asks"))
            sketch, hashes = _sketch_rows(table.column("sketch")), table.column("hashes")
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                left, right = a + np.flatnonzero(~asks[a:b]), a + np.flatnonzero(asks[a:b])
                if not len(left) or not len(right):
                    continue
                sets = [np.frombuffer(h, np.uint64) for h in hashes.slice(a, b - a).to_pylist()]
                x, y = close_pairs(sketch[left], sketch[right], most)
                for p, q in zip(left[x].tolist(), right[y].tolist(), strict=True):
                    u, v = int(root[p]), int(root[q])
                    if told.root(u) != told.root(v) and similar(sets[p - a], sets[q - a], least):
                        told.join(u, v)
        yield from told.flat()

    return dealt.mapInArrow(run, "child long, parent long")


def _same_document(some: DataFrame, reps: DataFrame) -> DataFrame | None:
    """Links doc_id, rep between the classes of documents that come with several texts: rows of one doc_id are one vertex. None if none do."""
    several = some.groupBy("doc_id").agg(*(f(c).alias(f"{c}_{f.__name__}") for c in ("d1", "d2") for f in (F.min, F.max))).where("d1_min != d1_max or d2_min != d2_max").select("doc_id")
    if several.isEmpty():
        return None
    several = cut(several, "several-texts")
    of = some.select("doc_id", "d1", "d2").join(light(several), "doc_id", "left_semi").distinct().join(reps.select("d1", "d2", F.col("doc_id").alias("rep")), ["d1", "d2"])
    return of.select("doc_id", "rep")


def _union(links: DataFrame, *more: DataFrame | None) -> DataFrame:
    for x in more:
        links = links if x is None else links.union(x)
    return links


def near_duplicates(docs: DataFrame, least: tuple[int, int] = LEAST) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text)."""
    signed = signatures(docs)
    some = signed.where("n_shingles > 0 and doc_id is not null")
    # classes of several rows; first is a row of the smallest document, which may come several times with one text
    copied = some.groupBy("d1", "d2").agg(F.min_by("row", "doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    reps = attach(some.select("doc_id", "d1", "d2", "bands", "sketch", "row"), cut(copied, "copied"), ["d1", "d2"], "doc_id", whole=SMALL)
    reps = cut(reps.where("first is null or row = first").select("doc_id", "d1", "d2", "n", "bands", "sketch"), "representatives")
    shared, sketches = buckets(reps), reps.select("doc_id", "sketch")
    stars = star_links(shared, sketches, least)
    links = stars.select("child", F.explode("parents").alias("parent"))
    clusters = components(_union(links, candidate_forest(shared, sketches, star_roots(stars), least)), few=True).toDF("doc_id", "cluster")
    # the smallest of a cluster isn't among its children
    sizes = cut(clusters.groupBy("cluster").agg((F.count(F.lit(1)) + 1).alias("n")), "sizes")
    sized = attach(clusters, sizes, ["cluster"], "doc_id", whole=SMALL).union(sizes.select("cluster", "cluster", "n"))
    sized = cut(sized, "sized")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(light(sized), "doc_id")
    linked = verified_blocks(texts, least)
    rest, same = verified_rest(texts, sized, linked, least), _same_document(some, reps)
    if same is not None:
        linked = components(_union(linked, rest, same)).toDF("child", "parent")
    elif rest is not None:
        # its links are between roots, so that both together are a forest
        linked = linked.union(components(rest, few=True))
        linked = linked if (up := lifted(linked)) is None else up
    placed = reps.select("doc_id", "d1", "d2", "n").join(linked.toDF("doc_id", "component"), "doc_id", "left").where("n is not null or component is not null")
    placed = cut(placed.select("d1", "d2", F.coalesce("component", "doc_id").alias("component"), F.coalesce("n", F.lit(1)).alias("n")), "placed")
    out = attach(some.select("doc_id", "n_shingles", "d1", "d2"), placed, ["d1", "d2"], "doc_id", whole=SMALL)
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    bare = signed.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.union(bare).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, least: tuple[int, int] = LEAST) -> DataFrame:
    """The rows of ``docs`` of which the document of its group with the smallest doc_id stays; all columns."""
    gone = cut(near_duplicates(docs, least).where("not kept").select("doc_id"), "gone")
    return docs.join(light(gone), "doc_id", "left_anti").select(*docs.columns)
