"""Cross-entropy difference: two matched bigram models score each document by its loss under either.

Both models share one vocabulary and one smoothing. The target model counts the documents of the target, the background
model counts all documents; what is scored leaves its own bigrams and contexts out of both:

    P1(w)   = (c(w) + 1) / (N + V)
    P(w|v)  = (c(v, w) + K * P1(w)) / (c(v) + K)

where c(v) counts v as a context; a document starts with a context of its own. A document's score is the mean over its
tokens of -ln P_target + ln P_background: the lower, the more it is like the target. A document that the corpus holds a
second time is foreseen by the background model, and stands apart.

Every bigram and every context of the corpus is counted by itself, so that the models grow with the corpus; only the
smoothing's c(w) has SLOTS hashed slots (V is the number of those in use, and one), an array of a fixed size that tasks
hold. Bigrams, and contexts, that make up a share of HOT_SHARE of all tokens are found first, as they must have half that
share in some piece of the corpus; there are 2 / HOT_SHARE of each at most, their counts go to the tasks, and documents
look them up where they are. All other bigrams are dealt into buckets of about BUCKET_TOKENS: by a hash of the context,
so that a bucket has all bigrams of a context and their sum is c(v), or, if the context is hot, by a hash of the bigram. A
task counts its bigrams and contexts and tells each document's part of the loss. Pieces of texts travel to the buckets and
back as arrays, a row for each piece and bucket, and a piece's parts are summed for its documents. Within a bucket
contexts and words go by 32 bits of their hashes each.

Pieces are cut anew when a task runs again. So rows that a shuffle, or anything else without a fixed order, has made are
written to the shared folder first.

Words are runs of characters other than white space (\\x20, \\x09-\\x0D), A-Z in lower case. Losses are summed in whole
units, so that their order changes nothing. Defined results: a null, empty or blank text has no tokens and losses and
score 0; without any target document the target model is its smoothing; repeated rows get the same result, and each
leaves only its own counts out; an empty table gives an empty result; other columns are ignored; texts of any length are
counted and scored whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .components import whole_runs
from .minhash_dedup import hashed_words, mix
from .quality import marked
from .shared import BROADCAST_IDS, cut, ship
from .tokens import slices

SLOTS = 1 << 20
HOT_SHARE = 2**-14
BUCKET_TOKENS = 2_000_000
K = 20.0
#: Units of a nat in which losses are summed.
UNIT = 1 << 24
#: Characters of texts that are counted or scored together.
PIECE = 2 << 20
_START = np.uint64(0xA0761D6478BD642F)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)


class Tokens:
    """The tokens of some texts: row, w (slot of the word), v (hash of the word before, or of a start), pair (32 bits of v and of the word)."""

    def __init__(self, texts: pa.Array):
        h, ends = hashed_words([t or b"" for t in texts.cast(pa.binary()).to_pylist()])
        self.n = np.diff(ends, prepend=0)
        self.row = np.repeat(np.arange(len(self.n)), self.n)
        before = np.empty_like(h)
        before[1:] = h[:-1]
        before[(ends - self.n)[self.n > 0]] = _START
        self.w = (h >> np.uint64(44)).astype(np.int64)
        with np.errstate(over="ignore"):
            self.v = mix(before * _BASE)
        self.pair = self.v & ~_LOW | h >> np.uint64(32)


def _slot(pair: np.ndarray) -> np.ndarray:
    """The slot of a pair's word."""
    return ((pair & _LOW) >> np.uint64(12)).astype(np.int64)


def _others(key: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The sums of ``own`` by key, without each one's own."""
    _, of = np.unique(key, return_inverse=True)
    return np.stack([np.bincount(of, weights=x)[of] for x in own]) - own


def _by_row(row: np.ndarray, key: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A token of each distinct (row, key), in that order, and how often it occurs (the sum of ``n``)."""
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    at = np.flatnonzero(new)
    return order[at], np.diff(at, append=len(row)) if n is None else np.add.reduceat(n[order], at) if len(at) else n[:0]


@dataclass
class Model:
    """Of the target and of the background (rows): all tokens, K * P1 by the word's slot, and the hot contexts and bigrams,
    sorted, with their counts. About 10 MB."""

    tokens: tuple[int, int]
    base: np.ndarray
    hot_v: np.ndarray
    of_v: np.ndarray
    hot: np.ndarray
    of_hot: np.ndarray

    @classmethod
    def of(cls, words: np.ndarray, *hot: np.ndarray) -> Model:
        """From counts of words by slot, and what is hot."""
        n = words.sum(axis=1, keepdims=True)
        base = (K * (words + 1) / (n + np.count_nonzero(words[1]) + 1)).astype(np.float32)
        return cls(tuple(n[:, 0].tolist()), base, *hot)

    def seen(self, counts: np.ndarray, pair: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The loss, in units, of bigrams (n of each) that are counted so often besides, but for their contexts."""
        return np.rint(-UNIT * n * np.log(counts + self.base[:, _slot(pair)].astype(np.float64)))


def _context(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The loss, in units, by contexts (n of each) that are counted so often besides."""
    return np.rint(UNIT * n * np.log(counts + K))


def _pieces(batches):
    for batch in batches:
        for a, b in slices(batch, PIECE):
            yield batch.slice(a, b - a)


def _good(part: pa.RecordBatch) -> np.ndarray:
    return part.column("good").to_numpy(zero_copy_only=False).astype(np.int64)


def _rows(n: int, **columns):
    """Record batches of equal columns, in steps."""
    for s in range(0, n, 65536):
        yield pa.RecordBatch.from_arrays([pa.array(c[s : s + 65536]) for c in columns.values()], names=list(columns))


def fit(docs: DataFrame, target: DataFrame, limit: int = BROADCAST_IDS) -> tuple[DataFrame, Model]:
    """The rows (doc_id, text, good) and the model. ``target`` has the doc_id of the target's documents.

    Up to ``limit`` target ids are broadcast; with more, the join shuffles. The driver gets the slots in use and what is
    hot: SLOTS + 8 / HOT_SHARE rows at most.
    """
    ship(docs.sparkSession)
    spark = docs.sparkSession
    rows = marked(docs, target, limit).select("doc_id", "text", F.col("good").isNotNull().alias("good"))
    if rows._jdf.queryExecution().toRdd().outputDeterministicLevel().toString() != "DETERMINATE":
        rows = cut(rows, "lm-rows")

    def count(batches):
        sums = np.zeros((2, SLOTS), np.int64)
        for part in _pieces(batches):
            t = Tokens(part.column("text"))
            good = np.repeat(_good(part), t.n).astype(bool)
            sums[0] += np.bincount(t.w[good], minlength=SLOTS)
            sums[1] += np.bincount(t.w, minlength=SLOTS)
            for kind, keys in ((1, t.v), (2, t.pair)):
                key, n = np.unique(keys, return_counts=True)
                some = n >= len(keys) * HOT_SHARE / 2
                yield from _rows(int(some.sum()), kind=np.full(some.sum(), kind, np.int32), at=key[some].view(np.int64), target=np.zeros(some.sum(), np.int64), background=n[some])
        at = np.flatnonzero(sums[1])
        yield from _rows(len(at), kind=np.zeros(len(at), np.int32), at=at, target=sums[0, at], background=sums[1, at])

    told = rows.mapInArrow(count, "kind int, at long, target long, background long").groupBy("kind", "at").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))
    told = cut(told, "lm-counts")
    slots = np.zeros((2, SLOTS), np.int64)
    found = told.where("kind = 0").toArrow()
    for m, name in enumerate(("target", "background")):
        slots[m, found.column("at").to_numpy()] = found.column(name).to_numpy()
    least = int(slots[1].sum()) * HOT_SHARE / 2
    some = told.where((F.col("kind") > 0) & (F.col("background") >= least)).select("kind", "at").toArrow()
    kind, at = some.column("kind").to_numpy(), some.column("at").to_numpy()
    hot = [np.sort(at[kind == k].view(np.uint64)) for k in (1, 2)]
    handle = spark.sparkContext.broadcast(hot)

    def count_hot(batches):
        sums = [np.zeros((2, len(x)), np.int64) for x in handle.value]
        for part in _pieces(batches):
            t = Tokens(part.column("text"))
            good = np.repeat(_good(part), t.n).astype(bool)
            for own, keys, s in zip(handle.value, (t.v, t.pair), sums, strict=True):
                at, known = _find(own, keys)
                s[0] += np.bincount(at[known & good], minlength=len(own))
                s[1] += np.bincount(at[known], minlength=len(own))
        for k, s in enumerate(sums):
            at = np.flatnonzero(s[1])
            yield from _rows(len(at), kind=np.full(len(at), k, np.int32), at=at, target=s[0, at], background=s[1, at])

    counts = [np.zeros((2, len(x)), np.int64) for x in hot]
    if any(map(len, hot)):
        exact = rows.mapInArrow(count_hot, "kind int, at long, target long, background long").groupBy("kind", "at").agg(F.sum("target").alias("target"), F.sum("background").alias("background")).toArrow()
        kind, at = exact.column("kind").to_numpy(), exact.column("at").to_numpy()
        for k, own in enumerate(counts):
            for m, name in enumerate(("target", "background")):
                own[m, at[kind == k]] = exact.column(name).to_numpy()[kind == k]
    return rows, Model.of(slots, hot[0], counts[0], hot[1], counts[1])


def _find(hot: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs among the hot ones, and whether they are there."""
    if not len(hot):
        return np.zeros(len(pair), np.int64), np.zeros(len(pair), bool)
    at = np.minimum(np.searchsorted(hot, pair), len(hot) - 1)
    return at, hot[at] == pair


def _labels(spark: SparkSession, n: int) -> np.ndarray:
    """A number for each of n buckets such that dealing by it gives every bucket a partition of its own."""
    at = F.pmod(F.hash(F.col("id").cast("int")), F.lit(n))
    found = spark.range(n * (20 + 2 * n.bit_length())).groupBy(at.alias("at")).agg(F.min("id").cast("int").alias("label"))
    return np.array([r["label"] for r in found.orderBy("at").collect()], np.int32)  # as many as tasks


def _dealt(rows: DataFrame, model: Broadcast, labels: np.ndarray) -> DataFrame:
    """For each piece of texts and bucket its documents' bigrams that aren't hot; and once a piece what is known of its
    documents already: their ids, numbers of tokens and losses by contexts and hot bigrams, and how many buckets it has.

    Columns: bucket, piece; pair, at, n (by bigram: hashes, step to the next document's place in the piece, four times how often, and two
    if its context is hot, and one if the target has the document) as little-endian numbers; ids, size, target, background, buckets, of the second sort of rows.
    """
    key = rows.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("piece", T.LongType()), *[T.StructField(c, T.BinaryType()) for c in ("pair", "at", "n")], *_known(key)])
    types = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches):
        m, task = model.value, TaskContext.get().partitionId()
        for number, part in enumerate(_pieces(batches)):
            t, good, docs = Tokens(part.column("text")), _good(part), part.num_rows
            piece = task << 31 | number
            lost = np.zeros((2, docs))

            def add(rows, losses, lost=lost, docs=docs):
                for k, x in enumerate(losses):
                    lost[k] += np.bincount(rows, weights=x, minlength=docs)

            at, warm = _find(m.hot_v, t.v)
            some = np.flatnonzero(warm)
            first, n = _by_row(t.row[some], at[some])
            first = some[first]
            own = np.stack([n * good[t.row[first]], n])
            add(t.row[first], _context(m.of_v[:, at[first]] - own, n))
            first, n = _by_row(t.row, t.pair)
            rows, pair = t.row[first], t.pair[first]
            at, known = _find(m.hot, pair)
            known &= warm[first]  # a hot bigram's context is hot
            own = np.stack([n * good[rows], n])[:, known]
            add(rows[known], m.seen(m.of_hot[:, at[known]] - own, pair[known], n[known]))
            first, rows, pair, n = first[~known], rows[~known], pair[~known], n[~known]
            by = np.where(warm[first], mix(pair), t.v[first]) & _LOW
            bucket = labels[(by % np.uint64(len(labels))).astype(np.int64)]
            order = np.argsort(bucket, kind="stable")
            first, rows, pair, bucket = first[order], rows[order], pair[order], bucket[order]
            n = (4 * n[order] + 2 * warm[first] + good[rows]).astype("<u4")
            edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]) if len(bucket) else np.zeros(1, np.int64)
            out = [(int(bucket[a]), piece, pair[a:b].tobytes(), np.diff(rows[a:b], prepend=0).astype("<u4").tobytes(), n[a:b].tobytes()) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            for s in range(0, len(out), 256):
                columns = list(zip(*out[s : s + 256], strict=True))
                yield pa.RecordBatch.from_arrays([*[pa.array(c, f) for c, f in zip(columns, types, strict=False)], *[pa.nulls(len(columns[0]), f) for f in types[5:]]], names=schema.names)
            lists = [pa.ListArray.from_arrays(pa.array([0, docs], pa.int32()), c) for c in (part.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in (t.n, *lost)))]
            yield pa.RecordBatch.from_arrays([pa.array([labels[number % len(labels)]], pa.int32()), pa.array([piece], pa.int64()), *[pa.nulls(1, pa.binary())] * 3, *lists, pa.array([len(out)], pa.int32())], names=schema.names)

    return rows.mapInArrow(run, schema)


def _known(key: T.DataType) -> list[T.StructField]:
    return [T.StructField("ids", T.ArrayType(key)), *[T.StructField(c, T.ArrayType(T.LongType())) for c in ("size", "target", "background")], T.StructField("buckets", T.IntegerType())]


def score(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score (nats per token) of every row (doc_id, text, good).

    ``rows`` must come in one order each time they are read, as those of ``fit`` do.
    """
    spark = rows.sparkSession
    ship(spark)
    handle = spark.sparkContext.broadcast(model)
    labels = _labels(spark, max(8, -(-model.tokens[1] // BUCKET_TOKENS)))
    dealt = _dealt(rows, handle, labels).repartition(len(labels), "bucket").sortWithinPartitions("bucket")
    key = rows.schema["doc_id"].dataType
    parts = T.StructType([T.StructField("piece", T.LongType()), *[T.StructField(c, T.BinaryType()) for c in ("at", "lost_target", "lost_background")], *_known(key)])
    types = [to_arrow_type(f.dataType) for f in parts.fields]

    def lose(batches):
        m = handle.value
        for table, edges in whole_runs(batches, ["bucket"], rows=1):
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                part = table.slice(a, b - a)
                whole = part.filter(part.column("ids").is_valid()).combine_chunks()
                for batch in whole.to_batches():
                    yield pa.RecordBatch.from_arrays([batch.column("piece"), *[pa.nulls(batch.num_rows, pa.binary())] * 3, *[batch.column(f.name) for f in _known(key)]], names=parts.names)
                part = part.filter(part.column("pair").is_valid())
                if not part.num_rows:
                    continue
                read = lambda c, kind: [np.frombuffer(x, kind) for x in part.column(c).to_pylist()]  # noqa: B023, E731
                pairs, places = read("pair", np.uint64), [np.cumsum(x.astype(np.int64)) for x in read("at", "<u4")]
                n = np.concatenate(read("n", "<u4")).astype(np.int64)
                good, warm, n = n & 1, n & 2 > 0, n >> 2
                pair = np.concatenate(pairs)
                lost = m.seen(_others(pair, np.stack([n * good, n])), pair, n)
                cool = np.flatnonzero(~warm)
                if len(cool):  # contexts of which all bigrams are here, once for each document
                    docs = np.concatenate([k * np.int64(1 << 32) + p for k, p in enumerate(places)])[cool]
                    v = (pair >> np.uint64(32))[cool]
                    first, many = _by_row(docs, v, n[cool])
                    own = np.stack([many * good[cool[first]], many])
                    lost[:, cool[first]] += _context(_others(v[first], own), many)
                at, out = 0, []
                for piece, place in zip(part.column("piece").to_pylist(), places, strict=True):
                    first = np.flatnonzero(np.diff(place, prepend=-1))  # places come in order
                    sums = np.add.reduceat(lost[:, at : at + len(place)], first, axis=1).astype(np.int64)
                    out.append((piece, place[first].astype("<u4").tobytes(), sums[0].tobytes(), sums[1].tobytes()))
                    at += len(place)
                for s in range(0, len(out), 256):
                    columns = list(zip(*out[s : s + 256], strict=True))
                    yield pa.RecordBatch.from_arrays([*[pa.array(c, f) for c, f in zip(columns, types, strict=False)], *[pa.nulls(len(columns[0]), f) for f in types[4:]]], names=parts.names)

    names = ["doc_id", "n", "target", "background"]

    def gather(batches):
        for table, edges in whole_runs(batches, ["piece"], rows=1):
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                part = table.slice(a, b - a)
                whole = part.filter(part.column("ids").is_valid()).combine_chunks()
                told = part.filter(part.column("at").is_valid())
                if whole.num_rows != 1 or told.num_rows != whole.column("buckets")[0].as_py():
                    raise RuntimeError("the documents came in another order when a task ran again")  # rows are stored where that can be
                lost = [whole.column(c)[0].values.to_numpy().copy() for c in ("target", "background")]
                for places, *sums in zip(*(told.column(c).to_pylist() for c in ("at", "lost_target", "lost_background")), strict=True):
                    at = np.frombuffer(places, "<u4")
                    for total, x in zip(lost, sums, strict=True):
                        total[at] += np.frombuffer(x, np.int64)
                yield pa.RecordBatch.from_arrays([whole.column("ids")[0].values, whole.column("size")[0].values, *map(pa.array, lost)], names=names)

    told = dealt.mapInArrow(lose, parts).repartition("piece").sortWithinPartitions("piece")
    sums = told.mapInArrow(gather, f"doc_id {key.simpleString()}, n long, target long, background long")
    loss = lambda c: F.when(F.col("n") > 0, F.round(c / UNIT / F.col("n"), 6)).otherwise(0.0)
    target, background = F.col("target"), F.col("background")
    return sums.select("doc_id", F.col("n").alias("n_tokens"), loss(target).alias("target_loss"), loss(background).alias("background_loss"), loss(target - background).alias("score"))


def cross_entropy_difference(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of every document; the target is the documents that ``labels`` gives quality 1."""
    return score(*fit(docs, labels.where("quality = 1")))
