"""Token ids in binary shards with a minimal perfect hash index, and keyed access to them.

``write`` puts documents in ascending doc_id order (a range shuffle) and each task streams its rows to shards of a
bounded size. A shard is one file: header, raw ids, then the index: the documents' offsets, and for the shard's
distinct keys a minimal perfect hash (hash and displace) whose slots hold a fingerprint, the key's first document and
how many it has. The manifest has an entry for each shard: its keys' range, documents, ids and the ids before it. It is
made by Spark and lies in parts of GROUP shards; its top, which alone passes the driver, has the range of each part (at
32 MB a shard, 730 entries for 100 TB).

Keyed access: the top gives the part, or parts, of the manifest, a part's ranges the shard, or shards; there one displacement
and one slot give the place of the ids.

Shards have names by partition and number and appear by a rename, so a task that runs again writes the same files.

Defined results: a null or empty text has the end id alone; documents with the same doc_id stand side by side, ordered
by a hash of the text, under one key, in as many shards as they need; a null doc_id is a key, too, and comes first; an
empty table gives a store without shards; other columns are ignored.
"""

from __future__ import annotations

import json
import struct
import zlib
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import cut, ship
from .tokens import encoder, is_narrow, offer, slices

MAGIC = b"IDSHARD1"
#: magic, bytes of an id, keys, documents, ids, buckets of the hash
HEADER = struct.Struct("<8sIIQQQ")
#: Bytes of ids after which a shard is closed.
SHARD_BYTES = 32 << 20
KEYS_PER_BUCKET = 4
#: Shards of one part of the manifest.
GROUP = 4096
_NULL = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser of whole numbers."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def hashed(keys: list[int | None]) -> np.ndarray:
    raw = np.array([0 if k is None else k for k in keys], np.int64).view(np.uint64)
    out = mixed(raw, 1)
    out[[i for i, k in enumerate(keys) if k is None]] = _NULL
    return out


def displaced(h: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    return (mixed(h ^ mixed(d.astype(np.uint64), 7), 3) % np.uint64(n)).astype(np.int64)


def build_index(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements by bucket (int64; -1 - slot for a bucket of one key) and the slot of each of the distinct hashes."""
    n = len(h)
    buckets = max(1, -(-n // KEYS_PER_BUCKET))
    of = (h % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    sizes = np.bincount(of, minlength=buckets)
    starts = np.cumsum(sizes) - sizes
    found, slots, free = np.zeros(buckets, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
    ranked = np.argsort(-sizes, kind="stable")
    for b in ranked:
        size = sizes[b]
        if size < 2:
            break
        keys = order[starts[b] : starts[b] + size]
        at, step = 0, 16
        while True:
            tries = np.arange(at, at + step)
            spots = displaced(h[keys][None, :], tries[:, None], n)
            good = free[spots].all(axis=1)
            for k in np.flatnonzero(good):
                if len(set(spots[k].tolist())) == size:
                    break
            else:
                at, step = at + step, min(step * 2, 4096)
                continue
            found[b], slots[keys] = tries[k], spots[k]
            free[spots[k]] = False
            break
    left = iter(np.flatnonzero(free).tolist())
    for b in ranked[np.count_nonzero(sizes > 1) :]:
        if sizes[b] == 1:
            slot = next(left)
            found[b], slots[order[starts[b]]] = -1 - slot, slot
    return found, slots


def slot_of(h: np.ndarray, displacements: np.ndarray, n: int) -> np.ndarray:
    d = displacements[(h % np.uint64(len(displacements))).astype(np.int64)]
    return np.where(d < 0, -1 - d, displaced(h, np.maximum(d, 0), n))


def fingerprints(h: np.ndarray) -> np.ndarray:
    return (mixed(h, 11) >> np.uint64(32)).astype(np.uint32)


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _save(uri: str, name: str, chunks: list[bytes]) -> None:
    fs, base = _filesystem(uri)
    mark = TaskContext.get().taskAttemptId() if TaskContext.get() else 0
    own = f"{base}/_{mark}-{name}"
    with fs.open_output_stream(own) as out:
        for c in chunks:
            out.write(c)
    fs.move(own, f"{base}/{name}")


def shard_bytes(keys: list[int | None], ids: list[bytes], width: int) -> list[bytes]:
    """A shard's file: header, ids of the documents (in order of their keys), index."""
    sizes = np.array([len(x) // width for x in ids], np.uint64)
    ends = np.concatenate([[np.uint64(0)], np.cumsum(sizes, dtype=np.uint64)])
    first = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
    many = np.diff([*first, len(keys)])
    h = hashed([keys[i] for i in first])
    displacements, slots = build_index(h)
    marks, place, count = np.zeros(len(h), "<u4"), np.zeros(len(h), "<u4"), np.zeros(len(h), "<u4")
    marks[slots], place[slots], count[slots] = fingerprints(h), first, many
    head = HEADER.pack(MAGIC, width, len(h), len(keys), int(ends[-1]), len(displacements))
    return [head, *ids, ends.astype("<u8").tobytes(), displacements.astype("<i8").tobytes(), marks.tobytes(), place.tobytes(), count.tobytes()]


class Shard:
    """An open shard: its index in memory, its ids read on demand."""

    def __init__(self, uri: str, name: str):
        fs, base = _filesystem(uri)
        self.file = fs.open_input_file(f"{base}/{name}")
        magic, self.width, self.n_keys, n_docs, n_ids, buckets = HEADER.unpack(self.file.read_at(HEADER.size, 0))
        if magic != MAGIC:
            raise ValueError(f"{name} is no shard of token ids")
        at = HEADER.size + n_ids * self.width
        tail = self.file.read_at(self.file.size() - at, at)
        parts, used = [], 0
        for kind, n in (("<u8", n_docs + 1), ("<i8", buckets), ("<u4", self.n_keys), ("<u4", self.n_keys), ("<u4", self.n_keys)):
            parts.append(np.frombuffer(tail, kind, n, used))
            used += parts[-1].nbytes
        self.ends, self.displacements, self.marks, self.place, self.count = parts

    def find(self, keys: list[int | None]) -> list[tuple[int, int] | None]:
        """First document and number of documents of each key; None for a key whose fingerprint isn't there."""
        if not self.n_keys or not keys:
            return [None] * len(keys)
        h = hashed(keys)
        slots = slot_of(h, self.displacements, self.n_keys)
        same = self.marks[slots] == fingerprints(h)
        return [(p, c) if s else None for p, c, s in zip(self.place[slots].tolist(), self.count[slots].tolist(), same.tolist(), strict=True)]

    def ids(self, doc: int) -> np.ndarray:
        a, b = int(self.ends[doc]), int(self.ends[doc + 1])
        return np.frombuffer(self.file.read_at((b - a) * self.width, HEADER.size + a * self.width), f"<u{self.width}")


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, bytes_per_shard: int = SHARD_BYTES, group: int = GROUP) -> DataFrame:
    """Writes the store to the folder ``path``; returns the shards: name, low, high, n_docs, n_ids, seq, before."""
    ship(docs.sparkSession)
    offer(docs.sparkSession, tokenizer)
    narrow = is_narrow(tokenizer, end_id)
    width = 2 if narrow else 4
    end = int(end_id).to_bytes(width, "little")
    fs, base = _filesystem(path)
    fs.create_dir(base, recursive=True)

    def run(batches):
        encode = encoder(tokenizer, narrow).encode
        part, number, keys, ids, held, made = TaskContext.get().partitionId(), 0, [], [], 0, []

        def close():
            nonlocal number, keys, ids, held
            name = f"shard-{part:06d}-{number:05d}.ids"
            _save(path, name, shard_bytes(keys, ids, width))
            made.append((name, part, number, keys[0], keys[-1], len(keys), sum(map(len, ids)) // width))
            number, keys, ids, held = number + 1, [], [], 0

        for batch in batches:
            for a, b in slices(batch):
                rows = batch.slice(a, b - a)
                for key, x in zip(rows.column("doc_id").to_pylist(), encode([t or "" for t in rows.column("text").to_pylist()]), strict=True):
                    if held >= bytes_per_shard:
                        close()
                    keys.append(key)
                    ids.append(x + end)
                    held += len(x) + width
        if keys:
            close()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), kinds, strict=True)], names=names)

    names = ["name", "part", "number", "low", "high", "n_docs", "n_ids"]
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]  # the hash deals a key of very many documents, too
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(*order).sortWithinPartitions(*order)
    made = cut(rows.mapInArrow(run, "name string, part int, number int, low long, high long, n_docs long, n_ids long"), "shards")
    parts, inside = (w.rowsBetween(Window.unboundedPreceding, -1) for w in (Window.orderBy("part"), Window.partitionBy("part").orderBy("number")))
    before = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    starts = made.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("n_ids").alias("ids"))  # a row for each partition
    starts = starts.select("part", before("n", parts).alias("first"), before("ids", parts).alias("ids"))
    placed = made.withColumn("before", before("n_ids", inside)).join(starts, "part")
    placed = placed.select("name", "low", "high", "n_docs", "n_ids", (F.col("first") + F.col("number")).alias("seq"), (F.col("ids") + F.col("before")).alias("before"))
    placed = cut(placed, "manifest")
    top = _save_manifest(placed, path, group)
    _save(path, "manifest.json", [json.dumps({"width": width, "parts": top}).encode()])
    return placed


def _save_manifest(shards: DataFrame, path: str, group: int) -> list[dict]:
    """Writes the manifest's parts; returns the range of keys and the number of shards of each."""

    def save(batches):
        done, held, at = [], [], -1

        def close():
            if held:
                _save(path, f"manifest-{at:06d}.json", [json.dumps(held).encode()])
                lows, highs = ([-(1 << 63) if r[c] is None else r[c] for r in held] for c in ("low", "high"))
                done.append((at, min(lows), max(highs), len(held)))

        for batch in batches:
            for r in batch.to_pylist():
                if r["part"] != at:
                    close()
                    held, at = [], r["part"]
                held.append({c: r[c] for c in ("name", "low", "high", "before")})
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*done, strict=True)], names=["part", "low", "high", "n"])

    parts = shards.withColumn("part", F.expr(f"seq div {group}")).select("part", "seq", "name", "low", "high", "before").repartition("part").sortWithinPartitions("part", "seq")
    found = parts.mapInArrow(save, "part long, low long, high long, n long").collect()
    return [r.asDict() for r in sorted(found, key=lambda r: r["part"])]


def _json(path: str, name: str):
    fs, base = _filesystem(path)
    with fs.open_input_stream(f"{base}/{name}") as f:
        return json.loads(f.read())


def _routed(keys: list[int | None], lows: list[int], highs: list[int]) -> list[tuple[int | None, int]]:
    """Each key with the ranges, which are in order and may touch, that can hold it."""
    return [(k, s) for k in keys for at in [-(1 << 63) if k is None else k] for s in range(bisect_left(highs, at), bisect_right(lows, at))]


def lookup(spark: SparkSession, path: str, keys: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document in the store with a doc_id of the table ``keys``.

    Keys go to their part of the manifest by its top, to their shard by the part, and each shard is opened once in the task
    that has its keys; there are as many tasks as shards, as what a task reads are its shards' ids, not the few bytes
    of its keys.
    """
    ship(spark)
    top = _json(path, "manifest.json")["parts"]

    def to_parts(batches):
        lows, highs = ([p[c] for p in top] for c in ("low", "high"))
        for batch in batches:
            pairs = _routed(batch.column("doc_id").to_pylist(), lows, highs)
            for i in range(0, len(pairs), 65536):
                columns = zip(*pairs[i : i + 65536], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32()), strict=True)], names=["doc_id", "part"])

    def to_shards(batches):
        at, shards, lows, highs = -1, [], [], []
        for batch in batches:
            number, keys = batch.column("part").to_numpy(), batch.column("doc_id").to_pylist()
            edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(keys)] if len(keys) else []
            for a, b in zip(edges, edges[1:], strict=False):
                if number[a] != at:
                    at = int(number[a])
                    shards = _json(path, f"manifest-{top[at]['part']:06d}.json")
                    lows, highs = ([-(1 << 63) if s[c] is None else s[c] for s in shards] for c in ("low", "high"))
                pairs = _routed(keys[a:b], lows, highs)
                for i in range(0, len(pairs), 65536):
                    some = pairs[i : i + 65536]
                    columns = ([k for k, _ in some], [shards[s]["name"] for _, s in some], [shards[s]["before"] for _, s in some])
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64()), strict=True)], names=["doc_id", "shard", "before"])

    def read(batches):
        opened, at = None, None
        for batch in batches:
            out = []
            names, before, ids = (batch.column(c).to_pylist() for c in ("shard", "before", "doc_id"))
            edges = [0, *[i for i in range(1, len(ids)) if names[i] != names[i - 1]], len(ids)] if ids else []
            for a, b in zip(edges, edges[1:], strict=False):
                if names[a] != at:
                    at = names[a]
                    opened = Shard(path, at)
                for key, hit in zip(ids[a:b], opened.find(ids[a:b]), strict=True):
                    for doc in range(hit[0], sum(hit)) if hit else ():
                        x = opened.ids(doc).astype("<u4").tobytes()
                        out.append((key, before[a] + int(opened.ends[doc]), len(x) // 4, zlib.crc32(x), *[x] * with_ids))
            for i in range(0, len(out), 4096):
                columns = zip(*out[i : i + 4096], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [*[pa.int64()] * 4, pa.binary()], strict=False)], names=schema.names)

    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")] + [T.StructField("ids", T.BinaryType())] * with_ids)
    if not top:
        return spark.createDataFrame([], schema)
    wanted = keys.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().mapInArrow(to_parts, "doc_id long, part int")
    placed = wanted.repartition("part", F.pmod(F.xxhash64("doc_id"), F.lit(16))).sortWithinPartitions("part").mapInArrow(to_shards, "doc_id long, shard string, before long")
    return placed.repartition(sum(p["n"] for p in top), "shard").sortWithinPartitions("shard", "doc_id").mapInArrow(read, schema)
