"""Language identification by bit-sliced Bloom filters over character n-grams.

One array of bit masks holds a Bloom filter for each language: bit l of a mask belongs to language l. An n-gram has
HASHES places in the array; the AND of the masks there is the set of all languages that contain it, one, several or none.
A text's n-grams are looked up; the population count of each language's bit, less the hits that a filter of its fill
would give by chance, is the share of the text's n-grams that the language has. The largest share wins and is the score.

A language has the n-grams that occur at least LEAST_SEEN times in its texts; n-grams that languages share are in the filter
of each, and what tells them apart are the counts. They are counted in a bounded sample of labelled texts, PER_LANGUAGE for
each language in expectation, chosen by a hash of the id; whole texts are counted and whole texts predicted. A language is
learned from LEAST_DOCS labelled documents on, whatever its share; more than MOST_LANGUAGES such tags are refused, as the
masks have a bit for each. A and Z count as a and z; digits and punctuation count as spaces.

Defined results: a null text, or one without letters, is ``und`` with score 0; so is any text if nothing was learned;
ties, no known n-gram at all among them, go to the language that comes first by name; repeated rows get the same
result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, ship
from .tokens import slices

NGRAMS = (1, 2, 3, 4)
PER_LANGUAGE = 1500
LEAST_SEEN = 3
#: Labelled documents that a language is learned from at least; languages at most.
LEAST_DOCS, MOST_LANGUAGES = 3, 1024
HASHES = 2
#: Masks for each n-gram of the largest language (at the next power of two), and masks at least and at most.
PER_GRAM, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 24
#: Bytes that all masks may have together: they are sent to every executor. Masks of one block of the array.
MOST_BYTES, BLOCK = 1 << 27, 1 << 14
#: Bytes of texts that are hashed together.
SLICE = 100_000
UNKNOWN = "und"
#: A corpus keeps texts whose score reaches this.
LEAST_SCORE = 0.5
#: By code point: 2 for a letter, 1 for a mark. Made once by each process.
_kinds: list[np.ndarray] = []


def _kind_of() -> np.ndarray:
    if not _kinds:
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        at = lambda i: i + (i >= 0xD800) * 0x800  # noqa: E731  surrogates aren't in texts
        kinds = np.zeros(0x110000, np.uint8)
        for value, pattern in ((2, r"\p{L}+"), (1, r"\p{M}+")):
            for m in regex.finditer(pattern, every):
                kinds[at(m.start()) : at(m.end() - 1) + 1] = value
        _kinds.append(kinds)
    return _kinds[0]


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def ngram_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all n-grams of some texts, the text (its number) of each, and whether a text has a letter.

    A text counts in lower case, with a space before, between and after its words; several n together.
    """
    low = [t.lower() for t in texts]
    sizes = np.fromiter(map(len, low), np.int64, len(low))
    c = np.frombuffer("".join(low).encode("utf-32-le"), "<u4")
    kind, own = _kind_of()[c], np.repeat(np.arange(len(low)), sizes)
    at = np.flatnonzero(kind)
    c, own, kind = c[at].astype(np.uint64), own[at], kind[at]
    letters = np.bincount(own, kind == 2, len(low)) > 0
    begins = np.ones(len(at), bool)
    begins[1:] = (np.diff(at) > 1) | (np.diff(own) > 0)
    ends = np.ones(len(at), bool)
    ends[:-1] = np.diff(own) > 0
    size = 1 + begins + ends
    first = np.cumsum(size) - size
    plain = np.full(int(size.sum()), 32, np.uint64)
    plain[first + begins] = c
    own = np.repeat(own, size)
    out, of, h = [], [], np.zeros(len(plain), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, max(NGRAMS) + 1):
            m = len(plain) - n + 1
            if m <= 0:
                break
            h = h[:m] * np.uint64(0x9E3779B97F4A7C15) + plain[n - 1 : n - 1 + m] + np.uint64(1)
            if n in NGRAMS:
                good = own[:m] == own[n - 1 : n - 1 + m]
                if n == 1:
                    good &= plain != 32  # a space alone is no n-gram
                out.append(_mix(h[good]))
                of.append(own[:m][good])
    return (np.concatenate(out), np.concatenate(of), letters) if out else (np.empty(0, np.uint64), np.empty(0, np.int64), letters)


def places(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """HASHES places of each hash in an array of ``bits`` masks."""
    low, high = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32) | np.uint64(1)
    within = (lambda x: x & np.uint64(bits - 1)) if bits & (bits - 1) == 0 else (lambda x: x % np.uint64(bits))
    return [within(low + np.uint64(k) * high if k else low).view(np.int64) for k in range(HASHES)]


def mask_type(languages: int):
    return next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if languages <= np.dtype(t).itemsize * 8)


class Filters:
    """The learned languages and their bit-sliced Bloom filters: arrays of masks, each for 64 languages at most."""

    def __init__(self, languages: list[str], planes: list[np.ndarray]):
        self.languages, self.planes, fill = languages, [], []
        self.bits = len(planes[0]) if planes else 1
        for at, masks in zip(range(0, len(languages), 64), planes, strict=True):
            n = min(64, len(languages) - at)
            masks = masks.astype(mask_type(n))
            self.planes.append((n, masks))
            fill += [np.count_nonzero(masks & masks.dtype.type(1 << k)) / self.bits for k in range(n)]
        self.chance = np.array(fill) ** HASHES

    @classmethod
    def of(cls, grams: dict[str, np.ndarray], bits: int) -> Filters:
        """Filters of the given n-gram hashes by language."""
        names = sorted(grams)
        planes = [np.zeros(bits, np.uint64) for _ in range(0, len(names), 64)]
        for k, name in enumerate(names):
            for p in places(grams[name], bits):
                planes[k // 64][p] |= np.uint64(1 << (k % 64))
        return cls(names, planes)

    def masks(self, h: np.ndarray) -> list[np.ndarray]:
        """For each plane of 64 languages, the mask of those that contain each hash."""
        spots, found = places(h, self.bits), []
        for _, masks in self.planes:
            both = masks[spots[0]]
            for p in spots[1:]:
                both &= masks[p]
            found.append(both)
        return found

    def votes(self, h: np.ndarray, of: np.ndarray, texts: int) -> np.ndarray:
        """For each of some texts and each language, the corrected share of the text's n-grams (``h``, of text ``of``) that the filter holds."""
        hits = []
        for (n, masks), both in zip(self.planes, self.masks(h), strict=True):
            if n <= 8:  # by text and mask
                seen = np.bincount(of << n | both, minlength=texts << n).reshape(texts, 1 << n)
                hits += [seen[:, (np.arange(1 << n) >> k) & 1 == 1].sum(axis=1) for k in range(n)]
            else:
                hits += [np.bincount(of[both & masks.dtype.type(1 << k) > 0], minlength=texts) for k in range(n)]
        share = np.array(hits).T / np.maximum(np.bincount(of, minlength=texts), 1)[:, None]
        return np.maximum(0.0, (share - self.chance) / np.maximum(1 - self.chance, 1e-9))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language and score of each text."""
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        at = [i for i, t in enumerate(texts) if t]
        if not at or not self.languages:
            return names, scores
        h, of, letters = ngram_hashes([texts[i] for i in at])
        v = self.votes(h, of, len(at))
        best = np.argmax(v, axis=1)
        for j in np.flatnonzero(letters).tolist():
            names[at[j]], scores[at[j]] = self.languages[best[j]], v[j, best[j]]
        return names, scores


def held_out(doc_id):
    """Column: whether a document is kept from learning."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4).cast("long")) == 2, F.lit(False))


def grams_of(docs: DataFrame, per_language: int = PER_LANGUAGE, least_docs: int = LEAST_DOCS) -> tuple[list[str], DataFrame]:
    """The languages learned, by name, and a table k (place of the language), gram (hash) of all that they contain."""
    ship(docs.sparkSession)
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = cut(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_docs), "language-sizes")
    known = sorted((r["lang"], r["n"]) for r in sizes.limit(MOST_LANGUAGES + 1).collect())
    if len(known) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages have {least_docs} labelled documents; raise least_docs or mend the tags")
    limits = [(name, k, int((1 << 30) * min(1.0, per_language / n)) + 1) for k, (name, n) in enumerate(known)]
    chosen = F.broadcast(spark.createDataFrame(limits, "lang string, k int, below int"))  # MOST_LANGUAGES rows at most
    sample = rows.join(chosen, "lang").where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < F.col("below")).select("k", "text")

    def count(batches):
        for batch in batches:
            for a, b in slices(batch, SLICE):
                part = batch.slice(a, b - a)
                h, of, _ = ngram_hashes(part.column("text").to_pylist())
                own = part.column("k").to_numpy()[of]
                for k in np.unique(own):
                    u, n = np.unique(h[own == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), k, np.int32)), pa.array(u.view(np.int64)), pa.array(n.astype(np.int64))], names=["k", "gram", "n"])

    counts = sample.mapInArrow(count, "k int, gram long, n long").groupBy("gram", "k").agg(F.sum("n").alias("n"))
    return [name for name, _ in known], cut(counts.where(F.col("n") >= LEAST_SEEN).select("k", "gram"), "language-filters")


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, bits: int | None = None, least_docs: int = LEAST_DOCS) -> Filters:
    """Learns from rows of ``docs`` (doc_id, text, lang) whose text and lang aren't null and that aren't held out.

    Masks are put together in Spark, in blocks of BLOCK; the driver gets the blocks that aren't empty as bytes, as it has to
    broadcast them: MOST_BYTES altogether at most. Without ``bits`` the arrays are sized by the language with the most
    n-grams; the chance hits of a filter that is fuller are corrected for as ever.
    """
    names, grams = grams_of(docs, per_language, least_docs)
    planes, kind = -(-len(names) // 64), mask_type(min(len(names), 64))
    if bits is None:
        most = grams.groupBy("k").count().agg(F.max("count")).first()[0] or 1
        room = MOST_BYTES // (max(planes, 1) * np.dtype(kind).itemsize)
        bits = min(MOST_BITS, 1 << (room.bit_length() - 1), max(LEAST_BITS, 1 << (PER_GRAM * most - 1).bit_length()))

    def spread(batches):
        for batch in batches:
            k, h = batch.column("k").to_numpy(), batch.column("gram").to_numpy().view(np.uint64)
            mask = (np.uint64(1) << (k % 64).astype(np.uint64)).view(np.int64)
            for p in places(h, bits):
                yield pa.RecordBatch.from_arrays([pa.array((k // 64).astype(np.int32)), pa.array(p), pa.array(mask)], names=["plane", "place", "mask"])

    def pack(batches):
        for batch in batches:
            out = []
            for at, masks in zip(batch.column("at").to_pylist(), batch.column("masks").to_pylist(), strict=True):
                block = np.zeros(BLOCK, np.uint64)
                block[at] = np.array(masks, np.int64).view(np.uint64)
                out.append(block.astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("plane"), batch.column("block"), pa.array(out, pa.binary())], names=["plane", "block", "bytes"])

    told = grams.mapInArrow(spread, "plane int, place long, mask long").groupBy("plane", "place").agg(F.bit_or("mask").alias("mask"))
    pairs = told.groupBy("plane", F.expr(f"place div {BLOCK}").alias("block")).agg(F.collect_list(F.struct((F.col("place") % BLOCK).alias("at"), "mask")).alias("x"))  # BLOCK at most
    blocks = pairs.select("plane", "block", F.col("x.at").alias("at"), F.col("x.mask").alias("masks")).mapInArrow(pack, "plane int, block long, bytes binary").toArrow()
    arrays = [np.zeros(-(-bits // BLOCK) * BLOCK, kind) for _ in range(planes)]
    for plane, block, raw in zip(*[blocks.column(c).to_pylist() for c in ("plane", "block", "bytes")], strict=True):
        arrays[plane][block * BLOCK : (block + 1) * BLOCK] = np.frombuffer(raw, kind)
    return Filters(names, [a[:bits] for a in arrays])


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text). The filters travel with the tasks."""
    ship(docs.sparkSession)
    handle = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        f = handle.value
        for batch in batches:
            for a, b in slices(batch, SLICE):
                rows = batch.slice(a, b - a)
                names, scores = f.predict(rows.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("held_out"), pa.array(names, pa.string()), pa.array(scores)],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs))


def accepted(docs: DataFrame, filters: Filters, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs``, all columns, in a learned language with at least this score."""
    ship(docs.sparkSession)
    handle = docs.sparkSession.sparkContext.broadcast(filters)

    @F.pandas_udf("boolean")
    def known(text: pd.Series) -> pd.Series:
        texts, good = pa.table({"text": pa.array(text, pa.string())}), []
        for a, b in slices(texts, SLICE):
            names, scores = handle.value.predict(texts.column("text").slice(a, b - a).to_pylist())
            good += [name != UNKNOWN and score >= least for name, score in zip(names, scores, strict=True)]
        return pd.Series(good, dtype=bool)

    return docs.where(known("text"))
