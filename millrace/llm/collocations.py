"""Phrase collocations per language: phrases of 2 to 5 words whose parts meet more often than chance would have them.

1. Texts are cut into pieces; identical pieces become one row with a multiplicity.
2. n-grams are counted by weight. Tasks over the pieces add up what they hold (in slices of SLICE words) and deal the sums
   by a hash of the n-gram; each bucket is counted out-of-core by DuckDB. A phrase that counts has only words and
   neighbours that count, so words go first, then pairs of frequent words, then runs of frequent pairs. What is frequent
   is told to the tasks by a bitmap of fixed size (``SLOTS`` bits); two n-grams in one slot cost a needless count, never
   a wrong one, so results don't depend on its size.
3. The counts of a phrase's parts are asked for by shuffled requests, which are answered where the part's count lies.

Defined results: a null text counts as empty, a null language as ``und``; repeated rows count as often as they are there; an
empty table gives an empty result; other columns are ignored. All arithmetic is exact (128 bits and more).
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import attach, cut, light, ship

LEAST, LONGEST, TOP, UNIT = 100, 5, 2000, 1000
#: Words of one slice that a task adds up before it deals them, bits of the bitmap, words of a bucket in the mean.
SLICE, SLOTS, BUCKET_WORDS = 2_000_000, 1 << 27, 8_000_000
MEMORY = "256MB"

_GRAMS = "lang string, gram string, k int, m long"
_COUNTED = "lang string, gram string, k int, f long, slot long"


def pieces(docs: DataFrame) -> DataFrame:
    """Distinct pieces: lang, piece (words with a space between), m (how often it is there)."""
    ship(docs.sparkSession)
    text = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    each = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.explode(F.split(text, r"[.,;:!?\x0A-\x0D]")).alias("piece"))
    plain = each.select("lang", F.trim(F.regexp_replace("piece", r"[\x20\x09]+", " ")).alias("piece"))
    return plain.where("piece <> ''").groupBy("lang", "piece").agg(F.count(F.lit(1)).alias("m"))


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))


def _hash(words) -> np.ndarray:
    import pandas as pd

    return pd.util.hash_array(np.array(words, object), categorize=False) if len(words) else np.zeros(0, np.uint64)


def _slots(size: int, lang: np.ndarray, *words: np.ndarray) -> np.ndarray:
    """The slot, of ``size``, of each n-gram by the hashes of its language and words."""
    h = lang
    for w in words:
        h = _mix(h + w)
    return (_mix(h) % np.uint64(size)).astype(np.int64)


def _has(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 6] >> (slots & 63).astype(np.uint64)) & np.uint64(1) > 0


class _Slice:
    """Pieces as numbers: per word its place in the slice's vocabulary, its language, weight and words left in its piece."""

    def __init__(self, batches: list[pa.RecordBatch]):
        t = pa.Table.from_batches(batches).combine_chunks()
        lists = pc.split_pattern(t["piece"], " ").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        sizes = np.diff(lists.offsets.to_numpy())
        words = lists.flatten().dictionary_encode()
        langs = t["lang"].combine_chunks()
        langs = (langs.chunk(0) if isinstance(langs, pa.ChunkedArray) else langs).dictionary_encode()
        self.vocabulary, self.languages = words.dictionary, langs.dictionary
        self.w = words.indices.to_numpy().astype(np.int64)
        self.lang = np.repeat(langs.indices.to_numpy().astype(np.int64), sizes)
        self.m = np.repeat(t["m"].to_numpy(), sizes)
        self.left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(self.w))
        self.word_hash, self.lang_hash = _hash(self.vocabulary.to_pylist()), _hash(self.languages.to_pylist())

    def sums(self, at: np.ndarray, ids: np.ndarray, k: int) -> tuple[pa.RecordBatch, np.ndarray]:
        """Weights of the k-grams that start ``at``, of which equal ones have equal ids; and a small id for each."""
        _, first, small = np.unique(ids, return_index=True, return_inverse=True)
        order = np.argsort(small, kind="stable")
        starts = np.searchsorted(small[order], np.arange(len(first)))
        total = np.add.reduceat(self.m[at][order], starts) if len(first) else np.zeros(0, np.int64)
        p = at[first]
        words = [self.vocabulary.take(pa.array(self.w[p + j])) for j in range(k)]
        gram = words[0] if k == 1 else pc.binary_join_element_wise(*words, " ")
        out = [self.languages.take(pa.array(self.lang[p])), gram, pa.array(np.full(len(p), k, np.int32)), pa.array(total)]
        return pa.RecordBatch.from_arrays(out, ["lang", "gram", "k", "m"]), small

    def words(self):
        yield self.sums(np.arange(len(self.w)), self.lang * len(self.vocabulary) + self.w, 1)[0]

    def pairs(self, frequent: np.ndarray):
        """Pairs of words that are both in the bitmap."""
        known = _has(frequent, _slots(len(frequent) * 64, self.lang_hash[self.lang], self.word_hash[self.w]))
        at = np.flatnonzero((self.left[:-1] > 1) & known[:-1] & known[1:])
        yield self.sums(at, (self.lang[at] * len(self.vocabulary) + self.w[at]) * len(self.vocabulary) + self.w[at + 1], 2)[0]

    def runs(self, frequent: np.ndarray, longest: int):
        """Phrases of 3 words and more of which all neighbours are pairs in the bitmap."""
        hashes = self.word_hash[self.w]
        good = np.zeros(len(self.w), bool)
        good[:-1] = (self.left[:-1] > 1) & _has(frequent, _slots(len(frequent) * 64, self.lang_hash[self.lang[:-1]], hashes[:-1], hashes[1:]))
        at = np.flatnonzero(good)
        ids = (self.lang[at] * len(self.vocabulary) + self.w[at]) * len(self.vocabulary) + self.w[at + 1]
        small = np.unique(ids, return_inverse=True)[1]
        for k in range(3, longest + 1):
            on = good[np.minimum(at + k - 2, len(good) - 1)] & (self.left[at] >= k)
            at, small = at[on], small[on]
            batch, small = self.sums(at, small * len(self.vocabulary) + self.w[at + k - 1], k)
            yield batch


def _sliced(step):
    """A function for mapInArrow that hands ``step`` slices of at most about SLICE words."""

    def run(batches):
        held, words = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                held.append(part)
                words += part["piece"].nbytes // 5
                if words >= SLICE:
                    yield from step(_Slice(held))
                    held, words = [], 0
        if held:
            yield from step(_Slice(held))

    return run


def _count(least: int, slots: int = SLOTS):
    """A function for mapInArrow that counts a bucket out-of-core: n-grams of weight ``least`` and more, and with words
    the weight of all (k = 0, a null gram). What exceeds MEMORY goes to a scratch folder that ends with the task, as the
    spills of Spark's own aggregates do; no other task reads it."""

    def run(batches):
        import duckdb

        with tempfile.TemporaryDirectory(prefix="grams-") as folder:
            con = duckdb.connect()
            con.execute(f"SET memory_limit='{MEMORY}'; SET threads=1; SET preserve_insertion_order=false; SET temp_directory='{folder}'")
            con.execute("CREATE TABLE bucket (lang VARCHAR, gram VARCHAR, k INTEGER, m BIGINT)")
            held, rows = [], 0

            def put():
                part = pa.Table.from_batches(held)  # noqa: F841  DuckDB finds it by its name
                con.execute("INSERT INTO bucket SELECT lang, gram, k, m FROM part")

            for batch in batches:
                held.append(batch)
                rows += batch.num_rows
                if rows >= 200_000:
                    put()
                    held, rows = [], 0
            if held:
                put()
            found = con.sql(
                f"""SELECT lang, gram, k, CAST(sum(m) AS BIGINT) AS f FROM bucket GROUP BY lang, gram, k HAVING sum(m) >= {least}
                    UNION ALL SELECT lang, NULL, 0, CAST(sum(m) AS BIGINT) FROM bucket WHERE k = 1 GROUP BY lang"""
            ).to_arrow_reader(50_000)
            for b in found:
                yield pa.RecordBatch.from_arrays([*b.columns, _slot_column(b, slots)], ["lang", "gram", "k", "f", "slot"])
            con.close()

    return run


def _slot_column(b: pa.RecordBatch, slots: int) -> pa.Array:
    """Slots of words and pairs; nulls for the rest."""
    k = b["k"].to_numpy()
    out = np.full(b.num_rows, -1, np.int64)
    for n in (1, 2):
        at = np.flatnonzero(k == n)
        grams = [g.split(" ") for g in b["gram"].take(pa.array(at)).to_pylist()]
        if len(at):
            out[at] = _slots(slots, _hash(b["lang"].take(pa.array(at)).to_pylist()), *[_hash([g[j] for g in grams]) for j in range(n)])
    return pa.array(out, mask=out < 0)


def _bitmap(counted: DataFrame, k: int, slots: int) -> np.ndarray:
    """The bitmap of the slots of the counted k-grams: so many bits at every size of the input."""
    words = counted.where(F.col("k") == k).groupBy(F.shiftright("slot", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS INT)))").alias("bits")).toArrow()
    bits = np.zeros(slots // 64, np.uint64)
    bits[words["at"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return bits


def counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, slots: int = SLOTS) -> DataFrame:
    """lang, gram, k (its words), f of every phrase of 1 to ``longest`` words found ``least`` times or more; for k = 0 the
    number of all words of the language."""
    spark = docs.sparkSession
    rows = cut(pieces(docs), "pieces", "zstd")
    sc, words = spark.sparkContext, rows.agg(F.sum(F.length("piece"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), words // 6 // BUCKET_WORDS + 1)

    def counted(step, name):
        grams = rows.mapInArrow(_sliced(step), _GRAMS).repartition(buckets, "lang", "gram")
        return cut(grams.mapInArrow(_count(least, slots), _COUNTED), name)

    one = counted(lambda s: s.words(), "words")
    known = sc.broadcast(_bitmap(one, 1, slots))
    two = counted(lambda s: s.pairs(known.value), "pairs")
    near = sc.broadcast(_bitmap(two, 2, slots))
    more = counted(lambda s: s.runs(near.value, longest), "phrases")
    known.unpersist()
    near.unpersist()
    return one.union(two).union(more).select("lang", "gram", "k", "f")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, slots: int = SLOTS) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    every = cut(counts(docs, least, longest, slots), "counts")
    totals, grams = every.where("k = 0").groupBy("lang").agg(F.sum("f").alias("n")), every.where("k > 0")
    word = F.split("gram", " ")
    part = lambda start, size: F.array_join(F.slice(word, start, size), " ")
    shorter = grams.where("k > 2").select("lang", F.explode(F.array(part(1, F.col("k") - 1), part(2, F.col("k") - 1))).alias("gram"), F.col("f").alias("over"))
    inside = shorter.groupBy("lang", "gram").agg(F.max("over").alias("over"))
    phrases = grams.where("k > 1").join(inside, ["lang", "gram"], "left").where("over IS NULL OR 100 * over < 100 * f").select("lang", "gram", "k", F.col("f").alias("a"))
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    asked = cuts.select("lang", "gram", "a", "cut", F.explode(F.array(F.struct(F.lit(0).alias("side"), part(1, F.col("cut")).alias("part")), F.struct(F.lit(1).alias("side"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("part")))).alias("ask"))
    asked = cut(asked.select("lang", "gram", "a", "cut", "ask.side", "ask.part"), "requests")
    known = grams.select("lang", F.col("gram").alias("part"), F.col("f").alias("answer"))
    wanted = cut(asked.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("n_asked")).join(known, ["lang", "part"]), "answers")
    told = attach(asked, wanted, ["lang", "part"], "gram", n="n_asked").groupBy("lang", "gram", "a", "cut")
    both = told.agg(F.max(F.when(F.col("side") == 0, F.col("answer"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("answer"))).alias("r"))
    scored = both.join(light(totals), "lang").withColumn("score", F.expr(f"(CAST({UNIT} AS DECIMAL(5,0)) * CAST(a AS DECIMAL(16,0)) * CAST(n AS DECIMAL(16,0))) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"))
    best = scored.groupBy("lang", "gram", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("at"))
    ranked = best.select("lang", F.col("gram").alias("phrase"), "a", "at.l", "at.r", "n", "at.score")
    ranked = ranked.withColumn("rank", F.expr("row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)"))
    return ranked.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
