"""Quality rules: exact heuristics and a hashed n-gram log-likelihood ratio, in DataFrame functions only.

The ratio compares two multinomials over hashed word unigrams and bigrams: one of the trusted target (documents that
``labels`` marks with quality 1), one of the whole raw corpus, both smoothed on the target's scale: a bucket that the
target has t times, and would have e times if it were like the corpus, weighs log((t + prior) / (e + prior)). A
document's score is the mean over its n-grams.

Each distinct text counts once in both, however often it is copied; it is the target's if any of its copies is. Texts
are dealt in two folds by their hash, and those of one fold are scored by the counts of the other: no text is scored by
counts that it is part of, so trusted and other clean texts score alike. The threshold is the score that all but LOST
of the trusted documents that pass the base rules reach.

Defined results: a null or empty text has no words and fails the base rules; documents without labels are scored as
any other; without any trusted document all weights are zero and only the base rules decide; repeated rows get the
same result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_IDS, cut, light

#: Buckets of the hashed n-grams. The two models are two arrays of this length.
BUCKETS = 1 << 18
#: Share of the trusted documents passing the base rules that may score below the threshold.
LOST = 0.01
#: Occurrences added to what the target has and to what it should have in each bucket, so that rare n-grams say little.
PRIOR = 5
#: Where the target has many n-grams the prior is this share of its mean count in a bucket, so that it grows with them.
PRIOR_SHARE = 1 / 16
#: The threshold is found among scores of whole 1 / BINS nats.
BINS = 10_000
#: Weights are whole millionths of a nat, so that sums don't depend on their order.
UNIT = 1_000_000
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once for a row, also where lambdas within ``body`` use it."""
    return F.transform(F.array(value), body)[0]


def word_hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _pair(h: Column, x: Column, i: Column) -> Column:
    """A hash of the bigram that starts at place i, whose word hash is x; null at the last place."""
    return F.shiftrightunsigned(x, 23).bitwiseXOR(F.get(h, i + 1))


def ngram_buckets(h: Column, buckets: int = BUCKETS) -> Column:
    """Buckets (a power of two) of the unigrams and bigrams of an array of word hashes."""
    mask = F.lit(buckets - 1).cast("long")
    one = F.transform(h, lambda x: x.bitwiseAND(mask).cast("int"))
    two = F.transform(h, lambda x, i: _pair(h, x, i).bitwiseAND(mask).cast("int"))
    return F.concat(one, F.slice(two, 1, F.greatest(F.size(h) - 1, F.lit(0))))


def _ngram_sum(h: Column, table: Column, buckets: int) -> Column:
    """Sum of the table's entries for all n-grams."""
    mask = F.lit(buckets - 1).cast("long")
    entry = lambda x: F.get(table, x.bitwiseAND(mask).cast("int")).cast("long")
    each = F.transform(h, lambda x, i: entry(x) + F.coalesce(entry(_pair(h, x, i)), F.lit(0).cast("long")))
    return F.aggregate(each, F.lit(0).cast("long"), lambda a, b: a + b)


def fold(text: Column) -> Column:
    """0 or 1, alike for equal texts."""
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(2)).cast("int")


def marked(docs: DataFrame, trusted: DataFrame, limit: int) -> DataFrame:
    """doc_id, text and good (1 or null) of every row. Up to ``limit`` trusted ids are broadcast; with more, the join shuffles."""
    ids = cut(trusted.select("doc_id", F.lit(1).alias("good")).where("doc_id is not null").distinct(), "trusted-ids")
    return docs.select("doc_id", "text").join(light(ids, limit), "doc_id", "left")


def distinct_texts(rows: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """text and good of the distinct texts of ``rows`` (text, good): a text is good if any of its copies is.

    Only texts whose hash occurs twice are shuffled and grouped (texts that share a hash are told apart there); the others
    stay where they are, as long as the hashes that occur twice are at most ``limit``.
    """
    hashed = rows.select("text", "good", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    twice = light(cut(hashed.groupBy("h").count().where("count > 1").select("h"), "quality-copies"), limit)
    copies = hashed.join(twice, "h", "left_semi").groupBy("text").agg(F.max("good").alias("good"))
    return hashed.join(twice, "h", "left_anti").select("text", "good").unionByName(copies)


def _weights(rows: DataFrame, buckets: int, folds: int, share: float) -> DataFrame:
    """Columns weights0, ...: the weights for the texts of each fold, from ``rows`` (text, good) of the other one."""
    hashed = rows.select("good", (fold(F.col("text")) if folds == 2 else F.lit(1)).alias("f"), word_hashes(words(F.col("text"))).alias("h"))
    grams = hashed.select("good", "f", F.explode(_let(F.col("h"), lambda h: ngram_buckets(h, buckets))).alias("bucket"))
    counts = grams.groupBy("f", "bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("good").alias("target"))
    grid = rows.sparkSession.range(folds * buckets).select(((F.lit(1) if folds == 1 else F.col("id") % 2).cast("int")).alias("f"), F.floor(F.col("id") / folds).cast("int").alias("bucket"))
    whole = grid.join(counts, ["f", "bucket"], "left").fillna(0).groupBy("f").agg(F.sum("raw").alias("n"), F.sum("target").alias("m"), F.array_sort(F.collect_list(F.struct("bucket", "raw", "target"))).alias("c"))
    prior = F.greatest(F.lit(float(PRIOR)), F.lit(share / buckets) * F.col("m"))
    ratio = lambda x: F.log((x["target"] + prior) / (x["raw"] * F.col("m") / F.col("n") + prior))
    weight = F.transform("c", lambda x: F.when(F.col("m") > 0, F.round(UNIT * ratio(x))).otherwise(0).cast("int"))
    of = whole.select((1 - F.col("f")).alias("f"), weight.alias("w"))
    return of.agg(*[F.any_value(F.when(F.col("f") == k, F.col("w")), ignoreNulls=True).alias(f"weights{k}") for k in range(folds)])


def fit(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, limit: int = BROADCAST_IDS) -> DataFrame:
    """One row, one column: the weights of all buckets in units, in order. Counts run over all rows of ``docs``.

    ``trusted`` has the doc_id of the target's documents. The row has ``buckets`` whole numbers whatever the corpus.
    """
    weights = _weights(marked(docs, trusted, limit), buckets, 1, 0.0)
    return cut(weights.select(F.col("weights0").alias("weights")), "quality-weights")


def cross_fit(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, limit: int = BROADCAST_IDS) -> DataFrame:
    """One row, two columns: the weights for the texts of either fold. Counts run over the distinct texts of ``docs``."""
    return cut(_weights(distinct_texts(marked(docs, trusted, limit), limit), buckets, 2, PRIOR_SHARE), "quality-weights")


def _repeated(w: Column) -> Column:
    """Words in 3-word windows that occur twice or more, from an array of word hashes.

    Each window becomes a 64-bit hash. Sorting longs that hold the hash's high bits and the window's place puts equal
    windows side by side; neighbours are compared by whole hashes; then the places' union is measured.
    """
    n = F.size(w)
    hashes = F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))), 1, F.greatest(n - 2, F.lit(0)))

    def cover(h: Column, low: Column) -> Column:
        packed = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))))

        def marked(s: Column) -> Column:
            at = lambda x: x.bitwiseAND(low).cast("int")
            alike = lambda x, y: x.bitwiseXOR(y) <= low  # noqa: E731  equal high bits; null at the ends
            some = F.filter(s, lambda x, i: alike(x, F.get(s, i - 1)) | alike(x, F.get(s, i + 1)))
            same = lambda x, y: F.get(h, at(x)) == F.get(h, at(y))
            twin = _let(some, lambda c: F.filter(c, lambda x, i: same(x, F.get(c, i - 1)) | same(x, F.get(c, i + 1))))
            places = F.sort_array(F.transform(twin, lambda x: at(x)))
            return F.aggregate(
                places,
                F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to")),
                lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x + 3 - a["to"])).alias("n"), (x + 3).alias("to")),
                lambda a: a["n"],
            )

        return _let(packed, marked)

    low = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(F.size(h).cast("long")))) - 1
    return F.when(n < 4, F.lit(0).cast("long")).otherwise(_let(hashes, lambda h: _let(low(h), lambda m: cover(h, m))))


def _weighed(docs: DataFrame, weights: DataFrame, *carried: Column) -> DataFrame:
    """doc_id, text, what is carried and _weights, the one row that ``fit`` made or the text's fold of ``cross_fit``'s.

    They come in as scalar subqueries, which tasks hold once; a joined column would be copied to each row. Being used
    once, they are put into the expression by the optimizer.
    """
    own = [weights.select(c).scalar() for c in weights.columns]
    return docs.select("doc_id", "text", *carried, (own[0] if len(own) == 1 else F.when(fold(F.col("text")) == 0, own[0]).otherwise(own[1])).alias("_weights"))


def _of_words(body, buckets: int) -> Column:
    """``body`` of a struct of n_words, word_chars and h (n_repeat_words and score) of the column text, evaluated once."""
    counted = lambda table, w: (
        F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _let(word_hashes(w), lambda h: F.struct(_repeated(h).alias("n_repeat_words"), _ngram_sum(h, table, buckets).alias("score"))).alias("h"),
        )
    )
    return _let(F.col("_weights"), lambda table: _let(words(F.col("text")), lambda w: _let(counted(table, w), body)))


def measures(docs: DataFrame, weights: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, the base counts and score (units of the whole text) of every row of ``docs`` (doc_id, text)."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp(x, F.lit(r"[^\x20\x09-\x0D]")))
    return _weighed(docs, weights).select(
        "doc_id",
        _of_words(lambda w: w, buckets).alias("w"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ).select("doc_id", "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines", "w.h.n_repeat_words", "w.h.score")


def _failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def _grams(n_words: Column) -> Column:
    return F.greatest(2 * n_words - 1, F.lit(1))


def _good(score: Column, n_words: Column, threshold: float) -> Column:
    return score >= F.lit(round(threshold * UNIT)).cast("long") * _grams(n_words)


def threshold_of(measured: DataFrame, trusted: DataFrame, limit: int = BROADCAST_IDS) -> float:
    """The highest of the binned scores that all but LOST of the trusted documents passing the base rules reach.

    ``measured`` (doc_id, n_words, n_repeat_words, score) is in shared storage. Only counts of bins come to the driver.
    """
    ids = light(cut(trusted.select("doc_id").where("doc_id is not null").distinct(), "quality-trusted"), limit)
    fine = measured.where(~_failed(F.col("n_words"), F.col("n_repeat_words"))).join(ids, "doc_id", "left_semi")
    bins = fine.groupBy(F.floor(F.col("score") * BINS / UNIT / _grams(F.col("n_words"))).alias("at")).count().collect()
    spare = int(LOST * sum(r["count"] for r in bins))
    for r in sorted(bins):
        if r["count"] > spare:
            return r["at"] / BINS
        spare -= r["count"]
    return 0.0


def verdict(measured: DataFrame, threshold: float) -> DataFrame:
    """Adds base_failed, llr (nats per n-gram, rounded to the unit) and kept."""
    n, score = F.col("n_words"), F.col("score")
    failed = _failed(n, F.col("n_repeat_words"))
    return measured.withColumn("base_failed", failed).withColumn("llr", F.round(score / _grams(n) / UNIT, 6)).withColumn("kept", ~failed & _good(score, n, threshold)).drop("score")


def quality(docs: DataFrame, labels: DataFrame, threshold: float | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Measures and verdict for every row of ``docs``; the target is the documents that ``labels`` gives quality 1.

    Without a ``threshold`` it is found from the target's scores.
    """
    trusted = labels.where("quality = 1")
    measured = cut(measures(docs, cross_fit(docs, trusted, buckets), buckets), "quality-measures")
    return verdict(measured, threshold_of(measured, trusted) if threshold is None else threshold)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep."""
    trusted = labels.where("quality = 1")
    weighed = _weighed(docs, cross_fit(docs, trusted, buckets), F.struct(*docs.columns).alias("_row"))
    # written, as a filter over the measures' columns would be pushed below them and measure once for each use
    rows = cut(weighed.select("doc_id", "_row", _of_words(lambda w: w, buckets).alias("_w")), "quality-rows")
    measured = rows.select("doc_id", "_row", "_w.n_words", "_w.h.n_repeat_words", "_w.h.score")
    least = threshold_of(measured, trusted) if threshold is None else threshold
    n = F.col("n_words")
    return measured.where(~_failed(n, F.col("n_repeat_words")) & _good(F.col("score"), n, least)).select("_row.*")
