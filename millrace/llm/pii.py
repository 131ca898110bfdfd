"""Personal data by patterns and by what stands before them, in DataFrame functions only.

1. Base entities (email, ip, card, phone) are matched in every text and are seeds.
2. A *run* is a longest row of tokens with a digit or an at sign, one space apart. What stands before a run, its last word
   and its last two words within the gap to the run before (80 characters at most), are lexical patterns; what the
   run says is an instance. A run with a base entity in it is known to be of that kind; others may have the look of some kinds.
3. Patterns and instances are scored on their graph for ROUNDS rounds: a pattern by the instances that it is met with
   (each once, however many texts have it), an unknown instance by its best pattern among kinds that it looks like.
4. A run that looks like a kind, after a pattern that scores STRONG for it, is a new entity of kind ``like_<kind>``.

Texts are scanned once, where they lie; equal texts (by SHA-256) count once in the graph. Scores are whole numbers in
millionths, so results don't depend on the order of rows. Every base span stays, and no new one overlaps a base span:
what lies between a run and the word of its pattern would have to be part of both.

Defined results: a null text counts as empty; an empty text has no spans; repeated rows each get their spans; an empty table
gives an empty result; other columns are ignored or, by ``redact``, passed through. A run of more than LONGEST code points
counts against its patterns, but is never new. With equal scores the first kind as listed is taken.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .secret_scan import _held, blob_of
from .shared import attach, cut

#: Rounds of scoring; a score's unit; what a pattern's instances are outweighed by at first; the score that finds new entities.
ROUNDS, UNIT, PRIOR, STRONG = 3, 1_000_000, 2, 800_000
LONGEST, NEAR = 64, 80

_digits = lambda m: F.regexp_replace(m, "[^0-9]", "")
_between = lambda n, low, high: (n >= low) & (n <= high)


@dataclass(frozen=True)
class Kind:
    """``pattern`` matches as the plain form does, without going back: it starts where no match could have begun before.

    ``look`` is for what may be of this kind though the pattern doesn't match it, with so many digits at least and most.
    """

    name: str
    pattern: str
    real: Callable[[Column], Column]
    look: str
    digits: tuple[int, int] = (0, LONGEST)


#: The plain forms: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+, [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+),
#: [0-9]([\x20-]?[0-9])+ and \+[0-9][\x20().0-9-]+[0-9].
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda m: F.lit(True), r"^[^\x20@]+@[^\x20@]+$"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda m: F.regexp(m, F.lit(r"^(0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(\.|$)){4}$")), r"^([0-9a-f]*(:[0-9a-f]*){3,7}|[0-9]+([.,-][0-9]+){3})$", (1, 32)),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", lambda m: _between(F.length(_digits(m)), 16, 19) & F.call_function("luhn_check", _digits(m)), r"^[0-9]([\x20-]?[0-9])*$", (12, 19)),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: _between(F.length(_digits(m)), 8, 15), r"^[0-9(][0-9\x20()./-]*[0-9]$", (6, 15)),
)
RUN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+(?:\x20[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+)*+"
RUNS = len(KINDS)
LEAD, TRAIL = r"""^["'<\[{,;:]+""", r"""["'>\]},;:.!?]+$"""
_SPAN = "array<struct<nth_kind:int,start:bigint,end:bigint,kind:string>>"
_HIT = "struct<k:int,nth:int,gap:int,size:int,real:boolean,lead:int,wide:int,said:string,one:string,two:string,base:int,looks:int>"


def _matches(text: Column, pattern: str, each: Callable[[Column, Column, Column], Column]) -> Column:
    """``each`` (match, its number, the text since the match before) of the matches in order."""
    found = F.array(F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")))
    hits = F.transform(found, lambda p: F.transform(p["found"], lambda m, i: each(m, i, p["gaps"][i])))
    return F.when(F.regexp(text, F.lit(pattern)), hits[0].cast(f"array<{_HIT}>")).otherwise(F.array().cast(f"array<{_HIT}>"))


def _hit(k: int, m: Column, i: Column, gap: Column, real: Column, *more: Column) -> Column:
    names = ("k", "nth", "gap", "size", "real", "lead", "wide", "said", "one", "two", "base", "looks")
    values = (F.lit(k), i, F.length(gap), F.length(m), real, *(more or [F.lit(None)] * 7))
    return F.struct(*[v.alias(n) for n, v in zip(names, values, strict=True)])


def _context(gap: Column, words: str) -> Column:
    """The last words before a run, in lower case with one space between; empty if there are none or no letter is in the last."""
    found = F.regexp_extract(F.right(gap, F.lit(NEAR)), words + r"[\x20\x09-\x0D]*\z", 1)
    plain = F.lower(F.regexp_replace(found, r"[\x20\x09-\x0D]+", " "))
    return F.when(F.regexp(plain, F.lit(r"\p{L}[^\x20]*\z")), plain).otherwise("")


def _run(m: Column, i: Column, gap: Column) -> Column:
    trimmed = F.regexp_replace(F.regexp_replace(m, LEAD, ""), TRAIL, "")
    bare = F.lower(trimmed)
    base = F.coalesce(*[F.when(F.exists(F.regexp_extract_all(m, F.lit(k.pattern), F.lit(0)), k.real), n) for n, k in enumerate(KINDS)])
    count = F.length(_digits(bare))
    looks = sum(F.when(F.regexp(bare, F.lit(k.look)) & _between(count, *k.digits), 1 << n).otherwise(0) for n, k in enumerate(KINDS))
    short = F.length(m) <= LONGEST
    word = r"[^\x20\x09-\x0D]+"
    return _hit(
        RUNS, m, i, gap, F.length(bare) > 0, F.length(F.regexp_extract(m, LEAD, 0)), F.length(trimmed), F.when(short, bare).otherwise(F.sha2(m, 256)), _context(gap, f"({word})"),
        _context(gap, rf"({word}[\x20\x09-\x0D]+{word})"), base, F.when(short & base.isNull(), looks).otherwise(0),
    )


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, blob and hits of every row; the texts stay where they are."""
    text = F.coalesce("text", F.lit(""))
    base = [_matches(text, k.pattern, lambda m, i, gap, n=n, k=k: _hit(n, m, i, gap, k.real(m))) for n, k in enumerate(KINDS)]
    runs = _matches(text, RUN, _run)
    return docs.select("doc_id", blob_of(F.col("text")).alias("blob"), F.concat(*base, runs).alias("hits"))


def _placed(rows: DataFrame) -> DataFrame:
    """A row for each hit of each distinct text, with its start and end."""
    one = Window.partitionBy("blob", "k").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = rows.where(F.size("hits") > 0).dropDuplicates(["blob"]).select("blob", F.inline("hits"))
    placed = each.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("size")).over(one)).where("real")
    return placed.withColumn("start", F.col("end") - F.col("size"))


def _contexts(runs: DataFrame) -> DataFrame:
    return runs.withColumn("context", F.explode(F.array_distinct(F.array("one", "two")))).where("context <> ''")


_p = [f"p{n}" for n in range(RUNS)]


def patterns(runs: DataFrame, rounds: int = ROUNDS, prior: int = PRIOR) -> DataFrame:
    """Scores of the lexical patterns: context, n (instances met with), p0 to p3 (millionths, by kind)."""
    graph = cut(_contexts(runs).select("context", "said", "base", "looks").distinct(), "pattern-graph")
    unknown = graph.where("looks > 0").select("context", "said", "looks")
    seeds = cut(graph.groupBy("context").agg(F.count(F.lit(1)).alias("n"), *[(F.count_if(F.col("base") == n) * UNIT).alias(f"s{n}") for n in range(RUNS)]), "seeds")
    some = " + ".join(_p) + " > 0"
    of_pattern = cut(seeds.select("context", "n", *[F.expr(f"s{n} div (n + {prior})").alias(_p[n]) for n in range(RUNS)]).where(some), "patterns")
    masked = [F.when(F.col("looks").bitwiseAND(1 << n) > 0, F.coalesce(_p[n], F.lit(0))).otherwise(0) for n in range(RUNS)]
    for _ in range(rounds - 1):
        met = attach(unknown, of_pattern, ["context"], "said")
        told = met.groupBy("said").agg(F.count(F.lit(1)).alias("n"), *[F.max(m).alias(p) for m, p in zip(masked, _p, strict=True)]).where(some)
        found = attach(unknown, cut(told, "instances"), ["said"], "context")
        more = found.groupBy("context").agg(*[F.sum(F.coalesce(p, F.lit(0))).alias(f"m{n}") for n, p in enumerate(_p)])
        both = seeds.join(more, "context", "left")
        of_pattern = cut(both.select("context", "n", *[F.expr(f"(s{n} + coalesce(m{n}, 0)) div (n + {prior})").alias(_p[n]) for n in range(RUNS)]).where(some), "patterns")
    return of_pattern


def _added(runs: DataFrame, scores: DataFrame, strong: int) -> DataFrame:
    """Runs that look like a kind after a pattern that is strong for it."""
    sure = cut(scores.where(" OR ".join(f"{p} >= {strong}" for p in _p)), "strong-patterns")
    known = _contexts(runs.where("looks > 0").select("blob", "start", "lead", "wide", "said", "looks", "one", "two"))
    met = attach(known, sure, ["context"], "start").where("n IS NOT NULL")
    best = met.groupBy("blob", "start", "lead", "wide").agg(*[F.max(F.when((F.col("looks").bitwiseAND(1 << n) > 0) & (F.col(_p[n]) >= strong), F.col(_p[n]))).alias(_p[n]) for n in range(RUNS)])
    top = F.greatest(*_p)
    kind = F.coalesce(*[F.when(F.col(p) == top, n) for n, p in enumerate(_p)])
    found = best.where(top.isNotNull()).select("blob", kind.alias("n"), (F.col("start") + F.col("lead")).alias("start"), "wide")
    names = F.array(*[F.lit(f"like_{k.name}") for k in KINDS])
    return found.select("blob", (F.col("n") + RUNS).alias("nth_kind"), "start", (F.col("start") + F.col("wide")).alias("end"), names[F.col("n")].alias("kind"))


def find(docs: DataFrame, rounds: int = ROUNDS, prior: int = PRIOR, strong: int = STRONG) -> DataFrame:
    """doc_id, blob and spans (nth_kind, start, end, kind; in that order) of every row of ``docs`` (doc_id, text)."""
    rows = cut(scanned(docs), "pii-hits")
    placed = cut(_placed(rows), "pii-places")
    names = F.array(*[F.lit(k.name) for k in KINDS])
    base = placed.where(F.col("k") < RUNS).select("blob", F.col("k").alias("nth_kind"), "start", "end", names[F.col("k")].alias("kind"))
    runs = placed.where(F.col("k") == RUNS)
    every = base.unionByName(_added(runs, patterns(runs, rounds, prior), strong))
    spans = every.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("nth_kind", "start", "end", "kind"))).alias("spans"))
    rows = rows.select("doc_id", "blob")
    return attach(rows, _held(rows, spans), ["blob"], "doc_id").select("doc_id", "blob", F.coalesce("spans", F.array().cast(_SPAN)).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of each base kind, the hash of the base spans and all spans as text."""
    text = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda n: F.size(F.filter("spans", lambda x: x["nth_kind"] == n)).cast("long")
    base = F.filter("spans", lambda x: x["nth_kind"] < RUNS)
    return found.select("doc_id", *[count(n).alias(f"n_{k.name}") for n, k in enumerate(KINDS)], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
