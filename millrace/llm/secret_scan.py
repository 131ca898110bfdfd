"""Secret scanning with an incremental blob ledger, in DataFrame functions only.

Every version of a text is content-addressed by its SHA-256 (a *blob*). A ledger table records, for each blob, the
(rule, version) pairs that have been run over it and the hits. A scan runs only the pairs the ledger lacks, appends
them, and joins the findings of each blob back to every row (path) that holds the text. Where there is a ledger, blobs
are compared with it before any text moves: texts that it knows stay where they are as long as the unseen blobs are few
enough for a broadcast. A blob that very many rows hold is joined to them in place.

Defined results: a null text counts as empty; an empty text has no findings; repeated rows each get their findings;
an empty table gives an empty result; other columns of the input are ignored or, by ``redact``, passed through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import BROADCAST_IDS, HOT, attach, cut, light, shared_dir


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if ``group`` of it has at least ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


BASE_RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32),
)
MORE_RULES = (
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES

_HIT = "struct<rule:string,nth:int,gap:int,size:int,real:boolean>"


def _hits(text: Column, rule: Rule) -> Column:
    """The matches of one rule in order, each with the length of the text since the match before it."""
    pattern = F.lit(rule.pattern)
    parts = F.array(F.struct(F.split(text, rule.pattern, -1).alias("gaps"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("found")))
    real = lambda m: F.length(F.regexp_extract(m, rule.pattern, rule.group)) >= rule.least
    each = F.transform(
        parts,
        lambda p: F.transform(
            p["found"],
            lambda m, i: F.struct(F.lit(rule.name).alias("rule"), i.alias("nth"), F.length(p["gaps"][i]).alias("gap"), F.length(m).alias("size"), real(m).alias("real")),
        ),
    )
    return F.when(F.regexp(text, pattern), each[0]).otherwise(F.array().cast(f"array<{_HIT}>"))


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Brings the ledger at path ``ledger`` up to date with the texts of ``docs``; returns its findings.

    The ledger has columns blob, ran (names of rules), hits. The result has a row for each finding: blob, kind,
    nth_kind (place of the rule in ``rules``), start, end (code points, end exclusive). ``docs`` needs ``text`` only.
    """
    spark = docs.sparkSession
    names = F.array(*[F.lit(r.name) for r in rules])
    texts = docs.select(blob_of(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    try:
        done = spark.read.parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        done = None
    if done is None:
        todo = texts.groupBy("blob").agg(F.first("text").alias("text")).withColumn("ran", names)
    else:
        ran = done.select("blob", F.explode("ran").alias("r")).groupBy("blob").agg(F.collect_set("r").alias("had"))
        blobs = texts.select("blob").distinct().join(ran, "blob", "left")
        unseen = cut(blobs.select("blob", F.array_except(names, F.coalesce("had", F.array().cast("array<string>"))).alias("ran")).where(F.size("ran") > 0), "unseen-blobs")
        todo = texts.join(light(unseen), "blob").groupBy("blob").agg(F.first("text").alias("text"), F.first("ran").alias("ran"))
    hits = F.concat(*[F.when(F.array_contains("ran", r.name), _hits(F.col("text"), r)).otherwise(F.array().cast(f"array<{_HIT}>")) for r in rules])
    todo.select("blob", "ran", hits.alias("hits")).write.mode("append").parquet(ledger)
    return findings(spark.read.parquet(ledger), rules)


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows blob, kind, nth_kind, start, end of a ledger, for the given rules and versions."""
    place = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    kinds = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(r.kind))])
    run = Window.partitionBy("blob", "rule").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ledger.where(F.size("hits") > 0)
        .select("blob", F.inline("hits"))
        .dropDuplicates(["blob", "rule", "nth"])  # two scans that raced have recorded the same hits
        .where(F.col("rule").isin([r.name for r in rules]))
        .withColumn("end", F.sum(F.col("gap").cast("long") + F.col("size")).over(run))
        .where("real")
        .select("blob", kinds[F.col("rule")].alias("kind"), place[F.col("rule")].alias("nth_kind"), (F.col("end") - F.col("size")).alias("start"), "end")
    )


def by_blob(found: DataFrame) -> DataFrame:
    """A row for each blob with findings: spans, an array of (start, nth_kind, end, kind) in that order."""
    return found.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "nth_kind", "end", "kind"))).alias("spans"))


def scan_documents(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, blob and spans (an empty array if none) of every row of ``docs`` (doc_id, text)."""
    ledger = ledger or shared_dir(docs.sparkSession, "secret-ledger")
    found = by_blob(scan(docs, ledger, rules))
    rows = cut(docs.select("doc_id", blob_of(F.col("text")).alias("blob")), "blobs")
    none = F.array().cast("array<struct<start:bigint,nth_kind:int,end:bigint,kind:string>>")
    return attach(rows, _held(rows, found), ["blob"], "doc_id").select("doc_id", "blob", F.coalesce("spans", none).alias("spans"))


def _held(rows: DataFrame, found: DataFrame) -> DataFrame:
    """blob, n (rows that hold it) and spans of the blobs with findings, and of those that many rows hold."""
    held = rows.groupBy("blob").agg(F.count(F.lit(1)).alias("n")).join(found, "blob", "left")
    return cut(held.where((F.col("n") > HOT) | F.col("spans").isNotNull()), "held-blobs")


def digest(scanned: DataFrame, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Counts of each base kind, the hash of the base spans and all spans as text."""
    kinds = [r.kind for r in base]
    text = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return scanned.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in kinds],
        F.sha2(text(F.filter("spans", lambda x: x["kind"].isin(kinds))), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES, limit: int = BROADCAST_IDS) -> DataFrame:
    """``docs`` with each secret of its text replaced by ``[kind]``; overlapping spans become one, named by the first.

    Up to ``limit`` spans are broadcast to the texts; with more, texts move to their spans, but for those of a blob that
    many rows hold. All columns and rows stay; a null text stays null; n_chars, if there, becomes the length of the new text.
    """
    ledger = ledger or shared_dir(docs.sparkSession, "secret-ledger")
    found = cut(by_blob(scan(docs, ledger, rules)).toDF("_blob", "_spans"), "secret-spans")
    marked = docs.withColumn("_blob", blob_of(F.col("text")))
    if (found.agg(F.sum(F.size("_spans"))).first()[0] or 0) <= limit:
        marked = marked.join(F.broadcast(found), "_blob", "left")
    else:
        held = marked.groupBy("_blob").agg(F.count(F.lit(1)).alias("_n")).join(found, "_blob", "left")
        held = cut(held.where((F.col("_n") > HOT) | F.col("_spans").isNotNull()), "held-blobs")
        marked = attach(marked, held, ["_blob"], "doc_id" if "doc_id" in docs.columns else "text", n="_n")
    text = F.col("text")
    piece = lambda a, to: F.substring(text, a["at"] + 1, F.greatest(F.lit(0), to - a["at"]))
    whole = F.aggregate(
        "_spans",
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, s: F.when(s["start"].cast("int") < a["at"], F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"].cast("int")).alias("at"))).otherwise(
            F.struct(F.concat(a["out"], piece(a, s["start"].cast("int")), F.lit("["), s["kind"], F.lit("]")).alias("out"), s["end"].cast("int").alias("at"))
        ),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.lit(2**31 - 1))),
    )
    new = F.when(F.col("_spans").isNotNull() & text.isNotNull(), whole).otherwise(text)
    columns = [new.alias("text") if c == "text" else F.col(c) for c in docs.columns]
    out = marked.select(*columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
