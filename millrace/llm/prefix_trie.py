"""The prefix trie of conversations: which turns many conversations begin with, and what keeping them once would save.

Conversations are rebuilt from forks: conversation c starts with the first h turns of conversation c - c % 5 (as many as
it has; none if it is absent) and goes on with its own turns after its first h. A node is a distinct sequence of d turns.

1. Turns are numbered by a range partition of (conversation, turn) and prefix sums of the partitions' rows, so a
   conversation of any length is dealt over many tasks. Texts stop there: a turn goes on as a digest and a length.
2. The digest of a prefix is the exclusive or of digests of (place, turn); running values come from blocks of BLOCK turns
   and the running values of the blocks' totals. Minima over equal prefix digests are the nodes: the smallest member *owns* it.
3. If a conversation owns a prefix, it owns all its longer ones. Each one's first owned depth is found by binary search:
   in each round all undecided conversations join one digest with the minima. What it owns is its chain.
4. Chains hang on the nodes where they begin. Sums of subtrees go from chains to their ancestors 1, 2, 4, ... steps up, so
   the rounds are the logarithm of the nesting; along a chain they are running sums by blocks again.

Defined results: a null role or text counts as empty; a null turn comes first; equal turns of a conversation are ordered
by their digest (SHA-256 of the role's UTF-8 length, a colon, role and text); repeated rows are turns of their own; rows
without conv_id are ignored; an empty table gives an empty result; other columns are ignored. Two different prefixes
share the 128 bits of a digest with a probability of n^2 / 2^129 among n prefixes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import attach, cut, light, ship

#: Turns of a block, whose running values one window holds; ids of a piece of a node's list in bytes, about.
BLOCK, PIECE_BYTES = 4096, 1 << 20


def numbered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (c, at, turn digest td, bytes) with ``i``, their place in the conversation from 1; and conversations: c, len."""
    spark = turns.sparkSession
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    slim = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), "turn", F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("td"), F.octet_length(text).cast("long").alias("bytes")
    )
    order = ["c", F.col("turn").asc_nulls_first(), "td"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = slim.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = cut(ranged.select("c", "td", "bytes", "_at"), "turns")
    part, row = F.shiftrightunsigned("_at", 33).cast("int"), F.col("_at").bitwiseAND((1 << 33) - 1)
    before = ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))  # a row for each partition
    before = before.select("part", F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    placed = ranged.join(F.broadcast(before), part == F.col("part")).select("c", "td", "bytes", (row + F.col("before")).alias("at"))
    convs = cut(placed.groupBy("c").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("len")), "conversations")
    return attach(placed, convs, ["c"], "at", n="len").select("c", "td", "bytes", (F.col("at") - F.col("first") + 1).alias("i")), convs.select("c", "len")


def rebuilt(conversations: DataFrame, forks: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations: c, d (place from 1), td, bytes; and their lengths: c, len."""
    turns, convs = numbered(conversations)
    turns = cut(turns, "numbered")
    heads = convs.select("c", "len", (F.col("c") - F.col("c") % forks).alias("base"), (F.crc32(F.col("c").cast("string").cast("binary")) % most).cast("long").alias("h"))
    theirs = convs.select(F.col("c").alias("base"), F.col("len").alias("base_len"))
    heads = heads.join(theirs, "base", "left").withColumn("head", F.least("h", F.coalesce("base_len", F.lit(0))))
    heads = cut(heads.withColumn("rebuilt", F.col("head") + F.greatest(F.col("len") - F.col("h"), F.lit(0))), "heads")
    own = attach(turns, heads, ["c"], "i", n="len").where("i > h").select("c", (F.col("head") + F.col("i") - F.col("h")).alias("d"), "td", "bytes")
    first = turns.where(F.col("i") < most).select(F.col("c").alias("base"), "i", "td", "bytes")  # a few of each conversation
    lent = first.join(heads.select("base", "c", "h"), "base").where("i <= h").select("c", F.col("i").alias("d"), "td", "bytes")
    return own.unionByName(lent), heads.select("c", F.col("rebuilt").alias("len"))


def running(rows: DataFrame, key: str, at: str, values: dict[str, str], block: int = BLOCK) -> DataFrame:
    """``rows`` with running values: for each new column the aggregate of SQL (of a column) from the group's first row on.

    ``at`` counts a group's rows (gaps are allowed). No window holds more than ``block`` rows: groups that are longer get the
    running values of their blocks' totals, found in the same way.
    """
    kind = lambda name: values[name].split("(")[0]
    part = f"{at}_block"
    rows = rows.withColumn(part, F.expr(f"{at} div {block}"))
    window = Window.partitionBy(key, part).orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = rows.withColumns({name: F.expr(agg).over(window) for name, agg in values.items()})
    if not rows.where(f"{part} > 0").take(1):
        return inner.drop(part)
    blocks = cut(rows.groupBy(key, part).agg(*[F.expr(agg).alias(f"_{name}") for name, agg in values.items()]), "blocks")
    sums = running(blocks, key, part, {f"_to_{name}": f"{kind(name)}(_{name})" for name in values}, block)
    before = {name: F.col(f"_to_{name}").bitwiseXOR(F.col(f"_{name}")) if kind(name) == "bit_xor" else F.col(f"_to_{name}") - F.col(f"_{name}") for name in values}
    joined = inner.join(sums.select(key, part, *[v.alias(f"_{name}") for name, v in before.items()]), [key, part])
    both = {name: F.col(name).bitwiseXOR(F.col(f"_{name}")) if kind(name) == "bit_xor" else F.col(name) + F.col(f"_{name}") for name in values}
    return joined.withColumns(both).drop(part, *[f"_{name}" for name in values])


def _prefixes(turns: DataFrame, convs: DataFrame, block: int) -> DataFrame:
    """c, d, digest (x, y) and last length of every prefix, the root's too."""
    root = convs.select("c", F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), F.lit(0).cast("long").alias("bytes"))
    each = turns.select("c", "d", F.xxhash64("d", "td").alias("p"), F.xxhash64("td", F.lit("second"), "d").alias("q"), "bytes")
    return root.unionByName(running(each, "c", "d", {"x": "bit_xor(p)", "y": "bit_xor(q)"}, block).select("c", "d", "x", "y", "bytes"))


def _owners(asked: DataFrame, prefixes: DataFrame, minima: DataFrame) -> DataFrame:
    """``asked`` (c, d, one row each) with ``owner``, the smallest conversation with the prefix of d turns of c."""
    digests = prefixes.select("c", "d", "x", "y").join(light(asked), ["c", "d"])
    return attach(digests, minima.select("d", "x", "y", "owner", "n_convs"), ["d", "x", "y"], "c", n="n_convs")


def first_owned(prefixes: DataFrame, minima: DataFrame, convs: DataFrame) -> DataFrame:
    """c, len, start: the first depth that each conversation owns, len + 1 if none, by binary search in batches."""
    longest = convs.agg(F.max("len")).first()[0]
    if longest is None:
        return convs.withColumn("start", F.lit(None).cast("long"))
    state = convs.select("c", "len", F.lit(0).cast("long").alias("low"), (F.col("len") + 1).alias("high"))
    for _ in range((longest + 1).bit_length()):
        state = cut(state, "search")
        asked = state.where("low < high").select("c", F.expr("(low + high) div 2").alias("d"))
        told = _owners(asked, prefixes, minima).select("c", F.col("d").alias("mid"), (F.col("owner") == F.col("c")).alias("owns"))
        state = state.join(told, "c", "left").select(
            "c", "len", F.when(F.col("owns"), F.col("low")).otherwise(F.coalesce(F.col("mid") + 1, "low")).alias("low"), F.when(F.col("owns"), F.col("mid")).otherwise(F.col("high")).alias("high")
        )
    return cut(state.select("c", "len", F.col("low").alias("start")), "search")


def _subtrees(chains: DataFrame, sums: list[str]) -> DataFrame:
    """``chains`` (c, up, sums) with each sum over the chain and all below it; ``up`` is the chain that it hangs on."""
    state = cut(chains.select("c", "up", *sums), "chains")
    while state.where("up IS NOT NULL").take(1):
        got = state.where("up IS NOT NULL").groupBy(F.col("up").alias("c")).agg(*[F.sum(s).alias(f"_{s}") for s in sums], F.count(F.lit(1)).alias("_n"))
        above = cut(state.select("c", "up", *sums).join(got, "c", "left"), "above")
        next_up = above.where("_n IS NOT NULL").select(F.col("c").alias("up"), F.col("up").alias("_up"), "_n")
        summed = above.select("c", "up", *[(F.col(s) + F.coalesce(f"_{s}", F.lit(0))).alias(s) for s in sums])
        risen = attach(summed.where("up IS NOT NULL"), next_up, ["up"], "c", n="_n").select("c", F.col("_up").alias("up"), *sums)
        state = cut(risen.union(summed.where("up IS NULL")), "chains")
    return state.select("c", *sums)


def _pieces_of_lists(batches):
    """Runs of rows (c, d, id) in order as pieces of a list: c, d, first id, text."""
    key, held, size, first = None, [], 0, None
    out: list[tuple] = []

    def close():
        nonlocal held, size
        if held:
            out.append((*key, first, ",".join(held)))
        held, size = [], 0

    for batch in batches:
        for c, d, i in zip(*[col.to_pylist() for col in batch.columns], strict=True):
            if (c, d) != key or size > PIECE_BYTES:
                close()
                key, first = (c, d), i
            held.append(str(i))
            size += len(held[-1]) + 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["c", "d", "first", "text"])
            out.clear()
    close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["c", "d", "first", "text"])


def _hashes_of_lists(batches):
    """SHA-256 of each list's pieces, which come in order: only the hash's state is held."""
    key, state = None, None
    out: list[tuple] = []
    for batch in batches:
        for c, d, text in zip(*[batch[n].to_pylist() for n in ("c", "d", "text")], strict=True):
            if (c, d) != key:
                if state is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (c, d), hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["c", "d", "ends"])
            out.clear()
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, state.hexdigest())], ["c", "d", "ends"])


def _ends(ended: DataFrame) -> DataFrame:
    """c, d, ends: the hash of the ids that end at each node; ``ended`` has c, d, id.

    Ids are put in order and into pieces over a range partition, so that a node of very many ids is a few rows afterwards.
    """
    parts = int(ended.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ended.select("c", "d", "id").repartitionByRange(parts, "c", "d", "id").sortWithinPartitions("c", "d", "id")
    pieces = ordered.mapInArrow(_pieces_of_lists, "c long, d long, first long, text string")
    return pieces.repartition(parts, "c", "d").sortWithinPartitions("c", "d", "first").select("c", "d", "text").mapInArrow(_hashes_of_lists, "c long, d long, ends string")


def trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each node of the prefix trie of the rebuilt ``conversations`` (conv_id, turn, role, text)."""
    ship(conversations.sparkSession)
    turns, convs = rebuilt(conversations)
    prefixes = cut(_prefixes(cut(turns, "rebuilt"), convs, block), "prefixes")
    minima = cut(prefixes.groupBy("d", "x", "y").agg(F.min("c").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes")), "minima")
    found = first_owned(prefixes, minima, convs)
    owned = found.where("start <= len")
    hung = _owners(cut(owned.where("start > 0").select("c", (F.col("start") - 1).alias("d")), "hung"), prefixes, minima).select("c", F.col("owner").alias("up"), F.col("d").alias("up_d"))
    chains = cut(owned.join(hung, "c", "left"), "chains")
    own = minima.select(F.col("owner").alias("c"), "d", "n_convs", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    below = cut(chains.where("up IS NOT NULL").groupBy(F.col("up").alias("c"), F.col("up_d").alias("d")).agg(F.count(F.lit(1)).alias("hanging")), "hanging")
    leafless = below.join(chains.select("c", F.col("len").alias("d")), ["c", "d"], "left_semi").select("c", F.lit(0).cast("long").alias("ends_in_leaf"))
    per_chain = own.groupBy("c").agg(F.sum("saved").alias("saved"))
    totals = _subtrees(chains.select("c", "up").join(per_chain, "c").join(leafless, "c", "left").withColumn("leaves", F.coalesce("ends_in_leaf", F.lit(1).cast("long"))), ["saved", "leaves"])
    hanging = chains.where("up IS NOT NULL").join(totals, "c").groupBy(F.col("up").alias("c"), F.col("up_d").alias("d")).agg(F.sum("saved").alias("under_saved"), F.sum("leaves").alias("under_leaves"), F.count(F.lit(1)).alias("hanging"))
    nodes = own.join(hanging, ["c", "d"], "left").fillna(0, ["under_saved", "under_leaves", "hanging"])
    facts = cut(chains.join(totals.withColumnsRenamed({"saved": "all_saved", "leaves": "all_leaves"}), "c").withColumn("n_owned", F.col("len") - F.col("start") + 1), "facts")
    nodes = cut(nodes.withColumn("s", F.col("saved") + F.col("under_saved")), "own-sums")
    summed = running(nodes, "c", "d", {"to_saved": "sum(s)", "to_leaves": "sum(under_leaves)"}, block)
    summed = attach(cut(summed, "nodes"), facts, ["c"], "d", n="n_owned")
    ended = _owners(cut(convs.select("c", F.col("len").alias("d")), "ended"), prefixes, minima).select(F.col("owner").alias("c"), "d", F.col("c").alias("id"))
    out = summed.join(_ends(ended), ["c", "d"], "left")
    here = lambda name, own: F.col(f"all_{name}") - F.col(f"to_{name}") + F.col(own)
    return out.select(
        F.col("c").alias("conv_id"),
        F.col("d").alias("depth"),
        F.when(F.col("d") > F.col("start"), F.col("c")).otherwise(F.col("up")).alias("parent_conv_id"),
        "n_convs",
        (F.col("hanging") + (F.col("d") < F.col("len")).cast("long")).alias("n_children"),
        here("leaves", "under_leaves").alias("n_leaves"),
        here("saved", "s").alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
