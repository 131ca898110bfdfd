"""Personal data, collocations and the prefix trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from millrace.llm import collocations, pii, prefix_trie
from pyspark.sql import functions as F

from . import edge

# ---- personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SPACE = r"\x20\x09-\x0D"
RUN = rf"[^{SPACE}0-9@]*[0-9@][^{SPACE}]*(?:\x20[^{SPACE}0-9@]*[0-9@][^{SPACE}]*)*"


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10 == 0


def real(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [(n, m.start(), m.end(), kind) for n, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if real(kind, m[0])]


def runs_of(text):
    """start, end, said, contexts, kind or None, looks of each run."""
    out, last = [], 0
    for m in re.finditer(RUN, text or ""):
        gap, last = text[last : m.start()], m.end()
        lead = len(re.match(r"""["'<\[{,;:]*""", m[0])[0])
        bare = re.sub(r"""["'>\]},;:.!?]+$""", "", m[0][lead:])
        words = [w.lower() for w in re.split(f"[{SPACE}]+", gap[-80:].strip(" \t\n\x0b\x0c\r")) if w]
        contexts = {" ".join(words[-k:]) for k in (1, 2) if len(words) >= k and any(c.isalpha() for c in words[-1])}
        kind = next((n for n, (k, p) in enumerate(PLAIN.items()) if any(real(k, x[0]) for x in re.finditer(p, m[0]))), None)
        digits = len(re.sub("[^0-9]", "", bare))
        short = len(m[0]) <= 64
        looks = [n for n, k in enumerate(pii.KINDS) if re.search(k.look, bare.lower()) and k.digits[0] <= digits <= k.digits[1]] if short and kind is None else []
        if bare:
            out.append((m.start() + lead, m.start() + lead + len(bare), bare.lower() if short else hashlib.sha256(m[0].encode()).hexdigest(), contexts, kind, looks))
    return out


def all_spans(texts):
    """Spans of each text by the module's definition."""
    runs = {t: runs_of(t) for t in {t or "" for t in texts}}
    graph = {(c, said): (kind, tuple(looks)) for rs in runs.values() for _, _, said, cs, kind, looks in rs for c in cs}
    met = Counter(c for c, _ in graph)
    seeds = {k: Counter(c for (c, _), (kind, _) in graph.items() if kind == k) for k in range(4)}
    scores = {c: [seeds[k][c] * pii.UNIT // (n + pii.PRIOR) for k in range(4)] for c, n in met.items()}
    for _ in range(pii.ROUNDS - 1):
        found = defaultdict(lambda: [0] * 4)
        for (c, said), (_, looks) in graph.items():
            for k in looks:
                found[said][k] = max(found[said][k], scores[c][k])
        more = defaultdict(lambda: [0] * 4)
        for (c, said), (_, looks) in graph.items():
            for k in looks:
                more[c][k] += found[said][k]
        scores = {c: [(seeds[k][c] * pii.UNIT + more[c][k]) // (n + pii.PRIOR) for k in range(4)] for c, n in met.items()}
    out = {}
    for t, rs in runs.items():
        new = []
        for start, end, _, cs, _, looks in rs:
            best = [max([scores[c][k] for c in cs if k in looks], default=0) for k in range(4)]
            if max(best) >= pii.STRONG:
                k = best.index(max(best))
                new.append((4 + k, start, end, "like_" + list(PLAIN)[k]))
        out[t] = sorted(base_spans(t) + new)
    return out


ODD = [
    "a@b.c_d@e.f x@y z@w..q.r mail <J.Doe+x@sub-1.example.com>, a@b@c.d é@x.yz 😀 me@host.org.",
    "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.255 12.3.4 999999999999999999999.1.1.1 1.2.3.4.",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 41111111111111111111111 0-0 1 2",
    "+1 (017) 555-7713 rest +12 3 +1 555 ()() +49 30 1234567890123456 ++1 222 333 44 (+33 1 23 45 67 89)",
    "x" * 3000 + "@" + "y" * 10 + ".z " + "7" * 3000 + " " + "1 " * 200,
]


def test_personal_data(spark):
    """Base spans by the plain patterns, learned ones by the definition."""
    r = random.Random(4)
    learn = [f"please call tel: +49 30 {r.randint(10**6, 10**7)} today" for _ in range(12)] + [f"write to mail: user{k}@example{k}.org or leave" for k in range(12)]
    found = ["you may call tel: (030) 1234567 at night", "then mail: bob@localhost, or", "serial no 030 7654321 is none", "no tel: 12 is short"]
    noise = [f"in the year {1900 + k} it rained" for k in range(40)]
    docs = edge.documents(spark, [*ODD, *learn, *found, *noise])
    texts = {i: t for i, t in ((r.doc_id, r.text) for r in docs.collect())}
    want = all_spans([r.text for r in docs.select("text").collect()])
    got = pii.digest(pii.find(docs)).collect()
    assert len(got) == docs.count()
    for row in got:
        if row.doc_id == 6:  # two texts have this id
            continue
        spans = want[texts[row.doc_id] or ""]
        text = lambda s: ",".join(f"{k}:{a}:{b}" for _, a, b, k in s)
        base = [s for s in spans if s[0] < 4]
        assert row.spans == text(spans), (row.doc_id, texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(text(base).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[0] == n for s in base) for n in range(4)]
    new = {t[a:b] for t, s in want.items() for n, a, b, _ in s if n >= 4}
    assert new == {"(030) 1234567", "bob@localhost"}
    assert pii.find(edge.empty(spark)).count() == 0


def test_patterns_like_the_plain_ones(spark):
    """On random strings of awkward characters."""
    r = random.Random(7)
    rows = [(k, "".join(r.choice("ab1279 .@+-()_\n") for _ in range(r.randint(0, 120)))) for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: [s for s in x.spans if s["nth_kind"] < 4] for x in pii.find(docs).collect()}
    for k, t in rows:
        assert [tuple(s) for s in got[k]] == base_spans(t), t


def test_a_text_of_very_many_rows(spark):
    docs = spark.createDataFrame([(k, "mail a@b.cd now" if k % 3 else f"nothing {k}") for k in range(1500)], "doc_id long, text string")
    assert {r.doc_id for r in pii.digest(pii.find(docs)).where("n_email = 1").collect()} == {k for k in range(1500) if k % 3}


# ---- collocations


def mined(rows, least, longest, top):
    count, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                count[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in count.items():
        phrases = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in phrases.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in phrases.items()):
                continue
            cuts = [(collocations.UNIT * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, n + 1, p.decode(), -a, x, y, total[lang], -s) for n, (s, a, p, x, y) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def phrase_rows(seed):
    r = random.Random(seed)
    words = ["new", "York", "city", "of", "the", "a", "É", "é", "x-y", "don't", "日本", " b"]
    fixed = ["new york city of the", "the A of", "once upon a time\tthere was"]
    rows = []
    for k in range(120):
        parts = [r.choice(fixed) if r.random() < 0.4 else " ".join(r.choice(words) for _ in range(r.randint(0, 9))) for _ in range(6)]
        rows.append((k, r.choice([". ", ",", "  ", "\n", "\x0b", " ? "]).join(parts), ("en", "de", None, "und")[k % 4]))
    return rows + [(200, None, "en"), (201, "", None), (202, " . ,\t", "de"), (203, "the " * 3000, "en"), (0, rows[0][1], "en")]


@pytest.mark.parametrize("slots", [1 << 27, 64])
def test_collocations(spark, slots):
    """Also with a bitmap that is full."""
    rows = phrase_rows(3)
    docs = spark.createDataFrame([(i, t, lang, "clash") for i, t, lang in rows], "doc_id long, text string, lang string, gram string").repartition(3)
    got = sorted(tuple(r) for r in collocations.collocations(docs, least=12, top=40, slots=slots).collect())
    assert got == mined([(lang, t) for _, t, lang in rows], 12, 5, 40) and len(got) > 30
    assert collocations.collocations(edge.empty(spark)).count() == 0


def test_slices_and_buckets():
    """Sums of slices are those of the whole; a bucket that outgrows its memory is counted all the same."""
    import pyarrow as pa

    schema = ["lang", "piece", "m"]
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "en", "de"]), pa.array(["a b a b", "b", "a b"]), pa.array([2, 3, 5])], schema)
    words = {(a, b): m for a, b, k, m in zip(*[c.to_pylist() for c in next(collocations._Slice([batch]).words()).columns], strict=True)}
    assert words == {("en", "a"): 4, ("en", "b"): 7, ("de", "a"): 5, ("de", "b"): 5}
    n = 600_000
    grams = pa.RecordBatch.from_arrays([pa.array(["en"] * n), pa.array([f"word{k % (n // 2)} and then some more words" for k in range(n)]), pa.array([2] * n, pa.int32()), pa.array([50 + k % 2 for k in range(n)])], ["lang", "gram", "k", "m"])
    got = pa.Table.from_batches(collocations._count(100)(iter([grams.slice(a, 10_000) for a in range(0, n, 10_000)])))
    assert got.num_rows == n // 2 and set(got["f"].to_pylist()) == {100, 102}


# ---- conversations


def tree(rows):
    """Nodes by brute force; rows are (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(built[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def chats(seed, n=60):
    r = random.Random(seed)
    rows = []
    for c in [*range(n), -3, -5, 2**62 + 1]:
        line = [("user" if k % 2 == 0 else None, r.choice(["hi", "", None, "Ünï", "why? because"])) for k in range(r.choice([0, 1, 3, 9, 14]))]
        rows += [(c, k if k else None, role, text) for k, (role, text) in enumerate(line)]
    rows += [(7, 2, "user", "tie"), (7, 2, "user", "tie"), (7, 2, "bot", "tie"), (None, 1, "user", "lost")]
    rows += [(c, k, "user", f"same {k}") for c in range(1000, 1400, 5) for k in range(12)]  # copies
    rows += [(2000 + 5 * c, k, "user", f"deep {k}" if k < 12 - c else f"own {c} {k}") for c in range(12) for k in range(13)]  # each hangs on the one before
    rows += [(3000, k, "user", "long" if k % 7 else f"long {k}") for k in range(300)] + [(3005, k, "user", "long" if k % 7 else f"long {k}") for k in range(280)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [4096, 4])
def test_prefix_trie(spark, block):
    rows = chats(5)
    table = spark.createDataFrame([(*x, "clash", 1) for x in rows], "conv_id long, turn long, role string, text string, c string, len int").repartition(5)
    got = sorted(tuple(r) for r in prefix_trie.trie(table, block).collect())
    want = tree(rows)
    assert len(got) == len(want)
    assert got == want


def test_no_conversations(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(table).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b")], table.schema)).count() == 0
    one = prefix_trie.trie(spark.createDataFrame([(4, None, None, None)], table.schema)).collect()
    assert [(r.conv_id, r.depth, r.n_convs) for r in one] == [(4, 0, 1)] + ([(4, 1, 1)] if zlib.crc32(b"4") % 9 == 0 else [])


def test_lists_in_pieces(monkeypatch):
    """A node's list comes in pieces of bounded size; the hash is that of the whole."""
    import pyarrow as pa

    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 20)
    ids = list(range(-50, 950))
    rows = [pa.RecordBatch.from_arrays([pa.array([1] * 100), pa.array([2] * 100), pa.array(ids[a : a + 100])], ["c", "d", "id"]) for a in range(0, 1000, 100)]
    pieces = list(prefix_trie._pieces_of_lists(iter(rows)))
    assert sum(p.num_rows for p in pieces) > 100
    got = pa.Table.from_batches(prefix_trie._hashes_of_lists(iter(pieces))).to_pylist()
    assert got == [{"c": 1, "d": 2, "ends": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()}]


def test_running_values(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 2).alias("at"), F.hash("id").cast("long").alias("v"))
    got = prefix_trie.running(rows, "g", "at", {"s": "sum(v)", "x": "bit_xor(v)"}, 8).orderBy("g", "at").collect()
    s, x = Counter(), Counter()
    for r in got:
        s[r.g] += r.v
        x[r.g] ^= r.v
        assert (r.s, r.x) == (s[r.g], x[r.g])
