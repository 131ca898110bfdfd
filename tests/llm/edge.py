"""A small documents table with every awkward case, and brute-force versions of the operators."""

import random
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that inputs may bring along, named like columns that operators use inside.
CLASHING = ("n", "part", "band", "kept", "score", "ids", "root", "blob", "rule", "spans", "held_out", "component_id", "w", "_row", "_blob", "_guess", "good", "bucket", "cluster")


def prose(seed, n, words=("river", "stone", "light", "walks", "under", "green", "sky", "over", "Old", "bridge", "and", "the", "a")):
    r = random.Random(seed)
    return " ".join(r.choice(words) + (str(r.randint(0, 99)) if r.random() < 0.3 else "") for _ in range(n))


def texts():
    base = prose(1, 120)
    swapped = base.split()
    swapped[60] = "changed"
    out = [None, "", "   \n\t ", "one", "one two three", "one two three", base, base, base.upper(), " ".join(swapped), prose(2, 20000), prose(3, 300)]
    out += ["a b c " * 60, "\n".join(["same line here"] * 30 + ["x"]), "### *** " * 40, "word\x0b\x0cword no-break  em", "日本語 のテキスト です", "Σίσυφος İstanbul ß <|endoftext|> don't", "x" * 5000]
    for k in range(6):
        words = prose(50, 200).split()
        for at in random.Random(k).sample(range(200), 4 + 2 * k):
            words[at] = f"edit{k}-{at}"
        out.append(" ".join(words))
    return out


def documents(spark, more=()):
    rows = [(k, t, ("en", "fr", None)[k % 3], f"s{k % 2}", None if t is None else len(t)) for k, t in enumerate([*texts(), *more])]
    rows += [(None, prose(9, 80), "en", None, None), (6, texts()[6], "en", "s0", 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHING})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def roots(links):
    """The smallest id of each component, by id."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for x in sorted(near):
        if x not in out:
            todo = [x]
            while todo:
                y = todo.pop()
                if y not in out:
                    out[y] = x
                    todo += near[y]
    return out


def similar_documents(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    links = []
    for k, (i, a) in enumerate(sets):
        links += [(i, j) for j, b in sets[:k] if a and b and i != j and 100 * len(a & b) >= 75 * len(a | b)]
    return roots(links)


def secret_spans(text):
    t = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def base_measures(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, covered = Counter(zip(w, w[1:], w[2:], strict=False)), set()
    for i in range(len(w) - 2):
        if seen[tuple(w[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines, repeats = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), repeats, len(covered)


def crc(ids):
    import numpy as np

    return zlib.crc32(np.array(ids, "<u4").tobytes())
