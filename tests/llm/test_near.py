"""Near-duplicates of documents and embeddings, components, and pages, against brute force."""

import numpy as np
import pytest

from millrace.llm import embedding_dedup, html_extract, minhash_dedup
from millrace.llm.components import components
from millrace.llm.shared import attach, cut
from pyspark.sql import functions as F

from . import edge


def test_components(spark):
    r = np.random.RandomState(2)
    links = [(int(a), int(b)) for a, b in r.randint(0, 400, (260, 2))] + [(k, k + 1) for k in range(1000, 1200)] + [(5000, k) for k in range(5001, 5300)] + [(7, 7)]
    df = spark.createDataFrame([*links, (None, 1)], "a long, b long").repartition(5)
    got = {x.id: x.component for x in components(df).collect()}
    want = edge.roots([e for e in links if e[0] != e[1]])
    assert {**{k: k for k in want}, **got} == want
    assert components(df.limit(0)).count() == 0


def check(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = edge.similar_documents(rows)
    got = minhash_dedup.near_duplicates(docs).collect()
    assert sorted((r.doc_id or -1, r.n_shingles) for r in got) == sorted((i or -1, len(edge.shingles(t))) for i, t in rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want.get(r.doc_id, r.doc_id) and r.kept == (r.component_id == r.doc_id)
    return got


def test_documents(spark):
    docs = edge.documents(spark)
    got = check(spark, docs)
    assert sum(not r.kept for r in got) >= 4
    out = minhash_dedup.deduplicated(docs)
    assert out.columns == docs.columns and out.count() == sum(r.kept for r in got)
    assert minhash_dedup.near_duplicates(edge.empty(spark)).count() == 0


def test_large_group_of_near_copies(spark):
    """A group in which most pairs lie about the threshold; more members than a block holds."""
    import random

    base, rows = edge.prose(77, 60).split(), []
    for k in range(400):
        r = random.Random(k)
        words = list(base)
        for at in r.sample(range(60), r.choice([1, 1, 2])):
            words[at] = f"e{r.randint(0, 30)}"
        rows.append((k, " ".join(words)))
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"))


def test_repeated_ids(spark):
    """Rows of one doc_id with different texts are one vertex."""
    a, b, c = edge.prose(11, 90), edge.prose(12, 90), edge.prose(13, 90)
    near = " ".join([*c.split()[:-1], "changed"])
    rows = [(3, a), (4, b), (5, a), (5, b), (6, c), (7, near), (8, near), (8, b), (8, b)]
    got = check(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got} == {k: 3 for k in (3, 4, 5, 6, 7, 8)}


def test_thousands_of_near_copies(spark):
    """A clear group of 5,000 near copies, with a few documents that bands lead to it and sets don't."""
    import random

    base, rows = edge.prose(78, 300).split(), []
    for k in range(5000):
        r = random.Random(k)
        words = list(base)
        for at in r.sample(range(300), 1):
            words[at] = f"e{r.randint(0, 1 << 30)}"
        rows.append((k + 100, " ".join(words)))
    for k in range(20):
        words = list(base)
        for at in range(k % 10, 300, 10):
            words[at] = f"x{k}-{at}"
        rows.append((k, " ".join(words)))
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[k + 100] == 100 for k in range(5000)) and all(got[k] == k for k in range(20))


def tasks_of(spark, group, run):
    """How many tasks of Spark's ``run`` started."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) if (job := tracker.getJobInfo(j)) for s in job.stageIds}
    return sum(i.numCompletedTasks for s in stages if (i := tracker.getStageInfo(s)))


def test_rounds_over_many_partitions(spark):
    """What a partition costs is paid a bounded number of times: few rounds, and Python only where links are."""
    import random

    base, rows = edge.prose(79, 200).split(), []
    for k in range(300):
        r = random.Random(k)
        words = list(base)
        for at in r.sample(range(200), r.choice([1, 2, 3])):
            words[at] = f"e{r.randint(0, 1 << 30)}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, edge.prose(1000 + k, 60)) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 32), spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = []
        n = tasks_of(spark, "rounds", lambda: got.extend(minhash_dedup.near_duplicates(docs).collect()))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert all(r.component_id == (0 if r.doc_id < 1000 else r.doc_id) for r in got) and len(got) == 400
    assert n <= 1000


def test_hot_keys_are_joined_in_place(spark):
    """Facts reach hot keys by a broadcast, by salts beyond its limit, and cold keys by a shuffle, alike."""
    rows = spark.createDataFrame([(k, 1 if k < 700 else k % 50 + 2 if k % 3 else None) for k in range(2000)], "id long, key long")
    facts = cut(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top")).where("key % 7 != 2"), "facts")
    want = sorted(map(str, rows.join(facts, ["key"], "left").select("id", "key", "n", "top").collect()))
    for limit in (10, 0):
        out = attach(rows, facts, ["key"], "id", limit=limit)
        assert out.columns == ["id", "key", "n", "top"] and sorted(map(str, out.collect())) == want


def test_sketches():
    """The estimate from odd sketches is within its error of the share of equal values."""
    a = np.random.RandomState(0).randint(0, 1 << 62, 3000).astype(np.uint64)
    for keep in (1.0, 0.95, 0.85):
        b = np.concatenate([a[: int(len(a) * keep)], np.random.RandomState(1).randint(0, 1 << 62, len(a) - int(len(a) * keep)).astype(np.uint64)])
        v = minhash_dedup.minhashes([np.sort(a), np.sort(b)])
        differ = int((v[0] != v[1]).sum())
        s = minhash_dedup.odd_sketches(v)
        x = int(np.bitwise_count(s[0] ^ s[1]).sum())
        estimate = -minhash_dedup.BITS / 4 * np.log(1 - 2 * x / minhash_dedup.BITS)
        assert abs(estimate - differ) <= 6


def vectors(spark):
    r = np.random.RandomState(4)
    rows, k = [], 0
    for label in (1, 2):
        for _ in range(12):
            base = r.standard_normal(24)
            for size in (0, 0, 0.05, 0.07, 0.075, 0.3):
                noise = r.standard_normal(24)
                rows.append((k, [float(np.float32(x)) for x in base + size * noise * np.linalg.norm(base) / np.linalg.norm(noise) * 4], label))
                k += 1
    line = r.standard_normal(24)
    rows += [(k + i, [float(x) for x in line + 0.02 * r.standard_normal(24)], 3) for i in range(300)]
    k = len(rows)
    rows += [(k, None, 1), (k + 1, [0.0] * 24, 1), (k + 2, [float("nan")] + [1.0] * 23, 1), (k + 3, [None] + [1.0] * 23, 1), (k + 4, [float("inf")] * 24, 1), (k + 5, rows[0][1], None), (k + 6, [1.0, 2.0], 1), (k + 7, [2.0, 4.0], 1), (k + 8, [], 1), (None, rows[0][1], 1), (0, rows[0][1], 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit(1) for c in ("cell", "n", "copies", "place")})


def test_embeddings(spark):
    df = vectors(spark)
    rows = {(r.vec_id): (r.embedding, r.label) for r in df.collect() if r.vec_id is not None}
    good = {}
    for i, (v, label) in rows.items():
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            good[i] = (x / np.linalg.norm(x), label)
    links = [(i, j) for i in good for j in good if i < j and good[i][1] == good[j][1] and len(good[i][0]) == len(good[j][0]) and good[i][0] @ good[j][0] >= 0.93]
    got = embedding_dedup.near_duplicates(df).collect()
    assert len(got) == df.count()
    found = sum(r.n_links for r in {r.vec_id: r for r in got if r.vec_id is not None}.values()) / 2
    assert 0.9 * len(links) <= found <= len(links) and embedding_dedup.recall() >= 0.95
    want = edge.roots(links)
    right = sum(r.component_id == want.get(r.vec_id, r.vec_id) for r in got)
    assert right >= 0.97 * len(got)
    assert all(r.n_links == 0 and r.kept for r in got if r.vec_id not in good)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_repeated_vec_ids(spark):
    """Rows of one vec_id with different vectors are one vertex; each row has the links of its own vector."""
    r = np.random.RandomState(9)
    a, b, c, d = ([float(x) for x in r.standard_normal(16)] for _ in range(4))
    rows = [(3, a, 1), (4, b, 1), (5, a, 1), (5, b, 1), (6, c, 1), (6, d, 1), (7, c, 1), (7, c, 1), (8, d, 2), (9, None, 1)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((x.vec_id, x.n_links, x.component_id) for x in got) == [(3, 1, 3), (4, 1, 3), (5, 1, 3), (5, 1, 3), (6, 0, 6), (6, 1, 6), (7, 1, 6), (7, 1, 6), (8, 0, 8), (9, 0, 9)]


def test_one_vector_in_a_third_of_the_rows(spark):
    """Copies beyond what a key may have before it is joined in place, and vectors that link with nothing by the hundred."""
    r = np.random.RandomState(10)
    base = [float(x) for x in r.standard_normal(16)]
    rows = [(k, base, 1) for k in range(700)] + [(1000 + k, base, None) for k in range(500)] + [(2000 + k, [float(x) for x in r.standard_normal(16)], 1) for k in range(100)]
    got = {x.vec_id: x for x in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert len(got) == len(rows) and all(got[k].n_links == 699 and got[k].component_id == 0 and got[k].kept == (k == 0) for k in range(700))
    assert all(got[1000 + k].n_links == 0 and got[1000 + k].kept for k in range(500)) and sum(got[2000 + k].kept for k in range(100)) > 90


def test_collision_counts():
    """Sorted windows count what the definition says."""
    r = np.random.RandomState(0)
    a, b = r.standard_normal((40, 32)), r.standard_normal((30, 32))
    want = (np.abs(a[:, None, :] - b[None, :, :]) <= embedding_dedup.WINDOW).sum(axis=2)
    assert (embedding_dedup.collisions(a, b) == want).all()


PAGE = """<!DOCTYPE html><html><head><title>T {k}</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header>Site name</header><nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- x --><div class="ad">Buy now</div>
<div class="cookie-notice">We use cookies</div><article><h1>Title {k}</h1><p>First &amp; <b>bold</b> text\n of   {k}.<br>Same block<p>Second&nbsp;&eacute; {k}
<form><input value="q">Search</form><div id="comments"><p>Reader says</p></div></article><aside>More</aside><footer>&copy; Site</footer>"""
PLAIN = """<body><div><span>Welcome to example dot com</span></div><div>Story {a} {b} of the day {c}</div><div><p>Subscribe to get the best offers</p></div></body>"""


def test_pages(spark):
    rows = [(k, f"https://a.example/{k}", PAGE.format(k=k)) for k in range(3)]
    rows += [(10 + k, "http://plain.example/x", PLAIN.format(a=f"alpha{k}", b="beta " * (k + 1), c=k * 7)) for k in range(12)]
    rows += [(30, None, None), (31, "::not a url", ""), (32, "http://a.example/", "no tags at all &lt;b&gt;"), (33, "http://a.example/", "<article><p>open <b>never closed"), (None, "http://b.example", "<main>x" + " y" * 100000), (34, "http://b.example", "<script>if (a < b) {}</script>1 < 2 & 3")]
    df = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("site", "host", "n", "text", "n_chars")})
    got = html_extract.extract(df).collect()
    assert len(got) == len(rows) + 1 and all(r.n_chars == len(r.text) for r in got)
    text = {r.page_id: r.text for r in got}
    assert text[1] == "Title 1\n\nFirst & bold text of 1. Same block\n\nSecond é 1"
    assert text[13] == "Story alpha3 beta beta beta beta of the day 21"
    assert (text[30], text[31], text[32], text[33]) == ("", "", "no tags at all <b>", "open never closed")
    assert len(text[None]) == 200001 and text[34] == "1 < 2 & 3"
    assert html_extract.extract(df.limit(0)).count() == 0


def test_template_needs_varied_pages():
    """A single page, or copies of one, deduce nothing; a passage that a third of all documents share is no template."""
    one = "<body><p>The only text</p></body>"
    assert html_extract.main_texts([one] * 20) == ["The only text"] * 20
    assert html_extract.CHUNK >= html_extract.LEAST_PAGES == 8
    assert html_extract.PASSAGE**8 < html_extract.CHANCE < html_extract.PASSAGE**7


@pytest.mark.parametrize(
    ("inner", "text"),
    [
        ("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> hold.</p>", "Let x=1 hold."),
        ('<section id="related-work"><p>Others did this before.</p></section>', "Others did this before."),
        ('<section id="search-algorithms"><h2>Search</h2><p>Binary search halves.</p></section>', "Search\n\nBinary search halves."),
        ('<div class="ad-hoc">A network without a base.</div>', "A network without a base."),
        ('<p class="alert-level">The level is low.</p>', "The level is low."),
        ('<p>One <video src="x">no video</video><x-note>two</x-note> <button>Buy</button>three</p>', "One two three"),
        ('<p>Text</p><div class="comments"><p>First!</p></div><div class="site-footer">Foot</div><ul id="comment-list"><li>Reader</li></ul>', "Text"),
        ('<p>Text</p><div class="related-links-more"><a href="/a">More of this</a> <a href="/b">and that</a></div>', "Text"),
        ('<p>Text <a href="/x">all</a> <a href="/y">links</a></p>', "Text all links"),
    ],
)
def test_article_text_is_whole(inner, text):
    """Names inside an article need evidence unless all of a word says so; formulas and links stay in their sentence."""
    assert html_extract.main_texts([f"<body><nav>Menu</nav><article>{inner}</article><p>Outside</p></body>"]) == [text]


SHOP = "<body><div><span>Welcome to our shop</span></div><div>{menu}</div><table>{rows}</table><div><p>All rights are reserved</p></div></body>"


def shop(k):
    rows = "".join(f"<tr><td>Price of item</td><td>thing{k}-{i} has no {k * i}</td></tr>" if i else f"<tr><td>Price of item</td><td>thing{k}</td></tr>" for i in range(1 + k % 3))
    return SHOP.format(menu=" ".join(f'<a href="/{i}">go{k}-{i}</a>' for i in range(3 + k % 2)), rows=rows)


def test_classes_against_brute_force():
    """Occurrence vectors, order, nesting and slots, told anew from the pages' tokens."""
    pages = [html_extract.Page(shop(k)) for k in range(12)]
    tokens = {t for p in pages for t in p.tokens}
    vector = {t: tuple(p.tokens.count(t) for p in pages) for t in tokens}
    want = {}
    for t, v in vector.items():
        if sum(n > 0 for n in v) >= 0.95 * len(pages):
            want.setdefault(v, set()).add(t)
    want = {frozenset(c) for c in want.values() if len(c) >= 3 and any(path for path, _ in c)}
    assert {frozenset(c) for c in html_extract.classes(pages)} == want and len(want) == 2
    outer, inner = html_extract.template(pages)
    assert len(outer.tokens) > len(inner.tokens) and outer.parent == -1 and inner.parent == 0
    assert [w for _, w in inner.tokens] == ["/body/table/tr", "Price", "of", "item"] and {"Welcome", "reserved"} < {w for _, w in outer.tokens}
    for k, p in enumerate(pages):
        at = [i for i, t in enumerate(p.tokens) if t in set(outer.tokens)]
        rows = [i for i, t in enumerate(p.tokens) if t in set(inner.tokens)]
        assert len(rows) == (1 + k % 3) * len(inner.tokens) and all(at[inner.gap - 1] < i < at[inner.gap] for i in rows)
    texts = html_extract.main_texts([shop(k) for k in range(12)])
    for k, text in enumerate(texts):
        assert text.split("\n\n") == [f"thing{k}-{i} has no {k * i}" if i else f"thing{k}" for i in range(1 + k % 3)]


def test_crossing_classes_are_not_nested():
    order = lambda *names: tuple(("p", x) for x in names)
    a = html_extract.Class(order("a", "b", "c", "d"), places=[[0, 2, 5, 9], [0, 2, 5, 9]])
    crossing = html_extract.Class(order("x", "y", "z"), places=[[1, 3, 4], [1, 3, 4]])
    inside = html_extract.Class(order("u", "v", "w"), places=[[6, 7, 8], [6, 7, 8]])
    apart = html_extract.Class(order("m", "n", "o"), places=[[10, 11, 12], [10, 11, 12]])
    kept = html_extract.nested([apart, inside, crossing, a])
    assert [c.tokens for c in kept] == [a.tokens, apart.tokens, inside.tokens]
    assert [(c.parent, c.gap) for c in kept] == [(-1, -1), (-1, -1), (0, 3)]


def test_large_hosts_are_chunked(spark):
    """A host of 200 pages is dealt in chunks that each find the template; sizes come by a broadcast or a join alike."""
    rows = [(k, f"http://shop.example/{k}", shop(k)) for k in range(200)] + [(500 + k, f"http://h{k}.example/", "<p>alone</p>") for k in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = [{r.page_id: r.text for r in html_extract.extract(df, limit=limit).collect()} for limit in (1000, 0)]
    assert found[0] == found[1] and len(found[0]) == 220
    assert all(found[0][k].split("\n\n") == [f"thing{k}-{i} has no {k * i}" if i else f"thing{k}" for i in range(1 + k % 3)] for k in range(200))
    assert all(found[0][500 + k] == "alone" for k in range(20))
