"""Packing, the token store and SentencePiece against the libraries."""

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from millrace.llm import packing, sentencepiece_codec, token_store
from millrace.llm.shared import shared_dir
from millrace.llm.tokens import Encoder
from pyspark.sql import functions as F

from . import edge

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def ids():
    t = Tokenizer.from_file(WORD)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [2]


def test_encoder_is_the_library():
    import random

    e = Encoder(WORD, True)
    assert e.by_chunk and e.lowers and e.splits_ends
    r = random.Random(3)
    for _ in range(1500):
        t = "".join(r.choice("aA .,'\n\t<>|!?#1é É̀ß日ΣİI$-_\x01\x1c  ") for _ in range(r.randint(0, 30)))
        assert e.encode([t])[0] == e._raw(t), t
    for t in edge.texts():
        assert e.encode([t or ""])[0] == e._raw(t or "")


def test_packing(spark, ids):
    docs = edge.documents(spark).repartition(3)
    pieces = packing.pack(docs, WORD, with_ids=True).cache()
    rows = pieces.collect()
    total = sum(len(ids(r.text)) for r in docs.collect())
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
        assert edge.crc(np.frombuffer(r.ids, "<u4")) == r.ids_crc32 and 0 < r.length == len(r.ids) // 4
    assert sum(at.values()) == total and sorted(at) == list(range(len(at))) and all(n == 4096 for k, n in at.items() if k < len(at) - 1)
    once = {}
    for r in sorted(rows, key=lambda r: r.start):
        once.setdefault(r.doc_id, []).append(r)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for i, own in once.items():
        copies = 2 if i == 6 else 1
        assert sum(r.length for r in own) == copies * len(ids(texts[i])) and {r.doc_tokens for r in own} == {len(ids(texts[i]))}
        if copies == 1:
            assert b"".join(r.ids for r in own) == np.array(ids(texts[i]), "<u4").tobytes()
    whole = packing.sequences(pieces).collect()
    assert all(len(r.ids) == 4 * 4096 or r.n_ids & (r.n_ids - 1) == 0 for r in whole) and sum(len(r.boundaries) for r in whole) == len(rows)
    assert packing.pack(edge.empty(spark), WORD).count() == 0


def test_token_store(spark, ids):
    docs = edge.documents(spark).repartition(3)
    path = shared_dir(spark, "store")
    made = token_store.write(docs, path, WORD, bytes_per_shard=2000, group=2).orderBy("seq").collect()
    n = len(made)
    assert n > 3 and [m.seq for m in made] == list(range(n)) and [m.before for m in made] == [sum(x.n_ids for x in made[:k]) for k in range(n)]
    assert [p["n"] for p in token_store._json(path, "manifest.json")["parts"]] == [min(2, n - k) for k in range(0, n, 2)]
    rows = sorted(token_store.lookup(spark, path, docs, with_ids=True).collect(), key=lambda r: r.start)
    want = sorted([(r.doc_id is not None, r.doc_id, r.text or "") for r in docs.collect()], key=lambda x: (x[0], x[1] or 0, x[2]))
    at = 0
    assert len(rows) == len(want)
    for r, (_, i, t) in zip(rows, want, strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids(t)), edge.crc(ids(t)))
        assert r.ids == np.array(ids(t), "<u4").tobytes()
        at += r.n_tokens
    assert token_store.lookup(spark, path, spark.createDataFrame([(10**9,), (-5,)], "doc_id long")).count() == 0
    assert token_store.write(edge.empty(spark), shared_dir(spark, "store"), WORD).count() == 0


def test_key_of_many_shards(spark, ids):
    """A third of all rows under one key, and as many without one: keys span shards, and all documents come back."""
    rows = [(k if k % 3 == 0 else 50 if k % 3 == 1 else None, f"text {k} of the {k % 7} kinds") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = shared_dir(spark, "store")
    made = token_store.write(docs, path, WORD, bytes_per_shard=500, group=3).collect()
    assert sum(m["low"] == m["high"] == 50 for m in made) > 1 and sum(m["high"] is None for m in made) > 1
    got = token_store.lookup(spark, path, docs, with_ids=True).collect()
    assert sorted((r.doc_id or -1, r.ids) for r in got) == sorted((i or -1, np.array(ids(t), "<u4").tobytes()) for i, t in rows)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    few = token_store.lookup(spark, path, spark.createDataFrame([(50,), (50,), (99,), (98,)], "doc_id long")).collect()
    assert sorted({r.doc_id for r in few}) == [50, 99] and len(few) == 201


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 1000, 20000])
def test_perfect_hash(n):
    h = token_store.hashed(list(range(-3, n - 3)))
    d, slots = token_store.build_index(h)
    assert sorted(slots.tolist()) == list(range(n))
    if n:
        assert (token_store.slot_of(h, d, n) == slots).all()


def test_sentencepiece(spark):
    import random

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    c = sentencepiece_codec.Codec(PIECE)
    r = random.Random(3)
    many = ["".join(r.choice("aA .,'\n\t<>|!?#1é É̀ß日ΣİI$-_\x01▁ 你好😀  ​") for _ in range(r.randint(0, 30))) for _ in range(1500)]
    for t in [*many, *[x for x in edge.texts() if x]]:
        got = np.frombuffer(c.encode(t), "<u4")
        assert got.tolist() == sp.encode(t), t
        assert c.decode(got) == sp.decode(sp.encode(t))
    docs = edge.documents(spark)
    encoded = sentencepiece_codec.encode(docs, PIECE)
    back = {(r.doc_id, r.text) for r in sentencepiece_codec.decode(encoded, PIECE).collect()}
    assert back == {(r.doc_id, r.text or "") for r in docs.collect()}
    rows = sentencepiece_codec.round_trip(docs, PIECE).collect()
    assert len(rows) == docs.count() and all(r.lossless for r in rows)
    assert sentencepiece_codec.round_trip(edge.empty(spark), PIECE).count() == 0


def test_unigram_viterbi():
    """With a unigram's scores, the best sum wins."""
    import itertools

    c = sentencepiece_codec.Codec(PIECE)
    c.bpe = False
    r = np.random.RandomState(1)
    c.score = r.uniform(-10, -1, len(c.pieces)).tolist()
    known = {p: i for i, p in enumerate(c.pieces) if c.kinds[i] == 1}
    for text in ("▁river", "▁abc", "▁the▁", "stone"):
        best = None
        for cuts in itertools.product([0, 1], repeat=len(text) - 1):
            parts, at = [], 0
            for k, x in enumerate([*cuts, 1], 1):
                if x:
                    parts.append(text[at:k])
                    at = k
            if all(p in known for p in parts):
                s = sum(c.score[known[p]] for p in parts)
                best = max(best, (s, [known[p] for p in parts])) if best else (s, [known[p] for p in parts])
        assert c._viterbi(text) == best[1]
    assert F is not None
