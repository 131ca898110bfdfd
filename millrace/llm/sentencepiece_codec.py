"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

The automaton holds every piece of the model. It reads a text once; at each position its output links name the pieces
that end there, longest first, and each relaxes the best path at that position. A unigram model's score of a path is
the sum of its pieces' scores. A BPE model's pieces have no such sum: a path is possible only if each two neighbours
would stay apart under the model's merges, exactly one path is, and relaxing keeps it. Whether two pieces stay apart
is asked of the model once for each pair and remembered. The result is the library's own segmentation in both cases.

White space and other characters are handled as the model's normaliser says; models with an identity normaliser and no
removal of extra white space are supported, others are refused. Characters that no piece covers become their UTF-8
bytes (if the model has byte pieces) or the unknown id. As no piece of such models reaches over the start of a word,
words are encoded one by one, cut further between characters that stand side by side in no piece; a worker remembers
the ids of words and parts it has seen.

Defined results: a null text is encoded like an empty one, to no ids, and decodes to an empty text; repeated rows get
the same result; an empty table gives an empty result; other columns are ignored; texts of any length are taken whole.
"""

from __future__ import annotations

import re
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import ship
from .tokens import found, offer, slices

SPACE = "▁"
MEMORY = 500_000
WORD_CHARS = 48
_codecs: dict[str, Codec] = {}
_RUNS = re.compile(r" *[^ ]+| +")


class Codec:
    """A model file read for encoding and decoding."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm, kind = proto.normalizer_spec, proto.trainer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or kind.treat_whitespace_as_suffix:
            raise ValueError("only models that leave characters and white space as they are, with white space before words")
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bpe = kind.model_type == pb.TrainerSpec.BPE
        self.prefix = norm.add_dummy_prefix
        normal = pb.ModelProto.SentencePiece
        self.pieces = [p.piece for p in proto.pieces]
        self.kinds = [p.type for p in proto.pieces]
        self.unknown = self.model.unk_id()
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == normal.BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.automaton = ahocorasick.Automaton()
        self.score = [p.score for p in proto.pieces]
        self.whole_words = True
        for i, p in enumerate(proto.pieces):
            if p.type in (normal.NORMAL, normal.USER_DEFINED):
                self.automaton.add_word(p.piece, (len(p.piece), i))
                self.whole_words &= SPACE not in p.piece.lstrip(SPACE)
        self.automaton.make_automaton()
        self.apart: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.segments: dict[str, bytes] = {}
        self.beside = {p.piece[k : k + 2] for p in proto.pieces if p.type in (normal.NORMAL, normal.USER_DEFINED) for k in range(len(p.piece) - 1)}
        self.plain = [" \u2047 " if p.type == normal.UNKNOWN else "" if p.type == normal.CONTROL else p.piece.replace(SPACE, " ") for p in proto.pieces]
        for b, i in self.bytes.items():
            self.plain[i] = chr(b) if b < 128 else "\ufffd"
        self.high = np.array([i in self.byte_of and self.byte_of[i] >= 128 for i in range(len(self.pieces))])

    def _merged(self, text: str) -> list[int]:
        """Ids by the model of a text that starts in the middle of a word."""
        return self.model.encode("\n" + text if not text.startswith(SPACE) else "\n" + text.replace(SPACE, " "))[self._head :]

    @property
    def _head(self) -> int:
        if not hasattr(self, "_n_head"):
            self._n_head = len(self.model.encode("\n"))
        return self._n_head

    def _stays(self, piece: int) -> bool:
        found = self.alone.get(piece)
        if found is None:
            found = self.alone[piece] = self._merged(self.pieces[piece]) == [piece]
        return found

    def _apart(self, left: int, right: int) -> bool:
        found = self._merged(self.pieces[left] + self.pieces[right]) == [left, right]
        if len(self.apart) < MEMORY:
            self.apart[left * len(self.pieces) + right] = found
        return found

    def _viterbi(self, text: str) -> list[int]:
        """Ids of a text whose spaces are SPACE already."""
        n, many, apart, score = len(text), len(self.pieces), self.apart, self.score
        last, start, best = [-1] * (n + 1), [*range(-1, n)], [None] * (n + 1)  # piece (-1: none) and start of the best path's end
        best[0] = 0.0
        for end, (size, piece) in self.automaton.iter(text):
            at, since = end + 1, end + 1 - size
            left = last[since]
            if self.bpe:
                if last[at] < 0 and self._stays(piece):
                    good = left < 0 or apart.get(left * many + piece)
                    if good is None:
                        good = self._apart(left, piece)
                    if good:
                        last[at], start[at] = piece, since
                continue
            k = since
            while best[k] is None:  # characters that no piece covers
                k -= 1
            for k in range(k + 1, since + 1):
                best[k] = best[k - 1] - 1e3
            if best[at] is None or best[since] + score[piece] > best[at]:
                best[at], last[at], start[at] = best[since] + score[piece], piece, since
        out: list[int] = []
        at = n
        while at:
            piece, since = last[at], start[at]
            if piece >= 0:
                out.append(piece)
            elif self.bytes:
                out += [self.bytes[b] for b in reversed(text[since:at].encode())]
            else:
                out.append(self.unknown)
            at = since
        return out[::-1]

    def _segments(self, word: str) -> bytes:
        """Ids of a word, cut where no piece has the two characters side by side: no merge reaches over such a place."""
        at, out, beside, known = 0, [], self.beside, self.segments
        for k in range(1, len(word) + 1):
            if k == len(word) or word[k - 1 : k + 1] not in beside:
                part = word[at:k]
                ids = known.get(part)
                if ids is None:
                    ids = np.array(self._viterbi(part), "<u4").tobytes()
                    if len(known) < MEMORY and len(part) <= WORD_CHARS:
                        known[part] = ids
                out.append(ids)
                at = k
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not text:
            return b""
        if not self.whole_words:
            return np.array(self._viterbi((" " * self.prefix + text).replace(" ", SPACE)), "<u4").tobytes()
        if self.prefix and SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            words = text.split(" ")  # each has one space before it
        else:
            # a word is a run of spaces and what follows; keys of this sort start with a space
            words = [" " + w for w in _RUNS.findall((" " * self.prefix + text).replace(SPACE, " "))]
        ids = list(map(self.words.get, words))
        if None in ids:
            for k, x in enumerate(ids):
                if x is None:
                    w = words[k]
                    ids[k] = x = self._segments(w[1:].replace(" ", SPACE) if w[:1] == " " else SPACE + w)
                    if len(self.words) < MEMORY and len(w) <= WORD_CHARS:
                        self.words[w] = x
        return b"".join(ids)

    def decode(self, ids: np.ndarray) -> str:
        if not self.high[ids].any():
            text = "".join(map(self.plain.__getitem__, ids.tolist()))
            return text[1:] if self.prefix and text.startswith(" ") else text
        out, raw = [], bytearray()
        for i in ids.tolist():
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.plain[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        text = "".join(out)
        return text[1:] if self.prefix and text.startswith(" ") else text


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(found(path))
    return _codecs[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit) of every row of ``docs`` (doc_id, text)."""
    ship(docs.sparkSession)
    offer(docs.sparkSession, path)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("ids", T.BinaryType())])

    def run(batches):
        own = codec(path)
        for batch in batches:
            for a, b in slices(batch):
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array([own.encode(t) for t in rows.column("text").to_pylist()], pa.binary())], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of every row of ``encoded`` (doc_id, ids)."""
    ship(encoded.sparkSession)
    offer(encoded.sparkSession, path)
    schema = T.StructType([T.StructField("doc_id", encoded.schema["doc_id"].dataType), T.StructField("text", T.StringType())])

    def run(batches):
        own = codec(path)
        for batch in batches:
            texts = [own.decode(np.frombuffer(x or b"", "<u4")) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, decoded_crc32 (of the decoded text's UTF-8) and lossless of every row of ``docs``."""
    ship(docs.sparkSession)
    offer(docs.sparkSession, path)
    names = ["doc_id", "n_tokens", "ids_crc32", "decoded_crc32", "lossless"]

    def run(batches):
        own = codec(path)
        for batch in batches:
            for a, b in slices(batch):
                rows = batch.slice(a, b - a)
                out = []
                for t in rows.column("text").to_pylist():
                    ids = own.encode(t)
                    back = own.decode(np.frombuffer(ids, "<u4"))
                    out.append((len(ids) // 4, zlib.crc32(ids), zlib.crc32(back.encode()), back == (t or "")))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *[pa.array(c, k) for c, k in zip(zip(*out, strict=True), [*[pa.int64()] * 3, pa.bool_()], strict=True)]], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text")).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_crc32 long, decoded_crc32 long, lossless boolean")
