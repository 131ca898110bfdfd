"""Token ids of whole texts by a tokenizers file, with a memory of chunks between white space."""

from __future__ import annotations

import functools
import os
from collections.abc import Iterable

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import SparkSession

#: Chunks a Python worker remembers; it encodes others anew, so the bound changes no result.
MEMORY = 500_000
#: Longer chunks aren't remembered.
CHUNK_CHARS = 48
_encoders: dict[tuple[str, bool], Encoder] = {}


class Encoder(dict):
    """Ids as bytes of little-endian unsigned integers (16 bits if ``narrow``, else 32).

    A tokenizer that splits at white space, and normalises each part for itself, gives a text the ids of its chunks
    one after another. That is tried on a probe when the file is loaded; if it doesn't hold, texts are encoded whole.
    """

    def __init__(self, path: str, narrow: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if narrow else "<u4"
        probe = "It's  the\tend,of 3 things\n\nÉtat́ naïve 日本 x_1 <|endoftext|>a  b ###!!"
        self.by_chunk = True
        same = lambda a, b: self._raw(a) == b"".join(map(self._raw, b))
        self.lowers = same("ÀB Éß <|x", ["àb éß <|x"])
        self.splits_ends = same("abc. dé, x.", ["abc", ".", "dé", ",", "x", "."])
        self.marks = {m: self._raw(m) for m in ".,"}
        self.by_chunk = self._raw(probe) == self.encode([probe])[0]
        self.by_chunk &= self._raw("  ") == b""

    def _raw(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _plain(self, text: str) -> str:
        """The text in lower case where the tokenizer would do that anyhow, letter by letter."""
        if self.lowers and "<" not in text:
            try:
                text.isascii() or text.encode("latin-1")
            except UnicodeEncodeError:
                return text
            return text.lower()
        return text

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of chunks that aren't remembered; as many as fit are from now on."""
        new: dict[str, bytes] = {}
        bases, ends = {}, {}
        for w in words:
            if w[-1:] in (".", ",") and self.splits_ends and w[:-1].lower().isalpha():
                ends[w] = w[:-1]
                if w[:-1] not in self:
                    bases[w[:-1]] = None
            else:
                bases[w] = None
        todo = list(bases)
        width = np.dtype(self.kind).itemsize
        for at in range(0, len(todo), 1024):  # one call for many chunks, set between spaces
            part = todo[at : at + 1024]
            e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids, first = np.asarray(e.ids, self.kind).tobytes(), np.array([a for a, _ in e.offsets], np.int64)
            cuts = (np.searchsorted(first, np.cumsum([0, *(len(w) + 1 for w in part)])) * width).tolist()
            new.update(zip(part, (ids[p:q] for p, q in zip(cuts, cuts[1:], strict=False)), strict=True))
        for w, base in ends.items():
            new[w] = (new[base] if base in new else self[base]) + self.marks[w[-1]]
        for w, ids in new.items():
            if len(self) >= MEMORY:
                break
            if len(w) <= CHUNK_CHARS:
                self[w] = ids
        return new

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        if not self.by_chunk:
            return [self._raw(t) for t in texts]
        words: list[str] = []
        ends = []
        for t in texts:
            words += self._plain(t).replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            ends.append(len(words))
        ids = list(map(self.get, words))
        if None in ids:
            unknown = [k for k, x in enumerate(ids) if x is None]
            new = self._learn(list(dict.fromkeys([words[k] for k in unknown])))
            for k in unknown:
                ids[k] = new[words[k]]
        return [b"".join(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)]


def offer(spark: SparkSession, path: str) -> None:
    """Sends a tokenizer's file to the executors of a cluster, once a session; ``found`` finds it there."""
    sent = spark.sparkContext.__dict__.setdefault("_millrace_files", set())
    if not spark.sparkContext.master.startswith("local") and path not in sent:
        spark.sparkContext.addFile(path)
        sent.add(path)


def found(path: str) -> str:
    """A tokenizer's file on this machine: at the driver's path, or as it was sent."""
    return path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))


def encoder(path: str, narrow: bool) -> Encoder:
    """The encoder of this Python process for the file at ``path``."""
    if (path, narrow) not in _encoders:
        _encoders[path, narrow] = Encoder(found(path), narrow)
    return _encoders[path, narrow]


@functools.cache
def is_narrow(path: str, *ids: int) -> bool:
    """Whether all ids of the tokenizer file, and those given, fit 16 bits. Called where the plan is made."""
    from tokenizers import Tokenizer

    return max([Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) - 1, *ids]) < 1 << 16


def slices(table, chars: int = 1 << 20):
    """Row ranges of an Arrow table or batch with a string column ``text``, of about so many bytes each."""
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(table.column("text")), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(sizes):
        to = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + chars, side="right"))
        to = max(to, at + 1)
        yield at, to
        at = to
