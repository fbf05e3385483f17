"""Byte-pair encoding and decoding (operator 2).

The vocabulary is cut from a public tokenizer file.  A word (a piece of the byte-level
pre-tokenizer) is encoded by backtracking: an Aho-Corasick automaton over all tokens gives
the longest token that starts at each byte, the encoder takes the longest token that is
*compatible* with the one before it (merging the two texts again would give just these
two), and steps back when none fits.  The result equals applying the merges in order, in
time linear in the word.  Compatibility of a pair of tokens is decided from the merge that
built each token and kept in a table as pairs turn up.

Words repeat, so each Python worker keeps encoded words and space-delimited stretches in
dictionaries of bounded size; a word that is not there is encoded again.

Decoding looks every id up in an offset table over the joined bytes of the vocabulary.

Cases: a null text counts as empty; an empty text has no ids; texts are encoded whole,
however long; strings of special tokens inside a text become their ids, as in the
tokenizers library.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_type

from orderlake.llm.common import working

#: Pre-tokenizer pattern of the byte-level tokenizers (a fixed value).
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: A space that a plain split at spaces would put in the wrong piece.
LOOSE_SPACE = re.compile(r" (?=\s|$)")
#: Entries in each of two generations of the word cache of a Python worker.
CACHE_ENTRIES = 100_000


def _byte_letters() -> dict[str, int]:
    """Letter -> byte of the byte-level alphabet: printable bytes stand for themselves, the
    rest for the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Cache(dict):
    """A dictionary that makes missing values with ``make``.

    A key is kept from its second turn on (``seen`` has one byte per hash), so that words
    that turn up once take no room.  When full it becomes the old generation, from which
    values still in use are taken over.
    """

    def __init__(self, make, entries: int):
        super().__init__()
        self.make, self.entries, self.old = make, entries, {}
        self.seen = bytearray(1 << 22)

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            at = hash(key) & 0x3FFFFF
            if not self.seen[at]:
                self.seen[at] = 1
                return value
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
            self.seen = bytearray(1 << 22)
        self[key] = value
        return value


class ByteBPE:
    """Encoder and decoder for one vocabulary; ``spec`` is the text of its JSON file."""

    def __init__(self, spec: str, cache_entries: int = CACHE_ENTRIES):
        data = json.loads(spec)
        letters = _byte_letters()
        vocab = {bytes(letters[c] for c in t): i for t, i in data["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        text = [b""] * size
        for token, i in vocab.items():
            text[i] = token
        for token, i in self.special.items():
            text[i] = token.encode()
        self.text = text
        self.offsets = np.concatenate(([0], np.cumsum([len(t) for t in text]))).astype(np.int64)
        self.joined = np.frombuffer(b"".join(text), np.uint8)
        self.vocab = vocab
        # rank of the merge that makes a pair, and of the merge that built each token
        self.merges: dict[tuple[int, int], int] = {}
        self.built: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            a, b = (vocab[bytes(letters[c] for c in t)]
                    for t in (merge.split(" ") if isinstance(merge, str) else merge))
            self.merges[a, b] = rank
            self.built.setdefault(vocab[text[a] + text[b]], (rank, a, b))
        self.matcher = ahocorasick.Automaton()
        for token, i in vocab.items():
            self.matcher.add_word(token.decode("latin-1"), len(token))
        self.matcher.make_automaton()
        self.fits: dict[int, bool] = _Cache(self._compatible, cache_entries)
        self.words = _Cache(self._encode_word, cache_entries)
        self.stretches = _Cache(self._encode_stretch, cache_entries)
        self.cut = (re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
                    if self.special else None)

    # -- pair compatibility

    def _compatible(self, pair: int) -> bool:
        """Whether merging text(left) + text(right) gives just these two tokens.

        Undo merges at the seam from the last made to the first.  The two stay apart
        unless some pair of pieces that face each other at the seam has a merge that
        comes before the pieces are used up by the merges of their own tokens.
        """
        left, right = pair >> 32, pair & 0xFFFFFFFF
        # merge rank at which the piece left (right) of the seam vanishes into a larger one
        until_left = until_right = len(self.merges)
        built, unbuilt = self.built, (-1,)
        while True:
            rank = self.merges.get((left, right))
            # at equal rank the pair further left is merged first: that is the left piece's
            if rank is not None and rank < until_left and rank <= until_right:
                return False
            made_left = built.get(left, unbuilt)
            made_right = built.get(right, unbuilt)
            if made_left[0] >= made_right[0]:
                if made_left[0] < 0:
                    return True
                until_left, left = made_left[0], made_left[2]
            else:
                until_right, right = made_right[0], made_right[1]

    # -- encoding

    def _encode_word(self, word: str) -> bytes:
        """Ids of one pre-tokenizer word as little-endian unsigned 32-bit integers."""
        raw = word.encode()
        n = len(raw)
        longest = [1] * n
        for end, size in self.matcher.iter(word if n == len(word) else raw.decode("latin-1")):
            if size > longest[end + 1 - size]:
                longest[end + 1 - size] = size
        vocab, fits = self.vocab, self.fits
        ids: list[int] = []
        cuts = [0]
        dead: set[int] = set()  # positions from which no encoding goes on
        at, size, before = 0, longest[0], -1
        while True:
            while size:
                to = at + size
                if to not in dead:
                    token = vocab.get(raw[at:to])
                    if token is not None and (before < 0 or fits[before << 32 | token]):
                        break
                size -= 1
            if size:
                ids.append(token)
                if to == n:
                    return struct.pack(f"<{len(ids)}I", *ids)
                cuts.append(to)
                at, size, before = to, longest[to], token
            else:
                dead.add(at)
                cuts.pop()
                ids.pop()
                size = at - cuts[-1] - 1
                at, before = cuts[-1], ids[-1] if ids else -1

    def _encode_stretch(self, stretch: str) -> bytes:
        """A space and what follows it up to the next space."""
        return b"".join(map(self.words.__getitem__, WORD.findall(" " + stretch)))

    def _encode_plain(self, text: str) -> bytes:
        if LOOSE_SPACE.search(text):
            return b"".join(map(self.words.__getitem__, WORD.findall(text)))
        head, *rest = text.split(" ")
        return b"".join((*map(self.words.__getitem__, WORD.findall(head)),
                         *map(self.stretches.__getitem__, rest)))

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text, packed as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.cut is None or not any(s in text for s in self.special):
            return self._encode_plain(text)
        return b"".join(self.special[part].to_bytes(4, "little") if part in self.special
                        else self._encode_plain(part) for part in self.cut.split(text) if part)

    # -- decoding

    def decode_bytes(self, ids: bytes) -> bytes:
        """The bytes that packed ids stand for."""
        i = np.frombuffer(ids, "<u4").astype(np.int64)
        if not len(i):
            return b""
        begin, size = self.offsets[i], self.offsets[i + 1] - self.offsets[i]
        shift = np.repeat(begin - np.concatenate(([0], np.cumsum(size)[:-1])), size)
        return self.joined[shift + np.arange(len(shift))].tobytes()

    def decode(self, ids: bytes) -> str:
        """Decoded text; bytes that are no UTF-8 become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


_LOADED: dict[str, ByteBPE] = {}


def load(spec: str) -> ByteBPE:
    """The encoder of a vocabulary, kept for the life of the Python worker."""
    working("bpe", _LOADED.clear)
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = ByteBPE(spec)
    return _LOADED[key]


def read_spec(path: str) -> str:
    """The vocabulary file, read once on the driver (its size is fixed by the tokenizer)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def map_texts(docs: DataFrame, vocabulary: str, keep: list[str], made: T.StructType, make,
              column: str = "text") -> DataFrame:
    """``keep`` columns plus the columns ``made``, whose values ``make(bpe, value)`` gives as a
    tuple for each value of ``column``.  A narrow map in one Python pass: no shuffle, values
    stream through the workers in small batches."""
    shared = docs.sparkSession.sparkContext.broadcast(read_spec(vocabulary))
    schema = T.StructType([*(docs.schema[c] for c in keep), *made.fields])
    kinds = [to_arrow_type(f.dataType) for f in made.fields]

    def run(batches):
        bpe = load(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [make(bpe, v) for v in part.column("__value").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep),
                     *(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds))],
                    [f.name for f in schema.fields])

    return docs.select(*keep, docs[column].alias("__value")).mapInArrow(run, schema)


def encode_documents(docs: DataFrame, vocabulary: str, keep: list[str],
                     text: str = "text") -> DataFrame:
    """``keep`` columns plus ``token_ids`` (binary, unsigned 32-bit little-endian).  Only the text goes to Python; a
    ``token_ids`` column among those kept is refused."""
    if "token_ids" in keep:
        raise ValueError("the documents have a column token_ids already")
    shared = docs.sparkSession.sparkContext.broadcast(read_spec(vocabulary))

    @arrow_udf(T.BinaryType())
    def encoded(texts: pa.Array) -> pa.Array:
        bpe, out = load(shared.value), []
        for at in range(0, len(texts), 64):
            out += [bpe.encode(t) for t in texts.slice(at, 64).to_pylist()]
        return pa.array(out, pa.binary())

    return docs.select(*keep, encoded(docs[text]).alias("token_ids"))


def decode_documents(encoded: DataFrame, vocabulary: str, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``decoded`` (string) from a ``token_ids`` column."""
    return map_texts(encoded, vocabulary, keep, T.StructType([T.StructField("decoded", T.StringType())]),
                     lambda bpe, ids: (bpe.decode(ids or b""),), "token_ids")
