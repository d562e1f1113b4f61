"""Encoding and decoding with a trained tokenizer, and its acceptance checks."""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import SPECIAL_TOKENS, Tokenizer, merge_flat, merge_ranked
from .ragged import Growing, offsets, spread

LOW, HIGH = 3.0, 4.5
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_SPECIAL = re.compile("(" + "|".join(map(re.escape, SPECIAL_TOKENS)) + ")")
#: White space and what follows it, up to white space that begins with one of these: there every word ends.
_CHUNK = re.compile(r"\s+\S*(?:[^\S\t-\r ]\s*\S*)*|\S+(?:[^\S\t-\r ]\s*\S*)*")
#: Chunks of words that a worker remembers, the frequent ones of those it met, and words.
REMEMBERED, REMEMBERED_WORDS = 300_000, 100_000
#: Characters of the longest word that is remembered, and of the longest chunk; longer ones are encoded each time.
LONGEST, LONGEST_CHUNK = 64, 256
#: Characters of texts that are encoded together.
SLICE_CHARS = 1_000_000
#: Texts of an Arrow batch.
BATCH_ROWS = 1024


class Codec:
    """Encodes each distinct word once, very long ones aside; the memory is bounded."""

    def __init__(self, tokenizer: Tokenizer):
        self.ids = tokenizer.ids()
        self.tokens = tokenizer.tokens()
        self.ranks: dict[tuple[bytes, bytes], int] = {}
        for i, p in enumerate(tokenizer.merges):
            self.ranks.setdefault(p, i)
        self.known: dict[str, list[int]] = {}
        pairs = sorted((self.ids[a] << 32 | self.ids[b], r, self.ids[a + b]) for (a, b), r in self.ranks.items())
        #: Pairs of ids in order, and the rank and the product of each.
        self._pairs, self._rank, self._made = (np.array([p[i] for p in pairs], np.int64) for i in range(3))
        self._bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self._ends = offsets(np.array([len(t) for t in self.tokens], np.int64))
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self._at, self._size, self._met = Growing(np.int64), Growing(np.int64), Growing(np.int64)
        self._ids = Growing(np.int32)

    def _thin(self) -> None:
        """Forgets all but half as many chunks as may be remembered, those met most; a chunk's place in slots is its number."""
        met = self._met.view()
        stay = np.sort(np.argsort(-met, kind="stable")[: REMEMBERED // 2])
        names, met, sizes = list(self.slots), met[stay] >> 1, self._size.view()[stay]
        ids = self._ids.view()[spread(self._at.view()[stay], sizes)]
        self._forget()
        self.slots = {names[i]: k for k, i in enumerate(stay.tolist())}
        self._at.add(np.cumsum(sizes) - sizes)
        self._size.add(sizes)
        self._met.add(met)
        self._ids.add(ids)

    def word(self, word: str) -> list[int]:
        got = self.known.get(word)
        if got is None:
            got = [self.ids[p] for p in self.merged([bytes([b]) for b in word.encode("utf-8")])]
            if len(word) <= LONGEST:
                if len(self.known) > REMEMBERED_WORDS:
                    self.known.clear()
                self.known[word] = got
        return got

    def merged(self, parts: list[bytes]) -> list[bytes]:
        return merge_ranked(parts, self.ranks)

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """The ids of many words: each step merges, in every word that has one, all pairs of the word's least rank."""
        sizes = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64) + len(SPECIAL_TOKENS)
        full = sizes > 0
        flat, sizes[full] = merge_flat(flat, sizes[full], self._pairs, self._rank, self._made)
        listed, upto = flat.tolist(), offsets(sizes).tolist()
        return [listed[a:b] for a, b in zip(upto, upto[1:], strict=False)]

    def encode(self, text: str) -> list[int]:
        """No tokens are added; the reserved ones in the text are whole tokens."""
        out: list[int] = []
        for part in _SPECIAL.split(text) if "<|" in text else (text,):
            if part in SPECIAL_TOKENS:
                out.append(SPECIAL_TOKENS.index(part))
            else:
                for w in _WORDS.findall(part):
                    out += self.word(w)
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.tokens[i] for i in ids).decode("utf-8", "replace")

    def _cut(self, text: str) -> list[str]:
        """The chunks of a text; a reserved token is a chunk of its own."""
        if "<|" not in text:
            return _CHUNK.findall(text)
        return [c for part in _SPECIAL.split(text) for c in ((part,) if part in SPECIAL_TOKENS else _CHUNK.findall(part))]

    def _learn(self, chunks: list[str]) -> None:
        cut = [[] if c in SPECIAL_TOKENS else _WORDS.findall(c) for c in chunks]
        every = set(chain.from_iterable(cut))
        new = [w for w in every.difference(self.known) if len(w) <= LONGEST]
        made = dict(zip(new, self.merge_all([w.encode("utf-8") for w in new]), strict=True))
        known = {w: self.known[w] for w in every.intersection(self.known)}

        if len(self.known) + len(made) > REMEMBERED_WORDS:
            self.known.clear()
        self.known.update(islice(made.items(), REMEMBERED_WORDS))

        def of(word: str) -> list[int]:
            if (got := known.get(word)) is None and (got := made.get(word)) is None:
                got = self.word(word)
            return got

        ids = [
            of(own[0]) if len(own) == 1 else list(chain.from_iterable(map(of, own))) if own else [SPECIAL_TOKENS.index(c)]
            for c, own in zip(chunks, cut, strict=True)
        ]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.slots.update(zip(chunks, range(self._at.n, self._at.n + len(ids)), strict=True))
        self._at.add(self._ids.n + np.cumsum(sizes) - sizes)
        self._size.add(sizes)
        self._met.add(np.zeros(len(ids), np.int64))
        self._ids.add(np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())))

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(how many ids each text has, all ids): each distinct chunk is encoded once, and its ids are copied."""
        cut = [self._cut(t) for t in texts]
        every = set(chain.from_iterable(cut))
        new = every.difference(self.slots)
        if len(self.slots) + len(new) > REMEMBERED:
            self._thin()
            new = every.difference(self.slots)
        self._learn([c for c in new if len(c) <= LONGEST_CHUNK])
        mark = self._at.n, self._ids.n
        self._learn(long := [c for c in new if len(c) > LONGEST_CHUNK])
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        slots = np.fromiter(map(self.slots.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        self._met.view()[:] += np.bincount(slots, minlength=self._met.n)
        length = self._size.view()[slots]
        ids = self._ids.view()[spread(self._at.view()[slots], length)]
        for c in long:
            del self.slots[c]
        self._at.n = self._size.n = self._met.n = mark[0]
        self._ids.n = mark[1]
        upto = offsets(length)
        ends = np.cumsum(sizes)
        return upto[ends] - upto[ends - sizes], ids

    def decode_all(self, sizes: np.ndarray, ids: np.ndarray) -> list[str]:
        """The texts of rows of so many ids each: the bytes of all tokens, gathered at once."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.tokens)):
            raise IndexError(f"no token {ids.min() if ids.min() < 0 else ids.max()}")
        starts, length = self._ends[:-1][ids], np.diff(self._ends)[ids]
        data = self._bytes[spread(starts, length)].tobytes()
        upto = offsets(length)[offsets(sizes)].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(upto, upto[1:], strict=False)]


_CODECS: dict[Tokenizer, Codec] = {}


def _codec(tokenizer: Tokenizer) -> Codec:
    """The codec of this worker for a tokenizer; only the last one is kept."""
    if tokenizer not in _CODECS:
        _CODECS.clear()
        _CODECS[tokenizer] = Codec(tokenizer)
    return _CODECS[tokenizer]


def _slices(sizes: list[int], limit: int) -> list[tuple[int, int]]:
    """Runs of rows of about so much together."""
    out, a, total = [], 0, 0
    for i, n in enumerate(sizes):
        if i > a and total + n > limit:
            out.append((a, i))
            a, total = i, 0
        total += n
    return [*out, (a, len(sizes))] if a < len(sizes) else out


def encode(docs: DataFrame, tokenizer: Tokenizer, text: str = "text", into: str = "ids") -> DataFrame:
    """docs with the ids of a text; null for a null text. Whole batches go through ``Codec.encode_all``."""

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        codec, sizes, ids = _codec(tokenizer), [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for a, b in _slices(pc.utf8_length(texts.fill_null("")).to_pylist(), SLICE_CHARS):
            size, own = codec.encode_all([t or "" for t in texts.slice(a, b - a).to_pylist()])
            sizes.append(size)
            ids.append(own)
        ends = offsets(np.concatenate(sizes)).astype(np.int32)
        mask = texts.is_null() if texts.null_count else None
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)), mask=mask)

    # Whole texts and their ids: a batch stays small.
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return docs.withColumn(into, run(text))


def decode(docs: DataFrame, tokenizer: Tokenizer, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """docs with the text of ids; U+FFFD for what is no UTF-8, null for null ids, an error for an id that no token has."""

    @F.arrow_udf("string")
    def run(rows: pa.Array) -> pa.Array:
        sizes = np.nan_to_num(rows.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        flat = rows.flatten().to_numpy(zero_copy_only=False)
        if flat.dtype.kind == "f":
            raise IndexError("a null among the ids")
        codec, ends, found = _codec(tokenizer), offsets(sizes), []
        for a, b in _slices(sizes.tolist(), SLICE_CHARS):
            found += codec.decode_all(sizes[a:b], flat[ends[a] : ends[b]])
        return pa.array(found, pa.string(), mask=rows.is_null().to_numpy(zero_copy_only=False))

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return docs.withColumn(into, run(ids))


def round_trips(codec: Codec, text: str) -> bool:
    return codec.decode(codec.encode(text)) == text


def chars_per_token(codec: Codec, text: str) -> float:
    n = len(codec.encode(text))
    return len(text) / n if n else 0.0


def verify_special_tokens(codec: Codec) -> None:
    for i, t in enumerate(SPECIAL_TOKENS):
        if codec.encode(t) != [i]:
            raise ValueError(f"special token {t} is not one token")


@dataclass(frozen=True)
class Report:
    vocab_size: int
    chars_per_token: float
    round_trips: bool

    @property
    def in_band(self) -> bool:
        return LOW <= self.chars_per_token <= HIGH


def report(tokenizer: Tokenizer, sample: str) -> Report:
    codec = Codec(tokenizer)
    verify_special_tokens(codec)
    if not round_trips(codec, sample):
        raise ValueError("decode(encode(sample)) is not the sample")
    return Report(tokenizer.vocab_size(), chars_per_token(codec, sample), True)
