"""BPE encoding and decoding by speculation and verification (operator 3).

The vocabulary is that of a public word-level BPE file. A text is normalised
and cut at white space into chunks; the encoding of a chunk depends on it
alone, so each worker keeps a bounded table of chunks it has met. For the
chunks of a batch that are new:

1. every word of them is cut greedily into the longest tokens there are;
2. the distinct adjacent token pairs of all those words are tested at once:
   a pair is compatible if merging its own characters gives the pair again.
   A word all of whose pairs are compatible is encoded exactly;
3. only a word with an incompatible pair goes through exact merging, all of
   them side by side: a step merges, in every word, the pairs of its least rank.

Words are remembered too, as many chunks differ only by the marks around one.

Cases: null and empty texts have no tokens; the two special strings match as
whole tokens wherever they stand; a text of any length is encoded whole;
repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bpe import merge_flat
from ..operators.ragged import offsets, spread
from .common import arrow_pass, table, text_of, text_slices

VOCABULARY = "word_bpe_49k.json"
#: Chunks, and words, that a worker remembers; then it starts anew, with the same results.
REMEMBERED = 300_000
#: Characters of the longest chunk or word that is remembered; a text without blanks is one chunk.
LONGEST = 256
#: Symbols of the longest word that is merged side by side with others.
TOGETHER = 64
_END = "</w>"
#: Before a special token among chunks; a lone surrogate, which no text holds.
_MARK = "\ud800"
_SPECIAL = regex.compile(r"(<\|startoftext\|>|<\|endoftext\|>)")
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Code points that str.split() takes for white space but the vocabulary's pattern doesn't.
_CONTROL = regex.compile("[\x1c-\x1f]")
_SPACES = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The printable letter of each byte: itself where it prints, else the next free one from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


@contextmanager
def uncollected() -> Iterator[None]:
    """No search for cycles meanwhile: tables of strings have none, and it would pass over all of them again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class WordBpe:
    """Encoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        merges = spec["model"]["merges"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        self.longest = max(map(len, self.ids))
        #: The length of the longest token that begins with these three letters, and of none.
        self.reach: dict[str, int] = {}
        for t in self.ids:
            self.reach[t[:3]] = max(self.reach.get(t[:3], 0), len(t))
        self.letters = byte_letters()
        self._fits: dict[int, bool] = {}
        self._table = str.maketrans({b: c for b, c in self.letters.items()})
        self.chunks: dict[str, tuple[str, str]] = {}
        self.words: dict[str, tuple[str, str]] = {}
        pairs = sorted((self.ids[a] << 32 | self.ids[b], r, self.ids[a + b]) for (a, b), r in self.ranks.items())
        #: Pairs of ids in order, and the rank and the product of each.
        self._pairs, self._rank, self._made = (np.array([p[i] for p in pairs], np.int64) for i in range(3))
        #: The id of each letter, and of each letter that ends a word.
        self._letter, self._last = (np.zeros(max(map(ord, self.letters.values())) + 1, np.int64) for _ in range(2))
        for c in self.letters.values():
            self._letter[ord(c)], self._last[ord(c)] = self.ids[c], self.ids[c + _END]
        #: The symbols of every token, one after the other, and where those of a token end.
        parts = [[self.ids[c] for c in self.symbols(self.tokens[i])] if self.tokens.get(i) in self.ids else [] for i in range(max(self.tokens) + 1)]
        self._symbols = np.fromiter(chain.from_iterable(parts), np.int64)
        self._ends = offsets(np.array([len(x) for x in parts], np.int64))

    def merge(self, symbols: list[str]) -> list[str]:
        """Exact merging: the pair of the lowest rank first, leftmost first."""
        ranks = self.ranks
        if len(symbols) > 64:
            return self._merge_long(symbols)
        while len(symbols) > 1:
            best, at = None, None
            for i in range(len(symbols) - 1):
                r = ranks.get((symbols[i], symbols[i + 1]))
                if r is not None and (best is None or r < best):
                    best, at = r, (symbols[i], symbols[i + 1])
            if at is None:
                break
            out, i, n = [], 0, len(symbols)
            while i < n:
                if i + 1 < n and symbols[i] == at[0] and symbols[i + 1] == at[1]:
                    out.append(at[0] + at[1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def _merge_long(self, symbols: list[str]) -> list[str]:
        """The same with a heap, so that a very long word takes n log n steps."""
        ranks, n = self.ranks, len(symbols)
        parts: list[str | None] = list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (r := ranks.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p in parts if p is not None]

    @staticmethod
    def symbols(token: str) -> list[str]:
        """The characters of a token; the mark of a word's end belongs to the last one."""
        if token.endswith(_END) and len(token) > len(_END):
            return [*token[: -len(_END) - 1], token[-len(_END) - 1 :]]
        return list(token)

    def greedy(self, word: str) -> list[int]:
        """Longest tokens from the left; word is in byte letters, without the mark."""
        ids, out, i, n = self.ids, [], 0, len(word)
        while i < n:
            tail = n - i
            if tail <= self.longest:
                t = ids.get(word[i:] + _END)
                if t is not None:
                    out.append(t)
                    return out
            for j in range(min(tail - 1, self.reach.get(word[i : i + 3], 2)), 0, -1):
                t = ids.get(word[i : i + j])
                if t is not None:
                    out.append(t)
                    i += j
                    break
            else:
                return []
        return out

    def fits(self, pairs: np.ndarray) -> np.ndarray:
        """Of distinct pairs (a << 32 | b): does merging their characters give them back? b alone if a is -1."""
        known = self._fits
        if len(known) > 4 * REMEMBERED:
            known.clear()
        listed = pairs.tolist()
        new = np.array([p for p in listed if p not in known], np.int64)
        if len(new):
            a, b = new >> 32, new & 0xFFFFFFFF
            both = np.stack([np.where(a < 0, b, a), b], axis=1)
            length = np.diff(self._ends)[both]
            length[a < 0, 1] = 0
            flat, sizes = merge_flat(self._symbols[spread(self._ends[:-1][both].ravel(), length.ravel())], length.sum(axis=1), self._pairs, self._rank, self._made)
            starts = np.cumsum(sizes) - sizes
            ok = (sizes == np.where(a < 0, 1, 2)) & (flat[starts] == both[:, 0]) & (flat[starts + sizes - 1] == b)
            known.update(zip(new.tolist(), ok.tolist(), strict=True))
        return np.fromiter(map(known.__getitem__, listed), bool, len(listed))

    def merge_all(self, words: list[str]) -> list[list[int]]:
        """Ids by exact merging of words in byte letters, none empty; very long ones one by one."""
        short = [w for w in words if len(w) <= TOGETHER]
        sizes = np.fromiter(map(len, short), np.int64, len(short))
        codes = np.frombuffer("".join(short).encode("utf-32-le"), "<u4")
        flat = self._letter[codes]
        last = np.cumsum(sizes) - 1
        flat[last] = self._last[codes[last]]
        flat, sizes = merge_flat(flat, sizes, self._pairs, self._rank, self._made)
        listed, upto = flat.tolist(), offsets(sizes).tolist()
        made = iter([listed[a:b] for a, b in zip(upto, upto[1:], strict=False)])
        return [next(made) if len(w) <= TOGETHER else [self.ids[s] for s in self.merge(self.symbols(w + _END))] for w in words]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of distinct words given in byte letters."""
        proposed = [self.greedy(w) for w in words]
        sizes = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter((t for p in proposed for t in p), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        before = np.empty_like(flat)
        if len(flat):
            before[0] = -1
            before[1:] = np.where(owner[1:] == owner[:-1], flat[:-1], -1)
        # A first token stands alone only if it is the whole word; else its pair tests it.
        pairs = np.where((before >= 0) | (sizes[owner] == 1), (before << 32) | flat, -1)
        tested, back = np.unique(pairs[pairs != -1], return_inverse=True)
        ok = np.ones(len(flat), bool)
        if len(tested):
            ok[pairs != -1] = self.fits(tested)[back]
        failed = sizes == 0
        failed[owner[~ok]] = True
        wrong = np.flatnonzero(failed).tolist()
        for i, ids in zip(wrong, self.merge_all([words[i] for i in wrong]), strict=True):
            proposed[i] = ids
        return proposed

    def normalise(self, text: str) -> str:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # lower case letter by letter, without the final form
        return text.lower()

    def cut(self, text: str) -> list[str]:
        """The chunks of a normalised text."""
        if _CONTROL.search(text):
            return [c for c in _SPACES.split(text) if c]
        return text.split()

    def pieces(self, text: str) -> list[str]:
        """Chunks of a raw text; a special token is a chunk of its own."""
        if "<|" not in text:
            return self.cut(self.normalise(text))
        out: list[str] = []
        for part in _SPECIAL.split(text):
            out += [_MARK + part] if part in self.special else self.cut(self.normalise(part))
        return out

    def learn(self, chunks: set[str]) -> None:
        """Adds chunks to the table: the ids and the tokens of each, as text."""
        if len(self.chunks) + len(chunks) > REMEMBERED:
            self.chunks.clear()
        made: list[tuple[str, list[str]]] = []
        for c in chunks:
            if c[0] == _MARK and c[1:] in self.special:
                self.chunks[c] = (str(self.special[c[1:]]), c[1:])
            else:
                made.append((c, _WORDS.findall(c)))
        every = set(chain.from_iterable(own for _, own in made))
        known = self.words
        new = every.difference(known)
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = every
        encoded = self.encode_words([w.encode("utf-8").decode("latin-1").translate(self._table) for w in new])
        for w, ids in zip(new, encoded, strict=True):
            known[w] = (" ".join(map(str, ids)), " ".join([self.tokens[t] for t in ids]))
        for c, own in made:
            if len(own) == 1:
                self.chunks[c] = known[own[0]]
            elif len(own) == 2:
                x, y = known[own[0]], known[own[1]]
                self.chunks[c] = (f"{x[0]} {y[0]}", f"{x[1]} {y[1]}")
            else:
                found = [known[w] for w in own]
                self.chunks[c] = (" ".join([x[0] for x in found]), " ".join([x[1] for x in found]))
        for w in new:
            if len(w) > LONGEST:
                del known[w]

    def encode_texts(self, texts: list[str]) -> Iterator[list[tuple[str, str]]]:
        """For each text the (ids, tokens) of its chunks."""
        cut = [self.pieces(t) for t in texts]
        new = {c for own in cut for c in own} - self.chunks.keys()
        if new:
            with uncollected():
                self.learn({c for own in cut for c in own} if len(self.chunks) + len(new) > REMEMBERED else new)
        found = [[self.chunks[c] for c in own] for own in cut]
        for c in new:
            if len(c) > LONGEST:
                del self.chunks[c]
        yield from found


_LOADED: dict[str, WordBpe] = {}


def encoder(path: str) -> WordBpe:
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id and ids array<int> of every row: the operator itself."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in text_slices(texts):
                ids = [[int(x) for s, _ in own for x in s.split()] for own in bpe.encode_texts(texts[a:b])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
                )

    narrow = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = dict(narrow.dtypes)["doc_id"]
    return arrow_pass(narrow, run, f"doc_id {kind}, ids array<int>")


def decode(tokens: DataFrame, ids_col: str = "ids", id_col: str = "doc_id", path: str | None = None) -> DataFrame:
    """doc_id and the decoded text: the tokens joined by one space, as the vocabulary has no decoder."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = encoder(path).tokens
        for batch in batches:
            text = [" ".join(names[t] for t in own if t in names) for own in (x or [] for x in batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], ["doc_id", "text"])

    narrow = tokens.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return arrow_pass(narrow, run, f"doc_id {dict(narrow.dtypes)['doc_id']}, text string")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the decoded text."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts, by_ids, by_text = [], [], []
            for a, b in text_slices(texts):
                for own in bpe.encode_texts(texts[a:b]):
                    ids = " ".join([x[0] for x in own])
                    counts.append(ids.count(" ") + 1 if ids else 0)
                    by_ids.append(hashlib.sha256(ids.encode()).hexdigest())
                    by_text.append(hashlib.sha256(" ".join([x[1] for x in own]).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(by_ids, pa.string()), pa.array(by_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    narrow = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = dict(narrow.dtypes)["doc_id"]
    return arrow_pass(narrow, run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
