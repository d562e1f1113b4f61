"""Language identification by segmentation-marginalised unigrams (operator 2).

The pieces of a fixed public vocabulary get a probability in each language.
A word's probability is the sum over all its segmentations into pieces, by the
forward algorithm; a text's is the product over its words. Probabilities come
from expectation maximisation (forward-backward, two rounds) over the words of
a bounded sample of labelled documents, about ``SAMPLE_ROWS`` of each language
chosen by a hash of the id. Scoring reads every text whole; workers remember
the words they have met, up to a bound.

Cases: a null text, or one without a letter, is ``und`` with score 0; equal
likelihoods give the language that comes first by name; a language is any
non-null value of the label column in the training rows, ``MOST_LANGUAGES`` at
most, else an error; without training rows everything is ``und``; repeated
rows have equal results; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_pass, fold_bucket, table, text_slices

VOCABULARY = "piece_bpe_32k.model"
FOLDS, HELD_OUT = 5, 0
SAMPLE_ROWS = 1500
MOST_LANGUAGES = 256
ROUNDS = 2
#: Added to every piece's expected count.
PRIOR = 0.01
#: Probability of a character outside the vocabulary, alike in all languages.
UNKNOWN = 1e-7
REMEMBERED = 400_000
#: From so many characters on, a word is scored in logarithms.
LONG = 96
#: A shorter word is scored in logarithms too where a language gives it less.
LEAST_LOG = math.log(1e-290)
#: Numbers that the forward algorithm holds at a time, about.
FORWARD_CELLS = 400_000
_LETTER = regex.compile(r"\p{L}")
START = "▁"
#: What ``str.split`` cuts at, so that words are learnt as they are scored.
WHITE = "(?U)[\\s\x1c-\x1f]+"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_PIECES: dict[str, dict[str, int]] = {}


def pieces(path: str) -> dict[str, int]:
    """Piece to number; control, unknown and byte pieces are left out."""
    if path not in _PIECES:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        keep = [i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))]
        _PIECES[path] = {m.id_to_piece(i): k for k, i in enumerate(keep)}
    return _PIECES[path]


def words_of(text: str) -> list[str]:
    return text.lower().split()


def lattice(word: str, known: dict[str, int], longest: int) -> list[list[tuple[int, int]]]:
    """For every end place of START + word, the (start place, piece) that end there; -1 is an unknown character."""
    s = START + word
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(s) + 1)]
    for i in range(len(s)):
        for j in range(i + 1, min(len(s), i + longest) + 1):
            p = known.get(s[i:j])
            if p is not None:
                out[j].append((i, p))
        if s[i] not in known:
            out[i + 1].append((i, -1))
    return out


def _ends(word: str, known: dict[str, int], longest: int) -> Callable[[int], list[tuple[int, int]]]:
    """``lattice`` by place; that of a long word is not held, only one place at a time."""
    if len(word) < LONG:
        return lattice(word, known, longest).__getitem__
    s = START + word

    def at(j: int) -> list[tuple[int, int]]:
        out = [(i, p) for i in range(max(0, j - longest), j) if (p := known.get(s[i:j])) is not None]
        return out if s[j - 1] in known else [*out, (j - 1, -1)]

    return at


def _expected(word: str, prob: list[float], known: dict[str, int], longest: int) -> Iterator[tuple[int, float]]:
    """(piece, expected uses) in a word, by forward-backward in logarithms."""
    ends, n = _ends(word, known, longest), len(START + word) + 1
    fore = [0.0] * n  # logarithms
    for j in range(1, n):
        v = [fore[i] + math.log(prob[p] if p >= 0 else UNKNOWN) for i, p in ends(j)]
        top = max(v)
        fore[j] = top + math.log(sum(math.exp(x - top) for x in v))
    back = [-math.inf] * n
    back[-1] = 0.0
    for j in range(n - 1, 0, -1):
        for i, p in ends(j):
            v = back[j] + math.log(prob[p] if p >= 0 else UNKNOWN)
            a = back[i]
            back[i] = v if a == -math.inf else max(a, v) + math.log1p(math.exp(-abs(a - v)))
    for j in range(1, n):
        for i, p in ends(j):
            if p >= 0:
                yield p, math.exp(fore[i] + math.log(prob[p]) + back[j] - fore[-1])


def _initial(known: dict[str, int]) -> np.ndarray:
    """The same start for all languages: longer pieces are rarer."""
    w = np.zeros(len(known))
    for p, k in known.items():
        w[k] = 0.25 ** min(len(p), 8)
    return w / w.sum()


class Lookup:
    """Finds pieces by the hashes of their characters, many at once."""

    BASE = np.uint64(0x9E3779B97F4A7C15)
    BITS = 20

    def __init__(self, known: dict[str, int]):
        self.known, self.size, self.longest = known, len(known), max(map(len, known))
        hashes = np.array([self.hash_of(p) for p in known], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], np.fromiter(known.values(), np.int64, len(known))[order]
        # For each slot the place of its piece in hashes; -1 for none, -2 if several share it.
        self.place = np.full(1 << self.BITS, -1, np.int32)
        slots = self._slot(self.hashes)
        self.place[slots] = np.arange(self.size)
        distinct, uses = np.unique(slots, return_counts=True)
        self.place[distinct[uses > 1]] = -2

    @classmethod
    def hash_of(cls, piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(cls.BASE) + ord(c) + 1) & ((1 << 64) - 1)
        return h

    @classmethod
    def _slot(cls, h: np.ndarray) -> np.ndarray:
        # The last character alone moves only the lowest bits of a hash: mix before the upper ones are read.
        return ((h ^ (h >> np.uint64(31))) * cls.BASE) >> np.uint64(64 - cls.BITS)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in h, pieces) of the hashes that are pieces."""
        near = self.place.take(self._slot(h).view(np.int64))
        at = np.flatnonzero(near != -1)
        near, own = near[at], h[at]
        shared = near == -2
        near[shared] = np.minimum(np.searchsorted(self.hashes, own[shared]), self.size - 1)
        same = self.hashes.take(near) == own
        return at[same], self.numbers[near[same]]


_LOOKUPS: dict[str, Lookup] = {}


class Model:
    """Piece probabilities by language, and a memory of words."""

    def __init__(self, languages: list[str], logs: np.ndarray, path: str):
        self.languages, self.path = languages, path
        self.prob = np.exp(logs)  # pieces by languages
        self._rows: np.ndarray | None = None

    def _start(self) -> None:
        self.known = pieces(self.path)
        if self.path not in _LOOKUPS or _LOOKUPS[self.path].known is not self.known:
            _LOOKUPS[self.path] = Lookup(self.known)
        self.lookup = _LOOKUPS[self.path]
        self.longest = self.lookup.longest
        # The last row is that of an unknown character.
        self._rows = np.concatenate([self.prob, np.full((1, len(self.languages)), UNKNOWN)])
        self._forget()

    def _forget(self) -> None:
        self._index: dict[str, int] = {}
        self._logs = np.empty((1024, len(self.languages)))

    def forward(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language, summed over all segmentations.

        All words advance together: the pieces that start at one place and have one length are one step.
        """
        find, n = self.lookup, len(words)
        text = START + START.join(words)
        c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        size = np.fromiter(map(len, words), np.int64, n) + 1
        first = np.cumsum(size) - size
        place = np.arange(len(c)) - np.repeat(first, size)
        left = np.repeat(size, size) - place
        # A word has one node more than characters.
        node = np.arange(len(c)) + np.repeat(np.arange(n), size)
        at, h = np.arange(len(c)), np.zeros(len(c), np.uint64)
        starts, lengths, found = [], [], []
        for k in range(1, find.longest + 1):
            inside = left[at] >= k
            at, h = at[inside], h[inside]
            h = h * find.BASE + c[at + (k - 1)]
            hit, piece = find.find(h)
            if k == 1:
                # A character that is no piece is an unknown one.
                single = np.full(len(at), find.size)
                single[hit] = piece
                hit, piece = np.arange(len(at)), single
            starts.append(at[hit])
            lengths.append(np.full(len(hit), k))
            found.append(piece)
        start, length, piece = np.concatenate(starts), np.concatenate(lengths), np.concatenate(found)
        step = place[start] * (find.longest + 1) + length
        order = np.argsort(step, kind="stable")
        step, source, piece = step[order], node[start[order]], piece[order]
        target = source + length[order]
        alpha = np.zeros((len(c) + n, len(self.languages)))
        alpha[node[first]] = 1.0
        edge = np.r_[np.flatnonzero(np.r_[True, step[1:] != step[:-1]]), len(step)].tolist()
        for a, b in zip(edge, edge[1:], strict=False):
            to = target[a:b]
            more = alpha.take(source[a:b], axis=0, mode="clip")
            more *= self._rows.take(piece[a:b], axis=0, mode="clip")
            more += alpha.take(to, axis=0, mode="clip")
            alpha[to] = more
        with np.errstate(divide="ignore"):
            out = np.log(alpha[node[first] + size])
        # Products that left the range of a double, or came near its end, are taken in logarithms.
        for i in np.flatnonzero((out < LEAST_LOG).any(1)).tolist():
            out[i] = self._long(words[i])
        return out

    def word(self, word: str) -> list[float]:
        """Log probability of one word in each language."""
        return self._long(word) if len(word) >= LONG else self.forward([word])[0].tolist()

    def _long(self, word: str) -> list[float]:
        """The same, scaled at each place, for words whose values could leave the range of a double."""
        ends, n = _ends(word, self.known, self.longest), len(START + word) + 1
        fore = np.zeros((n, len(self.languages)))
        for j in range(1, n):
            v = np.array([fore[i] + np.log(self.prob[p] if p >= 0 else UNKNOWN) for i, p in ends(j)])
            top = v.max(0)
            fore[j] = top + np.log(np.exp(v - top).sum(0))
        return fore[-1].tolist()

    def _learn(self, new: list[str]) -> None:
        """Adds words to the memory, a bounded number of characters at a time."""
        short = [w for w in new if len(w) < LONG]
        limit = max(1, FORWARD_CELLS // len(self.languages))
        at, parts = 0, []
        while at < len(short):
            upto, chars = at, 0
            while upto < len(short) and chars < limit:
                chars += len(short[upto]) + 2
                upto += 1
            parts.append(self.forward(short[at:upto]))
            at = upto
        long = [w for w in new if len(w) >= LONG]
        if long:
            parts.append(np.array([self.word(w) for w in long]))
        index, k = self._index, len(self._index)
        while k + len(new) > len(self._logs):
            self._logs = np.concatenate([self._logs, np.empty_like(self._logs)])
        self._logs[k : k + len(new)] = np.concatenate(parts)
        index.update(zip(short + long, range(k, k + len(new)), strict=True))

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = [("und", 0.0)] * len(texts)
        lettered = [i for i, t in enumerate(texts) if t and self.languages and _LETTER.search(t)]
        if not lettered:
            return out
        if self._rows is None:
            self._start()
        words = [words_of(texts[i]) for i in lettered]
        if len(self._index) > REMEMBERED:
            self._forget()
        index = self._index
        new = set().union(*words).difference(index)
        if new:
            self._learn(list(new))
        for i, own in zip(lettered, words, strict=True):
            v = self._logs[[index[w] for w in own]].sum(0)
            k = int(v.argmax())
            out[i] = self.languages[k], float(1 / np.exp(v - v[k]).sum())
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]


def fit(rows: DataFrame, path: str | None = None) -> Model:
    """Learns from rows (doc_id, text, lang), of which a bounded sample is read."""
    path = path or vocabulary_path()
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((0, 0)), path)
    share = F.coalesce(
        *(F.when(F.col("lang") == x, F.lit(int(min(1.0, SAMPLE_ROWS / counts[x]) * (1 << 30)))) for x in languages)
    )
    sample = rows.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(2)), F.lit(1 << 30)) < share)
    words = sample.select("lang", F.explode(F.split(F.lower("text"), WHITE)).alias("word"))
    words = words.filter("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    words = words.cache()
    start = _initial(pieces(path))
    prob = {x: start for x in languages}
    for _ in range(ROUNDS):
        now = {x: p.tolist() for x, p in prob.items()}

        def run(batches: Iterator[pa.RecordBatch], now: dict = now) -> Iterator[pa.RecordBatch]:
            known = pieces(path)
            longest = max(map(len, known))
            total: dict[tuple[str, int], float] = {}
            for batch in batches:
                for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    for p, v in _expected(word, now[lang], known, longest):
                        total[lang, p] = total.get((lang, p), 0.0) + n * v
            cols = [[k[0] for k in total], [k[1] for k in total], list(total.values())]
            kinds = (pa.string(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["lang", "piece", "v"])

        # At most the vocabulary times the languages.
        found = arrow_pass(words, run, "lang string, piece int, v double").groupBy("lang", "piece").agg(F.sum("v").alias("v"))
        table_ = found.toPandas()
        for x in languages:
            own = table_[table_["lang"] == x]
            v = np.full(len(start), PRIOR)
            np.add.at(v, own["piece"].to_numpy(), np.round(own["v"].to_numpy(), 6))
            prob[x] = v / v.sum()
    words.unpersist()
    return Model(languages, np.log(np.stack([prob[x] for x in languages], 1)), path)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang_pred and score of every row; the columns of keep follow."""
    narrow = docs.select(F.col(id_col).alias("__row_id"), F.col(text_col).cast("string").alias("__row_text"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found: list[tuple[str, float]] = []
            for a, b in text_slices(texts):
                found += model.predict_all(texts[a:b])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), *batch.columns[2:]],
                ["doc_id", "lang_pred", "score", *keep],
            )
        model._rows = None
        model._forget()

    kinds = dict(narrow.dtypes)
    more = "".join(f", `{c}` {kinds[c]}" for c in keep)
    return arrow_pass(narrow, run, f"doc_id {kinds['__row_id']}, lang_pred string, score double{more}")


def training(docs: DataFrame) -> DataFrame:
    return docs.filter(fold_bucket("doc_id", FOLDS) != HELD_OUT).select("doc_id", "text", "lang")


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, fit(training(docs)))
    held = F.coalesce(fold_bucket("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
