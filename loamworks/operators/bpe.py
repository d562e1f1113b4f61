"""Training of a byte-level BPE tokenizer.

Spark counts the distinct words of the corpus; they are few against its
occurrences. The merges themselves are a sequence of argmaxima: a driver loop
with an incremental pair index learns them from the word counts; where the words
are too many for the driver, ``hot_merges`` takes over. ``first_merges`` does one
merge as a DataFrame operation, for checks against SQL.
"""

from __future__ import annotations

import heapq
import json
import os
import uuid
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import pretokens, symbol_list, symbols
from ..staging import delete, read_file, rename, write_file
from .ragged import spread

#: The reserved tokens, with ids from 0.
SPECIAL_TOKENS = ("<|pad|>", "<|bos|>", "<|eos|>", "<|im_start|>", "<|im_end|>")
VOCAB_SIZE = 16_000
MIN_FREQUENCY = 2
#: Symbols of distinct words, or of their fragments, that the driver holds at once: about 200 bytes each.
MOST_SYMBOLS = 1_000_000
FLOOR = len(SPECIAL_TOKENS) + 256


def byte_letters() -> dict[int, str]:
    """The printable letter of each byte: itself where it prints, else the next free one from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


LETTERS = byte_letters()
BYTES = {c: b for b, c in LETTERS.items()}


def byte_alphabet(spark: SparkSession) -> DataFrame:
    """(byte, codepoint): printable bytes stand for themselves, the others follow from 256 on, in order."""
    b = F.col("id").cast("int")
    kept = b.between(33, 126) | b.between(161, 172) | b.between(174, 255)
    rank = F.when(b <= 32, b).when(b <= 160, b - 94).otherwise(F.lit(67))
    return spark.range(256).select(b.alias("byte"), F.when(kept, b).otherwise(256 + rank).cast("int").alias("codepoint"))


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(w, n): the words of all texts; partial counts before the one shuffle."""
    return texts.select(F.explode(pretokens(F.col(text))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))


def pair_counts(words: DataFrame) -> DataFrame:
    """(l, r, c) of adjacent symbols of words (s, n), s in symbol form.

    A filter on the symbols would be pushed below an aggregation that makes the words, and make them for every
    occurrence; so words without a pair leave after the explode.
    """
    listed = words.select("n", symbol_list(F.col("s")).alias("a"))
    pair = F.expr("CASE WHEN size(a) > 1 THEN transform(sequence(0, size(a) - 2), i -> named_struct('l', a[i], 'r', a[i + 1])) END")
    exploded = listed.select("n", F.explode_outer(pair).alias("p")).filter("p IS NOT NULL")
    return exploded.groupBy("p.l", "p.r").agg(F.sum("n").alias("c"))


def best_pair(pairs: DataFrame, min_frequency: int = MIN_FREQUENCY) -> DataFrame:
    """The most frequent pair; ties by the left, then by the right symbol."""
    return pairs.filter(F.col("c") >= min_frequency).orderBy(F.desc("c"), "l", "r").limit(1)


def apply_merge(word: Column, left: str, right: str) -> Column:
    return F.replace(word, F.lit(f"<{left}><{right}>"), F.lit(f"<{left}{right}>"))


def first_merges(texts: DataFrame, k: int, text: str = "text", min_frequency: int = MIN_FREQUENCY) -> list[tuple[str, str, int]]:
    """The first k merges by DataFrame steps: one row a step comes to the driver."""
    words = word_counts(texts, text).select(symbols(F.col("w")).alias("s"), "n").cache()
    out, now = [], words
    for _ in range(k):
        best = best_pair(pair_counts(now), min_frequency).collect()
        if not best:
            break
        out.append((best[0].l, best[0].r, best[0].c))
        now = now.select(apply_merge(F.col("s"), best[0].l, best[0].r).alias("s"), "n")
    words.unpersist()
    return out


def learn_merges(counts: dict[bytes, int], target: int, min_frequency: int = MIN_FREQUENCY) -> list[tuple[bytes, bytes]]:
    """Up to target merges of distinct words, by an incremental index of pairs and a lazy heap."""
    return merges_of([[bytes([b]) for b in w] for w in counts], list(counts.values()), target, min_frequency)


def merges_of(
    words: list[list[bytes]], weight: list[int], target: int, least: int, known: set[bytes] | None = None, often: list[int] | None = None
) -> list[tuple[bytes, bytes]]:
    """Up to target merges of weighted sequences of symbols, while the best pair occurs at least so often.

    With known, the symbols that other sequences may hold: a merge whose product is among them is the last. The
    words are changed, new symbols are added to known, and how often each pair occurred is added to often.
    """
    count: Counter = Counter()
    where: dict[tuple[bytes, bytes], set[int]] = defaultdict(set)
    for i, w in enumerate(words):
        for p in zip(w, w[1:], strict=False):
            count[p] += weight[i]
            where[p].add(i)
    heap = [(-c, *p) for p, c in count.items()]
    heapq.heapify(heap)
    out: list[tuple[bytes, bytes]] = []
    while heap and len(out) < target:
        c, a, b = heapq.heappop(heap)
        now = count.get((a, b), 0)
        if now != -c:
            if now >= least:
                heapq.heappush(heap, (-now, a, b))
            continue
        if now < least:
            break
        out.append((a, b))
        if often is not None:
            often.append(now)
        if known is not None:
            if a + b in known:
                break
            known.add(a + b)
        changed: Counter = Counter()
        for i in where.pop((a, b)):
            w, n = words[i], weight[i]
            for p in zip(w, w[1:], strict=False):
                changed[p] -= n
            k, new = 0, []
            while k < len(w):
                if k + 1 < len(w) and w[k] == a and w[k + 1] == b:
                    new.append(a + b)
                    k += 2
                else:
                    new.append(w[k])
                    k += 1
            words[i] = new
            for p in zip(new, new[1:], strict=False):
                changed[p] += n
                where[p].add(i)
        for p, d in changed.items():
            if d:
                count[p] += d
                if count[p] >= least:
                    heapq.heappush(heap, (-count[p], *p))
        del count[a, b]
    return out


def merge_ranked(parts: list[bytes], ranks: dict[tuple[bytes, bytes], int]) -> list[bytes]:
    """The parts after all merges: of the pairs of least rank all places at once, from the left, until none is left.

    A heap of the ranked places makes a word of n parts cost n log n, however long it is.
    """
    n = len(parts)
    # Places of merged parts leave the chain: after and before name their living neighbours.
    parts, after, before = parts[:], list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if (r := ranks.get(p)) is not None]
    heapq.heapify(heap)
    while heap:
        rank, made = heap[0][0], []
        while heap and heap[0][0] == rank:
            i = heapq.heappop(heap)[1]
            j = after[i]
            if j < n and parts[i] and ranks.get((parts[i], parts[j])) == rank:
                parts[i] += parts[j]
                parts[j] = b""
                after[i] = after[j]
                if after[j] < n:
                    before[after[j]] = i
                made.append(i)
        # New pairs count from the next round on; a pair that is gone by then no longer has its rank.
        for i in made:
            for a, b in ((before[i], i), (i, after[i])):
                if parts[i] and a >= 0 and b < n and (r := ranks.get((parts[a], parts[b]))) is not None:
                    heapq.heappush(heap, (r, a))
    return [p for p in parts if p]


def merge_flat(
    flat: np.ndarray, sizes: np.ndarray, pairs: np.ndarray, ranks: np.ndarray, made: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """``merge_ranked`` for many words at once, none empty: flat holds their symbols as numbers, so many for each word.

    pairs (l << 32 | r, in order) have ranks and products. Each step merges, in every word, all pairs of its least rank.
    """
    own, ids, lengths, parts = np.arange(len(sizes)), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [flat[:0]]
    never = np.int64(1 << 62)
    while len(own):
        starts = np.cumsum(sizes) - sizes
        rank = np.full(len(flat), never)
        codes = (flat[:-1] << 32) | flat[1:]
        at = np.minimum(np.searchsorted(pairs, codes), max(len(pairs) - 1, 0))
        if len(pairs):
            rank[:-1] = np.where(pairs[at] == codes, ranks[at], never)
        rank[starts[1:] - 1] = never
        least = np.minimum.reduceat(rank, starts)
        hit = (rank == np.repeat(least, sizes)) & (rank < never)
        # Of pairs that overlap, as in a run of one symbol, every second one.
        place = np.arange(len(hit))
        first = np.where(hit & ~np.r_[False, hit[:-1]], place, 0)
        hit &= (place - np.maximum.accumulate(first)) % 2 == 0
        merged = np.flatnonzero(hit)
        flat = flat.copy()
        if len(merged):
            flat[merged] = made[at[merged]]
        stay = np.ones(len(flat), bool)
        stay[merged + 1] = False
        done = least == never
        if done.any():
            whole = np.repeat(done, sizes)
            ids.append(own[done])
            lengths.append(sizes[done])
            parts.append(flat[whole])
            stay &= ~whole
        sizes = np.add.reduceat(stay, starts, dtype=np.int64)[~done]
        own, flat = own[~done], flat[stay]
    size = np.concatenate(lengths)
    order = np.argsort(np.concatenate(ids), kind="stable")
    return np.concatenate(parts)[spread((np.cumsum(size) - size)[order], size[order])], size[order]


@dataclass(frozen=True)
class Tokenizer:
    """Reserved tokens, 256 bytes, then one token for each merge; equal symbols share the first id."""

    merges: tuple[tuple[bytes, bytes], ...]

    def tokens(self) -> list[bytes]:
        out = [t.encode() for t in SPECIAL_TOKENS] + [bytes([b]) for b in range(256)]
        seen = set(out[len(SPECIAL_TOKENS) :])
        for a, b in self.merges:
            if a + b not in seen:
                seen.add(a + b)
                out.append(a + b)
        return out

    def ids(self) -> dict[bytes, int]:
        """Of byte tokens; the reserved ones are matched apart."""
        return {t: i for i, t in enumerate(self.tokens()) if i >= len(SPECIAL_TOKENS)}

    def vocab_size(self) -> int:
        return len(self.tokens())

    def token_to_id(self, token: str) -> int | None:
        if token in SPECIAL_TOKENS:
            return SPECIAL_TOKENS.index(token)
        try:
            return self.ids().get(bytes(BYTES[c] for c in token))
        except KeyError:
            return None

    def vocab(self, spark: SparkSession) -> DataFrame:
        """(id, token, special)."""
        rows = [(i, bytearray(t), i < len(SPECIAL_TOKENS)) for i, t in enumerate(self.tokens())]
        return spark.createDataFrame(rows, "id int, token binary, special boolean")

    def artifact(self) -> bytes:
        """The public JSON form."""
        show = lambda t: "".join(LETTERS[b] for b in t)
        vocab = {t: i for i, t in enumerate(SPECIAL_TOKENS)} | {show(t): i for t, i in self.ids().items()}
        level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        spec = {
            "version": "1.0", "truncation": None, "padding": None,
            "added_tokens": [
                {"id": i, "content": t, "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
                for i, t in enumerate(SPECIAL_TOKENS)
            ],
            "normalizer": None, "pre_tokenizer": level, "post_processor": level, "decoder": level,
            "model": {
                "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None,
                "fuse_unk": False, "byte_fallback": False, "ignore_merges": False, "vocab": vocab,
                "merges": [[show(a), show(b)] for a, b in self.merges],
            },
        }
        return json.dumps(spec, ensure_ascii=False, indent=2).encode()

    def save(self, path: str, spark: SparkSession | None = None) -> None:
        """Writes the artifact whole, or not at all; with a session, to any file system that Spark writes to."""
        if spark:
            write_file(spark, path, self.artifact())
            return
        with open(path + ".part", "wb") as f:
            f.write(self.artifact())
        os.replace(path + ".part", path)

    def save_folder(self, spark: SparkSession, folder: str) -> None:
        """tokenizer.json, and vocabulary and merges as Parquet, in a folder that appears when it is whole."""
        part = f"{folder}.{uuid.uuid4().hex}.part"
        try:
            write_file(spark, f"{part}/tokenizer.json", self.artifact())
            self.vocab(spark).coalesce(1).write.parquet(f"{part}/vocabulary")
            rows = [(i, bytearray(a), bytearray(b)) for i, (a, b) in enumerate(self.merges)]
            spark.createDataFrame(rows, "rank int, left binary, right binary").coalesce(1).write.parquet(f"{part}/merges")
            rename(spark, part, folder)
        except BaseException:
            delete(spark, part)
            raise

    @staticmethod
    def load(path: str, spark: SparkSession | None = None) -> Tokenizer:
        if spark:
            data = read_file(spark, path)
        else:
            with open(path, "rb") as f:
                data = f.read()
        model = json.loads(data)["model"]
        back = lambda t: bytes(BYTES[c] for c in t)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        return Tokenizer(tuple((back(a), back(b)) for a, b in pairs))


def vocab_size_from_file(path: str) -> int:
    return Tokenizer.load(path).vocab_size()


def counted_merges(
    texts: DataFrame, target: int, min_frequency: int = MIN_FREQUENCY, text: str = "text"
) -> tuple[list[tuple[bytes, bytes]], list[int]]:
    """The first merges of a corpus, learnt from all its words, and how often the pair of each occurred.

    Words of at most MOST_SYMBOLS bytes together come to the driver; more stay in Spark, with the same result.
    """
    from .hot_merges import spark_merges

    often: list[int] = []
    words = word_counts(texts, text).persist(StorageLevel.DISK_ONLY)
    try:
        size = words.agg(F.sum(F.octet_length("w").cast("long"))).first()[0] or 0
        if size > MOST_SYMBOLS:
            return spark_merges(words, target, min_frequency, MOST_SYMBOLS, often=often, total=size), often
        counts = {w.encode(): n for w, n in words.orderBy(F.desc("n"), "w").toPandas().itertuples(index=False)}
    finally:
        words.unpersist()
    return merges_of([[bytes([b]) for b in w] for w in counts], list(counts.values()), target, min_frequency, often=often), often


def train(texts: DataFrame, vocab_size: int = VOCAB_SIZE, min_frequency: int = MIN_FREQUENCY, text: str = "text") -> Tokenizer:
    """Learns a tokenizer of at most vocab_size tokens, from all words."""
    if vocab_size <= FLOOR:
        raise ValueError(f"vocab size {vocab_size} is too small: it must exceed {FLOOR}")
    return Tokenizer(tuple(counted_merges(texts, vocab_size - FLOOR, min_frequency, text)[0]))
