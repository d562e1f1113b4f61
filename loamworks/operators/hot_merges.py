"""BPE training of word tables that are too large for the driver: many exact merges from one pass over the words.

A round counts all pairs in Spark and calls the most frequent ones hot: all
those of a count of T or more. Every word is cut where a pair isn't hot; the
pieces left, in which all neighbours are hot pairs, are counted over all words,
and only these fragments come to the driver. There the merges are learnt as
usual, as long as the best pair occurs T times or more. This is exact:

- merging (a, b) changes pairs of a or b only, and these lie in fragments with it or are cold;
- a new pair (x, ab) is at most as frequent as (x, a) was, and (ab, y) as (b, y); if that was
  cold, so is the new one, unless ab existed before: such a merge ends its round.

So one round gives all merges of a count of T or more, hundreds at a time.
Spark then applies them to the words. The number of hot pairs is lowered until
the fragments fit the driver, and raised again when they are few: the faster,
the fewer they are. It begins the lower, the larger the table is, as each
number that is too high costs a pass over all words. No merge depends on it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import conf_held, delete, stage_path
from .bpe import MIN_FREQUENCY, MOST_SYMBOLS, merge_flat, merges_of

#: Hot pairs of the first round, and at most; with more of one count the round makes a single merge.
HOT_PAIRS, MOST_HOT = 4_096, 1_000_000
#: Hot pairs of the first round at least, however large the table is.
LEAST_HOT = 16
#: Entries that a worker holds before it passes them on.
_HELD = 1 << 19
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_WORDS = "a array<int>, n long"


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and the offsets of its rows."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _neighbours(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pair that begins at each place, as one number, and whether both are of one word."""
    codes = (flat.astype(np.int64)[:-1] << 32) | flat[1:] if len(flat) else np.zeros(0, np.int64)
    inside = np.ones(len(codes), bool)
    ends = offsets[1:-1]
    inside[ends[(ends > 0) & (ends < len(flat))] - 1] = False
    return codes, inside


def _member(codes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of the codes are in wanted, which is sorted."""
    if not len(wanted):
        return np.zeros(len(codes), bool)
    return wanted[np.minimum(np.searchsorted(wanted, codes), len(wanted) - 1)] == codes


def as_symbols(words: DataFrame) -> DataFrame:
    """Words (w, n) as (a, n), a the bytes of w; words without a pair are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            lengths = pc.binary_length(column).to_numpy().astype(np.int64)
            data = np.frombuffer(b"".join(column.to_pylist()), np.uint8).astype(np.int32)
            ends = np.r_[0, np.cumsum(lengths)].astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(data)), batch.column(1)], ["a", "n"])

    spark = words.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    own = words.filter(F.octet_length("w") > 1).select(F.col("w").cast("binary").alias("w"), F.col("n").cast("long").alias("n"))
    # Counted words come in few partitions, for their size; the work on them is dealt evenly.
    return own.repartition(parts, "w").mapInArrow(run, _WORDS)


def pair_sums(words: DataFrame) -> DataFrame:
    """(p, c): the neighbours of all words, l << 32 | r, summed in each task before the shuffle."""

    def sums(codes: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        keys, back = np.unique(np.concatenate(codes), return_inverse=True)
        # Doubles hold sums of counts up to 2**53 exactly.
        return keys, np.bincount(back, np.concatenate(n), len(keys)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            flat, offsets = _flat(batch.column(0))
            codes, inside = _neighbours(flat, offsets)
            n = np.repeat(batch.column(1).to_numpy(), np.diff(offsets))[: len(codes)]
            keys, total = sums([keys, codes[inside]], [total, n[inside]])
            if len(keys) > _HELD:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(total)], ["p", "c"])
                keys, total = keys[:0], total[:0]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(total)], ["p", "c"])

    return words.mapInArrow(run, "p long, c long").groupBy("p").agg(F.sum("c").alias("c"))


def fragments(words: DataFrame, hot: np.ndarray) -> DataFrame:
    """(f, n): the maximal pieces of words all of whose neighbours are hot pairs, as little-endian numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["f", "n"])

        for batch in batches:
            flat, offsets = _flat(batch.column(0))
            codes, inside = _neighbours(flat, offsets)
            link = np.r_[False, inside & _member(codes, hot), False]
            starts, ends = np.flatnonzero(link[1:] & ~link[:-1]), np.flatnonzero(~link[1:] & link[:-1]) + 1
            n = np.repeat(batch.column(1).to_numpy(), np.diff(offsets))[starts]
            data = flat.astype("<i4").tobytes()
            for a, b, c in zip((4 * starts).tolist(), (4 * ends).tolist(), n.tolist(), strict=True):
                key = data[a:b]
                held[key] = held.get(key, 0) + c
            if len(held) > _HELD:
                yield out()
                held.clear()
        yield out()

    return words.mapInArrow(run, "f binary, n long").groupBy("f").agg(F.sum("n").alias("n"))


def merged(words: DataFrame, symbols: list[bytes], merges: list[tuple[bytes, bytes]], last_alone: bool) -> DataFrame:
    """The words after these merges; words of one symbol are done and leave. last_alone: the last merge comes after all others."""
    codes = {x: i for i, x in enumerate(symbols)}
    first = merges[:-1] if last_alone else merges
    rounds = []
    for own in (first, merges[-1:])[: 1 + last_alone]:
        ranked = sorted({codes[a] << 32 | codes[b]: (i, codes[a + b]) for i, (a, b) in reversed(list(enumerate(own)))}.items())
        rounds.append(tuple(np.array([x[k] for x in ((p, *v) for p, v in ranked)], np.int64) for k in range(3)))
    touched = np.unique(np.array([codes[a] << 32 | codes[b] for a, b in merges if a in codes and b in codes], np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = _flat(batch.column(0))
            pairs, inside = _neighbours(flat, offsets)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            hit = np.zeros(batch.num_rows, bool)
            hit[owner[np.flatnonzero(inside & _member(pairs, touched))]] = True
            sizes = np.diff(offsets)
            made, size = flat[hit[owner]].astype(np.int64), sizes[hit]
            for own in rounds:
                made, size = merge_flat(made, size, *own)
            sizes[hit] = size
            # Changed words and unchanged ones, back in their places, without those of one symbol.
            new_owner = np.repeat(np.arange(batch.num_rows), sizes)
            values = np.empty(len(new_owner), np.int32)
            values[hit[new_owner]] = made
            values[~hit[new_owner]] = flat[~hit[owner]]
            stay = sizes > 1
            ends = np.r_[0, np.cumsum(sizes[stay])].astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(ends), pa.array(values[stay[new_owner]]))
            yield pa.RecordBatch.from_arrays([column, batch.column(1).filter(pa.array(stay))], ["a", "n"])

    return words.mapInArrow(run, _WORDS)


def first_hot(total: int | None, most_symbols: int) -> int:
    """Hot pairs of the first round for words of so many bytes together."""
    over = max(1.0, (total or 0) / max(most_symbols, 1))
    return max(LEAST_HOT, int(HOT_PAIRS / over**2))


def faster(size: int, most_symbols: int) -> int:
    """By how much the hot pairs are raised after fragments of so many symbols."""
    return next((k for k, part in ((8, 512), (4, 64), (2, 8)) if size < most_symbols // part), 1)


def spark_merges(
    words: DataFrame, target: int, min_frequency: int = MIN_FREQUENCY, most_symbols: int = MOST_SYMBOLS, told: Callable[[dict], None] | None = None,
    often: list[int] | None = None, total: int | None = None,
) -> list[tuple[bytes, bytes]]:
    """The merges that ``learn_merges`` gives for words (w, n), all of which stay in Spark.

    told hears of each round; how often each pair occurred is added to often; total: the bytes of all words, if known.
    """
    often = [] if often is None else often
    spark = words.sparkSession
    folder = stage_path(spark)
    symbols = [bytes([b]) for b in range(256)]
    out: list[tuple[bytes, bytes]] = []
    step, wanted = 0, first_hot(total, most_symbols)

    def stage(df: DataFrame, kind: str) -> DataFrame:
        nonlocal step
        step += 1
        df.write.option("compression", "zstd").parquet(f"{folder}/{step}")
        found = spark.read.schema(kind).parquet(f"{folder}/{step}")
        found.place = f"{folder}/{step}"
        return found

    try:
        with conf_held(spark, _ARROW_ROWS, "50000"):
            now = stage(as_symbols(words), _WORDS)
            while len(out) < target:
                pairs = stage(pair_sums(now).filter(F.col("c") >= min_frequency), "p long, c long")
                while True:
                    # So many counts at most, in order.
                    top = [r.c for r in pairs.orderBy(F.desc("c")).limit(wanted + 1).select("c").collect()]
                    if not top:
                        return out
                    least = min_frequency if len(top) <= wanted else min(top[0], top[-1] + 1)
                    hot = pairs.filter(F.col("c") >= least)
                    n_hot = hot.count()
                    size = 0
                    if n_hot <= MOST_HOT:
                        codes = np.sort(hot.select("p").toArrow().column("p").to_numpy())
                        found = stage(fragments(now, codes), "f binary, n long")
                        size = found.agg(F.sum(F.octet_length("f").cast("long"))).first()[0] // 4
                        if size <= most_symbols:
                            break
                        delete(spark, found.place)
                    if wanted == 1 or top[0] == top[-1]:
                        size = -1
                        break
                    wanted = max(1, wanted // 4)
                known = set(symbols)
                if size < 0:
                    # Even one count's pairs are too many: the best pair alone is certain.
                    new, last_alone = [_best(pairs.filter(F.col("c") == top[0]), symbols)], False
                    often.append(top[0])
                else:
                    rows = found.toArrow()
                    words_ = [[symbols[x] for x in np.frombuffer(f, "<i4").tolist()] for f in rows.column("f").to_pylist()]
                    new = merges_of(words_, rows.column("n").to_pylist(), target - len(out), least, known, often)
                    del words_, rows
                    delete(spark, found.place)
                    last_alone = len(known) < len(symbols) + len(new)
                out += new
                have = set(symbols)
                for a, b in new:
                    if a + b not in have:
                        have.add(a + b)
                        symbols.append(a + b)
                if told:
                    told({"merges": len(out), "new": len(new), "hot": n_hot, "least": least, "symbols": size})
                if len(out) < target:
                    before = now
                    now = stage(merged(before, symbols, new, last_alone), _WORDS)
                    delete(spark, before.place)
                    if size >= 0:
                        wanted = min(faster(size, most_symbols) * wanted, MOST_HOT - 1)
                delete(spark, pairs.place)
    finally:
        delete(spark, folder)
    return out


def _best(pairs: DataFrame, symbols: list[bytes]) -> tuple[bytes, bytes]:
    """Of pairs of one count the first by its left symbol, then by its right; each symbol's rank is a row, so the vocabulary bounds the side."""
    order = {x: k for k, x in enumerate(sorted(symbols))}
    ranks = pairs.sparkSession.createDataFrame([(i, order[x]) for i, x in enumerate(symbols)], "i long, rank int")
    left, right = ranks.select(F.col("i").alias("l"), F.col("rank").alias("a")), ranks.select(F.col("i").alias("r"), F.col("rank").alias("b"))
    split = pairs.select(F.shiftright("p", 32).alias("l"), F.col("p").bitwiseAND(0xFFFFFFFF).alias("r"))
    best = split.join(F.broadcast(left), "l").join(F.broadcast(right), "r").orderBy("a", "b").select("l", "r").first()
    return symbols[best.l], symbols[best.r]
