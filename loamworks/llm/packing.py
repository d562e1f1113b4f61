"""Best-two-fit packing of tokenised documents into fixed-length sequences (operator 8).

Only lengths matter for packing, and there are at most 4096 of them. So the
driver packs the histogram of piece lengths, whatever the number of documents:
it fills a bin greedily with the longest lengths that fit, then replaces the
smallest one by two unpacked lengths that fit the widened gap more tightly,
and repeats the finished bin as often as the counts allow. Every place in
such a pattern is a range of ranks among the pieces of one length. Pieces get
their rank from counts for each partition, so no task sees more than its own.

Cases: a null or empty text is the closing id alone; longer documents are cut
into full pieces and a rest; repeated rows are packed each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import LONGEST, WordBpe, vocabulary_path
from .common import arrow_pass, staged, table, text_of, text_slices

CAPACITY = 4096
CLOSING_ID = 1
#: Chunks that a worker remembers; then it starts anew, with the same results.
CHUNKS = 1_000_000
#: Characters of new chunks that go to the library at once; a longer chunk goes alone.
LINE_CHARS = 16_384


class ChunkIds(WordBpe):
    """Ids of chunks as little-endian bytes; new chunks go through the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__(path)
        self.library = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}

    def ids_of(self, texts: list[str]) -> Iterator[bytes]:
        cut = [self.pieces(t) for t in texts]
        every = set().union(*cut)
        new = every.difference(self.known)
        if len(self.known) + len(new) > CHUNKS:
            self.known.clear()
            new = every
        self._learn_ids(new)
        known = self.known
        found = [[known[c] for c in own] for own in cut]
        for c in new:
            if len(c) > LONGEST:
                del known[c]
        for own in found:
            yield b"".join(own)

    def _learn_ids(self, new: set[str]) -> None:
        """New chunks go to the library in lines, parted by a special token that no chunk of a line holds."""
        part = min(self.special, key=len)
        mark = self.special[part]
        plain = []
        for c in new:
            if "<|" in c and any(x in c for x in self.special):
                # A special token, or its letters in another case, which the library would take for one.
                self.learn({c})
                self.known[c] = np.array(self.chunks.pop(c)[0].split(), "<u4").tobytes()
            else:
                plain.append(c)
        for a, b in text_slices(plain, LINE_CHARS):
            line = self.library.encode_batch_fast([part.join(plain[a:b])], add_special_tokens=False)[0]
            ids = np.array(line.ids, "<u4")
            cuts = (4 * np.flatnonzero(ids == mark)).tolist()
            if len(cuts) != b - a - 1:
                raise RuntimeError(f"{b - a} chunks came back as {len(cuts) + 1}")
            flat = ids.tobytes()
            starts = [0, *[x + 4 for x in cuts]]
            self.known.update(zip(plain[a:b], [flat[i:j] for i, j in zip(starts, [*cuts, len(flat)])], strict=True))


_LOADED: dict[str, ChunkIds] = {}


def encoder(path: str) -> ChunkIds:
    """The encoder of this worker; a function that Spark ships gets a copy of the table, not the table itself."""
    if path not in _LOADED:
        _LOADED[path] = ChunkIds(path)
    return _LOADED[path]


def pieces(rows: DataFrame, capacity: int, path: str) -> DataFrame:
    """The pieces of rows (doc_id, text), with the partition and the rank among its pieces of that length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoder(path)
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        closing = CLOSING_ID.to_bytes(4, "little")
        for batch in batches:
            texts = batch.column(1).to_pylist()
            row, piece, start, length, crc, rank = [], [], [], [], [], []
            for a, b in text_slices(texts):
                for r, own in enumerate(ids.ids_of(texts[a:b]), a):
                    own += closing
                    for k, s in enumerate(range(0, len(own), 4 * capacity)):
                        part_ids = own[s : s + 4 * capacity]
                        n = len(part_ids) // 4
                        row.append(r)
                        piece.append(k)
                        start.append(s // 4)
                        length.append(n)
                        crc.append(zlib.crc32(part_ids))
                        rank.append(seen[n])
                        seen[n] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([part] * len(row), pa.int32()),
                    pa.array(rank, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"],
            )

    kind = dict(rows.dtypes)["doc_id"]
    return arrow_pass(rows, run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, rank long")


def pack_counts(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(how many bins, lengths in each) by best-two-fit over a histogram of lengths."""
    left = {n: c for n, c in counts.items() if c > 0}
    sizes = sorted(left)
    used: dict[int, int] = {}

    def free(n: int) -> int:
        return left[n] - used.get(n, 0)

    def longest(limit: int, spare: int = 0) -> int:
        """The longest length up to the limit with one unused piece, two if it equals spare; 0 if none."""
        i = bisect_right(sizes, limit) - 1
        while i >= 0:
            if free(sizes[i]) > (sizes[i] == spare):
                return sizes[i]
            i -= 1
        return 0

    out = []
    while sizes:
        used = {}
        bin_: list[int] = []
        gap = capacity
        while n := longest(gap):
            insort(bin_, n)
            used[n] = used.get(n, 0) + 1
            gap -= n
        while gap:
            least = bin_[0]
            used[least] -= 1
            best, pair = least, None
            i = bisect_right(sizes, gap + least - 1) - 1
            while i >= 0 and 2 * sizes[i] > best:
                a = sizes[i]
                i -= 1
                if free(a) < 1:
                    continue
                b = longest(min(a, gap + least - a), a)
                if b and a + b > best:
                    best, pair = a + b, (a, b)
                    if best == gap + least:
                        break
            if pair is None:
                used[least] += 1
                break
            bin_.pop(0)
            gap += least - best
            for n in pair:
                insort(bin_, n)
                used[n] = used.get(n, 0) + 1
        times = min(left[n] // u for n, u in used.items() if u)
        out.append((times, bin_[::-1]))
        for n, u in used.items():
            left[n] -= times * u
            if u and not left[n]:
                sizes.pop(bisect_right(sizes, n) - 1)
    return out


def _places(patterns: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """For each place of each pattern: length, first rank, first sequence and offset, sorted by length and rank."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for times, lengths in patterns:
        offset = 0
        for n in lengths:
            rows.append((n, rank.get(n, 0), sequence, offset))
            rank[n] = rank.get(n, 0) + times
            offset += n
        sequence += times
    a = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"key": (a[:, 0] << 44) + a[:, 1], "rank": a[:, 1], "sequence": a[:, 2], "offset": a[:, 3]}


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, path: str | None = None
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    cut = staged(pieces(rows, capacity, path or vocabulary_path()))
    counts = staged(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    places = _places(pack_counts(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    # A row for each partition and length: too many for a broadcast as the input grows.
    ranked = cut.join(bases.hint("shuffle_hash"), ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("rank")).alias("rank")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.searchsorted(places["key"], (length << 44) + rank, side="right") - 1
            sequence = places["sequence"][at] + rank - places["rank"][at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(places["offset"][at])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    kind = dict(ranked.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return arrow_pass(ranked, run, schema)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
