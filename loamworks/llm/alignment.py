"""Alignment of the tokens of two tokenizers over the same bytes (operator 12).

Tokenizer A is byte-level BPE, B is piece BPE with byte fallback. The tokens
of B tile the bytes, so their sorted ends are a static interval index: two
bisections per token of A stab the first and the last token of B that it
overlaps, which gives its links. A gap between two tokens of B that no token of
A spans is a group boundary.

Work is done once for each distinct chunk of text. A chunk is a run of white
space and what follows it up to the next; both tokenizers end a token at its
edges, as A's pattern never joins other letters with white space after them and
no piece of B holds such a pair (this is read from the vocabulary). So links,
groups and counts of a text are those of its chunks, one after the other.
New chunks are tokenised in lines and cut again by the bytes of their tokens.

Pass 1 stages blocks of documents: the figures of each document, its chunks as
indices into the block's table of chunks, and that table with its links. Pass 2
sums the links of a block by pair, Spark sums them over the corpus and takes the
largest count of each id of B. Pass 3 adds the counts up for each document. The
counts of pairs come to the workers in slices of at most ``SLICE_PAIRS``, one
pass over the staged blocks for each slice, and the sums of the slices are added
for each block.

Cases: null and empty texts, and texts that either tokenizer does not give back
byte for byte (such as ones with U+2581), have no tokens: zeros and an empty
digest; special tokens are plain text; a text of any length is aligned whole and
is a block of its own if it is long; repeated rows and repeated ids keep a row
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import conf_held
from .bpe import byte_letters, vocabulary_path
from .common import arrow_pass, drop_staged, staged, table, text_slices

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
#: Chunks that a worker remembers; then it starts anew, with the same results.
REMEMBERED = 400_000
#: Characters of the longest chunk that is remembered.
LONGEST = 256
#: Characters of new chunks that are tokenised together.
LINE_CHARS = 16_384
#: Characters of the documents of a block; a longer document is a block alone.
BLOCK_CHARS = 500_000
#: Pairs of ids with their counts (13 bytes each) that go to the workers at once.
SLICE_PAIRS = 4_000_000
#: Pairs that a worker holds before it passes them on.
_HELD = 4_000_000
#: Blocks that Spark reads at once.
BLOCKS_READ = 8
#: Ids of B take so many low bits of a pair's code.
B_BITS = 15
READ_AT_ONCE = "spark.sql.parquet.columnarReaderBatchSize"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_MARK = "▁"
#: Stands before every line: B puts its own space there.
_FIRST = " a"
_BLOCK = (
    "ids array<{}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, sha array<string>, "
    "words array<int>, n_words array<int>, links array<int>, n_chunk_links array<int>"
)


class Growing:
    """A NumPy array that grows by doubling."""

    def __init__(self, kind: type):
        self.data, self.n = np.zeros(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        end = self.n + len(more)
        if end > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.zeros(max(end, len(self.data)), self.data.dtype)])
        self.data[self.n : end] = more
        self.n = end

    def view(self) -> np.ndarray:
        return self.data[: self.n]


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For tokens that tile the same bytes: the first and last token of B that each of A overlaps, and the gaps of B (by the token before) that none spans."""
    starts_a = np.r_[0, ends_a[:-1]]
    starts_b = np.r_[0, ends_b[:-1]]
    first = np.searchsorted(ends_b, starts_a, side="right")
    last = np.searchsorted(starts_b, ends_a, side="left") - 1
    spans = np.cumsum(np.bincount(first, minlength=len(ends_b)) - np.bincount(last, minlength=len(ends_b)))
    return first, last, np.flatnonzero(spans == 0)


class Aligner:
    """Both tokenizers and the table of the chunks met so far."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        back = {c: i for i, c in byte_letters().items()}
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            self.bytes_a[i] = bytes(back[c] for c in t)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if len(pieces) > 1 << B_BITS or len(self.bytes_a) > 1 << (31 - B_BITS):
            raise ValueError("ids don't fit a pair's code")
        self.bytes_b = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode("utf-8") for i, p in enumerate(pieces)
        ]
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # White space that follows no other letter in any piece of B begins a chunk.
        held = {y for p in pieces for x, y in zip(p, p[1:], strict=False) if y in "\t\n\v\f" + _MARK and not (x.isspace() or x == _MARK)}
        begins = "".join(c for c in "\t\n\v\f" if c not in held) + ("" if _MARK in held else " ")
        if " " not in begins:
            raise ValueError("pieces cross spaces")
        self.chunk = re.compile(rf"\s+\S*(?:[^\S{begins}]\s*\S*)*")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        #: For each chunk: tokens of A and B, groups, links; -1 tokens if bytes are lost.
        self.n_a, self.n_b, self.n_groups, self.n_links = (Growing(np.int64) for _ in range(4))
        self.links = Growing(np.int32)

    def cut(self, text: str) -> list[str]:
        """The chunks of a space and the text."""
        return self.chunk.findall(" " + text)

    def _encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of A, ids of B and the byte ends of chunks; None if bytes are lost."""
        line = _FIRST + "".join(chunks)
        a = np.array(self.a.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.int64)
        b = np.array(self.b.encode(line[1:]), np.int64)
        raw = line.encode("utf-8")
        if b"".join([self.bytes_b[i] for i in b.tolist()]) != raw or b"".join([self.bytes_a[i] for i in a.tolist()]) != raw:
            return None
        ends = np.cumsum([len(c) if c.isascii() else len(c.encode("utf-8")) for c in chunks])
        skip = len(_FIRST)
        ends_a, ends_b = np.cumsum(self.length_a[a]) - skip, np.cumsum(self.length_b[b]) - skip
        return a[ends_a > 0], b[ends_b > 0], ends

    def learn(self, chunks: list[str]) -> None:
        """Adds new chunks to the table; one that ends in white space, as only a text's last can, stands alone."""
        inner = [c for c in chunks if not c[-1].isspace()]
        lines = [inner[i:j] for i, j in text_slices(inner, LINE_CHARS)]
        for part in [*lines, *([c] for c in chunks if c[-1].isspace())]:
            found = self._encode(part)
            if found is not None:
                self._add(part, *found)
                continue
            for c in part:
                alone = self._encode([c])
                if alone is not None:
                    self._add([c], *alone)
                else:
                    self.known[c] = len(self.groups)
                    self.groups.append("")
                    for array, n in ((self.n_a, -1), (self.n_b, 0), (self.n_groups, 0), (self.n_links, 0)):
                        array.add(np.array([n]))

    def _add(self, chunks: list[str], a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> None:
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        upto_a, upto_b = np.searchsorted(ends_a, ends) + 1, np.searchsorted(ends_b, ends) + 1
        if (ends_a[upto_a - 1] != ends).any() or (ends_b[upto_b - 1] != ends).any():
            raise RuntimeError("a token crosses the edge of a chunk")
        first, last, free = overlaps(ends_a, ends_b)
        # The end of the last token of B is a boundary too, so `free` holds every group's last token of B.
        cuts = np.searchsorted(ends_a, ends_b[free]) + 1
        n = last - first + 1
        at = np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(int(n.sum()))
        links = (np.repeat(a, n) << B_BITS) | b[at]
        upto_links = np.r_[0, np.cumsum(n)][upto_a]
        upto_groups = np.searchsorted(free, upto_b - 1) + 1
        text_a, text_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        made, i, k = [], 0, 0
        for x, y in zip(cuts.tolist(), (free + 1).tolist(), strict=True):
            made.append((text_a[i] if x == i + 1 else ",".join(text_a[i:x])) + "|" + (text_b[k] if y == k + 1 else ",".join(text_b[k:y])))
            i, k = x, y
        g = 0
        base = len(self.groups)
        self.known.update(zip(chunks, range(base, base + len(chunks)), strict=True))
        for x in upto_groups.tolist():
            self.groups.append(";".join(made[g:x]))
            g = x
        for array, upto in ((self.n_a, upto_a), (self.n_b, upto_b), (self.n_groups, upto_groups), (self.n_links, upto_links)):
            array.add(np.diff(upto, prepend=0))
        self.links.add(links.astype(np.int32))

    def block(self, texts: list[str | None]) -> dict[str, np.ndarray | list[str]]:
        """The figures of some documents, their chunks, and the table of these chunks."""
        cut = [self.cut(t) if t else [] for t in texts]
        every = set().union(*cut)
        new = every.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self._forget()
            new = every
        kept = [c for c in new if len(c) <= LONGEST]
        self.learn(kept)
        mark = (len(self.groups), self.links.n)
        once = [c for c in new if len(c) > LONGEST]
        self.learn(once)
        known, groups = self.known, self.groups
        sizes = np.array([len(x) for x in cut], np.int64)
        words = np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(texts)), sizes)
        lost = np.zeros(len(texts), bool)
        lost[owner[self.n_a.view()[words] < 0]] = True
        if lost.any():
            words, sizes = words[~lost[owner]], np.where(lost, 0, sizes)
            owner = np.repeat(np.arange(len(texts)), sizes)
        out: dict[str, np.ndarray | list[str]] = {"n_words": sizes}
        for name in ("n_a", "n_b", "n_groups", "n_links"):
            out[name] = np.bincount(owner, getattr(self, name).view()[words].astype(np.float64), len(texts)).astype(np.int64)
        sha, at = [], 0
        listed = words.tolist()
        for n in sizes.tolist():
            sha.append(hashlib.sha256(";".join(map(groups.__getitem__, listed[at : at + n])).encode()).hexdigest() if n else "")
            at += n
        out["sha"] = sha
        used, out["words"] = np.unique(words, return_inverse=True)
        n = self.n_links.view()
        starts = np.cumsum(n) - n
        count = n[used]
        take = np.repeat(starts[used] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        out["links"], out["n_chunk_links"] = self.links.view()[take], count
        # Very long chunks are not remembered.
        if once:
            for c in once:
                del known[c]
            del groups[mark[0] :]
            for array in (self.n_a, self.n_b, self.n_groups, self.n_links):
                array.n = mark[0]
            self.links.n = mark[1]
        return out


_LOADED: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of this worker."""
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Aligner(path_a, path_b)
    return _LOADED[path_a, path_b]


def _one(values: object, kind: pa.DataType) -> pa.Array:
    """A list array of one row."""
    flat = values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Pass 1: blocks of documents (doc_id, text), as the module's text says."""
    kind = dict(docs.dtypes)["doc_id"]
    kinds = {"sha": pa.string(), "words": pa.int32(), "n_words": pa.int32(), "links": pa.int32(), "n_chunk_links": pa.int32()}
    names = ["ids", "n_a", "n_b", "n_groups", "n_links", "sha", "words", "n_words", "links", "n_chunk_links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in text_slices(texts, BLOCK_CHARS):
                found = own.block(texts[a:b])
                ids = batch.column(0).slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [_one(ids, ids.type), *(_one(found[x], kinds.get(x, pa.int64())) for x in names[1:])], names
                )

    return arrow_pass(docs, run, _BLOCK.format(kind))


def _flat(column: pa.Array) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False) if len(column) == 1 else column[0].values.to_numpy(zero_copy_only=False)


def _rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for i in range(batch.num_rows):
        # A copy of the row alone: a slice would still show the values of all rows.
        yield batch.take(pa.array([i]))


def pair_counts(found: DataFrame) -> DataFrame:
    """Pass 2: (code, n) of the links of all blocks, summed in each task and then by Spark."""

    def sums(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        codes, back = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
        return codes, np.bincount(back, np.concatenate([x for _, x in held]), len(codes)).astype(np.int64)

    def out(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        codes, n = sums(held)
        return pa.RecordBatch.from_arrays([pa.array(codes, pa.int32()), pa.array(n, pa.int64())], ["code", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for row in _rows(batch):
                words, links, count = _flat(row.column(0)), _flat(row.column(1)), _flat(row.column(2))
                often = np.bincount(words, minlength=len(count))
                held.append(sums([(links, np.repeat(often, count))]))
            if sum(len(x) for x, _ in held) > _HELD:
                held = [sums(held)]
                if len(held[0][0]) > _HELD // 2:
                    yield out(held)
                    held = []
        if held:
            yield out(held)

    parts = arrow_pass(found.select("words", "links", "n_chunk_links"), run, "code int, n long", BLOCKS_READ)
    return parts.groupBy("code").agg(F.sum("n").alias("n"))


def with_best(counts: DataFrame) -> DataFrame:
    """counts (code, n) with best: is n the highest of the pair's id of B?"""
    keyed = counts.withColumn("b", F.col("code").bitwiseAND((1 << B_BITS) - 1))
    # One row for each id of B: the vocabulary bounds them.
    top = keyed.groupBy("b").agg(F.max("n").alias("top"))
    return keyed.join(F.broadcast(top), "b").select("code", "n", (F.col("n") == F.col("top")).alias("best"))


def added(found: DataFrame, codes: np.ndarray, n: np.ndarray, best: np.ndarray) -> DataFrame:
    """Pass 3 for one slice of pairs: (block, n_best array, count_sum array), what the slice adds to each document."""
    shared = found.sparkSession.sparkContext.broadcast((codes, n, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n, best = shared.value
        for batch in batches:
            for row in _rows(batch):
                words, n_words, links, count = (_flat(row.column(i)) for i in range(1, 5))
                at = np.minimum(np.searchsorted(codes, links), max(len(codes) - 1, 0))
                hit = codes[at] == links if len(codes) else np.zeros(len(links), bool)
                chunk = np.repeat(np.arange(len(count)), count)
                sums = []
                for values in (best, n):
                    whole = np.zeros(len(count) + 1, np.int64)
                    np.cumsum(np.bincount(chunk[hit], minlength=len(count)), out=whole[1:])
                    upto = np.r_[0, np.cumsum(values[at[hit]].astype(np.int64))]
                    by_chunk = upto[whole[1:]] - upto[whole[:-1]]
                    ends = np.cumsum(n_words, dtype=np.int64)
                    upto = np.r_[0, np.cumsum(by_chunk[words])]
                    sums.append(upto[ends] - upto[ends - n_words])
                yield pa.RecordBatch.from_arrays(
                    [row.column(0), _one(sums[0], pa.int64()), _one(sums[1], pa.int64())], ["block", "n_best", "count_sum"]
                )

    own = found.select("block", "words", "n_words", "links", "n_chunk_links")
    return arrow_pass(own, run, "block long, n_best array<long>, count_sum array<long>", BLOCKS_READ)


def align(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None,
    slice_pairs: int = SLICE_PAIRS,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    path_a, path_b = path_a or vocabulary_path(VOCABULARY_A), path_b or vocabulary_path(VOCABULARY_B)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    spark = docs.sparkSession
    found = staged(blocks(narrow, path_a, path_b).withColumn("block", F.monotonically_increasing_id()))
    with conf_held(spark, READ_AT_ONCE, str(BLOCKS_READ)):
        counts = staged(with_best(pair_counts(found)))
    slices = -(-counts.count() // slice_pairs)
    sums = None
    for k in range(slices):
        own = counts if slices == 1 else counts.filter(F.pmod(F.xxhash64("code"), F.lit(slices)) == k)
        # So many pairs at most, about, whatever the corpus.
        with conf_held(spark, ARROW_ROWS, "100000"):
            got = own.select("code", "n", "best").toArrow()
        order = np.argsort(codes := got.column("code").to_numpy(), kind="stable")
        with conf_held(spark, READ_AT_ONCE, str(BLOCKS_READ)):
            one = staged(added(found, codes[order], got.column("n").to_numpy()[order], got.column("best").to_numpy()[order]))
        sums = one if sums is None else _both(sums, one)
    drop_staged(counts)
    figures = found.select("block", "ids", "n_a", "n_b", "n_groups", "n_links", "sha")
    if sums is None:
        zeros = F.transform("n_a", lambda _: F.lit(0).cast("long"))
        figures = figures.withColumn("n_best", zeros).withColumn("count_sum", zeros)
    else:
        figures = figures.join(sums, "block")
    row = F.explode(F.arrays_zip("ids", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "sha")).alias("r")
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return figures.select(row).select(
        F.col("r.ids").alias("doc_id"), *(F.col(f"r.{x}") for x in names), F.col("r.sha").alias("groups_sha256")
    )


def _both(a: DataFrame, b: DataFrame) -> DataFrame:
    """The sums of two slices, block by block."""
    b = b.select("block", F.col("n_best").alias("__n"), F.col("count_sum").alias("__c"))
    plus = lambda x, y: F.zip_with(x, y, lambda p, q: p + q)
    return a.join(b, "block").select("block", plus("n_best", "__n").alias("n_best"), plus("count_sum", "__c").alias("count_sum"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
