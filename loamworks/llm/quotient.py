"""Exact dedup by counting quotient filters and byte verification (operator 13).

Every text is normalised (each run of white space becomes one space) and
fingerprinted by 64 bits. Each partition of fingerprints builds counting
quotient filters: the high bits of a fingerprint, its quotient, are not stored
but marked in a bit vector of occupied quotients; the low bits, its remainder,
stand in sorted runs, one for each occupied quotient, whose ends a second bit
vector marks; a third marks remainders that occur more than once, and their
counts follow apart. A filter covers one block of quotients, so filters of a
block from all partitions meet in one task and merge by their sorted
remainders, without loss: the merged filter is that of all rows.

Only fingerprints with a count above one go on to byte verification: their
whole normalised texts are grouped by their bytes, pre-aggregated in each
partition. Texts that merely share a fingerprint stay apart. All other rows
are known to be single without being compared.

Bounds: a block holds about ``BLOCK_ROWS`` fingerprints whatever the input, as
blocks grow in number with the rows; a fingerprint has one entry for each
partition, however many rows share it. Rows of large groups are dealt to
several tasks in joins, by the counts of the filter. Repeated fingerprints are
broadcast up to ``MOST_BROADCAST``, else joined by a shuffle.

Cases: a null text counts as empty, and empty texts are equal; the row of the
least id stays, of several rows with that id one of them, null ids last; a
group of null ids alone has a null ``keep_id``; texts of any length are read
whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_pass, dealt_join, drop_staged, join_hot, staged, table, text_of

#: Fingerprints of one block, about.
BLOCK_ROWS = 1 << 17
#: Repeated fingerprints (8 bytes each) that are broadcast; more are joined by a shuffle.
MOST_BROADCAST = 1 << 20
#: Rows of one group that a join sends to one task.
HOT_ROWS = 2_000
#: Bits of a fingerprint; tests take few, so that unlike texts collide.
BITS = 64
#: Entries that a worker holds before it merges them.
_HELD = 1 << 21
U = np.uint64


def normalised(name: str) -> Column:
    """The text with each run of white space as one space; null is empty."""
    return F.regexp_replace(text_of(name), r"[\x20\x09-\x0D]+", " ")


def fingerprint(text: Column, bits: int = BITS) -> Column:
    """The high bits of a 64-bit hash of the text, as an unsigned number in a long."""
    found = F.xxhash64(text)
    return found if bits == 64 else F.shiftrightunsigned(found, 64 - bits)


class Layout:
    """How bits of a fingerprint are divided: block, quotient within the block, remainder of whole bytes."""

    def __init__(self, blocks: int, bits: int = BITS):
        self.block_bits = max(0, (blocks - 1).bit_length())
        # Four bits of quotient at least; the rest of the fingerprint fills whole bytes where it can.
        first = min(bits, self.block_bits + 4)
        self.remainder_bits = (bits - first) // 8 * 8
        self.quotient_bits = bits - self.block_bits - self.remainder_bits
        if self.quotient_bits < 0:
            raise ValueError(f"{bits} bits are too few for {blocks} blocks")
        self.bits = bits

    def block(self, prints: np.ndarray) -> np.ndarray:
        return prints >> U(self.bits - self.block_bits) if self.block_bits else np.zeros(len(prints), U)


def counted(prints: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints in order and their counts."""
    order = np.argsort(prints, kind="stable")
    prints = prints[order]
    starts = np.flatnonzero(np.r_[True, prints[1:] != prints[:-1]]) if len(prints) else np.zeros(0, np.int64)
    if counts is None:
        return prints[starts], np.diff(np.r_[starts, len(prints)])
    return prints[starts], np.add.reduceat(counts[order], starts) if len(starts) else np.zeros(0, np.int64)


def pack(prints: np.ndarray, counts: np.ndarray, layout: Layout) -> bytes:
    """The counting quotient filter of sorted distinct fingerprints of one block."""
    n, width = len(prints), layout.remainder_bits // 8
    quotients = (prints >> U(layout.remainder_bits)) & U((1 << layout.quotient_bits) - 1) if layout.remainder_bits < 64 else np.zeros(n, U)
    occupied = np.zeros(1 << layout.quotient_bits, bool)
    occupied[quotients.astype(np.int64)] = True
    ends = np.r_[quotients[1:] != quotients[:-1], True] if n else np.zeros(0, bool)
    remainders = prints.astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
    often = counts > 1
    head = np.array([n, int(often.sum())], "<u4")
    parts = (head, np.packbits(occupied), np.packbits(ends), remainders, np.packbits(often), counts[often].astype("<u8"))
    return b"".join(x.tobytes() for x in parts)


def unpack(data: bytes, block: int, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """The sorted fingerprints and counts of a filter."""
    n, more = np.frombuffer(data, "<u4", 2).tolist()
    at = 8

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(data, np.uint8, size, at - size)

    width = layout.remainder_bits // 8
    slots = 1 << layout.quotient_bits
    occupied = np.unpackbits(take(-(-slots // 8)), count=slots)
    ends = np.unpackbits(take(-(-n // 8)), count=n)
    rest = np.zeros((n, 8), np.uint8)
    rest[:, :width] = take(n * width).reshape(n, width)
    often = np.unpackbits(take(-(-n // 8)), count=n).astype(bool)
    counts = np.ones(n, np.int64)
    counts[often] = take(8 * more).view("<u8")
    # The k-th run belongs to the k-th occupied quotient.
    run = np.cumsum(ends) - ends
    quotients = np.flatnonzero(occupied).astype(U)[run]
    prints = rest.view("<u8").reshape(n).astype(U) | (quotients << U(layout.remainder_bits))
    if layout.block_bits:
        prints |= U(block) << U(layout.bits - layout.block_bits)
    return prints, counts


def filters(prints: DataFrame, layout: Layout) -> DataFrame:
    """(block, filter) of each partition of prints (fp long): a filter for every block that it meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            held.append(counted(batch.column(0).to_numpy(zero_copy_only=False).view(U)))
            size += len(held[-1][0])
            if size > _HELD:
                held = [counted(*map(np.concatenate, zip(*held, strict=True)))]
                size = len(held[0][0])
                if size > _HELD // 2:
                    # Very large partitions give several filters of a block; they merge as those of partitions do.
                    yield from _emit(*held.pop(), layout)
                    size = 0
        if held:
            yield from _emit(*counted(*map(np.concatenate, zip(*held, strict=True))), layout)

    return arrow_pass(prints.select("fp"), run, "block long, filter binary", 65_536)


def _emit(prints: np.ndarray, counts: np.ndarray, layout: Layout) -> Iterator[pa.RecordBatch]:
    blocks, starts = np.unique(layout.block(prints), return_index=True)
    cuts = [*starts.tolist(), len(prints)]
    for k in range(0, len(blocks), 1024):
        own = [pack(prints[a:b], counts[a:b], layout) for a, b in zip(cuts[k : k + 1024], cuts[k + 1 : k + 1025], strict=False)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks[k : k + 1024].astype(np.int64), pa.int64()), pa.array(own, pa.binary())], ["block", "filter"]
        )


def merged(parts: DataFrame, layout: Layout) -> DataFrame:
    """(block, filter): the filters of each block merged by their sorted remainders."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = key[0].as_py()
        now = (np.zeros(0, U), np.zeros(0, np.int64))
        held, size = [now], 0
        for batch in batches:
            for data in batch.column(1):
                held.append(unpack(data.as_py(), block, layout))
                size += len(held[-1][0])
                if size > _HELD:
                    held, size = [counted(*map(np.concatenate, zip(*held, strict=True)))], 0
        prints, counts = counted(*map(np.concatenate, zip(*held, strict=True)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([pack(prints, counts, layout)], pa.binary())], ["block", "filter"]
        )

    return parts.groupBy("block").applyInArrow(run, "block long, filter binary")


def repeated(whole: DataFrame, layout: Layout, least: int = 2) -> DataFrame:
    """(fp, n) of the fingerprints that a merged filter counts so often at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                prints, counts = unpack(data.as_py(), block, layout)
                many = counts >= least
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prints[many].view(np.int64), pa.int64()), pa.array(counts[many], pa.int64())], ["fp", "n"]
                )

    return arrow_pass(whole.select("block", "filter"), run, "fp long, n long", 64)


def verified(docs: DataFrame, often: DataFrame, bits: int = BITS, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """(fp, sha, keep_id, group_size) of the byte-equal groups among the rows of docs (doc_id, text) whose fingerprint is in often (fp, n)."""
    texts = docs.select("doc_id", normalised("text").alias("t")).withColumn("fp", fingerprint(F.col("t"), bits))
    if often.count() <= most_broadcast:
        routed = texts.join(F.broadcast(often.select("fp")), "fp", "left_semi")
    else:
        routed = join_hot(texts, often.select("fp"), "fp", together=HOT_ROWS)
    groups = routed.groupBy("fp", "t").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return groups.select("fp", F.unhex(F.sha2("t", 256)).alias("sha"), "keep_id", "group_size")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, block_rows: int = BLOCK_ROWS, most_broadcast: int = MOST_BROADCAST
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    text = normalised("text")
    rows = staged(
        docs.select("doc_id", text.alias("t")).select("doc_id", fingerprint(F.col("t"), bits).alias("fp"), F.unhex(F.sha2("t", 256)).alias("sha"))
        .withColumn("rid", F.monotonically_increasing_id())
    )
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    layout = Layout(min(max(parts, -(-rows.count() // block_rows)), 1 << min(bits, 40)), bits)
    whole = staged(merged(filters(rows, layout), layout))
    often = staged(repeated(whole, layout))
    groups = staged(verified(docs, often, bits, most_broadcast).filter("group_size > 1"))
    # Of several rows with the least id, the first; a group is known by its digest once its bytes are compared.
    found = dealt_join(rows, groups, ["fp", "sha"], hot_of(groups))
    least = found.filter("doc_id <=> keep_id").groupBy("fp", "sha").agg(F.min("rid").alias("first"))
    first = staged(groups.join(least, ["fp", "sha"]))
    drop_staged(whole, often, groups)
    found = dealt_join(rows, first, ["fp", "sha"], hot_of(first), "left")
    return found.select(
        "doc_id",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("first").isNull() | (F.col("first") == F.col("rid"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def hot_of(groups: DataFrame) -> DataFrame:
    """The large groups, and the number of tasks that each is dealt to."""
    return groups.filter(F.col("group_size") > HOT_ROWS).select("fp", "sha", F.ceil(F.col("group_size") / HOT_ROWS).cast("int").alias("__k"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))
