"""Removal of repeated 35-word passages (operator 7).

Every window of 35 consecutive words of a document gets a Rabin-Karp hash.
Counting all of them by shuffle would move several times the corpus, so Spark
first counts one eighth: in each window the least hash of its 8-word grams is
its anchor, a function of the window's words alone, hence windows with equal
words have equal anchors. Neighbouring windows mostly share an anchor; such a
run (at most 28 windows) is one row, with a hash of the whole run.

Equal runs of one document are one row with all its places, so a line that a
document repeats many times is shuffled once. Anchors and runs of very many
documents are dealt to several tasks.

1. Anchors are counted; an anchor that occurs once rules its run out.
2. Runs that are equal as a whole are repeated in all their windows.
3. Where an anchor has runs that differ (the rims of passages), the windows of
   one run of each kind are hashed and counted one by one.

Overlapping repeated windows merge into maximal removal intervals.

Cases: null and empty texts, and texts under 35 words, have no window; a
document that occurs twice loses all words of its windows in both; rows that
share id and text count as two documents; an empty table gives an empty
result; columns other than the id and the text are ignored. Hashes have 64
bits; different passages of one hash would be taken for equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import HOT_ROWS, arrow_pass, dealt_join, join_hot, row_key, staged, table, text_of

WIDTH = 35
GRAM = 8
#: Frequent anchors up to which they are shipped with the tasks; more are joined by a shuffle.
MOST_HOT = 1 << 20


def _windows(buf: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, window hashes, which windows lie in one row, and each row's first word."""
    starts, ends, first = K.word_spans(buf, offs)
    words = K.word_hashes(buf, starts, ends)
    n = max(0, len(words) - width + 1)
    inside = np.zeros(n + width + 1, np.int8)
    # A window may start at a row's first word, and no later than its width-th last one.
    full = first[1:] - first[:-1] >= width
    np.add.at(inside, first[:-1][full], 1)
    np.add.at(inside, first[1:][full] - width + 1, -1)
    return words, K.gram_hashes(words, width), np.cumsum(inside[:n]) > 0, first


def _runs(buf: np.ndarray, offs: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """anchor, hash of the run, row, first window in the row, and windows more, of every run."""
    words, windows, inside, first = _windows(buf, offs, width)
    grams = K.mix(K.gram_hashes(words, gram))
    at = K.sliding_argmin(grams, width - gram + 1)
    own = np.flatnonzero(inside)
    edge = K.runs(at[own])
    a, b = own[edge[:-1]], own[edge[1:] - 1]
    row = np.searchsorted(first, a, side="right") - 1
    whole = K.mix(windows[a] * np.uint64(0x9E3779B97F4A7C15) + K.mix(windows[b]) + (b - a).astype(np.uint64))
    return grams[at[a]], whole, row, a - first[row], b - a


def anchors(docs: DataFrame, width: int, gram: int, only: bool, hot: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """Runs of the rows of docs (key, text), equal ones of a row as one with its places: the anchors only, or all columns.

    hot: frequent anchors (sorted) and the parts that the rows of each are dealt into; the part of a row is __deal.
    """
    hot_anchor, hot_parts = hot or (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def deal(anchor: np.ndarray, key: np.ndarray) -> np.ndarray:
        if not len(hot_anchor):
            return np.zeros(len(anchor), np.int32)
        at = np.searchsorted(hot_anchor, anchor) % len(hot_anchor)
        return (key.view(np.uint64) % np.where(hot_anchor[at] == anchor, hot_parts[at], 1).astype(np.uint64)).astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column(0).to_numpy(zero_copy_only=False))
            buf, offs = K.buffers(batch.column(1))
            for i, j in K.slices(offs):
                part = buf[offs[i] : offs[j]]
                anchor, whole, row, at, more = _runs(part, offs[i : j + 1] - offs[i], width, gram)
                order = np.lexsort((anchor, row)) if only else np.lexsort((at, whole, anchor, row))
                anchor, whole, row = anchor[order], whole[order], row[order]
                new = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
                if not only:
                    new |= whole[1:] != whole[:-1]
                edge = np.r_[0, np.flatnonzero(new) + 1, len(row)] if len(row) else np.zeros(1, np.int64)
                n = pa.array(np.diff(edge).astype(np.int64))
                head = edge[:-1]
                if only:
                    yield pa.RecordBatch.from_arrays([K.signed(anchor[head]), n], ["anchor", "n"])
                else:
                    places = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array((at * 64 + more)[order]))
                    key = keys[i:j][row[head]].astype(np.int64)
                    part_of = pa.array(deal(anchor[head].view(np.int64), key))
                    cols = [K.signed(anchor[head]), K.signed(whole[head]), pa.array(key), n, places, part_of]
                    yield pa.RecordBatch.from_arrays(cols, ["anchor", "whole", "key", "n", "places", "__deal"])

    schema = "anchor long, n long" if only else "anchor long, whole long, key long, n long, places array<long>, __deal int"
    return arrow_pass(docs, run, schema)


def _rims(docs: DataFrame, width: int) -> DataFrame:
    """Window hashes of rows (key, text, items), where an item is 2 * place + (its run is repeated)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, items = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            buf, offs = K.buffers(batch.column(1))
            for i, j in K.slices(offs):
                _, windows, _, first = _windows(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], width)
                out: list[list[np.ndarray]] = [[np.zeros(0, np.uint64)], *([np.zeros(0, np.int64)] for _ in range(3))]
                for r in range(i, j):
                    item = np.array(items[r], np.int64)
                    place, sure = item >> 1, item & 1
                    n = (place & 63) + 1
                    at = np.repeat(place >> 6, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    out[0].append(windows[first[r - i] + at])
                    out[1].append(np.repeat(1 + sure, n))
                    out[2].append(np.full(len(at), keys[r]))
                    out[3].append(at * 64)
                cols = [np.concatenate(x) for x in out]
                yield pa.RecordBatch.from_arrays(
                    [K.signed(K.mix(cols[0])), *map(pa.array, cols[1:])], ["window", "weight", "key", "place"]
                )

    return arrow_pass(docs, run, "window long, weight long, key long, place long")


def repeated_places(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(key, places) of all repeated windows of docs (key, text); a place is 64 * first window + windows more."""
    counts = anchors(docs, width, gram, True).groupBy("anchor").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"))
    often = staged(counts.filter("n > 1"))
    # Anchors of very many rows are dealt to several tasks; at most one in HOT_ROWS rows is such.
    hot = staged(often.filter(F.col("rows") > HOT_ROWS // 10).select("anchor", F.ceil(F.col("rows") / (HOT_ROWS // 10)).cast("int").alias("__k")))
    few = hot.limit(MOST_HOT + 1).toPandas().sort_values("anchor")
    if len(few) <= MOST_HOT:
        copies = often.join(hot, "anchor", "left").select("anchor", F.explode(F.sequence(F.lit(0), F.coalesce("__k", F.lit(1)) - 1)).alias("__deal"))
        found = anchors(docs, width, gram, False, (few["anchor"].to_numpy(np.int64), few["__k"].to_numpy(np.int64)))
        runs = staged(found.join(copies, ["anchor", "__deal"]).drop("__deal"))
    else:
        runs = staged(dealt_join(anchors(docs, width, gram, False).drop("__deal"), often.select("anchor"), ["anchor"], hot))
    kinds = staged(
        runs.groupBy("anchor", "whole").agg(F.sum("n").alias("n"), F.min(F.struct("key", F.col("places")[0].alias("place"))).alias("one"))
        .select("anchor", "whole", "n", "one.key", "one.place")
    )
    mixed = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("anchor")
    rims = join_hot(kinds, mixed, "anchor", together=HOT_ROWS // 10).groupBy("key")
    rims = rims.agg(F.collect_set(F.expr("2 * place + IF(n > 1, 1, 0)")).alias("items"))
    windows = staged(_rims(docs.join(rims, "key").select("key", "text", "items"), width))
    twice = windows.groupBy("window").agg(F.sum("weight").alias("w")).filter("w > 1").select("window")
    by_window = windows.filter("weight = 1").join(twice, "window").select("key", F.array("place").alias("places"))
    by_run = join_hot(runs, kinds.filter("n > 1").select("anchor", "whole"), ["anchor", "whole"], together=HOT_ROWS // 10)
    return by_run.select("key", "places").unionByName(by_window)


def _covered(n: int, places: np.ndarray, width: int) -> np.ndarray:
    """Which of n words the windows cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, places >> 6, 1)
    np.add.at(edge, (places >> 6) + (places & 63) + width, -1)
    return np.cumsum(edge[:n]) > 0


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, keep: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, n_words, n_removed, kept (text) and spans (removed words [from, upto)); the columns of keep follow."""
    rows = docs.select(row_key(id_col, text_col).alias("key"), text_of(text_col).alias("text"))
    flags = repeated_places(rows, width).groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))
    own = docs.select(
        F.col(id_col).alias("__row_id"), text_of(text_col).alias("__row_text"), row_key(id_col, text_col).alias("__row_key"), *keep
    )
    flags = flags.select(F.col("key").alias("__row_key"), F.col("places").alias("__row_places"))
    joined = own.join(flags, "__row_key", "left").select("__row_id", "__row_text", "__row_places", *keep)
    made = ["doc_id", "n_words", "n_removed", "kept", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept, spans = [], [], [], []
            for text, places in zip(batch.column(1), batch.column(2), strict=True):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                n_words.append(len(words))
                if not places.is_valid:
                    n_removed.append(0)
                    kept.append(b" ".join(words))
                    spans.append([])
                    continue
                gone = _covered(len(words), np.array(places.as_py(), np.int64), width)
                n_removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g))
                edge = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8))).reshape(-1, 2)
                spans.append([{"from": a, "upto": b} for a, b in edge.tolist()])
            arrays = [
                batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
                pa.array(spans, pa.list_(pa.struct([("from", pa.int64()), ("upto", pa.int64())]))),
            ]
            yield pa.RecordBatch.from_arrays(arrays + batch.columns[3:], made + list(keep))

    kinds = dict(joined.dtypes)
    more = "".join(f", `{c}` {kinds[c]}" for c in keep)
    return arrow_pass(
        joined, run,
        f"doc_id {kinds['__row_id']}, n_words long, n_removed long, kept string,"
        f" spans array<struct<from:long,upto:long>>{more}",
    )


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
