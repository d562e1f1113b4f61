"""Shared plumbing of the corpus operators: tables, staging and Arrow passes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import drop_staged, staged

__all__ = ["arrow_pass", "dealt_join", "drop_staged", "fold_bucket", "join_hot", "row_key", "staged", "table", "text_of", "text_slices"]

#: Rows an Arrow batch holds at most; texts are long, so batches stay small.
BATCH_ROWS = 1024
#: Rows of one key that a join sends to one task.
HOT_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_pass(
    df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, rows: int = BATCH_ROWS
) -> DataFrame:
    """mapInArrow in batches of so many rows; texts need small ones, and the session's setting is read when the plan runs.

    Spark bounds a batch in bytes too. A worker gives memory that it no longer uses back before and after its task,
    as it lives on beside the workers of later stages.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        yield from f(batches)
        release_memory()

    return df.mapInArrow(run, schema)


def release_memory() -> None:
    """Gives the free memory of this process back to the system, where it can."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def join_hot(left: DataFrame, right: DataFrame, key: str | list[str], how: str = "inner", together: int | None = None) -> DataFrame:
    """left joined with right, which has a key once; a key of more than so many rows of left is dealt to several tasks."""
    together = together or HOT_ROWS
    keys = [key] if isinstance(key, str) else key
    many = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__k")).filter(F.col("__k") > together)
    return dealt_join(left, right, keys, many.withColumn("__k", F.ceil(F.col("__k") / together).cast("int")), how)


def dealt_join(left: DataFrame, right: DataFrame, keys: list[str], many: DataFrame, how: str = "inner") -> DataFrame:
    """The same, where many (keys, __k) names the frequent keys, few as they are, and the tasks that each is dealt to."""
    deal = F.when(F.col("__k").isNotNull(), F.pmod(F.xxhash64(*left.columns), F.col("__k"))).otherwise(0).cast("int")
    dealt = left.join(many, keys, "left").withColumn("__deal", deal).drop("__k")
    copies = right.join(many, keys, "left").withColumn("__deal", F.explode(F.sequence(F.lit(0), F.coalesce("__k", F.lit(1)) - 1)))
    return dealt.join(copies.drop("__k"), [*keys, "__deal"], how).drop("__deal")


def text_of(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_slices(texts: list[str | None], limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Runs of texts of about so many characters together."""
    a, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > a and size + n > limit:
            yield a, i
            a, size = i, 0
        size += n
    if a < len(texts):
        yield a, len(texts)


def row_key(doc_id: str, text: str) -> Column:
    """64-bit key of a row by its id and content; rows that share both are the same document."""
    return F.xxhash64(F.col(doc_id).cast("string"), text_of(text))


def fold_bucket(doc_id: str, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n
