"""Balanced contiguous shards by global byte-size prefix sums (operator 4).

Rows are put in one global order, (60 bits of the text's SHA-256, id), by
range partitioning. Each range reports its total bytes and rows; the running sums
of those totals, a few rows for each partition, give every range its base, and a
window inside the range adds the local prefix. A row goes to the shard in
whose equal slice of the total its middle byte falls. Everything is built-in
DataFrame functions. Equal texts are neighbours in the order, so a group of
copies lies in one shard, or in neighbouring shards where a cut meets it.

Cases: a null text has no bytes and size 1; rows that are equal in every way
are kept, each with its own slot; an empty table gives an empty result; a
document larger than a shard's target takes the shard of its middle byte;
columns other than the id and the text are ignored whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table, text_of

SHARDS = 16


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard for every row."""
    spark = docs.sparkSession
    text = text_of(text_col)
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long").alias("ord"),
    )
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # The sampled range bounds are fixed by staging: both uses below see the same partitions.
    ranged = staged(
        narrow.repartitionByRange(parts, "ord", "doc_id", "text_crc32").withColumn("part", F.spark_partition_id())
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    # One row for each range partition: a bound known beforehand.
    bases = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte_base"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("row_base"),
        F.sum("bytes").over(everything).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy("ord", "doc_id", "text_crc32")
    placed = (
        ranged.withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("nth", F.row_number().over(inside))
        .join(F.broadcast(bases), "part")
        .withColumn("middle", 2 * (F.col("byte_base") + F.col("upto")) - F.col("size"))
        .withColumn("shard", F.expr(f"CAST(least({shards - 1}, (middle * {shards}) div (2 * all_bytes)) AS INT)"))
        .withColumn("rank", F.col("row_base") + F.col("nth") - 1)
    )
    placed = placed.select("doc_id", "size", "text_crc32", "shard", "rank")
    placed = staged(placed)
    firsts = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"))
