"""The prefix of a corpus up to a number of characters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..staging import delete, staged

#: Characters, not bytes.
SAMPLE_CHARS = 65_536


def _literal(value: object) -> Column:
    return F.struct(*(_literal(v).alias(k) for k, v in value.asDict().items())) if isinstance(value, Row) else F.lit(value)


def _before(wanted: dict[str, Column]) -> Column:
    """Is a row before the values, in the order of the columns, nulls first?"""
    out = F.lit(False)
    for c, v in reversed(wanted.items()):
        less = v.isNotNull() & (F.col(c).isNull() | (F.col(c) < v))
        out = F.coalesce(less, F.lit(False)) | (F.col(c).eqNullSafe(v) & out)
    return out


def prefix(records: DataFrame, order: list[str], text: str = "text", budget: int = SAMPLE_CHARS) -> DataFrame:
    """The records in order until the budget is reached, that record whole; a record counts its characters and one.

    Two levels of prefix sums over lengths alone find the last record: the sums of ranges of the order, one row each,
    give the range in which the budget is reached, and only that one is summed record by record. Then the records up
    to that one are fetched by a filter on the order, which reaches the scan; no text is sorted, whatever the budget.
    Equal places in the order go by a hash of the text; records that are alike in that too count as interchangeable.
    Empty and null texts are no records.
    """
    spark = records.sparkSession
    budget = max(budget, 1)
    keys = [*order, "__hash"]
    hashed = records.filter(F.length(text) > 0).withColumn("__hash", F.xxhash64(text))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    narrow = hashed.select(*keys, (F.length(text).cast("long") + 1).alias("__n"))
    ranged = staged(narrow.repartitionByRange(parts, *keys).withColumn("__part", F.spark_partition_id()))
    try:
        upto, cut = 0, None
        # One row for each range.
        for part, n in ranged.groupBy("__part").agg(F.sum("__n")).orderBy("__part").collect():
            if upto + n >= budget:
                cut = part
                break
            upto += n
        if cut is None:
            return records.filter(F.length(text) > 0)
        inside = Window.partitionBy("__part").orderBy(*keys)
        before = F.sum("__n").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")
        kept = ranged.filter(F.col("__part") == cut).withColumn("__before", before).filter(F.col("__before") + upto < budget)
        last = kept.withColumn("__same", F.row_number().over(Window.partitionBy(*keys).orderBy("__before")))
        # The last record, and how many records alike it has before it.
        row = last.orderBy(F.desc("__before")).limit(1).first()
        values = {k: _literal(row[k]).cast(hashed.schema[k].dataType) for k in keys}
        alike = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(v) for k, v in values.items()))
        found = hashed.filter(_before(values)).union(hashed.filter(alike).limit(row["__same"]))
        return found.drop("__hash")
    finally:
        delete(spark, ranged.staged_path)


def read_sample(records: DataFrame, order: list[str], text: str = "text", budget: int = SAMPLE_CHARS) -> str:
    """The text of the prefix, each record followed by a line end."""
    rows = prefix(records, order, text, budget).orderBy(*order).select(text).collect()  # bounded by the budget
    if not rows:
        raise ValueError("the corpus has no records")
    return "".join(r[0] + "\n" for r in rows)
