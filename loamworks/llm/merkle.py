"""Merkle manifest of a dataset by window-based levels (operator 11).

Rows become leaves; the leaves of a group (its source), in the order of their
ids, become the lowest level of that group's tree. One level is one window:
partitioned by group and parent index, ordered by index, over the full frame,
whose ``collect_list`` gives the nodes of the run. Joined they are the preimage
of the parent, and without the row's own place they are its siblings. Of equal
parents one goes on to the next level. A run has ``FANOUT`` nodes at most, so
no window partition grows with its group. The roots of the groups are the
leaves of one more tree of the same kind.

Places in a group come from range partitions: a row knows its place in its
partition, and running sums over (group, partition) totals give each its base.
Proofs are joined from the top downwards, a node's path once for the run below it.

Cases: a null source is a group of its own, the first; null ids come first in
their group; rows of equal id are ordered by their leaf, and rows equal in
every way each keep a leaf of the tree; a null in any column is hashed as
``-``, an empty text as ``0:``; a group of one row has its leaf as root, and a
single group's root is the root of all; an empty table gives an empty result;
further columns are ignored whatever their names. A null id is never tampered with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_staged, staged, table

#: Nodes of a run.
FANOUT = 16
#: Totals of (group, partition) that are broadcast; more are joined by a shuffle.
MOST_TOTALS = 100_000
#: Rows whose crc32 of the id this divides are tampered with.
TAMPERED = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """A value with its length before it, so that no two rows have one preimage; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    """The lowercase hex SHA-256 of a row's fields."""
    return F.sha2(F.concat(*map(field, columns)), 256)


def group_key(name: str) -> Column:
    """A key without nulls that sorts as the group does: null first, then by the bytes."""
    text = F.col(name).cast("string")
    return F.when(text.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), text))


def placed(rows: DataFrame, order: list[str], made: list[DataFrame]) -> DataFrame:
    """rows (g, ...) with idx, the place in their group g by that order, and n, the size of the group.

    Sorting by range deals a large group to many partitions; only totals of
    (group, partition) are summed up. The staged tables are added to made.
    """
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    own = [F.col(c).asc_nulls_first() for c in ("g", *order)]
    ranged = rows.repartitionByRange(parts, *own).sortWithinPartitions(*own).withColumn("__at", F.monotonically_increasing_id())
    ranged = staged(ranged.withColumn("__part", F.shiftright("__at", 33).cast("int")))
    made.append(ranged)
    totals = ranged.groupBy("g", "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    inside = Window.partitionBy("g").orderBy("__part")
    bases = staged(
        totals.select(
            "g", "__part", "__first",
            F.coalesce(F.sum("__rows").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"),
            F.sum("__rows").over(Window.partitionBy("g")).alias("n"),
        )
    )
    made.append(bases)
    side = F.broadcast(bases) if bases.count() <= MOST_TOTALS else bases
    found = ranged.join(side, ["g", "__part"]).withColumn("idx", F.col("__base") + F.col("__at") - F.col("__first"))
    return found.drop("__part", "__at", "__first", "__base")


def with_run(level: DataFrame) -> DataFrame:
    """A level (g, idx, n, hash, ...) with the index up of its parent, the parent's hash, and what stands left and right in the run."""
    run = Window.partitionBy("g", "up").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    at = (F.col("idx") % FANOUT).cast("int")
    return (
        level.withColumn("up", F.expr(f"idx div {FANOUT}"))
        .withColumn("run", F.collect_list("hash").over(run))
        .withColumn("left", F.array_join(F.slice("run", F.lit(1), at), ""))
        .withColumn("right", F.array_join(F.slice("run", at + 2, F.lit(FANOUT)), ""))
        .withColumn("parent", F.sha2(F.array_join("run", ""), 256))
        .drop("run")
    )


def parents(level: DataFrame) -> DataFrame:
    """The next level: each parent once, by the first node of its run."""
    first = with_run(level).filter(F.col("idx") % FANOUT == 0)
    return first.select("g", F.col("up").alias("idx"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"), F.col("parent").alias("hash"))


def _step() -> Column:
    return F.array(F.struct("left", "right"))


def climb(leaves: DataFrame, made: list[DataFrame]) -> tuple[list[DataFrame], DataFrame]:
    """The staged levels above the leaves (g, idx, n, hash), and the roots (g, hash) of all groups."""
    levels, now = [], leaves
    roots = now.filter("n = 1").select("g", "hash")
    while now.filter("n > 1").limit(1).count():
        now = staged(parents(now.filter("n > 1")))
        made.append(now)
        levels.append(now)
        roots = roots.union(now.filter("n = 1").select("g", "hash"))
    return levels, roots


def paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(g, idx, path, subroot, root) of the lowest of the levels above the leaves; tops has these of the roots of groups, by g."""
    found = None
    for level in reversed(levels):
        top = level.filter("n = 1").select("g", "idx").join(tops, "g").select("g", "idx", "path", "subroot", "root")
        if found is not None:
            inner = with_run(level.filter("n > 1")).select("g", "idx", "up", "left", "right")
            above = found.withColumnRenamed("idx", "up")
            inner = inner.join(above, ["g", "up"]).select("g", "idx", F.concat(_step(), "path").alias("path"), "subroot", "root")
            top = top.union(inner)
        found = top
    return found


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, start, lambda acc, x: F.sha2(F.concat(x["left"], acc, x["right"]), 256))


def proof(path: Column) -> Column:
    """The siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), "")


def manifest(rows: DataFrame, order: list[str], keep: list[str]) -> DataFrame:
    """rows (g, hash, ...) with subroot, root and path, the (left, right) siblings of each level from the leaf up."""
    made: list[DataFrame] = []
    leaves = staged(placed(rows, order, made))
    drop_staged(*made)
    made = []
    levels, roots = climb(leaves.select("g", "idx", "n", "hash"), made)
    subroots = staged(roots)
    # One more tree, over the roots of the groups in the order of their keys.
    above_made: list[DataFrame] = []
    one = subroots.select(F.lit("").alias("g"), F.col("g").alias("own"), "hash")
    upper = staged(placed(one, ["own"], above_made))
    upper_levels, top = climb(upper.select("g", "idx", "n", "hash"), above_made)
    none = F.array().cast("array<struct<left:string,right:string>>")
    start = top.select("g", none.alias("path"), F.col("hash").alias("subroot"), F.col("hash").alias("root"))
    tops = upper.filter("n = 1").join(start, "g").select(F.col("own").alias("g"), "path", F.col("hash").alias("subroot"), "root")
    if upper_levels:
        above = paths(upper_levels, start).withColumnRenamed("idx", "up").drop("subroot")
        inner = with_run(upper.filter("n > 1")).join(above, ["g", "up"])
        tops = tops.union(inner.select(F.col("own").alias("g"), F.concat(_step(), "path").alias("path"), F.col("hash").alias("subroot"), "root"))
    tops = staged(tops)
    drop_staged(subroots, upper, *above_made)
    single = leaves.filter("n = 1").select("g", *keep).join(tops, "g")
    out = single.select(*keep, "path", "subroot", "root")
    if levels:
        above = staged(paths(levels, tops).withColumnRenamed("idx", "up"))
        drop_staged(*made)
        many = with_run(leaves.filter("n > 1")).join(above, ["g", "up"])
        out = out.union(many.select(*keep, F.concat(_step(), "path").alias("path"), "subroot", "root"))
    return out


def merkle_manifest(
    docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    text_col: str = "text",
) -> DataFrame:
    """doc_id, leaf, subroot, root, the path of siblings, and the leaf of the tampered row (null where it isn't tampered with)."""
    own = [F.col(c) for c in fields]
    other = [F.translate(F.col(c).cast("string"), _UPPER, _LOWER) if c == text_col else F.col(c) for c in fields]
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % TAMPERED == 0
    rows = docs.select(
        F.col(id_col).alias("doc_id"), group_key(group_col).alias("g"), leaf(own).alias("hash"), F.when(hit, leaf(other)).alias("tampered")
    )
    keep = ["doc_id", "hash", "tampered"]
    return manifest(rows, ["doc_id", "hash"], keep).withColumnRenamed("hash", "leaf")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle_manifest(table(spark, sf_dir, "documents"))
    found = found.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
