"""Exact differences of two tables by a hash tree: digests of hashed buckets, compared from the root down.

A bucket's digest is the sum of its rows' hashes, so it depends neither on the rows'
order nor on how they are partitioned, and copies count.  Where two sides agree on a
node, all below it is equal; only rows of buckets that differ are moved and compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.names import SYSTEM_COLUMNS, align, col
from tideline.functions.text import compare_text
from tideline.operators.sample import ORDER, hash_order
from tideline.session import scratch_dir
from tideline.sinks.tables import write_table

# Hexadecimal digits of a bucket's name; each level of the tree adds LEVEL_DIGITS.
DIGITS, LEVEL_DIGITS = 4, 2
MOST_DIGITS = 8
# A row's hash is summed in parts of 32 bits, so that sums of 2^31 rows fit 64 bits.
PARTS, PART_DIGITS = 4, 8
# Names of differing buckets that may be sent to every task; more are joined by a shuffle.
BROADCAST_BUCKETS = 200_000
SIDES = ("source_copies", "target_copies")


def comparable(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Comparison text of the paired columns, under the second names, and the row's hash."""
    types = {f.name: f.dataType for f in df.schema.fields}
    texts = df.select(*[compare_text(col(name), types[name]).alias(alias) for name, alias in pairs])
    return texts.withColumn(ORDER, hash_order([col(alias) for _, alias in pairs]))


def _part(k: int) -> Column:
    # the bucket's name is the hash's beginning, so the parts are taken from its end
    return F.conv(F.substring(ORDER, 64 - PART_DIGITS * (k + 1) + 1, PART_DIGITS), 16, 10).cast("long")


def tree_of(rows: DataFrame, digits: int = DIGITS) -> DataFrame:
    """``level, bucket, n, d0 .. d3`` of all nodes of ``rows (__order, ...)``; level 0 is the root.

    The leaves come from one pass that combines before its shuffle; there are at most
    ``16 ** digits`` of them, and inner nodes are sums of theirs.
    """
    if not 0 < digits <= MOST_DIGITS or digits % LEVEL_DIGITS:
        raise ValueError(f"digits must be a multiple of {LEVEL_DIGITS} up to {MOST_DIGITS}, got {digits}")
    sums = [F.sum(F.col(f"d{k}").cast("decimal(38,0)")).alias(f"d{k}") for k in range(PARTS)]
    leaves = rows.groupBy(F.substring(ORDER, 1, digits).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(_part(k)).cast("decimal(38,0)").alias(f"d{k}") for k in range(PARTS)]
    )
    depth = digits // LEVEL_DIGITS
    above = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level")
    nodes = leaves.select(above, F.col("bucket").alias("leaf"), "n", *[f"d{k}" for k in range(PARTS)])
    bucket = F.expr(f"substring(leaf, 1, level * {LEVEL_DIGITS})").alias("bucket")
    return nodes.groupBy("level", bucket).agg(F.sum("n").alias("n"), *sums)


def write_tree(rows: DataFrame, path: str, digits: int = DIGITS) -> None:
    """Keep a tree beside its table, by level: an unchanged table is not read again to be compared."""
    write_table(tree_of(rows, digits), path, partition_by=["level"])


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def differing_buckets(one: DataFrame, two: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Leaves (``bucket``) on which two trees differ, found from the root down.

    A level is read only for children of nodes that differ; equal tables end at the root.
    """
    names = ["n", *[f"d{k}" for k in range(PARTS)]]
    above: DataFrame | None = None
    for level in range(digits // LEVEL_DIGITS + 1):
        sides = [t.where(F.col("level") == level).select("bucket", *[F.col(n).alias(f"{s}{n}") for n in names]) for t, s in ((one, "a"), (two, "b"))]
        if above is not None:
            parent = F.substring("bucket", 1, (level - 1) * LEVEL_DIGITS)
            sides = [s.withColumn("parent", parent).join(above, "parent", "left_semi").drop("parent") for s in sides]
        same = reduce(lambda x, y: x & y, [F.col(f"a{n}").eqNullSafe(F.col(f"b{n}")) for n in names])
        found = sides[0].join(sides[1], "bucket", "full").where(~same).select("bucket")
        if level < digits // LEVEL_DIGITS:
            if found.isEmpty():
                return found.limit(0)
            above = found.select(F.col("bucket").alias("parent"))
    return found


def table_differences(
    source: DataFrame, target: DataFrame, exclude: Sequence[str] = SYSTEM_COLUMNS, digits: int = DIGITS,
    source_tree: DataFrame | None = None, target_tree: DataFrame | None = None,
) -> DataFrame:
    """Every row that one side has more often than the other: its values as text and its copies on both sides.

    Columns are those both sides have, by name ignoring case; values are compared as stripped text,
    NULL equal to empty.  Trees that were kept are used as they are: they must be of the same
    columns and as deep.  Rows of equal buckets are neither moved nor grouped.
    """
    pairs = align(source.columns, target.columns, exclude)
    if not pairs:
        raise ValueError("the two sides share no column to compare")
    names = [s for s, _ in pairs]
    left = comparable(source, [(s, s) for s, _ in pairs])
    right = comparable(target, [(t, s) for s, t in pairs])
    trees = [tree if tree is not None else tree_of(side, digits) for tree, side in ((source_tree, left), (target_tree, right))]
    buckets = differing_buckets(*trees, digits)
    # How many differ is known only by comparing, which is done once.
    path = scratch_dir(source.sparkSession, "buckets")
    count = write_table(buckets, path)
    buckets = source.sparkSession.read.schema("bucket string").parquet(path)
    if count <= BROADCAST_BUCKETS:
        buckets = F.broadcast(buckets)

    def inside(side: DataFrame, own: int) -> DataFrame:
        rows = side.withColumn("bucket", F.substring(ORDER, 1, digits)).join(buckets, "bucket", "left_semi")
        return rows.select(ORDER, *[col(n) for n in names], *[F.lit(int(k == own)).alias(s) for k, s in enumerate(SIDES)])

    both = inside(left, 0).unionAll(inside(right, 1))
    copies = both.groupBy(ORDER, *[col(n) for n in names]).agg(*[F.sum(s).alias(s) for s in SIDES])
    return copies.where(F.col(SIDES[0]) != F.col(SIDES[1])).drop(ORDER)
