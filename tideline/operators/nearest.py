"""For every row that has no equal on the other side, the row there with most equal columns.

Of all targets that agree on the same columns only the smallest matters, so each set of columns and
its values has one representative.  In tables of few columns the sets are gone through from the largest
down; a Bloom filter of what the open rows have goes to the tasks, so that only targets that
it claims move.  In wider tables an inverted index comes first: a row looks up its rarest pairs of
column and value, so many that a target row beyond them could not have enough equal columns.  What is
left has few equal columns; where these still make too many sets, rows are compared with the
whole target in blocks of a few.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.names import col
from tideline.operators.appended import claimed, key_filter
from tideline.operators.reconcile import nearest_rows
from tideline.session import scratch_dir
from tideline.sinks.tables import write_table

# Target rows that one row may be compared with by the index.
MOST_LOOKUPS = 1000
# Sets of columns of one size that representatives are found for; of all sizes, where that is done without the index.
MOST_SETS = 256
# Words of the filter that goes to the tasks; what it claims in vain only moves in vain.
MOST_WORDS = 1 << 20
BLOCK_ROWS = 100
ID = "__row"


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, purpose)
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pairs(values: Sequence[Column]) -> Column:
    """A row's (column, value) pairs as hashes; equal hashes only make candidates."""
    return F.array(*[F.struct(F.lit(k).alias("place"), F.xxhash64(F.lit(k), v).alias("pair")) for k, v in enumerate(values)])


def _values(columns: Sequence[str]) -> Column:
    return F.struct(*[col(n).alias(f"v{k}") for k, n in enumerate(columns)])


def _equal(columns: Sequence[str], one: str, two: str) -> Column:
    """How many columns two structs of values have equal."""
    same = [(F.col(f"{one}.v{k}") == F.col(f"{two}.v{k}")).cast("int") for k in range(len(columns))]
    return reduce(lambda a, b: a + b, same)


def _best(candidates: DataFrame) -> DataFrame:
    """Of ``(__row, equal, target)`` the row with most equal columns, the smallest target by column text among them."""
    return candidates.groupBy(ID).agg(F.min(F.struct((-F.col("equal")).alias("less"), "target")).alias("b")).select(ID, (-F.col("b.less")).alias("equal"), "b.target")


def _by_rare_pairs(rows: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``__row, equal, target, bound``: the best that a row's rarest pairs find, exact if ``equal >= bound``."""
    m = len(columns)
    own = rows.select(ID, F.inline(_pairs([F.col(f"source.v{k}") for k in range(m)])))
    wanted = own.select("pair").distinct()
    index = target.select(F.inline(_pairs([col(n) for n in columns])), _values(columns).alias("target"))
    often = index.select("pair").join(wanted, "pair", "left_semi").groupBy("pair").agg(F.count(F.lit(1)).alias("times"))
    ranked = own.join(often, "pair", "left").withColumn("times", F.coalesce("times", F.lit(0)))
    rarest = F.sort_array(F.collect_list(F.struct("times", "place", "pair")))
    listed = ranked.groupBy(ID).agg(rarest.alias("pairs"))
    # as many of the rarest pairs as may be looked up: a target that has none of them has at most m - that many equal columns
    costs = F.transform("pairs", lambda p, i: F.aggregate(F.slice("pairs", F.lit(1), i + 1), F.lit(0).cast("long"), lambda a, x: a + x["times"]))
    looked = F.size(F.filter(costs, lambda c: c <= MOST_LOOKUPS))
    listed = listed.withColumn("looked", looked).withColumn("bound", F.lit(m + 1) - F.col("looked"))
    lookups = listed.select(ID, F.inline(F.slice("pairs", F.lit(1), F.col("looked")))).where("times > 0").select(ID, "pair")
    found = lookups.join(index.drop("place"), "pair").select(ID, "target").distinct()
    scored = found.join(rows.select(ID, "source"), ID).select(ID, _equal(columns, "source", "target").alias("equal"), "target")
    return listed.select(ID, "bound").join(_best(scored), ID, "left").select(ID, F.coalesce("equal", F.lit(0)).alias("equal"), "target", "bound")


def _by_column_sets(rows: DataFrame, target: DataFrame, columns: Sequence[str], size: int) -> DataFrame:
    """``__row, equal, target`` of rows that agree with some target on a set of ``size`` columns, given that none has more."""
    sets = list(itertools.combinations(range(len(columns)), size))

    def keys(value) -> Column:
        return F.array(*[F.struct(F.lit(s).alias("set"), F.array(*[value(k) for k in own]).alias("key")) for s, own in enumerate(sets)])

    wanted = rows.select(ID, F.inline(keys(lambda k: F.col(f"source.v{k}"))))
    offered = target.select(_values(columns).alias("target"), F.inline(keys(lambda k: col(columns[k]))))
    words = _kept(key_filter(wanted, ["set", "key"], MOST_WORDS), "filter")
    one = claimed(offered, words, ["set", "key"]).groupBy("set", "key").agg(F.min("target").alias("target"))
    return _best(wanted.join(one, ["set", "key"]).select(ID, F.lit(size).alias("equal"), "target"))


def nearest_for_all(missing: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each distinct row of ``missing`` with the target row that equals it in most columns.

    Both sides have ``columns`` as comparison text (never NULL).  Returns ``matched_columns`` and
    both rows' values (``source_<column>``, ``target_<column>``).  Of equally good target rows the smallest
    by column text wins.  Without a target row the target's values are NULL.
    """
    columns = list(columns)
    m = len(columns)
    rows = _kept(missing.select(*[col(n) for n in columns]).distinct().select(F.monotonically_increasing_id().alias(ID), _values(columns).alias("source")), "missing")
    if 2**m <= MOST_SETS:
        done, rest, size = [], rows.withColumn("most", F.lit(m)), m
    else:
        first = _kept(_by_rare_pairs(rows, target, columns), "nearest")
        done = [first.where("equal >= bound").select(ID, "equal", "target")]
        rest = _kept(rows.join(first.where("equal < bound").select(ID, (F.col("bound") - 1).alias("most")), ID), "open")
        size = rest.agg(F.max("most")).first()[0] or 0
    while size > 0 and math.comb(m, size) <= MOST_SETS and not rest.isEmpty():
        found = _kept(_by_column_sets(rest.where(F.col("most") >= size), target, columns, size), "nearest")
        done.append(found)
        rest = _kept(rest.join(found.select(ID), ID, "left_anti"), "open")
        size -= 1
    if size > 0 and not rest.isEmpty():
        done += [_in_blocks(rest, target, columns)]
    elif not done or not rest.isEmpty():
        # nothing is equal: all target rows are equally near
        smallest = target.agg(F.min(_values(columns)).alias("target"))
        done.append(rest.select(ID, F.lit(0).alias("equal")).join(F.broadcast(smallest)))
    best = reduce(DataFrame.unionByName, done)
    out = rows.join(best, ID)
    pick = lambda side: [F.col(f"{side}.v{k}").alias(f"{side}_{n}") for k, n in enumerate(columns)]
    return out.select(F.col("equal").cast("int").alias("matched_columns"), *pick("source"), *pick("target"))


def _in_blocks(rest: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows against the whole target, a few at a time: one aggregate over the target for each block, written at once."""
    spark = rest.sparkSession
    path = scratch_dir(spark, "blocks")
    names = [f"c{k}" for k in range(len(columns))]
    plain = target.select(*[col(n).alias(f"c{k}") for k, n in enumerate(columns)])
    found = F.struct(*[F.col(f"t{k}").alias(f"v{k}") for k in range(len(columns))]).alias("target")
    rows = rest.select(ID, "source").toLocalIterator()
    while block := list(itertools.islice(rows, BLOCK_ROWS)):
        numbers = spark.createDataFrame([(k + 1, r[ID]) for k, r in enumerate(block)], f"mismatch int, {ID} long")
        best = nearest_rows([dict(zip(names, r["source"])) for r in block], plain, names)
        best.join(F.broadcast(numbers), "mismatch").select(ID, F.col("matched_columns").alias("equal"), found).write.mode("append").parquet(path)
    return spark.read.parquet(path)
