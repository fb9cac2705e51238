"""Keys checked across loads: a table grows by batches, and old keys are read only where a filter says they may clash.

Each batch keeps a Bloom filter of its keys beside the table.  A filter is a table, too: one row
for each 64-bit word, and a key's bits lie in one word, so testing new keys is one
join that moves the new keys and the filters' words, never the old keys.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.names import col, resolve
from tideline.operators.constraints import primary_key_violations
from tideline.session import scratch_dir
from tideline.sinks.tables import write_table
from tideline.sources.many import path_exists

BATCH, SIZE, WORD = "__batch", "__size", "__word"
KEPT_KEY = "kept_key"
# Words for so many keys each, and bits that a key sets in its word: about one new key in 40 is looked up in vain.
KEYS_PER_WORD, KEY_BITS = 5, 4
LEAST_WORDS = 1 << 10


def _filters(path: str) -> str:
    return f"{path.rstrip('/')}__filters"


def _word(keys: Sequence[Column], size: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("word"), *keys), size)


def _bits(keys: Sequence[Column]) -> Column:
    h = F.xxhash64(F.lit("bits"), *keys)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * k).bitwiseAND(63).cast("int")) for k in range(KEY_BITS)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def key_filter(df: DataFrame, keys: Sequence[str], most_words: int | None = None) -> DataFrame:
    """The filter's words: ``__size`` (how many there may be), ``__word`` and ``bits``; keys with a NULL are left out.

    With ``most_words``, a power of two, it grows no further and claims more keys in vain.
    """
    names = [col(k) for k in keys]
    distinct = df.select(*names).dropna().distinct()
    rows, size = df.count(), LEAST_WORDS
    while size * KEYS_PER_WORD < rows and (most_words is None or size < most_words):
        size *= 2
    word = _word(names, F.lit(size)).alias(WORD)
    return distinct.select(word, _bits(names).alias("b")).groupBy(WORD).agg(F.bit_or("b").alias("bits")).select(F.lit(size).cast("long").alias(SIZE), WORD, "bits")


def claimed(df: DataFrame, words: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys the filter claims: all that it has, and a few that it has not.  Its words go to every task, the rows stay."""
    first = words.first()
    if first is None:
        return df.limit(0)
    names = [col(k) for k in keys]
    sent = F.broadcast(words.select(WORD, F.col("bits").alias("__claims")))
    hit = df.withColumn(WORD, _word(names, F.lit(first[SIZE]))).withColumn("__bits", _bits(names)).join(sent, WORD)
    return hit.where(F.col("__claims").bitwiseAND(F.col("__bits")) == F.col("__bits")).select(*[col(c) for c in df.columns])


def possible_clashes(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """New keys that some batch's filter claims, with the batch: all that clash, and a few that do not."""
    filters = spark.read.schema(f"{SIZE} long, {WORD} long, bits long, {BATCH} string").parquet(_filters(path))
    sizes = sorted(r[SIZE] for r in filters.select(SIZE).distinct().collect())  # powers of two: a few dozen at most
    names = [col(k) for k in keys]
    asked = df.select(*names).dropna().distinct().withColumn("__bits", _bits(names))
    asked = asked.withColumn(SIZE, F.explode(F.array(*[F.lit(s).cast("long") for s in sizes]))).withColumn(WORD, _word(names, F.col(SIZE)))
    hit = asked.join(filters, [SIZE, WORD]).where(F.col("bits").bitwiseAND(F.col("__bits")) == F.col("__bits"))
    return hit.select(*names, BATCH)


def appended_key_violations(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Keys of a new batch that are NULL in part, occur twice in it, or are in the table already.

    ``n_rows`` counts the batch's rows.  Only batches with possible clashes are read, and of these only the keys.
    """
    keys = resolve(keys, df.columns, "primary key columns")
    own = primary_key_violations(df, keys)
    if not path_exists(spark, _filters(path)):
        return own
    staged = scratch_dir(spark, "clashes")
    write_table(possible_clashes(spark, df, path, keys), staged)
    clashes = spark.read.schema(T.StructType([*[df.schema[k] for k in keys], T.StructField(BATCH, T.StringType())])).parquet(staged)
    batches = [r[0] for r in clashes.select(BATCH).distinct().collect()]
    if not batches:
        return own
    names = [col(k) for k in keys]
    old = read_batches(spark, path).where(F.col(BATCH).isin(*batches)).select(*names)
    known = old.join(clashes.select(*names).distinct(), keys, "left_semi").distinct()
    counted = df.join(known, keys, "left_semi").groupBy(*names).agg(F.count(F.lit(1)).alias("n_rows"))
    both = own.unionByName(counted.withColumn("violation", F.lit(KEPT_KEY)))
    # a key that clashes with the table counts as that, also where it is repeated in the batch
    worst = F.when(F.max((F.col("violation") == KEPT_KEY).cast("int")) == 1, F.lit(KEPT_KEY)).otherwise(F.max("violation"))
    return both.groupBy(*names).agg(F.max("n_rows").alias("n_rows"), worst.alias("violation"))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The table with each row's batch, whose name stays text."""
    fields = [f for f in spark.read.parquet(path).schema if f.name != BATCH]
    return spark.read.schema(T.StructType([*fields, T.StructField(BATCH, T.StringType())])).parquet(path)


def append_batch(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str], batch: str) -> int:
    """Append a batch under a name of its own; repeated after a failure it replaces what is there.

    The filter is written first: without its rows it costs lookups in vain, while rows without
    a filter would not be found.
    """
    keys = resolve(keys, df.columns, "primary key columns")
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"a batch's name is part of a path, got {batch!r}")
    write_table(key_filter(df, keys), f"{_filters(path)}/{BATCH}={batch}")
    return write_table(df, f"{path.rstrip('/')}/{BATCH}={batch}")
