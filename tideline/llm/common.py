"""What the operators share: input columns, written stages, splitting, connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.session import configure, remove_path, scratch_dir

# The ASCII white space that all operators split and trim by.
SPACE = " \t\n\x0b\x0c\r"
# The same on bytes, where str.split() would also split at other Unicode spaces:
# bytes.split() and bytes.lower() know exactly these and A-Z.

BATCH_ROWS = 1_000
BATCH_BYTES = 8 << 20
DISTINCT_WORDS = 200_000  # words a task keeps in one dictionary before it starts a new one


def tuned(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, and fewer rows and bytes in each batch that goes to Python: texts and shards are long."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: later steps start from the files."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete a stage's files, once what is read from them has been written."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove_path(df.sparkSession, folder)


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``id`` and ``text`` (null: empty), whatever else the table holds."""
    return df.select(df[id_col].cast("long").alias("id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"))


def numbered(df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with a number of its own as ``key``, in the order of ids (null ids last), written to the shared folder."""
    place = F.monotonically_increasing_id()
    ordered = df.withColumn(key, place).orderBy(F.col(id_col).asc_nulls_last(), F.xxhash64(text_col), key)
    return stage(ordered.withColumn(key, place), "numbered")


def words(text: str) -> list[bytes]:
    """Lower-case (A-Z) words between ASCII white space, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def frame(columns: dict[str, object]) -> pd.DataFrame:
    return pd.DataFrame(columns, copy=False)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over an array."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def summed_blocks(parts: DataFrame, size: int, dtype: str, combine: np.ufunc = np.add) -> np.ndarray:
    """Combine dense arrays that tasks send in blocks (``block``, ``data``); the length is fixed beforehand."""

    def add_some(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for pdf in batches:
            for b, x in zip(pdf["block"], pdf["data"]):
                got = np.frombuffer(x, dtype)
                if b in sums:
                    combine(sums[b], got, out=sums[b])
                else:
                    sums[b] = got.copy()
        if sums:
            yield frame({"block": list(sums), "data": [x.tobytes() for x in sums.values()]})

    rows = parts.repartition(16, "block").mapInPandas(add_some, "block int, data binary").collect()
    out = np.zeros(size, dtype)
    for r in rows:
        got = np.frombuffer(r["data"], dtype)
        out[r["block"] * len(got) : (r["block"] + 1) * len(got)] = got
    return out


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``; root is the smallest node it reaches.

    Alternating large-star and small-star steps; each round is written to the
    shared folder, and a hot node's neighbours are combined before the shuffle.
    """
    edges = stage(
        links.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u < v").distinct(), "links"
    )
    while True:
        # large star: each node links its larger neighbours to its smallest one
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("m").alias("u"), "v").where("u < v").distinct()
        # small star: each node links its smaller neighbours, and itself, to the smallest
        low2 = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (
            large.join(low2, "v")
            .select(F.explode(F.array(F.struct(F.col("m").alias("u"), F.col("u").alias("v")), F.struct(F.col("m").alias("u"), F.col("v")))).alias("e"))
            .select("e.*").where("u < v").distinct()
        )
        after = stage(small, "stars")
        # converged when every node has one link and no root is itself linked below
        deep = after.join(after.select(F.col("v").alias("u")).distinct(), "u", "left_semi").limit(1).count()
        multi = after.groupBy("v").count().where("count > 1").limit(1).count()
        edges = after
        if not deep and not multi:
            break
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
        edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    )
