"""Exact de-duplication by distributed MSD radix partitioning.

The first digit of a text is its length and its first bytes, the next ones are
ever longer runs of the bytes that follow.  One round splits every group by one
digit; groups of one row are done, groups whose text has ended are copies.  Texts
are equal because all their digits are: no digest decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import SPACE, numbered, stage, texts

FIRST_DIGIT = 64  # bytes
DIGIT_GROWTH = 64  # each digit is so many times longer, so rounds grow with log(length)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = FIRST_DIGIT) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256``.

    Equal means identical without ASCII white space; null counts as empty, so all
    empty and null texts are one group.  Of a group the row with the most code
    points stays, then the smallest id (null ids last); exactly one row of a group
    is ``kept``.  Where ids are null or repeated, rows are numbered, and the number
    decides between rows of one id and length.  An empty table gives an empty
    result; other columns are ignored.

    A group, however large, is one row of each task in the count, and its rows
    are the skewed side of a join that Spark may split.
    """
    norm = F.translate("text", SPACE, "")
    own = texts(docs, id_col, text_col)
    if own.groupBy("id").count().where("id IS NULL OR count > 1").isEmpty():
        own = own.withColumn("row", F.lit(0).cast("long"))
    else:
        own = numbered(own, "row", "id")
    rows = own.select(
        "id",
        "row",
        F.length("text").alias("points"),
        F.sha2(norm, 256).alias("text_sha256"),
        F.octet_length(norm).alias("size"),
        F.lit(0).cast("long").alias("gid"),
        norm.cast("binary").alias("rest"),
    )
    done, at = [], 0
    while True:
        keyed = rows.withColumn("digit", F.substring("rest", 1, width))
        order = F.struct((-F.col("points")).alias("p"), F.col("id").isNull().alias("n"), F.col("id").alias("i"), F.col("row").alias("r"))
        groups = stage(
            keyed.groupBy("gid", "size", "digit")
            .agg(F.count("*").alias("group_size"), F.min(order).alias("best"), F.min("text_sha256").alias("text_sha256"))
            .select("gid", "size", "digit", "group_size", F.col("best.i").alias("keep_id"), F.col("best.r").alias("keep_row"), "text_sha256", F.monotonically_increasing_id().alias("next")),
            "digits",
        )
        done.append(groups.where("group_size = 1").select(F.col("keep_id").alias("id"), "keep_id", "group_size", F.lit(True).alias("kept"), "text_sha256"))
        split = stage(
            keyed.join(groups.where("group_size > 1").drop("text_sha256"), ["gid", "size", "digit"]).select(
                "id", "row", "points", "text_sha256", "size", F.col("next").alias("gid"), "keep_id", "group_size",
                (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("row") == F.col("keep_row"))).alias("kept"),
                F.when(F.col("size") > at + width, F.substring(F.col("rest"), width + 1, 2**31 - 1)).alias("rest"),
            ),
            "split",
        )
        done.append(split.where("rest IS NULL").select("id", "keep_id", "group_size", "kept", "text_sha256"))
        rows = split.where("rest IS NOT NULL").select("id", "row", "points", "text_sha256", "size", "gid", "rest")
        if rows.isEmpty():
            break
        at, width = at + width, width * DIGIT_GROWTH
    out = done[0]
    for x in done[1:]:
        out = out.union(x)
    return out
