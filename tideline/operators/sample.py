"""Exact, reproducible samples of a fixed size, without a global sort.

Rows are ordered by a hash of their text and the first ``n`` are taken.  The
n-th hash is found by counting hash prefixes: each count has at most 16^4 groups
whatever the table's size, and one or two of them narrow the cut-off to a handful
of rows.  The sample is then a plain filter, so no task holds it whole.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.names import col
from tideline.functions.text import as_text, row_text

ORDER = "__order"
ORDER_DIGITS = 64
PREFIX_DIGITS = 4
# Below this many rows a prefix is resolved hash by hash.
SMALL_BUCKET = 10_000


@dataclass(frozen=True)
class Cutoff:
    """Where a sample ends in hash order.

    Rows whose order starts below or at ``prefix`` are in.  ``ties`` is set when
    ``prefix`` is one whole hash and only that many of its rows (identical ones)
    belong to the sample.  No prefix: the whole table is the sample.
    """

    prefix: str | None = None
    ties: int | None = None

    def contains(self, order: Column) -> Column:
        """Rows of the sample, all ties included."""
        if self.prefix is None:
            return F.lit(True)
        return F.substring(order, 1, len(self.prefix)) <= self.prefix

    def is_tie(self, order: Column) -> Column:
        if self.ties is None:
            return F.lit(False)
        return order == self.prefix


def hash_order(texts: Sequence[Column]) -> Column:
    """The hash rows are ordered by, 64 hexadecimal digits."""
    return F.sha2(row_text(texts), 256)


def prefix_counts(
    frame: DataFrame, prefix: str = "", digits: int = PREFIX_DIGITS, weight: Column | None = None
) -> list[tuple[str, int]]:
    """Rows (or their weights) per next ``digits`` of the order, in order."""
    within = frame.filter(F.col(ORDER).startswith(prefix)) if prefix else frame
    part = F.substring(F.col(ORDER), len(prefix) + 1, digits)
    rows = within.groupBy(part.alias("part")).agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("n")).collect()
    return sorted((r["part"], r["n"]) for r in rows)


def find_cutoff(
    frame: DataFrame,
    n: int,
    first_counts: list[tuple[str, int]] | None = None,
    small: int = SMALL_BUCKET,
    weight: Column | None = None,
) -> Cutoff:
    """The cut-off that leaves exactly ``n`` rows of ``frame`` (column ``__order``).

    With ``weight`` a row of the frame stands for that many rows.
    """
    if n <= 0:
        raise ValueError("a sample has at least one row")
    prefix, left = "", n
    counts = prefix_counts(frame, weight=weight) if first_counts is None else first_counts
    while True:
        for part, rows in counts:
            if rows >= left:
                break
            left -= rows
        else:
            return Cutoff()
        prefix += part
        if rows == left:
            return Cutoff(prefix)
        if len(prefix) == ORDER_DIGITS:
            return Cutoff(prefix, left)
        digits = ORDER_DIGITS
        if rows > small:
            # Copies of one row share their whole hash: skip what the prefix's
            # rows have in common, however many they are.
            within = frame.filter(F.col(ORDER).startswith(prefix))
            low, high = within.agg(F.min(ORDER), F.max(ORDER)).first()
            prefix = os.path.commonprefix([low, high])
            if len(prefix) == ORDER_DIGITS:
                return Cutoff(prefix, left)
            digits = PREFIX_DIGITS
        counts = prefix_counts(frame, prefix, digits, weight)


def hash_sample(
    df: DataFrame, n: int, key_columns: Sequence[str] | None = None, small: int = SMALL_BUCKET
) -> DataFrame:
    """``n`` rows without replacement, the same rows every time (all rows if fewer).

    With ``key_columns`` these are hashed first, and read to find the cut-off; rows
    that share a key are told apart by the whole row, hashed as well where the key
    does not identify one.  Without, the whole row is hashed, so rows that tie are
    copies of each other and it does not matter which of them are taken.
    """
    whole = F.sha2(F.to_json(F.struct(*[col(c) for c in df.columns])), 256)
    if key_columns:
        types = {f.name: f.dataType for f in df.schema.fields}
        order = hash_order([F.coalesce(as_text(col(k), types[k]), F.lit("")) for k in key_columns])
    else:
        order = whole
    ordered = df.withColumn(ORDER, order)
    cutoff = find_cutoff(ordered.select(ORDER), n, small=small)
    if cutoff.ties is None:
        return ordered.filter(cutoff.contains(F.col(ORDER))).drop(ORDER)
    below = ordered.filter(F.col(ORDER) < cutoff.prefix).drop(ORDER)
    if key_columns:
        # The rest comes from the rows of the last key, in the order of their whole text.
        return below.unionByName(hash_sample(ordered.filter(F.col(ORDER) == cutoff.prefix).drop(ORDER), cutoff.ties, small=small))
    # One of the tied rows, repeated as often as the sample needs it.
    tied = ordered.filter(F.col(ORDER) == cutoff.prefix).limit(1)
    places = df.sparkSession.range(cutoff.ties).select(F.lit(cutoff.prefix).alias(ORDER))
    copies = places.join(F.broadcast(tied), ORDER).select(*[col(c) for c in df.columns])
    return below.unionByName(copies)
