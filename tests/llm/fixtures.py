"""Small awkward tables for the operators."""

from __future__ import annotations

import random

from pyspark.sql import types as T

CLASHES = "id text2 n th gid rest size points key word c score digit token sign node place share label host path rule block data base known".split()
SYLLABLES = "an ber cor du el fi ga hen il jo ka lu mi nor op pra qui ro sel ti um ver wa xi yo zen".split()


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)]


def documents(spark, rows, columns=("doc_id", "text"), kinds=("long", "string")):
    """A table of these rows, with further columns whose names clash with inner ones."""
    names = [c for c in CLASHES if c not in columns]
    schema = T.StructType([T.StructField(c, T.LongType() if k == "long" else T.StringType()) for c, k in zip(columns, kinds)] + [T.StructField(c, T.StringType()) for c in names])
    return spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows], schema)


def awkward(seed: int = 1) -> list[tuple]:
    """Nulls, empty and blank texts, ties, repeated rows, one very long text, copies and near copies."""
    rng = random.Random(seed)
    base = [" ".join(words(rng, rng.randint(3, 120))) for _ in range(40)]
    line = " ".join(words(rng, 30))
    near = base[3].split()
    near[len(near) // 2] = "changed"
    texts = [
        *base, base[0], base[1] + "  ", " " + base[1], base[2].replace(" ", "\n"), " ".join(near), line + "\n" + base[5], base[6] + "\n" + line, line, line,
        None, None, "", " \t\n", "a", "a b", "A B", "é ß ñ", "日本語 テキスト", "a<|endoftext|>b", "x" * 5000, " ".join(words(rng, 30_000)), "Aa " * 400, "\x1c\x85 \xa0z",
    ]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return [*rows, rows[0], rows[1], (None, base[7]), (None, None)]
