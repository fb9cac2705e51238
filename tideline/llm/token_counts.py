"""Token counts by the whole-token shortcut.

Before any text is read, the library encodes every string of the vocabulary by
itself; those that come back as one token are proven: a pre-token equal to one of
them counts one.  Only the other pre-tokens are merged, each once per task's dictionary.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import frame, texts
from tideline.llm.tokens import Counts, byte_characters, encoder, without_normalizer


def whole_tokens(path: str, end: str = "</w>") -> list[str]:
    """The vocabulary's strings that are one pre-token and encode alone as one token."""
    library = without_normalizer(path)
    back = byte_characters()
    strings = []
    for piece in library.get_vocab(with_added_tokens=False):
        if piece.endswith(end):
            raw = bytes(back[c] for c in piece.removesuffix(end) if c in back)
            strings.append(raw.decode("utf-8", "replace"))
    strings = list(dict.fromkeys(strings))
    alone = [len(library.pre_tokenizer.pre_tokenize_str(s)) == 1 for s in strings]
    counts = [len(e.ids) for e in library.encode_batch(strings, add_special_tokens=False)]
    return [s for s, one, n in zip(strings, alone, counts) if one and n == 1]


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` of every row, as the library counts the whole text.

    ``path`` is a lower-casing word vocabulary with word ends.  A null text counts
    as empty and has no tokens; a special string inside a text is the one token
    that it is by default.  Repeated rows are counted one by one, a null id stays
    null, an empty table gives an empty result, other columns are ignored.
    """
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(("count", path), lambda: Counts(path, frozenset(whole.value)))
        for pdf in batches:
            yield frame({"id": pdf["id"].astype("Int64"), "n_bytes": pdf["n_bytes"], "n_tokens": [e.count(t) for t in pdf["text"]]})

    rows = texts(docs, id_col, text_col).select("id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    return rows.mapInPandas(count, "id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
