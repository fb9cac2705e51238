"""URL verdicts from Bloom filter cascades that are exact over the corpus's own keys.

A key is a host suffix with a path prefix.  Level 0 of a cascade encodes the
listed keys; level 1 the keys of the corpus that wrongly pass level 0; level 2 the
listed keys that wrongly pass level 1, and so on until no error is left.  Over the
keys of the corpus membership is then exact, and a look-up needs no join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import mix

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PROBES = 24  # most probes a level uses
SLACK = 4  # false positives that are accepted per listed key; beyond, level 0 gets more bits


@dataclass(frozen=True)
class Level:
    bits: np.ndarray
    size: int
    probes: int
    seed: int

    @classmethod
    def of(cls, hashes: np.ndarray, rate: float, seed: int) -> Level:
        size = max(64, math.ceil(-len(hashes) * math.log(rate) / math.log(2) ** 2))
        probes = min(PROBES, max(1, round(size / max(1, len(hashes)) * math.log(2))))
        level = cls(np.zeros((size + 7) // 8, np.uint8), size, probes, seed)
        for at in level._places(hashes):
            np.bitwise_or.at(level.bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        return level

    def _places(self, hashes: np.ndarray):
        one = mix(hashes ^ np.uint64(self.seed * 0x9E3779B97F4A7C15 & 2**64 - 1))
        two = mix(one) | np.uint64(1)
        for i in range(self.probes):
            yield (one + np.uint64(i) * two) % np.uint64(self.size)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for at in self._places(hashes):
            out &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def has(levels: list[Level], hashes: np.ndarray) -> np.ndarray:
    """The level at which a key stops tells its side: an odd one is listed."""
    out = np.zeros(len(hashes), bool)
    live = np.arange(len(hashes))
    for n, level in enumerate(levels):
        live = live[level.has(hashes[live])]
        out[live] = n % 2 == 0
    return out


def key_hash(key: str) -> int:
    """Spark's xxhash64 of one string."""
    return xxhash.xxh64_intdigest(key.encode(), seed=42)


def host_and_path(url: str) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path of a url column; both empty without ``://``."""
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.locate("://", u)
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def candidate_keys(host: str, path: str, depths: list[int], lengths: list[int]) -> F.Column:
    """Host suffixes of as many labels as rules have, with path prefixes of the lengths that rules have, longest key first.

    No other key can be listed, so a url has as many keys as rules have shapes, however long it is.
    """
    labels = F.length(F.col(host)) - F.length(F.replace(F.col(host), F.lit("."), F.lit(""))) + 1
    suffixes = F.filter(F.array(*[F.when(labels >= n, F.substring_index(F.col(host), ".", -n)) for n in depths]), lambda h: h.isNotNull())
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(F.col(path))), lambda n: F.substring(F.col(path), F.lit(1), n)
    )
    keys = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))
    order = F.transform(keys, lambda k: F.struct((-F.length(k)).alias("n"), k.alias("k")))
    return F.transform(F.array_sort(order), lambda s: s["k"])


def build(listed: list[str], universe: DataFrame, others: list[str]) -> list[Level]:
    """A cascade for ``listed`` over ``universe (hash)``, the hashes of all keys in the corpus.

    Level 0 is sized so that about as many corpus keys pass it wrongly as are
    listed; more than ``SLACK`` times as many are never collected: then level 0 gets more bits.
    """
    own = np.unique(np.array([key_hash(k) for k in listed], np.uint64))
    if not len(own):
        return []
    total = universe.count()
    rate = min(0.5, len(own) / (math.sqrt(2) * max(total, 1)))
    limit = SLACK * len(own) + 100
    while True:
        first = Level.of(own, rate, 0)
        passes = F.pandas_udf(lambda h, level=first: pd.Series(level.has(h.to_numpy().view(np.uint64))), "boolean")
        wrong = universe.where(passes("hash")).distinct().limit(limit + len(own) + 1)
        got = np.array([r["hash"] for r in wrong.collect()], np.int64).view(np.uint64)
        bad = np.setdiff1d(np.union1d(got, np.array([key_hash(k) for k in others], np.uint64)), own)
        bad = bad[first.has(bad)]
        if len(bad) <= limit:
            break
        rate /= 16
    levels, inside, outside = [first], own, bad
    while len(outside):
        level = Level.of(outside, 0.5, len(levels))
        levels.append(level)
        inside, outside = outside, inside[level.has(inside)]
    return levels


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``id, host, path, rule, verdict`` of every row.

    ``rules`` are ``(allow or block, host/path)``; a rule fits its host and all
    subdomains where the path starts with the rule's; the longest wins.  A null url, or one without ``://``, has
    an empty host and path, no rule and the default verdict, as has a url that no
    rule fits.  Repeated rows are judged one by one; an empty table gives an empty
    result; other columns are ignored.
    """
    host, path = host_and_path("url")
    base = pages.select(pages[id_col].alias("id"), pages[url_col].cast("string").alias("url"))
    base = base.select("id", host.alias("host"), path.alias("path"))
    lengths = sorted({len(r) - r.index("/") for _, r in rules})
    depths = sorted({r[: r.index("/")].count(".") + 1 for _, r in rules})
    keyed = base.withColumn("keys", candidate_keys("host", "path", depths, lengths) if lengths else F.array().cast("array<string>"))
    keyed = keyed.withColumn("hashes", F.transform("keys", lambda k: F.xxhash64(k)))
    universe = keyed.select(F.explode("hashes").alias("hash"))
    names = [r for _, r in rules]
    cascades = {a: build([r for b, r in rules if b == a], universe, names) for a in ("allow", "block")}

    @F.pandas_udf("at int, verdict string")
    def judge(hashes: pd.Series) -> pd.DataFrame:
        sizes = np.array([len(x) for x in hashes], np.int64)
        flat = np.concatenate([*hashes, np.zeros(0, np.int64)]).astype(np.int64).view(np.uint64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at, verdict = np.full(len(sizes), 2**31 - 1), np.full(len(sizes), default, object)
        for action, levels in cascades.items():
            hit = has(levels, flat)
            first = np.full(len(sizes), 2**31 - 1)
            np.minimum.at(first, row[hit], place[hit])
            verdict[first < at] = action
            at = np.minimum(at, first)
        return pd.DataFrame({"at": np.where(at == 2**31 - 1, 0, at + 1).astype(np.int32), "verdict": verdict})

    return keyed.withColumn("j", judge("hashes")).select(
        "id", "host", "path", F.when(F.col("j.at") > 0, F.element_at("keys", F.greatest(F.col("j.at"), F.lit(1)))).alias("rule"), F.col("j.verdict").alias("verdict")
    )
