"""Language-model scores from a subword lattice.

A word's probability is the sum over all ways to spell it with the pieces of an
existing vocabulary, by a forward recursion in log space; a text's is the product
over its words, since no piece crosses one.  The vocabulary's own
scores (ranks) start the piece weights, and the training texts re-estimate them by
expected counts over all segmentations of their words.

A second score mixes the lattice with what was seen: words of the training texts are arcs of
their own, discounted, and what the discount leaves goes to the pieces; words that the
document already holds are arcs too: after ``t`` words one that occurred ``k`` times
has ``(k + CACHE * p) / (t + CACHE)``, whatever the order.

Counts of words grow with the corpus and stay distributed.  Words above a fixed
share of it, whose number that share bounds, go to every task; the rest is joined.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from functools import cached_property

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import DISTINCT_WORDS, frame, stage, summed_blocks, words

HOT_SHARE = 1_000_000  # words are sent to the tasks that make up at least one in so many tokens
PRIOR = 1000.0  # expected pieces that the vocabulary's own scores count for
BYTE_SHARE = 1e-4  # of the starting weight that single bytes share
PLAIN_CHARS = 64  # longest word, its start included, that is summed in plain numbers
PLAIN_LEAST = 1e-250  # and the least probability that these are trusted with
CACHE = 1000.0  # words of a document after which its own shares weigh half
START = "▁"  # how the vocabulary marks the start of a word
LN10 = math.log(10)


class Lattice:
    """Pieces with log weights; bytes spell what no piece covers."""

    def __init__(self, path: str, weights: np.ndarray | None = None):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        usable = [i for i in range(self.size) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)) and model.get_score(i) > -1e8]
        self.bytes = {int(model.id_to_piece(i)[1:-1], 16): i for i in range(self.size) if model.is_byte(i)}
        if weights is None:
            best = max(model.get_score(i) for i in usable)
            weights = np.zeros(self.size)
            for i in usable:
                weights[i] = 1 / (1 + best - model.get_score(i))
            weights *= (1 - BYTE_SHARE) / weights.sum()
            for i in self.bytes.values():
                weights[i] = BYTE_SHARE / len(self.bytes)
        self.weights = weights
        self.log = np.log(np.maximum(weights, 1e-300)).tolist()
        # every prefix of a piece, with the piece's number where it is one
        self.trie: dict[str, int] = {}
        for i in usable:
            piece = model.id_to_piece(i)
            for n in range(1, len(piece)):
                self.trie.setdefault(piece[:n], -1)
            self.trie[piece] = i
        self.spelt: dict[str, tuple[int, ...]] = {}

    def spelling(self, char: str) -> tuple[int, ...]:
        """The byte pieces of a character."""
        got = self.spelt.get(char)
        if got is None:
            got = self.spelt[char] = tuple(self.bytes[b] for b in char.encode("utf-8", "replace"))
        return got

    def arcs(self, text: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """From every place: where an arc ends, its log weight, its pieces; bytes where no piece is that character."""
        trie, log, n, out = self.trie, self.log, len(text), []
        for i in range(n):
            own = []
            for j in range(i + 1, n + 1):
                piece = trie.get(text[i:j])
                if piece is None:
                    break
                if piece >= 0:
                    own.append((j, log[piece], (piece,)))
            if trie.get(text[i], -1) < 0:
                spelt = self.spelling(text[i])
                own.append((i + 1, sum(log[b] for b in spelt), spelt))
            out.append(own)
        return out

    @staticmethod
    def _forward(arcs: list) -> list[float]:
        exp, log1p = math.exp, math.log1p
        alpha = [-math.inf] * (len(arcs) + 1)
        alpha[0] = 0.0
        for i, own in enumerate(arcs):
            here = alpha[i]
            for j, weight, _ in own:
                a, b = alpha[j], here + weight
                if b > a:
                    a, b = b, a
                alpha[j] = a if b < a - 40 else a + log1p(exp(b - a))
        return alpha

    def log_probability(self, word: str) -> float:
        """Natural log of the word's probability over all segmentations."""
        return self._forward(self.arcs(START + word))[-1]

    def expect(self, word: str, counts: list[float], times: float = 1.0) -> None:
        """Add each piece's expected number in ``times`` such words; in logs only where plain numbers would vanish."""
        arcs = self.arcs(START + word)
        if len(arcs) <= PLAIN_CHARS and self._expect_plain(arcs, counts, times):
            return
        alpha = self._forward(arcs)
        exp, log1p = math.exp, math.log1p
        beta = [-math.inf] * len(arcs) + [0.0]
        total = alpha[-1]
        for i in range(len(arcs) - 1, -1, -1):
            best = -math.inf
            for j, weight, pieces in arcs[i]:
                a, b = best, weight + beta[j]
                share = alpha[i] + b - total
                if share > -20:
                    for p in pieces:
                        counts[p] += times * exp(share)
                if b > a:
                    a, b = b, a
                best = a if b < a - 40 else a + log1p(exp(b - a))
            beta[i] = best

    @staticmethod
    def _expect_plain(arcs: list, counts: list[float], times: float) -> bool:
        n, exp = len(arcs), math.exp
        plain = [[(j, exp(weight), pieces) for j, weight, pieces in own] for own in arcs]
        alpha, beta = [1.0] + [0.0] * n, [0.0] * n + [1.0]
        for i, own in enumerate(plain):
            here = alpha[i]
            for j, weight, _ in own:
                alpha[j] += here * weight
        total = alpha[n]
        if total < PLAIN_LEAST:
            return False
        for i in range(n - 1, -1, -1):
            here, all_on = times * alpha[i] / total, 0.0
            for j, weight, pieces in plain[i]:
                on = weight * beta[j]
                all_on += on
                for p in pieces:
                    counts[p] += here * on
            beta[i] = all_on
        return True

    @cached_property
    def _steps(self) -> tuple[pd.Index, np.ndarray]:
        """The trie as a table: prefix ``k`` is reached by ``keys[k - 1]``, the number of the prefix before and a character."""
        number = {prefix: k for k, prefix in enumerate(self.trie, 1)} | {"": 0}
        keys = np.fromiter((number[prefix[:-1]] << 21 | ord(prefix[-1]) for prefix in self.trie), np.int64, len(self.trie))
        return pd.Index(keys), np.fromiter(self.trie.values(), np.int64, len(self.trie))

    def _arcs_of(self, found: Sequence[str]) -> tuple[np.ndarray, ...]:
        """All words' arcs by where they start: word, start, end, weight, piece (below -1: a character of ``chars``)."""
        index, piece_of = self._steps
        size = np.fromiter(map(len, found), np.int64, len(found)) + 1
        codes = np.frombuffer((START + START.join(found)).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        ends = np.cumsum(size)
        word = np.repeat(np.arange(len(found)), size)
        at = np.arange(len(codes))
        place = at - np.repeat(ends - size, size)
        left, node = np.repeat(ends, size), np.zeros(len(codes), np.int64)
        out, steps, whole = [], 0, at
        spelt = np.zeros(len(codes), bool)
        while len(at):
            node = index.get_indexer(node << 21 | codes[at + steps]) + 1
            steps += 1
            piece = np.where(node > 0, piece_of[node - 1], -1)
            hit = piece >= 0
            if steps == 1:
                spelt[at[~hit]] = True
            out.append((at[hit], np.full(np.count_nonzero(hit), steps), piece[hit]))
            on = (node > 0) & (at + steps < left[at])
            at, node = at[on], node[on]
        by_bytes = whole[spelt]
        chars, which = np.unique(codes[by_bytes], return_inverse=True)
        out.append((by_bytes, np.ones(len(by_bytes), np.int64), -2 - which))
        at, steps, piece = map(np.concatenate, zip(*out))
        one = np.array([math.prod(float(np.exp(self.log[b])) for b in self.spelling(chr(c))) for c in chars.tolist()], float)
        plain = np.exp(np.array(self.log))
        weight = np.concatenate([plain[piece[: len(piece) - len(which)]], one[which]])
        order = np.argsort(place[at], kind="stable")
        at, steps, piece, weight = at[order], steps[order], piece[order], weight[order]
        return word[at], place[at], place[at] + steps, weight, piece, size, chars

    def _sums(self, found: Sequence[str]) -> tuple:
        """Forward sums of many words at once, in plain numbers, and their arcs, which are cut where the start changes."""
        word, start, end, weight, piece, size, chars = self._arcs_of(found)
        width = int(size.max()) + 1
        source, target = word * width + start, word * width + end
        cuts = np.searchsorted(start, np.arange(width))
        alpha = np.zeros(len(found) * width)
        alpha[::width] = 1.0
        for a, b in zip(cuts, cuts[1:]):
            np.add.at(alpha, target[a:b], alpha[source[a:b]] * weight[a:b])
        last = np.arange(len(found)) * width + size
        return alpha, last, source, target, cuts, weight, piece, chars, word

    def log_probabilities(self, found: Sequence[str]) -> np.ndarray:
        """``log_probability`` of every word; one by one only where plain numbers would vanish."""
        out = np.full(len(found), -math.inf)
        short = [k for k, w in enumerate(found) if len(w) < PLAIN_CHARS]
        if short:
            alpha, last, *_ = self._sums([found[k] for k in short])
            total = alpha[last]
            out[short] = np.log(total, where=total >= PLAIN_LEAST, out=np.full(len(short), -math.inf))
        for k in np.flatnonzero(out == -math.inf).tolist():
            out[k] = self.log_probability(found[k])
        return out

    def expect_all(self, found: Sequence[str], times: np.ndarray) -> np.ndarray:
        """Each piece's expected number in the words, each so many ``times``."""
        counts, done = np.zeros(self.size), np.zeros(len(found), bool)
        short = np.array([k for k, w in enumerate(found) if len(w) < PLAIN_CHARS], np.int64)
        if len(short):
            alpha, last, source, target, cuts, weight, piece, chars, word = self._sums([found[k] for k in short.tolist()])
            total = alpha[last]
            done[short] = total >= PLAIN_LEAST
            share = np.where(done[short], times[short], 0) / np.where(done[short], total, 1)
            beta = np.zeros(len(alpha))
            beta[last] = 1.0
            seen = np.zeros(len(source))
            for a, b in zip(cuts[-2::-1], cuts[:0:-1]):
                on = weight[a:b] * beta[target[a:b]]
                np.add.at(beta, source[a:b], on)
                seen[a:b] = on * alpha[source[a:b]] * share[word[a:b]]
            own = piece >= 0
            counts += np.bincount(piece[own], seen[own], self.size)
            for c, n in zip(chars.tolist(), np.bincount(-2 - piece[~own], seen[~own], len(chars)).tolist()):
                for b in self.spelling(chr(c)):
                    counts[b] += n
        rest = counts.tolist()
        for k in np.flatnonzero(~done).tolist():
            self.expect(found[k], rest, float(times[k]))
        return np.array(rest)


def count_words(rows: DataFrame) -> DataFrame:
    """``word, c`` of ``rows (text, train)``: every word, and how often it is in training texts."""

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()

        def told() -> pd.DataFrame:
            out = frame({"word": [w.decode() for w in counts], "c": np.fromiter(counts.values(), np.int64, len(counts))})
            counts.clear()
            return out

        for pdf in batches:
            for text, train in zip(pdf["text"], pdf["train"]):
                found = words(text)
                counts.update(found if train else dict.fromkeys(found, 0))
                if len(counts) > DISTINCT_WORDS:
                    yield told()
        if counts:
            yield told()

    return rows.select("text", "train").mapInPandas(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def learn_pieces(counts: DataFrame, path: str) -> np.ndarray:
    """Piece weights from one round of expected counts over the training words, each word as often as it occurs."""
    size = Lattice(path).size

    def expect(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice, total = Lattice(path), np.zeros(size)
        for pdf in batches:
            total += lattice.expect_all(pdf["word"].tolist(), pdf["c"].to_numpy(float))
        yield frame({"block": [0], "data": [total.tobytes()]})

    got = summed_blocks(counts.where("c > 0").select("word", "c").mapInPandas(expect, "block int, data binary"), size, "float64")
    start = Lattice(path).weights
    return (got + PRIOR * start) / (got.sum() + PRIOR)


def score_texts(docs: DataFrame, train: Column, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, n_known, train_tokens, base_score, score, mixed_score`` of every row; logs are to base 10.

    Tokens are lower-case (A-Z) words between ASCII white space and one end.  The
    model learns from the rows where ``train`` holds.  ``score`` is the lattice's
    marginal probability of the text, ``mixed_score`` that of the lattice mixed with
    known words and the document's own, ``base_score`` that of the
    tokens' smoothed shares in the training texts.  A null or empty text is its end
    alone.  With no training row every token is unknown and words are spelt by the
    vocabulary's own weights.  Repeated rows are scored one by one, a null id stays
    null, an empty table gives an empty result, other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    counts = stage(count_words(rows), "words")
    n_docs = rows.where("train").count()
    sums = counts.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v"), F.count_if(F.col("c") == 1).alias("one"), F.count_if(F.col("c") == 2).alias("two")).first()
    total, kinds = (sums["n"] or 0) + n_docs, sums["v"] + (n_docs > 0)
    discount = min(0.95, max(0.05, sums["one"] / max(1, sums["one"] + 2 * sums["two"])))
    mass = (sums["n"] or 0) + 0.5  # of the words; the end has its own share
    spare = math.log((discount * sums["v"] + 0.5) / mass)
    weights = spark.sparkContext.broadcast(learn_pieces(counts, path))

    def spell(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(path, weights.value)
        for pdf in batches:
            marginal = lattice.log_probabilities(pdf["word"].tolist())
            c, spelt = pdf["c"].to_numpy(), marginal + spare
            own = np.log(np.maximum(c - discount, 1e-300) / mass)
            yield pdf.assign(score=marginal / LN10, mixed=np.where(c > 0, np.logaddexp(own, spelt), spelt) / LN10)

    def base(c):
        return np.log10((c + 0.1) / (total + 0.1 * (kinds + 1)))

    scored = stage(counts.mapInPandas(spell, "word string, c long, score double, mixed double"), "scored")
    hot_c = max(1, -(-total // HOT_SHARE))
    hot = scored.where(F.col("c") >= hot_c) if total else scored.where("false")
    known = spark.sparkContext.broadcast({r["word"].encode(): (float(base(r["c"])), r["score"], r["mixed"]) for r in hot.toLocalIterator()})
    p_end = (n_docs + 0.5) / (total + 1)
    end_base, end_score, go_on = float(base(n_docs)), math.log10(p_end), math.log10(1 - p_end)

    def look_up(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get, lgamma = known.value.get, math.lgamma
        for pdf in batches:
            docs_out, key_out, word_out, tf_out = [], [], [], []
            for key, i, text in zip(pdf["key"], pdf["id"], pdf["text"]):
                found = Counter(words(text))
                n, here, b, s, m = sum(found.values()), 0, end_base, 0.0, 0.0
                for w, tf in found.items():
                    got = get(w)
                    if got is None:
                        key_out.append(key)
                        word_out.append(w.decode())
                        tf_out.append(tf)
                    else:
                        here += tf
                        b += tf * got[0]
                        s += tf * got[1]
                        p = CACHE * 10 ** got[2]
                        m += math.log(p) if tf == 1 else lgamma(p + tf) - lgamma(p)
                ends = n * go_on + end_score
                m = (m - lgamma(n + CACHE) + lgamma(CACHE)) / LN10
                docs_out.append((key, i, None, n + 1, here + (n_docs > 0), b, s + ends, m + ends))
            columns = ["key", "id", "word", "n", "known", "base", "score", "mixed"]
            yield pd.DataFrame(docs_out, columns=columns).astype({"id": "Int64"})
            if key_out:
                yield frame({"key": key_out, "id": pd.array([None] * len(key_out), "Int64"), "word": word_out, "n": tf_out, "known": 0, "base": 0.0, "score": 0.0, "mixed": 0.0})

    keyed = rows.select(F.monotonically_increasing_id().alias("key"), "id", "text")
    found = stage(keyed.mapInPandas(look_up, "key long, id long, word string, n long, known long, base double, score double, mixed double"), "found")
    rare = found.where("word IS NOT NULL").select("key", "word", "n").join(scored.where(F.col("c") < hot_c if total else F.lit(True)), "word")
    p = F.lit(CACHE) * F.pow(F.lit(10.0), "mixed")
    again = F.aggregate(F.sequence(F.lit(1), F.greatest(F.col("n") - 1, F.lit(1))), F.lit(0.0), lambda x, k: x + F.log10(k + p))
    cached = F.col("mixed") + math.log10(CACHE) + F.when(F.col("n") > 1, again).otherwise(0.0)
    shares = F.log10((F.col("c") + 0.1) / F.lit(total + 0.1 * (kinds + 1)))
    rare = rare.select(
        "key", F.lit(None).cast("long").alias("id"), F.lit(0).cast("long").alias("n"), F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("known"),
        (F.col("n") * shares).alias("base"), (F.col("n") * F.col("score")).alias("score"), cached.alias("mixed"),
    )
    return (
        found.where("word IS NULL").select("key", "id", "n", "known", "base", "score", "mixed").union(rare).groupBy("key")
        .agg(F.max("id").alias("id"), F.sum("n").alias("n_tokens"), F.sum("known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("score").alias("score"), F.sum("mixed").alias("mixed_score"))
        .select("id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score", "mixed_score")
    )
