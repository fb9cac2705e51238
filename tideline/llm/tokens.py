"""Token ids from a dictionary of pre-tokens, with the tokenizers library for what it lacks."""

from __future__ import annotations

import json
import os
import re
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator

import numpy as np
import tiktoken

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import tokenizers  # noqa: E402

# Latin-1's letters, digits and spaces as Unicode classes them; other characters
# are classed by the library.
LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
WHITE = "\t\n\x0b\x0c\r \x85\xa0"
CONTRACTION = "'s|'t|'re|'ve|'m|'ll|'d"
#: How the byte-level vocabularies and the word vocabulary split text before merging.
BYTE_LEVEL_TEXT = rf"{CONTRACTION}| ?\p{{L}}+| ?\p{{N}}+| ?[^\s\p{{L}}\p{{N}}]+|\s+(?!\S)|\s+"
WORD_LEVEL = re.compile(f"{CONTRACTION}|[{LETTER}]+|[{NUMBER}]|[^{WHITE}{LETTER}{NUMBER}]+")

ENTRIES = 500_000  # chunks remembered at once
LONGEST = 64  # characters of a chunk that is remembered
LONG = 2_000  # characters from which a chunk goes to the library
BLOCK = 5_000  # strings given to the library at once


def latin(text: str) -> bool:
    """Whether all characters are within Latin-1."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def without_normalizer(path: str) -> tokenizers.Tokenizer:
    """The vocabulary for text that is in its normal form already: normalising twice may change it again."""
    bare = tokenizers.Tokenizer.from_file(path)
    bare.no_truncation()
    bare.no_padding()
    bare.normalizer = None
    return bare


class Encoder(ABC):
    """Values of a text's chunks, in order, from a dictionary that grows as it meets new ones.

    Texts are split at single spaces, where both vocabularies split anyway; a chunk
    is looked up whole, and a new one is worked out once by ``fresh``.
    """

    def __init__(self, path: str):
        self.library = tokenizers.Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.cut = re.compile("(" + "|".join(sorted(map(re.escape, self.specials), key=len, reverse=True)) + ")") if self.specials else None
        self.held: dict = {}

    def encode(self, strings: list[str]) -> Iterator[tokenizers.Encoding]:
        for k in range(0, len(strings), BLOCK):
            yield from self.library.encode_batch_fast(strings[k : k + BLOCK], add_special_tokens=False)

    @abstractmethod
    def fresh(self, chunks: list[str]) -> list:
        """The values of chunks that were not met before."""

    def look_up(self, chunks: list[str]) -> list:
        held = self.held
        try:
            return [held[c] for c in chunks]
        except KeyError:
            new = [c for c in dict.fromkeys(chunks) if c not in held]
            asked = dict(zip(new, self.fresh(new)))
            out = [held[c] if c in held else asked[c] for c in chunks]
            if len(held) > ENTRIES:
                held.clear()
            held.update((c, v) for c, v in asked.items() if len(c) <= LONGEST)
            return out

    def pieces(self, text: str) -> list[str]:
        """The text cut at its special strings, which stand at the odd places."""
        return self.cut.split(text) if self.cut and "<|" in text else [text]


class Counts(Encoder):
    """How many tokens a lower-casing word vocabulary makes of a text.

    Text is brought to the vocabulary's normal form, cut at spaces, and a chunk is
    split into pre-tokens: by ``WORD_LEVEL`` within Latin-1, otherwise by the library.
    """

    def __init__(self, path: str, whole: frozenset[str]):
        super().__init__(path)
        self.normal = self.library.normalizer.normalize_str
        self.library = without_normalizer(path)
        self.whole = whole

    def pre_tokens(self, chunk: str) -> list[str]:
        if latin(chunk):
            return WORD_LEVEL.findall(chunk)
        return [chunk[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(chunk)]

    def fresh(self, chunks: list[str]) -> list[int]:
        split = [self.pre_tokens(c) for c in chunks]
        rest = list({t for found in split for t in found if t not in self.whole})
        sizes = dict(zip(rest, map(len, self.encode(rest))))
        return [sum(sizes.get(t, 1) for t in found) for found in split]

    def count(self, text: str) -> int:
        total = 0
        for k, part in enumerate(self.pieces(text)):
            if k % 2:
                total += 1
            elif part:
                plain = part.lower().replace("\n", " ") if latin(part) else self.normal(part)
                total += sum(self.look_up(plain.split(" ")))
        return total


class Ids(Encoder):
    """The ids that a byte-level vocabulary makes of a text, as little-endian unsigned 32-bit.

    Where every merge makes the id that its rank says, merging by least id is what
    the library does; a faster library that merges so then works out new chunks.
    Texts with characters beyond Latin-1 go to the library unsplit.
    """

    def __init__(self, path: str):
        super().__init__(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, back = model["vocab"], byte_characters()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        same = all(vocab[a + b] == 256 + n for n, (a, b) in enumerate(merges)) and len(vocab) == 256 + len(merges)
        ranks = {bytes(back[c] for c in t): i for t, i in vocab.items()} if same else {}
        self.fast = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_TEXT, mergeable_ranks=ranks, special_tokens={}) if same else None

    def whole(self, text: str) -> bytes:
        return np.array(next(self.encode([text])).ids, "<u4").tobytes()

    def one(self, chunk: str) -> bytes:
        if self.fast is None or len(chunk) > LONG:
            return self.whole(chunk)
        return np.array(self.fast.encode_ordinary(chunk), "<u4").tobytes()

    def fresh(self, chunks: list[str]) -> list[bytes | None]:
        # A chunk stands for itself after one space; white space at its ends could join its neighbours.
        return [self.one(" " + c) if c and c[0] not in WHITE and c[-1] not in WHITE else None for c in chunks]

    def plain(self, text: str) -> bytes:
        if not latin(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        got = self.look_up(rest)
        if None in got or first[-1:] in WHITE:
            return self.whole(text)
        return b"".join([self.one(first), *got])

    def ids(self, text: str) -> bytes:
        parts = self.pieces(text)
        if len(parts) == 1:
            return self.plain(text)
        return b"".join(np.array([self.specials[p]], "<u4").tobytes() if k % 2 else self.plain(p) for k, p in enumerate(parts))


def byte_characters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(key: tuple, make: Callable[[], Encoder]) -> Encoder:
    """One encoder a worker process keeps for all its tasks."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = make()
    return _ENCODERS[key]
