"""Exact encoding for a BPE vocabulary with word ends, as far as both the packer and the encoder need it.

The text is normalised (NFC, lower case by character) and cut into the words of the
vocabulary's pattern. A word's ids depend on nothing else, so each is encoded once.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from itertools import groupby

import regex

#: Unicode's White_Space.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _class(points: list[int]) -> str:
    """Code points as ranges of a character class."""
    runs = [[p for _, p in g] for _, g in groupby(enumerate(points), lambda x: x[1] - x[0])]
    return "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs)


def plain_pattern(pattern: str) -> re.Pattern:
    """The same pattern with the classes L, N and white space spelled out below U+10000, where ``re`` is fast."""
    kinds = [unicodedata.category(chr(p))[0] for p in range(0x10000)]
    for name, points in ((r"\p{L}", [p for p, k in enumerate(kinds) if k == "L"]), (r"\p{N}", [p for p, k in enumerate(kinds) if k == "N"]), (r"\s", _WHITE)):
        pattern = pattern.replace(name, _class(points))
    return re.compile(pattern)


class Vocabulary:
    """What the tokenizer's file says: ids, merges, the word pattern, special strings."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.merges = {tuple(m if isinstance(m, list) else m.split(" ")): k for k, m in enumerate(model["merges"])}
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.names = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.specials.items()}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.pattern, self.plain = regex.compile(split["pattern"]["Regex"]), plain_pattern(split["pattern"]["Regex"])
        # bytes that print stand for themselves, the others for the letters from U+0100 on, in order
        printing = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        rest = (b for b in range(256) if b not in printing)
        self.letter = {b: chr(b) for b in printing} | {b: chr(256 + k) for k, b in enumerate(rest)}

    def symbols(self, word: str) -> list[str]:
        """A word as letters of the byte alphabet, one for each byte."""
        return [self.letter[b] for b in word.encode("utf-8")]

    def words(self, text: str) -> list[str]:
        """The text's words, in order; a special string is one that begins with a space."""
        if self.special is None or not self.special.search(text):
            return self._split(text)
        out: list[str] = []
        for k, part in enumerate(self.special.split(text)):
            out += [" " + part] if k % 2 else self._split(part)
        return out

    def _split(self, text: str) -> list[str]:
        text = normalise(text)
        return (self.plain if text.isascii() or max(text) < "\U00010000" else self.pattern).findall(text)


def normalise(text: str) -> str:
    if text.isascii():
        return text.lower()
    # lower case by character: a final sigma is no special case, unlike in str.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Memory(dict):
    """Key -> value, filled for many keys at once; emptied, between texts, when it holds over ``most``."""

    def __init__(self, fill: Callable[[list[str]], list], most: int) -> None:
        super().__init__()
        self.fill, self.most = fill, most

    def learn(self, keys: set[str]) -> None:
        if len(self) > self.most:
            self.clear()
        new = list(keys.difference(self))
        if new:
            self.update(zip(new, self.fill(new)))


class Encoder(Memory):
    """Word -> its ids as bytes (little-endian, 32 bits), from a function that encodes new words."""

    def __init__(self, v: Vocabulary, encode_words: Callable[[list[str]], list[bytes]], most: int = 500_000) -> None:
        super().__init__(self._fill, most)
        self.v, self.encode_words = v, encode_words

    def _fill(self, words: list[str]) -> list[bytes]:
        plain = iter(self.encode_words([w for w in words if w[0] != " "]))
        return [next(plain) if w[0] != " " else self.v.specials[w[1:]].to_bytes(4, "little") for w in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.v.words(t) for t in texts]
        self.learn(set().union(*split))
        return [b"".join(map(self.__getitem__, s)) for s in split]
