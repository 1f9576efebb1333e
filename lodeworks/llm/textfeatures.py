"""Sparse hashed features of whole texts, and fast scores of them under a linear model."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from math import log1p, log2
from zlib import crc32

import numpy as np

_WORDS = re.compile(r"[^\W\d_]+")
_MARKS = re.compile(r"[^\w\s]+|_+|\d+")


@dataclass(frozen=True)
class TextFeatures:
    """Words, and with ``style`` also runs of marks, capitals and statistics of the text.

    The value of a word or mark is log(1 + times), of a statistic 1 at its bucket. Ids are
    CRC-32 cut to ``bits`` bits.
    """

    style: bool = False
    bits: int = 22

    def _id(self, name: str) -> int:
        return crc32(name.encode("utf-8", "replace")) & ((1 << self.bits) - 1)

    def _of_chunk(self, chunk: str) -> tuple[int, ...]:
        """Features of what stands between two white spaces."""
        found = [self._id(w) for w in _WORDS.findall(chunk.lower())]
        if self.style:
            found += [self._id(f"mark {m}" if not m[0].isdigit() else "mark 0") for m in _MARKS.findall(chunk)]
            if len(chunk) > 3 and chunk.isupper():
                found.append(self._id("capitals"))
        return tuple(found)

    def _of_text(self, text: str, chunks: list[str], distinct: int) -> list[int]:
        if not self.style:
            return []
        n, lines = max(1, len(chunks)), text.split("\n")
        stats = {
            "distinct": 10 * distinct // n, "capitals": 10 * sum(map(str.isupper, chunks)) // n, "letters": 10 * sum(map(str.isalpha, chunks)) // n,
            "length": min(12, len(text) // n), "lines": 10 * len(set(lines)) // len(lines), "words": int(log2(n)),
        }
        return [self._id(f"{k} = {v}") for k, v in stats.items()]

    def of(self, text: str) -> dict[int, float]:
        chunks = text.split()
        counts, times = Counter(chunks), Counter()
        for chunk, n in counts.items():
            for f in self._of_chunk(chunk):
                times[f] += n
        x = {f: log1p(n) for f, n in times.items()}
        for f in self._of_text(text, chunks, len(counts)):
            x[f] = x.get(f, 0) + 1.0
        return x

    def scorer(self, weights: dict[int, float], most: int = 300_000):
        """Texts to w.x; remembers up to ``most`` chunks, of which few have a weight."""
        known: dict[str, tuple[int, ...]] = {}

        def score(texts: list[str]) -> np.ndarray:
            out = np.zeros(len(texts))
            for k, text in enumerate(texts):
                chunks = text.split()
                distinct = set(chunks)
                for chunk in distinct.difference(known):
                    known[chunk] = tuple(f for f in self._of_chunk(chunk) if f in weights)
                hits = {c for c in distinct if known[c]}
                if hits:
                    times: Counter = Counter()
                    for chunk, n in Counter(c for c in chunks if c in hits).items():
                        for f in known[chunk]:
                            times[f] += n
                    out[k] = sum(weights[f] * log1p(n) for f, n in times.items())
                out[k] += sum(weights.get(f, 0.0) for f in self._of_text(text, chunks, len(distinct)))
                if len(known) > most:
                    known.clear()
            return out

        return score
