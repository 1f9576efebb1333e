"""Texts of an Arrow column as bytes, some documents at a time."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


@dataclass
class Texts:
    """Consecutive rows of a batch: their UTF-8 bytes in a row, and where each begins (and the last ends)."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @property
    def document(self) -> np.ndarray:
        """The row of each byte."""
        return np.repeat(np.arange(len(self), dtype=np.int32), np.diff(self.bounds))

    def spaces(self) -> np.ndarray:
        """Which bytes are white space; one that is not ASCII never is."""
        return _SPACE[self.data]

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """First byte of each word, and the byte behind its last."""
        inner = ~self.spaces()
        before, behind = np.zeros_like(inner), np.zeros_like(inner)
        before[1:], behind[:-1] = inner[:-1], inner[1:]
        filled = self.bounds[:-1][np.diff(self.bounds) > 0]
        before[filled] = False
        behind[filled[1:] - 1] = False
        return np.flatnonzero(inner & ~before), np.flatnonzero(inner & ~behind) + 1


def slices(column: pa.Array, at_once: int = 1 << 20) -> Iterator[Texts]:
    """The rows of a text column, null as empty, as many at a time as hold ``at_once`` bytes, one at least."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(column.buffers()[1], "<i8")[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    k = 0
    while k < len(column):
        stop = max(k + 1, int(np.searchsorted(bounds, bounds[k] + at_once, "right")) - 1)
        yield Texts(k, data[bounds[k] : bounds[stop]], bounds[k : stop + 1] - bounds[k])
        k = stop


def sha256(*parts: bytes | memoryview) -> str:
    digest = hashlib.sha256()
    for part in parts:
        digest.update(part)
    return digest.hexdigest()
