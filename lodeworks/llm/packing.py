"""Packing: Karmarkar-Karp multiway differencing deals pieces of documents into near-equal windows."""

from __future__ import annotations

import heapq
import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.common import document_key, ship, stored, texts
from lodeworks.llm.ordinal import known_id
from lodeworks.llm.registry import query, read
from lodeworks.llm.wordbpe import Encoder, Vocabulary

TOKENIZER = "word_bpe_49k.json"


def _library(path: str, v: Vocabulary):
    """Words to their ids as bytes, by the tokenizers library's model; a word is one pre-token."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenize = Tokenizer.from_file(path).model.tokenize

    def encode(words: list[str]) -> list[bytes]:
        spelled = (w if w.isascii() and w.isprintable() else "".join(v.symbols(w)) for w in words)  # printing ASCII spells itself
        return [array("I", [t.id for t in tokenize(s)]).tobytes() for s in spelled]

    return encode


@lru_cache(1)
def _encoder(path: str) -> Encoder:
    """One per worker process, which keeps what it has learnt from task to task."""
    v = Vocabulary(path)
    return Encoder(v, _library(path, v))


def _pieces(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    encoder, end = _encoder(path), end_id.to_bytes(4, "little")
    for batch in batches:
        of, starts, lengths, crcs, totals = [], [], [], [], []
        bodies = texts(batch.column("body"))
        for first in range(0, len(bodies), 256):
            for k, ids in enumerate(encoder.encode(bodies[first : first + 256]), first):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    of.append(k)
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    crcs.append(zlib.crc32(piece))
                    totals.append(n)
        of = pa.array(of, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc").take(of), batch.column("row").take(of), *[pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals)]],
            ["doc", "row", "start", "length", "ids_crc32", "doc_tokens"],
        )


def differenced(sizes: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Multiway Karmarkar-Karp: the window of each size, and the windows' sums.

    A partial partition is ``windows`` sums in falling order. The two with the largest
    imbalance (largest minus smallest sum) are merged, largest on smallest, until one is left.
    """
    n = len(sizes)
    left, right = [0] * n, [0] * n  # nodes n.. are merged sets of two nodes each
    heap = []
    for k in range(n):
        sums, sets = np.zeros(windows, np.int64), np.full(windows, -1, np.int64)
        sums[0], sets[0] = sizes[k], k
        heap.append((-int(sizes[k]) if windows > 1 else 0, k, sums, sets))
    heapq.heapify(heap)
    made = n
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)
        _, _, b, y = heapq.heappop(heap)
        sums, y = a + b[::-1], y[::-1]
        sets = np.where(x < 0, y, x)
        both = np.flatnonzero((x >= 0) & (y >= 0))
        sets[both] = np.arange(len(left), len(left) + len(both))
        left += x[both].tolist()
        right += y[both].tolist()
        order = np.argsort(-sums, kind="stable")
        sums, sets = sums[order], sets[order]
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), made, sums, sets))
        made += 1
    _, _, sums, sets = heap[0]
    window = np.zeros(n, np.int64)
    for w, s in enumerate(sets.tolist()):
        stack = [s] if s >= 0 else []
        while stack:
            s = stack.pop()
            if s < n:
                window[s] = w
            else:
                stack += (left[s], right[s])
    return window, sums


def windows_for(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each length: as few windows as differencing can hold within capacity, counting up."""
    if not len(lengths):
        return np.zeros(0, np.int64)
    count = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        window, sums = differenced(lengths, count)
        if sums[0] <= capacity:
            return window
        count += 1


def _packed(group: pd.DataFrame, capacity: int) -> pd.DataFrame:
    group = group.sort_values(["length", "doc", "row", "start"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
    length = group["length"].to_numpy()
    full = int((length == capacity).sum())  # each of these is a window, and they come first
    window = np.r_[np.arange(full), full + windows_for(length[full:], capacity)].astype(np.int64)
    order = np.argsort(window, kind="stable")
    group, window, length = group.iloc[order], window[order], length[order]
    before = np.cumsum(length) - length
    first = np.r_[True, window[1:] != window[:-1]]
    group["offset"] = before - before[first][np.cumsum(first) - 1]
    group["sequence_id"] = group["block"].astype(np.int64) * 2**32 + window
    return group[["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, capacity: int = 4096, windows: int = 128) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids, and ``end_id`` after them, are cut at multiples of ``capacity``. Pieces
    are dealt by hash (of the row and of its place among all) into blocks of about ``windows`` windows' worth of tokens. Each block is
    one multiway differencing into as few windows as the tokens need; if any would exceed the
    capacity, their number rises by one. A block's work is bounded, whatever the input.
    sequence_id is the block's number times 2^32 plus the window's.

    Null and empty texts are a document of ``end_id`` alone. Rows without doc_id are packed
    with a null id; repeated rows are packed as often as they come. Other columns are not
    read. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    rows = docs.select(*document_key())
    pieces = stored(rows.mapInArrow(lambda it: _pieces(it, path, end_id, capacity), "doc long, row long, start long, length long, ids_crc32 long, doc_tokens long"))
    total = pieces.agg(F.sum("length")).first()[0] or 0
    blocks = max(1, -(-total // (capacity * windows)))
    # rows alike in everything are told apart by where they were written
    file, place = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1), F.col("_metadata.row_index")
    block = F.pmod(F.xxhash64("doc", "row", "start", file, place), F.lit(blocks)).alias("block")
    dealt = pieces.select("*", block).groupBy("block").applyInPandas(
        lambda g: _packed(g, capacity), "doc long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
    return dealt.select(known_id().alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op4_packing")
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(read(spark, folder, "documents"))
