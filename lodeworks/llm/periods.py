"""Periodic runs of words by a dictionary of basic factors.

The dictionary gives every stretch of 2^k words a name; that of 2^(k+1) words is made of
two names. Stretches that stand once in their document are dropped, as no longer one that
begins there can stand twice, so in usual texts few are left after some levels.

Per level, of L words, the next occurrence of a name at a distance d <= L proposes period d.
Occurrences that overlap like that form arithmetic progressions; neighbouring ones with one
distance join to an unbroken range of starts a..b, and words a to b + d + L - 1 have period d.
The range is as long as it can be: would a word beside it keep the period, the start there
would have the same successor. Nor can a run of exponent 3 or more be missed: at the level
with d <= L < 2d every start in it that leaves room for a successor has one at d, and none
nearer, as no conjugate of a primitive word stands inside its square elsewhere. Longer levels
propose a run again, so equal proposals are merged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.llm.common import ship, unpacked
from lodeworks.llm.registry import query, read
from lodeworks.llm.textbytes import Texts, sha256, slices

#: For a document of n words: first word of a made repetition and its period, or none.
Plant = Callable[[int | None, int], tuple[int, int] | None]


def planted(doc: int | None, n: int) -> tuple[int, int] | None:
    """A tenth of the documents, by their id, goes on from some word as a repetition. None without words or id."""
    if doc is None or not n:
        return None
    g, h = divmod(crc32(str(doc).encode()), 10)
    a = g % n
    return (a, 1 + (n - a) // (3 + g % 8)) if h == 0 else None


def _numbered(words: pa.Array) -> np.ndarray:
    return pc.dictionary_encode(words).indices.to_numpy().astype(np.int64)


def _words(texts: Texts) -> tuple[pa.Array, np.ndarray]:
    """The words, and how many there are before each document and in all."""
    starts, ends = texts.words()
    if not len(starts):
        return pa.array([], pa.large_binary()), np.zeros(len(texts) + 1, np.int64)
    bounds = np.column_stack([starts, ends]).ravel()
    buffers = [None, pa.py_buffer(bounds.astype("<i8")), pa.py_buffer(texts.data)]
    every = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, buffers)  # word, gap, word, ...
    return every.take(pa.array(np.arange(0, len(bounds) - 1, 2))), np.searchsorted(starts, texts.bounds)


def progressions(distance: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, word behind the last, and period of each stretch that starts with one distance, ``size`` at most, propose."""
    at = np.flatnonzero((distance > 0) & (distance <= size))
    if not len(at):
        return at, at, at
    d = distance[at]
    broken = (np.diff(at) != 1) | (np.diff(d) != 0)
    first, last = np.r_[True, broken], np.r_[broken, True]
    return at[first], at[last] + d[last] + size, d[first]


def periodic_runs(words: np.ndarray, bounds: np.ndarray, least: int = 6, exponent: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs (first word, word behind the last, smallest period) by first word, then period.

    ``words`` numbers the words of some documents, alike where they are alike; document k has
    those from ``bounds[k]`` to ``bounds[k + 1]``. Memory is some numbers per word.
    """
    total, sizes = len(words), np.diff(bounds)
    stop = np.repeat(bounds[1:], sizes)
    at = np.arange(total)
    key = np.repeat(np.arange(len(sizes)), sizes) * (words.max(initial=0) + 1) + words
    size, found = 1, []
    while len(at):
        order = np.argsort(key, kind="stable")
        place, key = at[order], key[order]
        again = key[1:] == key[:-1]
        several = np.zeros(len(place), bool)
        several[1:] |= again
        several[:-1] |= again
        distance, name = np.zeros(total, np.int64), np.zeros(total, np.int64)
        distance[place[:-1][again]] = (place[1:] - place[:-1])[again]
        name[place[several]] = np.cumsum(np.r_[True, ~again])[several]
        found.append(progressions(distance, size))
        at = np.flatnonzero(name)
        at = at[at + 2 * size <= stop[at]]
        at = at[name[at + size] > 0]
        key = name[at] * (len(place) + 1) + name[at + size]
        size *= 2
    first, last, period = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    long = last - first >= np.maximum(least, exponent * period)
    merged = np.unique(np.column_stack([first, period, last])[long], axis=0)
    return merged[:, 0], merged[:, 2], merged[:, 1]


def _collapsed(words: pa.Array, bounds: np.ndarray, first: np.ndarray, last: np.ndarray, period: np.ndarray) -> list[bytes]:
    """Each document's words that no run holds behind its first period, joined by spaces."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, first + period, 1)
    np.add.at(change, last, -1)
    kept = np.cumsum(change[:-1]) == 0
    before = np.r_[0, np.cumsum(kept)][bounds]
    lists = pa.LargeListArray.from_arrays(pa.array(before, pa.int64()), words.filter(pa.array(kept)))
    return pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).to_pylist()


Found = tuple[np.ndarray, np.ndarray, np.ndarray, bytes]


def _documents(texts: Texts, ids: list[int | None], least: int, exponent: int, plant: Plant | None) -> Iterator[Found]:
    """Start, length and period of each document's runs, numbered in it, and its words that stay."""
    words, bounds = _words(texts)
    if plant:
        source = np.arange(len(words))
        for k, doc in enumerate(ids):
            if made := plant(doc, int(bounds[k + 1] - bounds[k])):
                a, p = bounds[k] + made[0], made[1]
                source[a : bounds[k + 1]] = a + np.arange(bounds[k + 1] - a) % p
        words = words.take(pa.array(source))
    first, last, period = periodic_runs(_numbered(words), bounds, least, exponent)
    left = _collapsed(words, bounds, first, last, period)
    of = np.searchsorted(first, bounds)
    for k in range(len(texts)):
        mine = slice(of[k], of[k + 1])
        yield first[mine] - bounds[k], last[mine] - first[mine], period[mine], left[k]


def _best(start: np.ndarray, length: np.ndarray, period: np.ndarray) -> tuple[int | None, ...]:
    """The run with the greatest exponent, the first and shortest of several, and its exponent in thousandths."""
    if not len(start):
        return None, None, None, None
    runs = zip(start.tolist(), length.tolist(), period.tolist())
    s, n, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
    return s, n, q, 1000 * n // q


_REPORT = {
    "doc_id": pa.int64(), "n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(), "period": pa.int64(),
    "exponent_milli": pa.int64(), "runs_sha256": pa.string(), "collapsed_sha256": pa.string(),
}


def _reported(batches: Iterator[pa.RecordBatch], least: int, exponent: int, plant: Plant | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for some in slices(batch.column("text")):
            mine, rows = ids[some.first : some.first + len(some)], []
            for doc, (s, n, q, left) in zip(mine, _documents(some, mine, least, exponent, plant)):
                lines = "".join(f"{a},{b},{c}\n" for a, b, c in zip(s.tolist(), n.tolist(), q.tolist()))
                rows.append((doc, len(s), *_best(s, n, q), sha256(lines.encode()), sha256(left)))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _REPORT.values())], list(_REPORT))


_RUN = T.StructType().add("start", "long").add("length", "long").add("period", "long")
_RUNS = pa.list_(pa.struct([(c, pa.int64()) for c in _RUN.names]))


def _found(batches: Iterator[pa.RecordBatch], least: int, exponent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for some in slices(batch.column("text")):
            mine, runs, left = ids[some.first : some.first + len(some)], [], []
            for s, n, q, text in _documents(some, mine, least, exponent, None):
                runs.append([{"start": a, "length": b, "period": c} for a, b, c in zip(s.tolist(), n.tolist(), q.tolist())])
                left.append(text.decode() if len(s) else None)
            whole = batch.column("whole").slice(some.first, len(some))
            yield pa.RecordBatch.from_arrays([whole, pa.array(runs, _RUNS), pa.array(left, pa.string())], ["whole", "runs", "shorter"])


def _runs_of(docs: DataFrame, least: int, exponent: int) -> DataFrame:
    if exponent < 3:
        raise ValueError("Only runs of exponent 3 or more are found")
    ship(docs.sparkSession)
    whole = F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("whole")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", whole)
    schema = rows.select("whole").schema.add("runs", T.ArrayType(_RUN)).add("shorter", "string")
    return rows.mapInArrow(lambda it: _found(it, least, exponent), schema)


def find_runs(docs: DataFrame, least: int = 6, exponent: int = 4) -> DataFrame:
    """One row per periodic run: doc_id, start (words from 0), length, period (words), exponent_milli.

    A run is a stretch of at least ``least`` words and ``exponent`` periods, its smallest
    period taken, that no neighbouring word extends. Words are what white space of ASCII
    parts, told apart to the byte. Null and empty texts have no run; rows are searched one
    by one, so repeated ones have their runs each; an empty table gives no rows. Nothing is
    shuffled, and a task holds the words of about a megabyte of text, or of one document.
    """
    found = _runs_of(docs.select("doc_id", "text"), least, exponent)
    each = found.select(F.col("whole.doc_id").alias("doc_id"), F.inline("runs"))
    return each.withColumn("exponent_milli", F.expr("1000 * length div period"))


def collapse_runs(docs: DataFrame, least: int = 6, exponent: int = 4) -> DataFrame:
    """The documents with each run cut down to its first period, and their words joined by one space.

    Texts without a run stay as they are, null stays null; other columns pass through, and
    n_chars, if there, follows the text.
    """
    text = F.coalesce("shorter", F.col("whole").getField("text"))
    new = {"text": text}
    if "n_chars" in docs.columns:
        cut = F.char_length("shorter").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.coalesce(cut, F.col("whole").getField("n_chars"))
    return unpacked(_runs_of(docs, least, exponent), docs.columns, **new)


def run_report(docs: DataFrame, least: int = 6, exponent: int = 4, plant: Plant | None = None) -> DataFrame:
    """Per row: doc_id, n_runs, the run of greatest exponent (first, then shortest period, of several) and hashes
    of all runs and of the words that ``collapse_runs`` keeps. ``plant`` may turn documents into repetitions first."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return rows.mapInArrow(lambda it: _reported(it, least, exponent, plant), schema)


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_report(read(spark, folder, "documents"), plant=planted)
