"""Substring dedup: hash every run of several consecutive sentences, join globally, remove what non-first runs cover."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.common import packed, ship, stored, texts, with_text
from lodeworks.llm.registry import query, read

#: Every so many consecutive words of a long sentence one at least is cut behind.
_WINDOW = 7
_SPACE, _STOP, _CLOSE = (np.isin(np.arange(128), [ord(c) for c in x]) for x in (" \t\n\r\x0b\x0c", ".!?", "\"')]"))


#: Odd numbers, one for each half of a hash, and their inverses modulo 2^64.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_INVERSE = tuple(pow(b, -1, 2**64) for b in _BASES)


def _is(codes: np.ndarray, kind: np.ndarray) -> np.ndarray:
    return kind[np.minimum(codes, 127)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _word_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Two numbers per word, alike for words alike with A-Z in lower case."""
    n = ends - starts
    at = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())
    place = at - np.repeat(starts, n)
    c = codes[at].astype(np.uint64)
    c += np.where((c >= 65) & (c <= 90), np.uint64(32), np.uint64(0))
    powers = [np.cumprod(np.full(int(n.max()), base, np.uint64)) for base in _BASES]
    return np.array([_mixed(np.add.reduceat(c * p[place], np.cumsum(n) - n)) for p in powers])


def _sentences(codes: np.ndarray, bounds: np.ndarray, most: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts in a row (``bounds``: where each begins, and the last ends), per word: where it starts, whether it is cut behind it,
    and its hashes; and the line feeds before each character."""
    word = ~_is(codes, _SPACE)
    before, behind = np.r_[False, word[:-1]], np.r_[word[1:], False]
    filled = bounds[:-1][np.diff(bounds) > 0]
    before[filled] = False  # a word does not go on from one text into the next
    behind[filled[1:] - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~behind) + 1
    feeds = np.r_[0, np.cumsum(codes == 10)]
    if not len(starts):
        return starts, np.zeros(0, bool), np.zeros((2, 0), np.uint64), feeds
    last = np.maximum.accumulate(np.where(_is(codes, _CLOSE), 0, np.arange(len(codes))))[ends - 1]  # before closing quotes and brackets
    stop = (last >= starts) & _is(codes[last], _STOP)
    words = np.searchsorted(starts, bounds)
    stop[words[1:][np.diff(words) > 0] - 1] = True
    cut = stop.copy()
    cut[:-1] |= feeds[starts[1:]] > feeds[ends[:-1]]
    sentence = np.cumsum(stop) - stop
    long = np.bincount(sentence) > most
    hashes = _word_hashes(codes, starts, ends)
    if long.any():
        windows = np.lib.stride_tricks.sliding_window_view(hashes[0], _WINDOW)
        first = np.arange(len(windows))
        first = first[(sentence[: len(windows)] == sentence[_WINDOW - 1 :]) & long[sentence[: len(windows)]]]
        cut[first + windows[first].argmin(axis=1)] = True
    return starts, cut, hashes, feeds


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _cut(text: str, most: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words before each cut (first 0, last all), characters before it, and the words' hashes."""
    codes = _codes(text)
    starts, cut, hashes, feeds = _sentences(codes, np.array([0, len(codes)]), most)
    if not len(starts):
        return np.zeros(1, np.int64), np.zeros(1, np.int64), hashes
    after = np.flatnonzero(cut) + 1
    lead = int(starts[0]) if feeds[starts[0]] else 0  # lines before the first word are no part of its sentence
    return np.r_[0, after], np.r_[lead, np.r_[starts, len(codes)][after]], hashes


def cuts(text: str, most: int = 12) -> tuple[list[int], list[int]]:
    """Where the text is cut: the words before each cut (first 0, last all), and the characters before it."""
    before, at, _ = _cut(text, most)
    return before.tolist(), at.tolist()


def sentences(text: str, most: int = 12) -> list[tuple[int, int]]:
    """Bounds of the sentences, which together are the whole text.

    One ends after ``.``, ``!`` or ``?`` with white space behind, or at a line feed. One of over
    ``most`` words (line feeds not counted as ends) counts as several: of every ``_WINDOW``
    words in a row inside it, it is cut behind the one with the smallest hash. These cuts
    depend on the words around them alone, so a passage is cut alike wherever it stands, but
    for its first and last words, whatever is before it and however its lines are broken.
    """
    _, at = cuts(text, most)
    at = [0, *at] if len(at) > 1 else [0, len(text)]
    return [(a, b) for a, b in zip(at[:-1], at[1:]) if a < b]


def _worded(text: str) -> list[tuple[int, int]]:
    """Those that hold words, as ``span_hashes`` numbers them."""
    _, at = cuts(text)
    return list(zip(at[:-1], at[1:]))


def runs_of(before: np.ndarray, first: np.ndarray, run: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the shortest runs from each sentence on, and up to each, with ``run`` sentences and ``min_words`` words.

    Both ways, so that of a passage that stands twice every sentence lies in a run inside it.
    ``before`` holds the words before each sentence of some texts, and at last all words;
    ``first`` the first sentence of each text, and at last their number.
    """
    n, at = len(before) - 1, np.arange(len(before))
    text = np.searchsorted(first, at[:-1], "right") - 1  # of each sentence
    ends = np.maximum(at + run, np.searchsorted(before, before + min_words))[:-1]
    starts = np.minimum(at - run, np.searchsorted(before, before - min_words, "right") - 1)[1:]
    ahead, back = ends <= first[text + 1], starts >= first[text]
    return np.divmod(np.unique(np.r_[at[:-1][ahead] * (n + 1) + ends[ahead], starts[back] * (n + 1) + at[1:][back]]), n + 1)


def span_hashes(texts: list[str], run: int, min_words: int) -> tuple[np.ndarray, ...]:
    """Text, first and last bounds (numbers of sentences of the text) and 128-bit hashes, as two rows, of the texts' runs."""
    codes = _codes("".join(texts))
    bounds = np.r_[0, np.cumsum([len(t) for t in texts])]
    starts, cut, hashes, _ = _sentences(codes, bounds)
    before = np.r_[0, np.flatnonzero(cut) + 1]
    first = np.searchsorted(before, np.searchsorted(starts, bounds))
    a, b = runs_of(before, first, run, min_words)
    begin, end, out = before[a], before[b], np.zeros((2, len(a)), np.uint64)
    for k in range(2 if len(a) else 0):
        # a run is a number in base _BASES[k] with its words as digits, whatever is before it
        powers, back = (np.r_[np.uint64(1), np.cumprod(np.full(hashes.shape[1], x[k], np.uint64))] for x in (_BASES, _INVERSE))
        total = np.r_[np.uint64(0), np.cumsum(hashes[k] * powers[:-1])]
        out[k] = _mixed((total[end] - total[begin]) * back[begin] + (end - begin).astype(np.uint64))
    of = np.searchsorted(first, a, "right") - 1
    return of, a - first[of], b - first[of], out.view(np.int64)


def _spans(batches: Iterator[pa.RecordBatch], run: int, min_words: int, at_once: int = 500_000) -> Iterator[pa.RecordBatch]:
    """Runs of some texts at a time: as many as hold ``at_once`` characters, one at least."""
    for batch in batches:
        doc, row = batch.column("doc").to_numpy(), batch.column("row").to_numpy()
        bodies = texts(batch.column("body"))
        ends = np.cumsum([len(t) for t in bodies])
        k = 0
        while k < len(bodies):
            stop = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + at_once, "right")))
            of, a, b, (h1, h2) = span_hashes(bodies[k:stop], run, min_words)
            of = of + k
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[of], row[of], a.astype(np.int32), b.astype(np.int32), h1, h2)], ["doc", "row", "pos", "stop", "h1", "h2"])
            k = stop


def remove_runs(text: str, runs: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without these runs of sentences, and how many sentences went."""
    bounds = _worded(text)
    gone = [bounds[k] for k in sorted({k for a, b in runs for k in range(a, b)})]
    kept, at = [], 0
    for a, b in gone:
        kept.append(text[at:a])
        at = b
    return "".join([*kept, text[at:]]), len(gone)


def _remover():
    """Of (text, runs): the text that is left, and how many sentences went; null where there are no runs."""

    @F.arrow_udf("left string, n_removed long")
    def removed(body: pa.Array, runs: pa.Array) -> pa.Array:
        left, gone = [], []
        for text, spans in zip(body.to_pylist(), runs.to_pylist()):
            kept, n = remove_runs(text, [(x["pos"], x["stop"]) for x in spans]) if spans else (None, None)
            left.append(kept)
            gone.append(n)
        return pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(gone, pa.int64())], ["left", "n_removed"])

    return removed


def _cleaned(docs: DataFrame, run: int, min_words: int) -> DataFrame:
    """doc, whole (all columns), left (the text that stays), n_removed (sentences)."""
    ship(docs.sparkSession)
    rows = packed(docs)
    spans = rows.select("doc", "row", "body").mapInArrow(lambda it: _spans(it, run, min_words), "doc long, row long, pos int, stop int, h1 long, h2 long")
    # most runs stand once and go by half their hash, a count of longs
    several = stored(spans.groupBy("h1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1"))
    spans = stored(spans.join(several, "h1"))
    at = F.struct("doc", "row", "pos")
    # copies of a passage are summed up in each task first, so a very common one is a row per task
    repeated = spans.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2", "first")
    repeated = stored(repeated)  # read from files, it is a plain side of the join, whose hot keys Spark may then split
    later = spans.join(repeated, ["h1", "h2"]).where(at != F.col("first"))
    covered = stored(later.groupBy("doc", "row").agg(F.collect_set(F.struct("pos", "stop")).alias("runs")))
    joined = rows.join(covered, ["doc", "row"], "left")
    # texts that stay as they are do not go to Python
    found = _remover()(F.when(F.col("runs").isNotNull(), F.col("body")), F.col("runs"))
    made = joined.select("doc", "whole", "body", found.alias("found"))
    return made.select("doc", "whole", F.coalesce("found.left", "body").alias("left"), F.coalesce("found.n_removed", F.lit(0)).cast("long").alias("n_removed"))


def dedup_spans(docs: DataFrame, run: int = 3, min_words: int = 15) -> DataFrame:
    """The documents without the sentences of passages that stand earlier already.

    Runs of consecutive sentences, ``run`` or more of them with ``min_words`` words or more
    (see ``runs_of``), are compared with all others of the corpus by their words, A-Z in lower
    case. Of equal runs the first by (doc_id, place) stays; every sentence that another covers
    goes, the rest of the text is left as it was, to the character. Long sentences count as
    several (see ``sentences``). At either end of a passage at most 13 words may be cut
    otherwise than in its copy, so with lines broken alike one of over 50 words always holds a run of three.

    Null text stays null. A document may end up empty but is never dropped. Rows without
    doc_id are one document after all others; rows alike in id and text are one place, so
    neither is a repeat of the other. Columns beside doc_id and text pass through; n_chars,
    if there, follows the text. An empty table gives an empty table.
    """
    return with_text(_cleaned(docs, run, min_words), docs, F.col("left"))


def span_report(docs: DataFrame, run: int = 3, min_words: int = 15) -> DataFrame:
    """Per document: doc_id, n_removed (sentences), kept_chars, kept_sha256 and kept_text of ``dedup_spans``."""
    found = _cleaned(docs.select("doc_id", "text"), run, min_words)
    return found.select(
        F.col("whole.doc_id").alias("doc_id"), "n_removed", F.char_length("left").cast("long").alias("kept_chars"),
        F.sha2("left", 256).alias("kept_sha256"), F.col("left").alias("kept_text"),
    )


@query("op10_substring_dedup")
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return span_report(read(spark, folder, "documents"))
