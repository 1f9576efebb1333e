"""Near copies by their word shingles: SimHash fingerprints and min-hashes propose pairs, the shingle sets themselves decide."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.common import components, dealt_blocks, document_key, grouped, packed, runs, ship, spanning, stored, texts, unpacked
from lodeworks.llm.simhash import fingerprint, groups_of

_AT_ONCE = 2048


def shingles(text: str, size: int = 5) -> np.ndarray:
    """The distinct hashes of all runs of ``size`` words, in order; of all words if there are fewer."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.int64)
    spans = map(b" ".join, zip(*(words[k:] for k in range(size)))) if len(words) > size else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, spans, repeat(43)), np.uint64).view(np.int64))


def band_keys(hashes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band, made of ``rows`` min-hashes each."""
    odd, shift = np.random.default_rng(1).integers(0, 2**63, (2, bands * rows, 1), np.uint64) | np.uint64(1)
    least = np.full(bands * rows, 2**64 - 1, np.uint64)
    for start in range(0, len(hashes), _AT_ONCE):
        h = hashes[start : start + _AT_ONCE].view(np.uint64)[None, :] * odd + shift
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        least = np.minimum(least, (h ^ (h >> np.uint64(29))).min(axis=1))
    return np.array([xxhash.xxh64_intdigest(x.tobytes()) for x in least.reshape(bands, rows)], np.uint64).view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [shingles(t, size).tobytes() for t in texts(batch.column("body"))]
        marks = [np.frombuffer(xxhash.xxh3_128_digest(x), "<i8") for x in made]
        marks = np.array(marks, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("row"), pa.array(marks[:, 0].copy()), pa.array(marks[:, 1].copy())], ["doc", "row", "mark", "mark2"]
        )


def _printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t) for t in texts(batch.column("body"))], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("mark"), pa.array(prints.view(np.int64))], ["doc", "print"])


def _banded(batches: Iterator[pa.RecordBatch], size: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [band_keys(x, bands, rows) if len(x := shingles(t, size)) else x for t in texts(batch.column("body"))]
        of = np.repeat(np.arange(len(made)), [len(x) for x in made])
        keys = np.concatenate([np.zeros(0, np.int64), *made])
        yield pa.RecordBatch.from_arrays([batch.column("mark").take(pa.array(of)), pa.array((np.arange(len(keys)) % bands).astype(np.int32)), pa.array(keys)], ["mark", "band", "key"])


def alike(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the Jaccard similarity of row and column members is at least ``similarity``, as a matrix."""
    sizes = np.array([len(x) for x in sets])
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    member = np.repeat(np.arange(len(sets)), sizes)
    keep = times[at] > 1
    member, at = member[keep], np.unique(at[keep], return_inverse=True)[1]
    order = np.argsort(at, kind="stable")
    member, at = member[order], at[order]
    common = np.zeros((len(rows), len(columns)))
    n = int(at.max(initial=-1)) + 1
    for start in range(0, n, 2048):
        s, e = np.searchsorted(at, [start, start + 2048])
        held = np.zeros((len(sets), min(2048, n - start)), np.float32)
        held[member[s:e], at[s:e] - start] = 1
        common += held[rows] @ held[columns].T
    return common / (sizes[rows][:, None] + sizes[columns][None, :] - common) >= similarity


def _linked(batches: Iterator[pa.RecordBatch], size: int, similarity: float) -> Iterator[pa.RecordBatch]:
    for table, bounds in runs(batches, ["band", "key", "i", "j"]):
        mark, own, i, j = (table.column(c).to_numpy() for c in ("mark", "own", "i", "j"))
        bodies = table.column("body").combine_chunks()
        a, b = [], []
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            every = np.arange(e - s)
            rows, columns = (every, every) if i[s] == j[s] else (np.flatnonzero(own[s:e] == i[s]), np.flatnonzero(own[s:e] == j[s]))
            if not len(rows) or not len(columns):
                continue
            r, c = np.nonzero(alike([shingles(t, size) for t in texts(bodies.slice(s, e - s))], rows, columns, similarity))
            node, root = spanning(mark[s + rows[r]], mark[s + columns[c]])
            a.append(node)
            b.append(root)
        node, root = spanning(np.concatenate([np.zeros(0, np.int64), *a]), np.concatenate([np.zeros(0, np.int64), *b]))
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["a", "b"])


def dedup_shingles(
    docs: DataFrame, shingle: int = 5, similarity: float = 0.8, bands: int = 32, rows: int = 5, block: int = 256, radius: int = 2, shard: int = 4096
) -> DataFrame:
    """The documents whose doc_id is the smallest of their group, all columns as they came.

    Texts link if the Jaccard similarity of their sets of ``shingle`` words in a row is
    ``similarity`` or more, A-Z in lower case; groups are what links reach. Texts with one set
    are one class from the start. Classes are compared, set by set, in the groups that their SimHash
    fingerprints form by at most ``radius`` bits (as in ``simhash_groups``, by BK-trees of shards), so no link
    within the radius is lost. Pairs of 0.8 lie farther apart than any radius a tree can afford; so classes are
    also compared where all ``rows`` min-hashes of one of ``bands`` bands agree: a pair of similarity s beyond the
    radius is missed with a chance of (1 - s^rows)^bands, 3e-6 at 0.8. A group or a band's value with over
    ``block`` classes is compared in pairs of blocks. A task emits a spanning tree of what it found, not the pairs.

    Null and empty texts have no shingles and are alike. Rows without doc_id are one document
    after all others. If rows of one doc_id lie in several groups, they stay if they lead any.
    """
    ship(docs.sparkSession)
    keyed = docs.select(*document_key())
    marks = stored(keyed.mapInArrow(lambda it: _sets(it, shingle), "doc long, row long, mark long, mark2 long"))
    classes = marks.groupBy("mark", "mark2").agg(F.min("doc").alias("first"), F.min(F.struct("doc", "row")).alias("at"))  # copies end here
    classes = stored(classes.select("mark", "first", F.col("at.doc").alias("doc"), F.col("at.row").alias("row")))
    bodies = stored(keyed.dropDuplicates(["doc", "row"]).join(classes.select("mark", "doc", "row"), ["doc", "row"]).select("mark", "body"))
    near = groups_of(stored(bodies.mapInArrow(_printed, "doc long, print long")), radius, shard)
    near = near.select(F.col("doc").alias("mark"), F.lit(-1).alias("band"), F.col("first").alias("key"))
    banded = stored(near.unionByName(bodies.mapInArrow(lambda it: _banded(it, shingle, bands, rows), "mark long, band int, key long")))
    dealt = stored(dealt_blocks(banded, ["band", "key"], F.col("mark"), block).drop("members"))
    met = grouped(dealt.join(bodies, "mark"), ["band", "key", "i", "j"])
    reached = components(met.mapInArrow(lambda it: _linked(it, shingle, similarity), "a long, b long"))
    labelled = classes.select("mark", "first").join(reached.select(F.col("node").alias("mark"), "component"), "mark", "left")
    kept = labelled.groupBy(F.coalesce("component", "mark").alias("component")).agg(F.min("first").alias("doc"))
    return unpacked(packed(docs).join(kept.select("doc").distinct(), "doc", "left_semi"), docs.columns)
