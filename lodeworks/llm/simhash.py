"""SimHash near-dedup: fingerprints are dealt to shards by a few of their bits, and the BK-tree of a shard finds the near ones."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.common import NO_ID, block_pairs, components, document_key, packed, runs, ship, spanning, stored, texts, unpacked
from lodeworks.llm.registry import query, read

_AT_ONCE = 65536
#: A shard this many times as large as shards should be is cut into several trees.
_UNEVEN = 4


def fingerprint(text: str, shingle: int = 3) -> int:
    """64 bits, each set in over half of the shingles' hashes; 0 for a text without words."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    total, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for start in range(0, n, _AT_ONCE):
        part = words[start : min(start + _AT_ONCE, n) + shingle - 1]
        spans = map(b" ".join, zip(*(part[k:] for k in range(shingle))))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, spans, repeat(42)), np.uint64)
        total += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << int(k) for k in np.flatnonzero(total * 2 > n))


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t, shingle) for t in texts(batch.column("body"))], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(prints.view(np.int64))], ["doc", "print"])


class BKTree:
    """Children are keyed by their distance to the parent; a search follows only edges within the radius."""

    def __init__(self) -> None:
        self.root: list | None = None
        #: Nodes that searches looked at.
        self.visited = 0

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while d := (node[0] ^ value).bit_count():
            if (child := node[1].get(d)) is None:
                node[1][d] = [value, {}]
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        found, stack = [], [self.root] if self.root else []
        while stack:
            at, children = stack.pop()
            self.visited += 1
            d = (at ^ value).bit_count()
            if d <= radius:
                found.append(at)
            if children:
                for e in range(max(1, d - radius), d + radius + 1):
                    if e in children:
                        stack.append(children[e])
        return found


def _near(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for table, bounds in runs(batches, ["band", "part", "i", "j"]):
        prints = table.column("print").to_numpy().view(np.uint64).tolist()
        own, i, j = (table.column(c).to_numpy() for c in ("own", "i", "j"))
        a, b = [], []
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            tree = BKTree()
            if i[start] == j[start]:
                for value in prints[start:end]:  # each finds those before it
                    near = tree.within(value, radius)
                    tree.add(value)
                    a += [value] * len(near)
                    b += near
            else:
                inside = (own[start:end] == i[start]).tolist()
                for value, is_tree in zip(prints[start:end], inside):
                    if is_tree:
                        tree.add(value)
                for value, is_tree in zip(prints[start:end], inside):
                    if not is_tree:
                        near = tree.within(value, radius)
                        a += [value] * len(near)
                        b += near
            if len(a) > 1_000_000:
                node, root = spanning(np.array(a, np.uint64), np.array(b, np.uint64))
                a, b = node.tolist(), root.tolist()
        node, root = spanning(np.array(a, np.uint64), np.array(b, np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(root.view(np.int64))], ["a", "b"])


def _assigned(docs: DataFrame, shingle: int, radius: int, shard: int) -> DataFrame:
    """doc, print and first (the smallest doc that can be reached) of every row."""
    ship(docs.sparkSession)
    prints = docs.select(*document_key()).select("doc", "body")
    return groups_of(stored(prints.mapInArrow(lambda it: _fingerprints(it, shingle), "doc long, print long")), radius, shard)


def groups_of(prints: DataFrame, radius: int, shard: int) -> DataFrame:
    """doc, print and first of every (doc, print)."""
    ship(prints.sparkSession)
    classes = stored(prints.groupBy("print").agg(F.min("doc").alias("first")))  # copies end here
    # radius + 1 bands: two prints that differ in at most radius bits are alike in one of them at least,
    # so also in its first bits, of which as many name a shard as make shards of about the given size
    edges, wide = [64 * k // (radius + 1) for k in range(radius + 2)], math.ceil(math.log2(max(classes.count() / shard, 2)))
    widths = [min(wide, high - low) for low, high in zip(edges, edges[1:])]
    parts = [F.struct(F.lit(k).alias("band"), F.expr(f"shiftrightunsigned(print, {edges[k]}) & {2**w - 1}L").alias("part")) for k, w in enumerate(widths)]
    banded = classes.select("print", F.explode(F.array(*parts)).alias("s")).select("print", "s.band", "s.part")
    dealt = block_pairs(banded, ["band", "part"], F.col("print"), _UNEVEN * shard)
    links = dealt.mapInArrow(lambda it: _near(it, radius), "a long, b long")
    reached = components(links).select(F.col("node").alias("print"), "component")
    grouped = classes.join(reached, "print", "left").select("print", "first", F.coalesce("component", "print").alias("component"))
    firsts = grouped.groupBy("component").agg(F.min("first").alias("first"))
    grouped = grouped.select("print", "component").join(firsts, "component").select("print", "first")
    return prints.join(grouped, "print")


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 2, shard: int = 4096) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable by links.

    Texts link if their fingerprints differ in at most ``radius`` bits. A fingerprint is in
    radius + 1 shards, each named by bits of another part of it, as many as make shards of about
    ``shard`` distinct fingerprints; two that link share one of these shards, so none is lost.
    Each shard is a BK-tree that its fingerprints search. One with over four times
    ``shard``, where bits are uneven, is cut into several trees, each searched by all of its fingerprints. A task emits a spanning tree of what it found, not
    the pairs.

    Null and empty texts have fingerprint zero and link like any other. Rows without doc_id
    are one document after all others (component_id null if they reach none with an id).
    Rows that share a doc_id are rows of one document, each with its own fingerprint.
    """
    found = _assigned(docs, shingle, radius, shard)
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return found.select(known("doc").alias("doc_id"), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), known("first").alias("component_id"))


def dedup_simhash(docs: DataFrame, shingle: int = 3, radius: int = 2, shard: int = 4096) -> DataFrame:
    """The documents whose doc_id is the smallest of their group, all columns as they came.

    If rows of one doc_id lie in several groups, they stay if they lead any of them.
    """
    gone = _assigned(docs, shingle, radius, shard)
    kept = gone.where("doc = first").select("doc").distinct()
    return unpacked(packed(docs).join(kept, "doc", "left_semi"), docs.columns)


@query("op8_simhash_dedup")
def op8_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_groups(read(spark, folder, "documents"))
