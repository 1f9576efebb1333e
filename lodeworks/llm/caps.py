"""Embedding near-dedup: spherical caps around the directions of a random product code, joined by direction.

A direction is one unit vector from each of two random codes, for the two halves of the
components, side by side. A vector's filters are the directions it exceeds a threshold on.
The code's structure lists them from two short tables of products, without trying all
code_size^2 directions. A few such codes are used together. Vectors that are close share filters with a chance that their
number makes near certain; all pairs that share one are verified by their cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.common import components, dealt_blocks, grouped, matrix, runs, ship, spanning, stored, vectors
from lodeworks.llm.registry import query, read

#: Fixed caps below so many components; their height lets pairs of cosine 0.9 share most of a cap.
_FEW, _HEIGHT = 16, 0.75


def _directions(width: int, n: int, *seed: int) -> np.ndarray:
    c = np.random.default_rng(list(seed)).standard_normal((n, width))
    return c / np.linalg.norm(c, axis=1, keepdims=True)


class Code:
    """One random product code for vectors of one length, and the height of its caps.

    Vectors are rotated at random, so that no half is empty. The height is the quantile of a
    random vector's products with all directions that leaves it ``filters`` of them. Under
    ``_FEW`` components such caps would be narrower than the pairs looked for: a code of
    single directions then has caps of a fixed height, and as many as give ``filters``.
    """

    def __init__(self, dim: int, filters: int, size: int, *seed: int) -> None:
        self.turn, _ = np.linalg.qr(_directions(dim, dim, *seed, dim, 9))
        trial = _directions(dim, 32, *seed, dim, 3)
        if dim < _FEW:
            self.cut = _HEIGHT
            share = (_directions(dim, 200_000, *seed, dim, 4) @ trial[0] >= _HEIGHT).mean()
            self.tables = [_directions(dim, int(np.ceil(filters / max(share, 1e-4))), *seed, dim, 0)]
            self.size = len(self.tables[0])
        else:
            self.tables = [_directions(dim - dim // 2, size, *seed, dim, 0), _directions(dim // 2, size, *seed, dim, 1)]
            first, second = self._products(trial)
            sums = (first[:, :, None] + second[:, None, :]).ravel()
            at = len(sums) - 1 - min(len(sums) - 1, filters * len(trial))
            self.cut, self.size = float(np.partition(sums, at)[at]), size * size

    def _products(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        turned, width = unit @ self.turn, self.tables[0].shape[1]
        return turned[:, :width] @ self.tables[0].T, turned[:, width:] @ self.tables[1].T

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (row, number of direction) with the row in the direction's cap, in order."""
        if len(self.tables) == 1:
            return np.nonzero(unit @ self.tables[0].T >= self.cut)
        a, b = self._products(unit)
        # only entries that can reach the cut with the row's best partner are paired at all
        x_row, x = np.nonzero(a >= self.cut - b.max(1, keepdims=True))
        y_row, y = np.nonzero(b >= self.cut - a.max(1, keepdims=True))
        partners = np.bincount(y_row, minlength=len(unit))
        first = np.cumsum(partners) - partners
        n = partners[x_row]
        left = np.repeat(np.arange(len(x)), n)
        right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[x_row], n)
        row, i, j = x_row[left], x[left], y[right]
        inside = a[row, i] + b[row, j] >= self.cut
        return row[inside], i[inside] * len(self.tables[1]) + j[inside]

    def best(self, unit: np.ndarray) -> np.ndarray:
        """The number of each row's nearest direction."""
        if len(self.tables) == 1:
            return (unit @ self.tables[0].T).argmax(1)
        a, b = self._products(unit)
        return a.argmax(1) * len(self.tables[1]) + b.argmax(1)


class Caps:
    """Several independent codes: in one alone, vectors whose halves fit it badly would have few filters."""

    def __init__(self, dim: int, filters: int, size: int, repeats: int, seed: int) -> None:
        self.codes = [Code(dim, filters, size, seed, k) for k in range(repeats)]

    def decode(self, unit: np.ndarray) -> pa.ListArray:
        """The filters of each row, in rising order: in each code its caps, and at least the nearest direction."""
        before = np.cumsum([0, *[code.size for code in self.codes]])
        every, rows, numbers = np.arange(len(unit)), [], []
        for code, at in zip(self.codes, before):
            row, number = code.decode(unit)
            rows += [row, every]
            numbers += [number + at, code.best(unit) + at]
        row, number = np.divmod(np.unique(np.concatenate(rows) * before[-1] + np.concatenate(numbers)), before[-1])
        offsets = np.searchsorted(row, np.arange(len(unit) + 1))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(number, pa.int32()))


def _decoded(batches: Iterator[pa.RecordBatch], filters: int, size: int, repeats: int, seed: int) -> Iterator[pa.RecordBatch]:
    caps: dict[int, Caps] = {}
    names = ["rep", "mark", "copies", "embedding"]
    for batch in batches:
        lengths = np.array(batch.column("embedding").value_lengths())
        for dim in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == dim)
            caps[dim] = caps.get(dim) or Caps(dim, filters, size, repeats, seed)
            for k in range(0, len(at), 1024):
                part = batch.take(pa.array(at[k : k + 1024]))
                x = matrix(part.column("embedding"))
                x = x / np.abs(x).max(axis=1, keepdims=True)
                found = caps[dim].decode(x / np.linalg.norm(x, axis=1, keepdims=True))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(np.full(len(x), dim, np.int32)), found], [*names, "dim", "filters"])


def _shares_earlier(lists: list[np.ndarray], rows: np.ndarray, columns: np.ndarray, this: int) -> np.ndarray:
    """Whether row and column members have a filter before ``this`` in common, as a matrix."""
    counts = [int(np.searchsorted(x, this)) for x in lists]
    member = np.repeat(np.arange(len(lists)), counts)
    ids, at, times = np.unique(np.concatenate([x[:n] for x, n in zip(lists, counts)]), return_inverse=True, return_counts=True)
    keep = times[at] > 1
    member, at = member[keep], np.unique(at[keep], return_inverse=True)[1]
    shared = np.zeros((len(rows), len(columns)), bool)
    for start in range(0, int(at.max(initial=-1)) + 1, 2048):
        part = (at >= start) & (at < start + 2048)
        held = np.zeros((len(lists), 2048), np.float32)
        held[member[part], at[part] - start] = 1
        shared |= held[rows] @ held[columns].T > 0
    return shared


def _candidates(unit: np.ndarray, bounds: np.ndarray, cosine: float, small: int = 24) -> np.ndarray:
    """Groups that may hold a pair: those over ``small`` rows, and smaller ones with a pair close enough."""
    sizes = np.diff(bounds)
    wanted = sizes > small
    start = np.repeat(bounds[:-1], sizes)
    before = np.arange(len(start)) - start
    before[np.repeat(wanted, sizes)] = 0
    ends = np.cumsum(before)
    first = 0
    while first < len(ends):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + 200_000, "right")))
        n = before[first:last]
        left = np.repeat(np.arange(first, last), n)
        right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[first:last], n)
        close = np.einsum("ij,ij->i", unit[left], unit[right]) >= cosine - 1e-9
        wanted[np.searchsorted(bounds, left[close], "right") - 1] = True
        first = last
    return np.flatnonzero(wanted)


def _verified(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows (rep, mark, n): links of a vector found here; rows (rep, peer): a spanning tree of the links."""
    keys = ["dim", "filter", "i", "j"]
    for table, bounds in runs(batches, keys):
        dims = table.column("dim").to_numpy()[bounds[:-1]]
        for dim in np.unique(dims):
            of = np.flatnonzero(dims == dim)
            first, last = of[0], of[-1] + 1  # rows are sorted by dim first
            yield _verified_part(table.slice(bounds[first], bounds[last] - bounds[first]), bounds[first : last + 1] - bounds[first], cosine)


def _verified_part(table: pa.Table, bounds: np.ndarray, cosine: float) -> pa.RecordBatch:
    x = matrix(table.column("embedding"))
    x = x / np.abs(x).max(axis=1, keepdims=True)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    rep, mark, copies, this, i, j, own = (table.column(c).to_numpy() for c in ("rep", "mark", "copies", "filter", "i", "j", "own"))
    lists = table.column("filters").combine_chunks()
    links, a, b = np.zeros(len(rep), np.int64), [], []
    for g in _candidates(unit, bounds, cosine).tolist():
        s, e = int(bounds[g]), int(bounds[g + 1])
        every = np.arange(e - s)
        rows, columns = (every, every) if i[s] == j[s] else (np.flatnonzero(own[s:e] == i[s]), np.flatnonzero(own[s:e] == j[s]))
        near = unit[s + rows] @ unit[s + columns].T >= cosine
        if i[s] == j[s]:
            near = np.triu(near, 1)
        if not near.any():
            continue
        # a pair counts in the first filter that both have, and only there
        near &= ~_shares_earlier([np.array(lists[k].values) for k in range(s, e)], rows, columns, int(this[s]))
        r, c = np.nonzero(near)
        if len(r):
            np.add.at(links, s + rows, near @ copies[s + columns])
            np.add.at(links, s + columns, near.T @ copies[s + rows])
            node, root = spanning(rep[s + rows[r]], rep[s + columns[c]])
            a.append(node)
            b.append(root)
    hit = np.flatnonzero(links)
    node, root = spanning(np.concatenate([np.zeros(0, np.int64), *a]), np.concatenate([np.zeros(0, np.int64), *b]))
    empty = lambda n: pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([pa.array(rep[hit]), pa.array(node)]), pa.concat_arrays([pa.array(mark[hit]), empty(len(node))]),
            pa.concat_arrays([empty(len(hit)), pa.array(root)]), pa.concat_arrays([pa.array(links[hit]), empty(len(node))]),
        ],
        ["rep", "mark", "peer", "n"],
    )


def link_embeddings(rows: DataFrame, cosine: float = 0.9, filters: int = 8, code_size: int = 128, repeats: int = 12, block: int = 1024, seed: int = 1) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Vectors link if their cosine, in double precision, is ``cosine`` or more and they share a
    filter. Equal vectors are one class with a count from the start. A vector gets about
    ``filters`` of code_size^2 directions in each of ``repeats`` codes, and its nearest one in
    any case; a direction gets about rows * filters / code_size^2 vectors, so ``code_size`` should
    grow as the square root of the table. Over 0.999 of pairs of cosine 0.901 share a filter
    (test), and more of closer ones. A filter with over ``block`` vectors is verified in pairs of blocks. A pair counts in its first common filter
    only; tasks return counts per vector and spanning trees, never the pairs.

    Vectors that are null, empty or zero, or hold a null or non-finite component, link with
    nothing, nor do rows without vec_id (kept false, component null). Vectors of different
    length don't link. Rows that share a vec_id are one node of the graph. Other columns are
    not read. An empty table gives no rows.
    """
    ship(rows.sparkSession)
    marked = rows.select("vec_id", "embedding", F.xxhash64("embedding").alias("mark"), F.xxhash64(F.lit(1), "embedding").alias("mark2"))
    sound = marked.where(F.col("vec_id").isNotNull() & vectors(F.col("embedding")))
    classes = sound.groupBy("mark", "mark2").agg(F.min("vec_id").alias("rep"), F.min_by("embedding", "vec_id").alias("embedding"), F.count(F.lit(1)).alias("copies"))
    schema = classes.select("rep", "mark", "copies", "embedding").schema.add("dim", "integer")
    decoded = classes.select("rep", "mark", "copies", "embedding").mapInArrow(
        lambda it: _decoded(it, filters, code_size, repeats, seed), f"rep long, mark long, copies long, embedding {schema['embedding'].dataType.simpleString()}, dim int, filters array<int>"
    )
    decoded = stored(decoded)
    narrow = decoded.select("rep", "mark", "dim", F.explode("filters").alias("filter"))
    dealt = dealt_blocks(narrow, ["dim", "filter"], F.struct("rep", "mark"), block).drop("members")
    met = grouped(dealt.join(decoded.drop("dim"), ["rep", "mark"]), ["dim", "filter", "i", "j"])
    found = stored(met.mapInArrow(lambda it: _verified(it, cosine), "rep long, mark long, peer long, n long"))
    links = found.where("peer is null").groupBy("rep", "mark").agg(F.sum("n").alias("n"))
    reached = components(found.where("peer is not null").select(F.col("rep").alias("a"), F.col("peer").alias("b")))
    classes = classes.select("mark", "mark2", "rep", "copies").join(links, ["rep", "mark"], "left").join(reached.select(F.col("node").alias("rep"), "component"), "rep", "left")
    classes = stored(classes.select("mark", "mark2", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    usable = F.col("vec_id").isNotNull() & vectors(F.col("embedding"))
    out = marked.select("vec_id", "mark", "mark2", usable.alias("usable")).join(classes, ["mark", "mark2"], "left")
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id", F.when(F.col("usable"), F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT vec_id, (SELECT count(*) FROM link WHERE a = vec_id) AS n_links,
       least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS kept
FROM embeddings
"""


@query("op2_embedding_dedup", _SQL)
def op2_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return link_embeddings(read(spark, folder, "embeddings"))
