"""Approximate nearest neighbours: a robust-pruned directed graph per shard, searched by beams.

Inner products become distances by one more component, sqrt(M^2 - |x|^2) with M the largest
norm of the shard, and 0 for queries: the nearest point is then the one with the largest
product. A shard holds vectors of like norm, scaled to components of at most 1, and distances
are in double precision, so that no long vector rounds the others' products away. All searches and prunings run for many points at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeworks.llm.common import matrix, ship, stored, vectors
from lodeworks.llm.registry import query, read


#: Components of candidates that are pruned at a time.
_PRUNED = 2_000_000


@dataclass(frozen=True)
class Build:
    """Out-degree, beam of the searches that propose neighbours, relaxation of the pruning, seed."""

    degree: int = 32
    beam: int = 80
    alpha: float = 1.2
    seed: int = 1


def beam_search(points: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int, wide: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest points each query has met, nearest first, and their squared distances.

    ``edges`` holds the out-neighbours of each point, -1 where there is none. Each round
    expands the ``wide`` nearest points of every beam that are not expanded yet. Missing
    places are -1 at infinite distance.
    """
    n, q = len(points), len(queries)
    norms = np.einsum("ij,ij->i", points, points)
    own = np.einsum("ij,ij->i", queries, queries)
    met = np.zeros((q, n + 1), bool)  # the last column takes missing neighbours
    met[:, n] = True
    ids, dist = np.full((q, beam), -1), np.full((q, beam), np.inf)
    done = np.ones((q, beam), bool)
    ids[:, 0], done[:, 0] = entry, False
    dist[:, 0] = norms[entry] + own - 2 * queries @ points[entry]
    met[:, entry] = True
    active = np.arange(q)
    while len(active):
        # beams are in order, so the first open places are the nearest
        open_ = ~done[active]
        rank = np.cumsum(open_, axis=1)
        pick = open_ & (rank <= wide)
        r, c = np.nonzero(pick)
        done[active[r], c] = True
        near = edges[ids[active[r], c]]
        row = np.repeat(active[r], near.shape[1])
        near = near.ravel()
        fresh = ~met[row, near]
        row, near = row[fresh], near[fresh]
        _, first = np.unique(row * (n + 1) + near, return_index=True)
        row, near = row[first], near[first]  # sorted by row
        met[row, near] = True
        d = norms[near] + own[row] - 2 * np.einsum("ij,ij->i", points[near], queries[row])
        counts = np.bincount(row, minlength=q)[active]
        width = int(counts.max(initial=0))
        if width:
            place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            at = np.searchsorted(active, row)
            new_ids, new_dist = np.full((len(active), width), -1), np.full((len(active), width), np.inf)
            new_ids[at, place], new_dist[at, place] = near, d
            all_ids, all_dist = np.concatenate([ids[active], new_ids], 1), np.concatenate([dist[active], new_dist], 1)
            all_done = np.concatenate([done[active], new_ids < 0], 1)
            order = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
            take = lambda x: np.take_along_axis(x, order, 1)
            ids[active], dist[active], done[active] = take(all_ids), take(all_dist), take(all_done)
        active = active[(~done[active]).any(1)]
    return ids, dist


def robust_prune(points: np.ndarray, of: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each point, diverse neighbours out of its row of candidates (-1: none).

    The nearest candidate is taken, and those go that are, by the factor alpha, nearer to it
    than to the point; again until ``degree`` are taken or none is left.
    """
    b, width = candidates.shape
    some = max(1, _PRUNED // (width * points.shape[1]))
    if b > some:
        return np.concatenate([robust_prune(points, of[k : k + some], candidates[k : k + some], degree, alpha) for k in range(0, b, some)])
    v = points[candidates]
    d = ((v - points[of][:, None, :]) ** 2).sum(2)
    d[(candidates < 0) | (candidates == of[:, None])] = np.inf
    order = np.argsort(d, axis=1, kind="stable")
    candidates, d = np.take_along_axis(candidates, order, 1), np.take_along_axis(d, order, 1)
    v = np.take_along_axis(v, order[:, :, None], 1)
    square = np.einsum("bij,bij->bi", v, v)
    between = square[:, :, None] + square[:, None, :] - 2 * v @ v.transpose(0, 2, 1)
    alive = np.isfinite(d)
    alive[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]  # equal candidates are neighbours in this order
    out, every = np.full((b, degree), -1), np.arange(b)
    for k in range(degree):
        some = alive.any(1)
        if not some.any():
            break
        best = alive.argmax(1)
        out[:, k] = np.where(some, candidates[every, best], -1)
        alive &= alpha * alpha * between[every, best] > d
        alive[every, best] = False
    return out


def build_graph(points: np.ndarray, p: Build) -> tuple[np.ndarray, int]:
    """Out-neighbours of each point, and the entry (the point nearest to the mean).

    Points are inserted in random order, in batches that double: a beam search over the graph
    so far proposes neighbours, pruning picks from them, and each neighbour gets the way back,
    pruned again where it has too many.
    """
    n = len(points)
    entry = int(((points - points.mean(0)) ** 2).sum(1).argmin())
    edges = np.full((n, p.degree), -1)
    order = np.random.default_rng(p.seed).permutation(n)
    order = np.r_[entry, order[order != entry]]
    start = 1
    while start < n:
        part = order[start : start + min(start, 256)]
        ids, _ = beam_search(points, edges, entry, points[part], p.beam)
        edges[part] = robust_prune(points, part, ids, p.degree, p.alpha)
        source = np.repeat(part, p.degree)
        target = edges[part].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        at, first, counts = np.unique(target, return_index=True, return_counts=True)
        # many ways back at once are taken in turns of one degree, so that no row of candidates grows with the batch
        for turn in range(0, int(counts.max(initial=0)), p.degree):
            some = counts > turn
            new = np.full((int(some.sum()), p.degree), -1)
            left = np.minimum(counts[some] - turn, p.degree)
            r = np.repeat(np.arange(len(left)), left)
            c = np.arange(left.sum()) - np.repeat(np.cumsum(left) - left, left)
            new[r, c] = source[np.repeat(first[some] + turn, left) + c]
            both = np.concatenate([edges[at[some]], new], 1)
            both = np.where(both >= 0, both, -1)
            fits = (both >= 0).sum(1) <= p.degree
            rows = at[some]
            packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, : p.degree]
            edges[rows[fits]] = packed[fits]
            for k in range(0, int((~fits).sum()), 256):
                full = np.flatnonzero(~fits)[k : k + 256]
                edges[rows[full]] = robust_prune(points, rows[full], both[full], p.degree, p.alpha)
        start += len(part)
    return edges, entry


def scaled(x: np.ndarray, axis: int | None = None) -> np.ndarray:
    """The same directions with the largest component 1, of the whole or of each row."""
    return x / np.abs(x).max(axis=axis, keepdims=True)


def lifted(x: np.ndarray) -> np.ndarray:
    """Points whose squared distances to (query, 0) fall as the inner products rise."""
    x = scaled(x)
    square = np.einsum("ij,ij->i", x, x)
    return np.c_[x, np.sqrt(np.maximum(square.max() - square, 0))]


def _graph(table: pa.Table, p: Build, top: int) -> pa.Table:
    """One row per distinct vector of a shard: its vec_ids, the vector, its edges."""
    x = matrix(table.column("embedding"))
    ids = table.column("vec_id").to_numpy()
    order = np.lexsort([ids, *x.T[::-1]])
    x, ids = x[order], ids[order]
    starts = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]).any(1)])
    edges, entry = build_graph(lifted(x[starts]), p)
    ends = np.r_[starts[1:], len(x)]
    n = len(starts)
    # of equal vectors the smallest ids come first, and one more than asked for can never be needed
    lists = [ids[s:e][: top + 1] for s, e in zip(starts.tolist(), ends.tolist())]
    return pa.table({
        "shard": pa.array(np.full(n, table.column("shard")[0].as_py()), pa.int64()), "band": pa.array(np.full(n, table.column("band")[0].as_py()), pa.int64()), "dim": pa.array(np.full(n, x.shape[1]), pa.int32()), "node": pa.array(np.arange(n), pa.int32()),
        "ids": pa.array(lists, pa.list_(pa.int64())), "embedding": table.column("embedding").combine_chunks().take(pa.array(order[starts])),
        "edges": pa.array([e[e >= 0] for e in edges.astype(np.int32)], pa.list_(pa.int32())), "entry": pa.array(np.arange(n) == entry),
    })


_FOUND = pa.schema([("query_id", pa.int64()), ("mark", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search(graph: pa.Table, queries: pa.Table, p: Build, beam: int, top: int) -> pa.Table:
    if not graph.num_rows or not queries.num_rows:
        return _FOUND.empty_table()
    graph = graph.sort_by("node")
    x = matrix(graph.column("embedding"))
    points = lifted(x)
    entry = int(np.flatnonzero(graph.column("entry").to_numpy(zero_copy_only=False))[0])
    lists = graph.column("edges").combine_chunks()
    counts = lists.value_lengths().to_numpy(zero_copy_only=False)
    edges = np.full((len(x), p.degree), -1)
    edges[np.repeat(np.arange(len(x)), counts), np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)] = lists.flatten().to_numpy()
    held = graph.column("ids").combine_chunks()
    held_ids, held_n = held.flatten().to_numpy(), held.value_lengths().to_numpy(zero_copy_only=False)
    held_at = np.cumsum(held_n) - held_n
    q = matrix(queries.column("embedding"))
    names, marks = queries.column("vec_id").to_numpy(), queries.column("mark").to_numpy()
    out = []
    for k in range(0, len(q), 256):
        part = q[k : k + 256]
        met, _ = beam_search(points, edges, entry, np.c_[scaled(part, 1), np.zeros(len(part))], beam)
        row, place = np.nonzero(met >= 0)
        node = met[row, place]
        n = held_n[node]
        row, node = np.repeat(row, n), np.repeat(node, n)
        ids = held_ids[np.repeat(held_at[met[np.nonzero(met >= 0)]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        score = np.einsum("ij,ij->i", x[node], part[row])  # double precision, on the vectors as they came
        keep = ids != names[k + row]
        row, ids, score = row[keep], ids[keep], score[keep]
        by = np.lexsort([ids, -score, row])
        row, ids, score = row[by], ids[by], score[by]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        row, ids, score = row[rank < top], ids[rank < top], score[rank < top]
        out.append(pa.table([pa.array(names[k + row]), pa.array(marks[k + row]), pa.array(ids), pa.array(score)], schema=_FOUND))
    return pa.concat_tables(out)


def norm_band(embedding: Column) -> Column:
    """The norm's power of two, rounded, so that vectors of norm 1 are in the middle of a band."""
    x = F.transform(embedding, lambda v: F.abs(v.cast("double")))
    top = F.array_max(x)
    square = F.aggregate(x, F.lit(0.0), lambda total, v: total + (v / top) * (v / top))
    return F.round(F.log2(top) + F.log2(square) / 2).cast("long")


def dealt_to(n: Column, seed: int) -> Column:
    """One of ``n`` shards or blocks; vectors that share an id are dealt apart."""
    return F.pmod(F.xxhash64("vec_id", "mark", F.lit(seed)), n)


def nearest(rows: DataFrame, queries: DataFrame, top: int = 20, shard_rows: int = 4096, query_rows: int = 2048, beam: int = 128, build: Build = Build()) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``top`` candidates found with the largest inner product.

    Rows are banded by their norm, doubling from band to band, and go to shards of about
    ``shard_rows`` of a band by a hash of the id and the vector; each shard is one graph, written to the
    shared folder. Every query searches every shard of its length, in tasks of one
    shard and about ``query_rows`` queries, with a beam of ``beam``. The score is the inner
    product in double precision of the vectors as they came; ties go to the smaller vec_id. A
    query's own vec_id is no candidate. If there are fewer candidates, all that were found come.

    Vectors that are null, empty or zero, or hold a null or non-finite component, take no part,
    nor do rows without vec_id. Repeated rows count once. Vectors meet only those of their own
    length. If a query's vec_id has several vectors, each is a query with ranks of its own.
    Other columns are not read. Empty tables give no rows.
    """
    spark = rows.sparkSession
    ship(spark)

    def sound(df: DataFrame) -> DataFrame:
        df = df.where(F.col("vec_id").isNotNull() & vectors(F.col("embedding")))
        return df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.size("embedding").alias("dim"), F.xxhash64("embedding").alias("mark")).dropDuplicates(["vec_id", "mark"])

    points, asked = sound(rows).withColumn("band", norm_band(F.col("embedding"))), stored(sound(queries))
    # a row per length and band: these tables are as small as the spread of norms
    sizes = stored(points.groupBy("dim", "band").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("shards")))
    blocks = max(1, -(-asked.count() // query_rows))
    kind = rows.schema["embedding"].dataType.simpleString()
    dealt = points.join(sizes, ["dim", "band"]).select("vec_id", "embedding", "dim", "band", dealt_to(F.col("shards"), 3).alias("shard"))
    graphs = stored(
        dealt.groupBy("band", "shard", "dim").applyInArrow(
            lambda t: _graph(t, build, top), f"shard long, band long, dim int, node int, ids array<bigint>, embedding {kind}, edges array<int>, entry boolean"
        )
    )
    left = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.withColumn("block", dealt_to(F.lit(blocks), 4).cast("int"))
    right = right.join(sizes, "dim").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    keys = ["band", "shard", "dim", "block"]
    found = left.groupBy(*keys).cogroup(right.select("vec_id", "embedding", "mark", *keys).groupBy(*keys)).applyInArrow(
        lambda g, q: _search(g, q, build, beam, top), "query_id long, mark long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@query("op9_nearest_neighbours")
def op9_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "embeddings")
    return nearest(rows, rows.where("vec_id % 20 = 0"))
