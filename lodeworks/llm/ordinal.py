"""Cumulative-link ordinal regression: one weight per text feature, shared by ordered thresholds.

P(grade >= k) = 1 / (1 + exp(threshold_k - w.x)), so the thresholds cut one line of scores into grades.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.llm.common import NO_ID, document_key, ship, texts

#: Text -> hashed features and their values.
Features = Callable[[str], dict[int, float]]


@dataclass(frozen=True)
class Ordinal:
    """Weights of features, and the thresholds between neighbouring grades, in order."""

    weights: dict[int, float]
    thresholds: tuple[float, ...]

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... by column."""
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds)[None, :] - scores[:, None], -500, 500)))


@dataclass(frozen=True)
class Sparse:
    """``n`` rows of features, one entry of the arrays for each value: row, feature, value."""

    n: int
    row: np.ndarray
    feature: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, rows: list[dict[int, float]]) -> Sparse:
        counts = [len(x) for x in rows]
        features, values = [f for x in rows for f in x], [v for x in rows for v in x.values()]
        return cls(len(rows), np.repeat(np.arange(len(rows)), counts), np.array(features, np.int64), np.array(values, float))

    def only(self, features: np.ndarray) -> Sparse:
        """These features, numbered in their (rising) order."""
        at = np.minimum(np.searchsorted(features, self.feature), max(0, len(features) - 1))
        keep = features[at] == self.feature if len(features) else np.zeros(len(self.feature), bool)
        return Sparse(self.n, self.row[keep], at[keep], self.value[keep])


def telling(x: Sparse, grades: np.ndarray, least: int = 3, z: float = 4.0) -> tuple[np.ndarray, np.ndarray]:
    """Features whose mean value differs between lower and higher grades by ``z`` standard errors or more.

    Also, for each, how many times the mean of the lower grades that of the higher ones is, at
    the cut where they differ most.
    """
    ids = np.unique(x.feature)
    x = x.only(ids)
    n, m_ids = x.n, len(ids)
    best, ratio = np.zeros(m_ids), np.ones(m_ids)
    seen = np.bincount(x.feature, minlength=m_ids)
    total, square = np.bincount(x.feature, x.value, m_ids), np.bincount(x.feature, x.value**2, m_ids)
    spread = np.sqrt(np.maximum(square / max(n, 1) - (total / max(n, 1)) ** 2, 1e-12))
    for k in range(1, int(grades.max(initial=0)) + 1):
        high = grades >= k
        if 0 < (m := int(high.sum())) < n:
            inside = np.bincount(x.feature, x.value * high[x.row], m_ids)
            over, under = inside / m, (total - inside) / (n - m)
            found = np.abs(over - under) / (spread * np.sqrt(1 / m + 1 / (n - m)))
            ratio = np.where(found > best, over / np.maximum(under, 1e-9), ratio)
            best = np.maximum(best, found)
    keep = (seen >= least) & (best >= z)
    return ids[keep], ratio[keep]


def fit(x: Sparse, grades: np.ndarray, ridge: float = 1e-3, steps: int = 400, rate: float = 0.1) -> Ordinal:
    """Maximum likelihood with a ridge, by Adam; the same input gives the same model.

    Without rows, or with one grade only, the model has no weights and its thresholds give
    the shares of the grades seen (a quarter each tail, if none was).
    """
    top = max(1, int(grades.max(initial=0)))
    n = x.n
    tail = np.array([((grades >= k).sum() + 0.5) / (n + 2) for k in range(1, top + 1)])
    cuts = -np.log(tail / (1 - tail))
    chosen, _ = telling(x, grades)
    if not len(chosen):
        return Ordinal({}, tuple(np.maximum.accumulate(cuts)))
    x = x.only(chosen)
    r, c, v = x.row, x.feature, x.value
    scale = np.sqrt(np.bincount(c, v * v, len(chosen)) / n) + 1e-9
    v = v / scale[c]
    # thresholds as the first one and the logs of the gaps, so that they stay in order
    p = np.r_[np.zeros(len(chosen)), cuts[:1], np.log(np.maximum(np.diff(cuts), 0.05))]
    d, first, second = len(chosen), np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, gaps = p[:d], np.exp(np.clip(p[d + 1 :], -10, 10))
        theta = p[d] + np.r_[0, np.cumsum(gaps)]
        s = np.bincount(r, v * w[c], n)
        edge = np.concatenate([np.full((n, 1), 1.0), 1 / (1 + np.exp(np.clip(theta[None, :] - s[:, None], -50, 50))), np.zeros((n, 1))], 1)
        at = np.arange(n)
        upper, lower = edge[at, grades], edge[at, grades + 1]
        mass = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper), lower * (1 - lower)  # slopes by the score
        slope = -(du - dl) / mass / n
        g = np.zeros_like(p)
        g[:d] = np.bincount(c, v * slope[r], d) + ridge * w
        by_cut = np.array([(du / mass * (grades == k)).sum() - (dl / mass * (grades == k - 1)).sum() for k in range(1, top + 1)]) / n
        g[d] = by_cut.sum()
        g[d + 1 :] = np.cumsum(by_cut[::-1])[::-1][1:] * gaps
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        p = p - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    w = p[:d] / scale
    theta = p[d] + np.r_[0, np.cumsum(np.exp(np.clip(p[d + 1 :], -10, 10)))]
    return Ordinal({f: float(k) for f, k in zip(chosen.tolist(), w)}, tuple(map(float, theta)))


def sample(docs: DataFrame, labels: DataFrame, grade, rows: int) -> DataFrame:
    """body and grade of at most ``rows`` labelled documents, chosen by a hash of their id.

    Labels without id or grade, and those of no document, take no part. A document with
    several different labels counts once for each. Of several rows with one id, the text whose
    hash is smallest is taken, so a label brings one row, however often its document repeats.
    """
    known = labels.select(F.col("doc_id").alias("doc"), *grade).dropna()
    known = known.orderBy(F.xxhash64("doc", F.lit(11)), *[c for c in known.columns]).limit(rows)
    bodies = docs.where(F.col("doc_id").isNotNull()).select(*document_key())
    # the bound of ``rows`` rows of an id and small numbers is what makes this broadcast safe
    found = bodies.join(F.broadcast(known.distinct()), "doc")
    return found.groupBy(*known.columns).agg(F.min_by("body", "row").alias("body"))


def collected(found: DataFrame, features: Features) -> tuple[Sparse, dict[str, np.ndarray]]:
    """The sample on the driver: its features instead of the texts, and its other columns."""
    ship(found.sparkSession)
    others = [c for c in found.columns if c not in ("doc", "body")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(t) for t in texts(batch.column("body"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), *[batch.column(c) for c in others], pa.array([list(x) for x in made], pa.list_(pa.int32())), pa.array([list(x.values()) for x in made], pa.list_(pa.float32()))],
                ["doc", *others, "features", "values"],
            )

    schema = ", ".join(["doc long", *[f"{c} {found.schema[c].dataType.simpleString()}" for c in others], "features array<int>", "values array<float>"])
    table = found.mapInArrow(run, schema).toArrow().sort_by([("doc", "ascending"), *[(c, "ascending") for c in others]]).combine_chunks()
    counts = table.column("features").combine_chunks().value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lambda c, kind: table.column(c).combine_chunks().flatten().to_numpy().astype(kind)
    x = Sparse(table.num_rows, np.repeat(np.arange(table.num_rows), counts), flat("features", np.int64), flat("values", float))
    return x, {c: table.column(c).to_numpy() for c in others}


def scored(rows: DataFrame, model: Ordinal, score: Callable[[list[str]], np.ndarray]) -> DataFrame:
    """``rows`` (body and more, or ``whole`` with the text in it) without body, with expected (grade) and tails (array)."""
    whole = "body" not in rows.columns  # the text comes to Python once
    others = [c for c in rows.columns if c != "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tails = model.tails(score(texts(batch.column("whole").field("text") if whole else batch.column("body"))))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], pa.array(tails.sum(1)), pa.array(tails.tolist(), pa.list_(pa.float64()))],
                [*others, "expected", "tails"],
            )

    return rows.mapInArrow(run, rows.select(*others).schema.add("expected", "double").add("tails", T.ArrayType(T.DoubleType())))


def known_id(column: str = "doc"):
    return F.when(F.col(column) != NO_ID, F.col(column))
