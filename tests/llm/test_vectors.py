"""Pairs at the threshold are linked, and a few very long vectors hide no neighbours."""

import numpy as np
import pytest

from lodeworks.llm import caps, graph


def _table(spark, x):
    return spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")


def _unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pairs(n, dim):
    rng = np.random.default_rng(11)
    a, b = _unit(rng.standard_normal((n, dim))), rng.standard_normal((n, dim))
    return a, 0.901 * a + np.sqrt(1 - 0.901**2) * _unit(b - (b * a).sum(1, keepdims=True) * a)


def test_pairs_at_the_threshold_are_linked(spark):
    a, b = _pairs(1000, 64)
    got = caps.link_embeddings(_table(spark, np.r_[a, b])).select("vec_id", "n_links", "component_id").collect()
    assert all(r.n_links == 1 and r.component_id == r.vec_id % 1000 for r in got) and len(got) == 2000


@pytest.mark.parametrize("dim", [16, 64, 768])
def test_more_than_0_999_of_pairs_share_a_filter(dim):
    a, b = _pairs(2000, dim)
    c = caps.Caps(dim, 8, 128, 12, 1)
    filters = [[f for k in range(0, 2000, 500) for f in c.decode(x[k : k + 500]).to_pylist()] for x in (a, b)]
    assert np.mean([bool({*x} & {*y}) for x, y in zip(*filters)]) > 0.999


def test_every_vector_has_a_cap_in_every_code():
    rng = np.random.default_rng(5)
    for dim in (3, 64):
        lists = caps.Caps(dim, 1, 16, 3, 1).decode(_unit(rng.standard_normal((500, dim)))).to_pylist()
        assert min(map(len, lists)) >= 3 and all(x == sorted({*x}) for x in lists)


@pytest.mark.parametrize("factor", [1e4, 1e8, 1e25])
def test_long_vectors_hide_no_neighbours(spark, factor):
    rng = np.random.default_rng(2)
    x = _unit(rng.standard_normal((40, 32)))[rng.integers(0, 40, 1500)] + 0.15 * rng.standard_normal((1500, 32))
    x[[7, 401, 902]] *= factor
    rows = _table(spark, x)
    got = {(r.query_id, r.vec_id) for r in graph.nearest(rows, rows.where("vec_id % 20 = 0"), shard_rows=800).collect()}
    product = x @ x.T
    np.fill_diagonal(product, -np.inf)
    want = {(q, int(i)) for q in range(0, 1500, 20) for i in np.argsort(-product[q])[:20]}
    assert len(got) == len(want) and len(got & want) >= 0.95 * len(want)
