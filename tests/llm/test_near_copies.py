"""The pipeline's near-copy stage against all pairs of five-word shingle sets."""

import sys

import numpy as np
from conftest import ROOT
from llm.fixtures import documents, lower

sys.path.insert(0, str(ROOT))

import corpus_pipeline  # noqa: E402
from lodeworks.llm import shingles  # noqa: E402
from lodeworks.llm.simhash import fingerprint  # noqa: E402


def _set(text):
    words = lower(text or "").encode().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def _similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def _planted():
    """Originals, and later copies with a few words changed: similarities on both sides of 0.8, most of 0.8 to 0.95."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(60):
        words = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        rows.append((k, " ".join(words)))
        for c, changes in enumerate((2, 4, 6, 7, 9)):
            copy = list(words)
            for at in rng.choice(300, changes, replace=False):
                copy[at] = f"changed{k}-{c}-{at}"
            rows.append((1000 + 10 * k + c, " ".join(copy).upper() if c == 1 else " ".join(copy)))
    return [*rows, (5000, None), (5001, ""), (5002, "three words only"), (5003, "Three words\nonly"), (None, rows[0][1])]


def test_the_stage_finds_every_near_copy(spark):
    rows = _planted()
    sets = [_set(t) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if label[a] != label[b] and _similarity(sets[a], sets[b]) >= 0.8:
                label = [label[b] if x == label[a] else x for x in label]
    smallest = {}
    for x, (d, _) in zip(label, rows):
        smallest[x] = min(smallest.get(x, 2**63), 2**63 - 1 if d is None else d)
    want = sorted(d for x, (d, _) in zip(label, rows) if smallest[x] == d)
    close = [_similarity(sets[6 * k], sets[6 * k + c]) for k in range(60) for c in range(1, 6)]
    assert sum(0.8 <= s <= 0.95 for s in close) > 150 and sum(s < 0.8 for s in close) > 30
    docs = documents(spark, rows)
    left = corpus_pipeline.simhash_dedup(spark, docs, "")
    assert left.dtypes == docs.dtypes and sorted(r.doc_id for r in left.select("doc_id").collect()) == want
    left = shingles.dedup_shingles(docs, block=2)  # also with bands cut into blocks
    assert sorted(r.doc_id for r in left.select("doc_id").collect()) == want


def test_fingerprints_find_what_lies_within_their_radius(spark):
    rows = [(d, t) for d, t in _planted() if d is not None]
    prints, sets = [fingerprint(t or "") for _, t in rows], [_set(t) for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    later = {max(rows[a][0], rows[b][0]) for a, b in pairs if _similarity(sets[a], sets[b]) >= 0.8}
    assert len(later) > 10
    # one band of very many min-hashes finds next to nothing
    left = {r.doc_id for r in shingles.dedup_shingles(documents(spark, rows), bands=1, rows=400).select("doc_id").collect()}
    assert not left & later and left >= {r for r, _ in rows if r < 60}


def test_pairs_at_the_threshold_share_a_band():
    rng, shared = np.random.default_rng(4), 0
    for _ in range(1500):
        x = rng.integers(-(2**63), 2**63, 100)  # 80 of 100 are in both
        keys = [shingles.band_keys(s, 32, 5) for s in (x[:90], x[10:])]
        shared += bool((keys[0] == keys[1]).any())
    assert shared == 1500
