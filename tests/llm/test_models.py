"""Ordinal regression, packing, encoding, embedding dedup and nearest neighbours."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.fixtures import LONG, ROWS, by_id, documents, sha
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodeworks.llm import bpe, caps, graph, ordinal, packing, quality, toxicity, wordbpe

LARGER = "/root/testdata/sf0.1"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return wordbpe.Vocabulary(PATH)


def test_thresholds_are_ordered_and_shared_weights_are_found():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 4, (3000, 5)).astype(float)
    score = x @ np.array([2.0, -1.5, 0, 0, 1.0]) + rng.logistic(size=3000)
    grades = (score > -1).astype(int) + (score > 2) + (score > 6)
    rows = ordinal.Sparse.of([{k: v for k, v in enumerate(r) if v} for r in x])
    m = ordinal.fit(rows, grades)
    assert list(m.thresholds) == sorted(m.thresholds)
    assert abs(m.weights[0] - 2) < 0.3 and abs(m.weights[1] + 1.5) < 0.3 and abs(m.weights.get(2, 0)) < 0.2
    assert np.allclose(m.thresholds, [-1, 2, 6], atol=0.5)
    tails = m.tails(np.array([-3.0, 0.0, 5.0]))
    assert (np.diff(tails, axis=1) < 0).all() and (np.diff(tails, axis=0) > 0).all()


def test_model_without_rows_or_with_one_grade():
    for rows, grades in (([], []), ([{1: 1.0}] * 5, [0] * 5)):
        m = ordinal.fit(ordinal.Sparse.of(rows), np.array(grades, int))
        assert m.weights == {} and len(m.thresholds) == 1


def _held_out(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    known = docs.join(labels, "doc_id", "left_semi")
    return known, labels.where("doc_id % 3 > 0"), labels.where("doc_id % 3 = 0")


def test_toxicity_on_held_out_labels(spark):
    docs, seen, unseen = _held_out(spark)
    model = toxicity.train_toxicity(docs, seen)
    assert len(model.thresholds) == 2
    found = toxicity.toxicity_scores(docs, model).withColumnRenamed("toxic", "said").join(unseen, "doc_id").collect()
    toxic, clean = [r.said for r in found if r.toxic], [r.said for r in found if not r.toxic]
    # one in ten of these labels is of a text, junk mostly, that holds no word to tell it by
    assert np.mean(toxic) > 0.88 and np.mean(clean) < 0.01
    assert all(r.p_toxic >= r.p_severe and abs(r.expected_severity - r.p_toxic - r.p_severe) < 1e-9 for r in found)


def test_quality_on_held_out_labels(spark):
    docs, seen, unseen = _held_out(spark)
    model = quality.train_quality(docs, quality.graded(seen))
    found = quality.quality_scores(docs, model).join(unseen, "doc_id").collect()
    clean, poor = [r.keep for r in found if r.quality and not r.toxic], [r.keep for r in found if not r.quality]
    assert np.mean(clean) > 0.98 and np.mean(poor) < 0.08


def test_scores_of_awkward_documents(spark):
    docs = documents(spark)
    for module, labels in ((toxicity, [(0, 0), (5, 1), (4, 0), (None, 1), (99, 1), (3, None)]),):
        table = spark.createDataFrame(labels, "doc_id long, toxic int")
        model = module.train_toxicity(docs, table)
        assert module.toxicity_scores(docs, model).count() == len(ROWS)
        assert module.reject_toxic(docs, model, 1.1).collect() and module.reject_toxic(docs, model, 1.1).columns == docs.columns
        assert module.toxicity_scores(docs.limit(0), model).collect() == []
        model = module.train_toxicity(docs, table.limit(0))
        assert module.reject_toxic(docs, model).count() == len(ROWS)
    kept = quality.select_quality(docs, ordinal.Ordinal({}, (-9.0,)))
    assert kept.columns == docs.columns and kept.count() == len(ROWS)


def test_fast_scores_are_the_features_times_the_weights():
    texts = [t or "" for _, t in ROWS]
    for features in (toxicity.WORDS, quality.STYLE):
        weights = {f: (k % 7) - 3.0 for k, f in enumerate(sorted({f for t in texts for f in features.of(t)})) if k % 2}
        want = [sum(weights.get(f, 0) * v for f, v in features.of(t).items()) for t in texts]
        assert np.allclose(features.scorer(weights, most=3)(texts), want)


@given(st.lists(st.integers(1, 99), min_size=1, max_size=60), st.integers(1, 9))
@settings(max_examples=60, deadline=None)
def test_differencing_deals_every_size_once(sizes, windows):
    window, sums = packing.differenced(np.array(sizes), windows)
    got = np.bincount(window, sizes, windows)
    assert sorted(got) == sorted(sums) and sums.sum() == sum(sizes)
    assert sums[0] - sums[-1] <= max(sizes)


def test_differencing_of_a_known_case():
    window, sums = packing.differenced(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(sums) == [14, 16]  # Karmarkar-Karp leaves 2, the best is 0
    assert packing.windows_for(np.array([6, 6, 6]), 10).max() == 2  # two windows can't hold them


def test_packing_of_whole_documents(spark, library):
    docs = documents(spark).unionByName(spark.read.parquet(f"{SMALL}/documents.parquet"), allowMissingColumns=True)
    rows = packing.pack(docs, windows=16).collect()
    pieces, want = {}, []
    for d, t in docs.select("doc_id", "text").collect():
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        for s in range(0, len(ids), 4096):
            want.append((d, s, len(ids[s : s + 4096]), zlib.crc32(np.array(ids[s : s + 4096], "<u4").tobytes()), len(ids)))
    assert by_id((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == by_id(want)
    for r in rows:
        pieces.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in pieces.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 4096
    assert sum(r.length for r in rows) / 4096 / len(pieces) > 0.93
    assert packing.pack(docs.limit(0)).collect() == []


ODD = [t or "" for _, t in ROWS] + [
    "Hi <|endoftext|> It's ΣΑΣ İx K don't 12a ½ … b 'S ' ''s _x <|startoftext|>é É<|endoftext|>s <|ENDOFTEXT|> a<|endoftext|>b",
    "ab" * 3000 + " 日本語 🎉🎉 " + "th" * 60, "é ẛ̣ ﬁ  x　y", "<|endoftext|>" * 3, "'s'S 'LL'd",
]


def test_encoding_report(spark, library):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "no id"), (1, "same id")]
    docs = documents(spark, rows)
    want = []
    for d, t in rows:
        ids = library.encode(t, add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha(library.decode(ids, skip_special_tokens=False))))
    for words in (50_000, 3):  # with and without a lexicon worth the name
        assert by_id(tuple(r) for r in bpe.encoding_report(docs, words=words).collect()) == by_id(want)
    r = {r.doc_id: r for r in bpe.encode_documents(docs).collect()}[0]
    assert r.ids == library.encode(ODD[0], add_special_tokens=False).ids
    assert bpe.encoding_report(docs.limit(0)).collect() == []


@given(st.text(st.sampled_from("ab th'sé日1 .-_ΣK\n"), max_size=80))
@settings(max_examples=300, deadline=None)
def test_any_text_encodes_as_by_the_library(library, vocabulary, text):
    encoder = wordbpe.Encoder(vocabulary, lambda ws: [np.array(bpe.merged(w, vocabulary), "<u4").tobytes() for w in ws], most=5)
    packer = wordbpe.Encoder(vocabulary, packing._library(PATH, vocabulary))
    assert packer.encode([text]) == encoder.encode([text])
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 2**32 - 1), max_size=3), max_size=40), st.lists(st.binary(max_size=7), max_size=20))
@settings(max_examples=100, deadline=None)
def test_transducer_finds_its_words_and_no_others(words, others):
    t = bpe.Transducer.mapped(bpe.Transducer.compile(words).packed())
    asked = [*words, *others, b""]
    got = t.find(asked)
    assert [None if x is None else np.frombuffer(x, "<u4").tolist() for x in got] == [words.get(w) for w in asked]


def test_transducer_shares_suffixes():
    words = {f"{a}{b}ing".encode(): [1] for a in "abcdef" for b in "xyz"}
    assert len(bpe.Transducer.compile(words).final) == 6


def _vectors(n=400, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)).astype(np.float32)
    x[50:200] = x[0] + 0.15 * rng.standard_normal((150, dim)).astype(np.float32)  # near copies
    x[200:260] = x[1]  # copies
    x[260] = 2 * x[1]
    x[261], x[262, 3], x[263, 0] = 0, np.nan, np.inf
    return x


def _table(spark, x):
    rows = [(k, [float(v) for v in r], k % 3) for k, r in enumerate(x)]
    odd = [(900, None, 0), (901, [], 1), (902, [1.0, None], 1), (903, [1.0, 2.0], 1), (904, [2.0, 4.0], 1), (None, [float(v) for v in x[0]], 1), (5, [float(v) for v in x[5]], 2)]
    return spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit("clash"))


def test_embedding_links(spark):
    x = _vectors()
    table = _table(spark, x)
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    sound = [k for k, (i, e) in enumerate(rows) if i is not None and e and all(v is not None and np.isfinite(v) for v in e) and any(e)]
    unit = {k: np.array(rows[k][1], float) / np.linalg.norm(rows[k][1]) for k in sound}
    near = {k: [j for j in sound if j != k and len(unit[j]) == len(unit[k]) and unit[k] @ unit[j] >= 0.9] for k in sound}
    label = {k: rows[k][0] for k in sound}
    changed = True
    while changed:
        changed = False
        for k in sound:
            low = min([label[k], *[label[j] for j in near[k]]])
            if low < label[k]:
                label[k], changed = low, True
    want = by_id((i, len(near.get(k, [])), label.get(k, i), i is not None and label.get(k, i) == i) for k, (i, _) in enumerate(rows))
    for block in (1024, 30):  # also with filters cut into blocks
        assert by_id(tuple(r) for r in caps.link_embeddings(table, block=block).collect()) == want
    assert caps.link_embeddings(table.limit(0)).collect() == []


@pytest.mark.parametrize("dim", [1, 2, 5, 16, 33])
def test_decoding_lists_every_direction_over_the_threshold(dim):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((40, dim))
    x[0], x[0, 0] = 0, 1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c = caps.Code(dim, 24, 60, 1)
    if len(c.tables) == 1:
        want = x @ c.tables[0].T >= c.cut
    else:
        a, b = c.tables
        want = (x @ c.turn) @ np.concatenate([np.repeat(a, 60, 0), np.tile(b, (60, 1))], 1).T >= c.cut
    row, number = c.decode(x)
    assert np.array_equal([row, number], np.nonzero(want))
    assert 8 * 40 < len(row) < 60 * 40
    lists = caps.Caps(dim, 4, 60, 3, 1).decode(x).to_pylist()
    assert len(lists) == 40 and all(f == sorted(set(f)) for f in lists)


def test_pairs_at_the_threshold_share_a_filter():
    rng = np.random.default_rng(6)
    a = rng.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2000, 64))
    b -= (b * a).sum(1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * b / np.linalg.norm(b, axis=1, keepdims=True)
    c = caps.Caps(64, 4, 128, 8, 1)
    shared = [bool({*x} & {*y}) for x, y in zip(c.decode(a).to_pylist(), c.decode(b).to_pylist())]
    assert np.mean(shared) > 0.98


def _nearest(rows, top):
    """The exact answer: (query_id, rank, vec_id, score)."""
    sound = {(i, tuple(e)) for i, e in rows if i is not None and e and all(v is not None and np.isfinite(v) for v in e) and any(e)}
    out = []
    for q, e in sound:
        if q % 20 == 0:
            found = sorted((-float(np.dot(e, f)), i) for i, f in sound if i != q and len(f) == len(e))
            out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(found[:top])]
    return out


def test_nearest_neighbours(spark):
    x = _vectors(600, 24)
    x[300:] *= np.linspace(0.5, 2, 300)[:, None].astype(np.float32)  # lengths differ, and products with them
    table = _table(spark, x)
    want = {(q, i): s for q, _, i, s in _nearest([(r.vec_id, r.embedding) for r in table.collect()], 20)}
    got = graph.nearest(table, table.where("vec_id % 20 = 0"), shard_rows=200, query_rows=16).collect()
    ranks: dict = {}
    for r in got:
        ranks.setdefault(r.query_id, []).append((r["rank"], -r.score, r.vec_id))
    assert all([k for k, _, _ in sorted(v)] == list(range(1, len(v) + 1)) for v in ranks.values())
    assert all([v[1:] for v in sorted(rows)] == sorted(v[1:] for v in rows) for rows in ranks.values())
    hits = sum((r.query_id, r.vec_id) in want for r in got)
    assert hits >= 0.95 * len(want) and len(got) == len(want)
    assert all(abs(want[r.query_id, r.vec_id] - r.score) < 1e-12 for r in got if (r.query_id, r.vec_id) in want)
    assert graph.nearest(table.limit(0), table.limit(0)).collect() == []
    assert graph.nearest(table.where("vec_id = 0"), table.where("vec_id = 0")).collect() == []


def test_recall_on_the_given_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = {(q, i) for q, _, i, _ in _nearest([(r.vec_id, r.embedding) for r in rows.collect()], 20)}
    got = {(r.query_id, r.vec_id) for r in graph.nearest(rows, rows.where("vec_id % 20 = 0")).collect()}
    assert len(got & want) >= 0.95 * len(want)


def test_long_text_in_all(spark):
    docs = documents(spark, [(1, LONG * 3)])
    assert bpe.encoding_report(docs).first().n_tokens == packing.pack(docs).agg(F.sum("length")).first()[0] - 1
