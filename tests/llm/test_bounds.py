"""Stated bounds hold where one id, row or label repeats very often, and both sides of each switch give equal rows."""

import math

import numpy as np
import pytest
from llm.fixtures import ROWS, documents
from pyspark.sql import functions as F

from lodeworks.llm import bpe, caps, graph, lines, ordinal, packing, quality, spans, wordbpe
from lodeworks.llm.textfeatures import TextFeatures


def test_a_label_brings_one_row_however_often_its_document_repeats(spark):
    docs = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("same text "), F.col("id") % 3).alias("text"))
    docs = docs.unionByName(spark.range(2, 9).select(F.col("id").alias("doc_id"), F.lit("other").alias("text")))
    labels = spark.createDataFrame([(1, 0), (1, 0), (1, 1), (2, 1), (77, 1), (None, 0)], "doc_id long, toxic int")
    got = ordinal.sample(docs, labels, [F.col("toxic")], 100).select("doc", "toxic").collect()
    assert sorted(map(tuple, got)) == [(1, 0), (1, 1), (2, 1)]


def test_equal_rows_are_dealt_over_all_blocks(spark):
    docs = spark.range(0, 20_000, 1, 8).select(F.lit(None).cast("long").alias("doc_id"), F.lit("one and the same short text").alias("text"))
    rows = packing.pack(docs, capacity=256, windows=8).withColumn("block", F.shiftright("sequence_id", 32))
    sizes = [r[1] for r in rows.groupBy("block").agg(F.sum("length")).collect()]
    assert max(sizes) < 2 * 256 * 8 and sum(sizes) == rows.agg(F.sum("doc_tokens")).first()[0]


def test_vectors_of_one_id_are_dealt_over_all_shards(spark):
    rows = spark.range(6000).select(F.lit(20).cast("long").alias("vec_id"), F.xxhash64("id").alias("mark"))
    counts = [r["count"] for r in rows.groupBy(graph.dealt_to(F.lit(6), 3)).count().collect()]
    assert len(counts) == 6 and max(counts) < 1200


def test_many_equal_rows_keep_their_lines_and_sentences(spark):
    """A third of all rows alike in id and text: each is cleaned like one of them."""
    first = "A first line that all of them hold. It goes on for some more words, as it should. And a third sentence ends it all here."
    rows = [(1, first)] + [(2, first + "\nA line of its own.")] * 300 + [(k, f"number {k} stands alone") for k in range(10, 600)]
    docs = documents(spark, rows)
    assert {r.text for r in lines.dedup_lines(docs).where("doc_id = 2").collect()} == {"A line of its own."}
    left = [r.text for r in spans.dedup_spans(docs).where("doc_id = 2").collect()]
    assert len(left) == 300 and {t.strip() for t in left} == {"A line of its own."}


def test_whole_runs_of_marks_are_features():
    style = TextFeatures(style=True)
    assert set(style.of("a " + "-" * 9)) != set(style.of("a " + "-" * 30))


def test_short_and_long_words_are_merged_alike(monkeypatch):
    import public_tokenizers

    v = wordbpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdeinorst"), n)) for n in (1, 2, 3, 7, 20, 47, 48, 49, 80)] + ["ab" * 40, "z" * 60, "internationalisation" * 3]
    found = []
    for short in (0, 1000):
        monkeypatch.setattr(bpe, "_SHORT", short)
        found.append([bpe.merged(w, v) for w in words])
    assert found[0] == found[1]


@pytest.mark.parametrize("few", [0, 99])
def test_links_are_the_same_with_caps_of_either_kind(spark, monkeypatch, few):
    """Vectors of 12 to 20 components, linked by product codes and by single directions, as brute force links them."""
    monkeypatch.setattr(caps, "_FEW", few)
    rng = np.random.default_rng(6)
    for dim in (12, 20):
        base = rng.standard_normal((60, dim))
        x = np.repeat(base, 4, axis=0) + 0.22 * rng.standard_normal((240, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        c = caps.Caps(dim, 8, 128 if few == 0 else 16, 12, 1)
        lists = [set(f) for f in c.decode(x).to_pylist()]
        near = [(a, b) for a in range(240) for b in range(a) if x[a] @ x[b] >= 0.9]
        assert len(near) > 100 and all(lists[a] & lists[b] for a, b in near)


def test_planted_links_are_those_of_brute_force(spark):
    """Groups at cosines about the threshold, one of them large, among the vectors of the given table."""
    rng = np.random.default_rng(8)
    given = np.array([r[0] for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("embedding").limit(150).collect()], float)
    noise = rng.standard_normal((120, given.shape[1]))
    noise *= rng.uniform(0.3, 0.55, (120, 1)) * np.linalg.norm(given[:1]) / np.linalg.norm(noise, axis=1, keepdims=True)
    x = np.r_[given, given[:60] + noise[:60], given[0] + noise[60:]]
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    label = np.arange(len(x))
    while (low := np.array([label[n].min() for n in near])).tolist() != label.tolist():
        label = low
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in caps.link_embeddings(rows).collect()}
    assert near.sum() > 2 * len(x)
    assert got == {k: (int(near[k].sum()) - 1, int(label[k]), bool(label[k] == k)) for k in range(len(x))}


def test_quality_scores_are_those_of_plain_python(spark):
    """Expected grades, tails and what is kept, of a table with every awkward row."""
    rng = np.random.default_rng(3)
    names = sorted({f for _, t in ROWS for f in quality.STYLE.of(t or "")})
    model = ordinal.Ordinal({f: float(w) for f, w in zip(names, rng.normal(size=len(names)))}, (-1.5, 0.25, 3.0))
    got = [(r.doc_id, round(r.expected_grade, 6), [round(x, 6) for x in r.tails], r.keep) for r in quality.quality_scores(documents(spark), model, least=2, keep=0.4).collect()]
    want = []
    for d, t in ROWS:
        score = sum(model.weights[f] * v for f, v in quality.STYLE.of(t or "").items())
        tails = [1 / (1 + math.exp(min(500, max(-500, theta - score)))) for theta in model.thresholds]
        want.append((d, round(sum(tails), 6), [round(x, 6) for x in tails], tails[1] >= 0.4))
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = quality.select_quality(documents(spark), model, least=2, keep=0.4)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(w[0]) for w in want if w[3]) and kept.columns == documents(spark).columns
    assert quality.quality_scores(documents(spark, []), model).collect() == []


def test_encoding_of_null_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (None, "a b")], "doc_id long, text string")
    got = {(r.doc_id, r.n_tokens, r.decoded_sha256) for r in bpe.encoding_report(docs).collect()}
    assert {(d, n) for d, n, _ in got} >= {(1, 0), (2, 0)} and len({s for d, _, s in got if d in (1, 2)}) == 1


def test_names_with_backticks_pass_through(spark):
    docs = documents(spark, [(1, "a line"), (2, "another")]).withColumnRenamed("lang", "la`ng")
    assert lines.dedup_lines(docs).columns == docs.columns
