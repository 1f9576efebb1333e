"""The whole pipeline against its stages in plain Python, and what it leaves alone."""

import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import ROOT, SMALL
from llm.fixtures import NO_ID, ROWS, brute_groups, brute_lines, brute_spans, by_id, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(ROOT))

import corpus_pipeline  # noqa: E402
from lodeworks.llm import toxicity  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The awkward documents beside the smallest given tables."""
    path = str(tmp_path_factory.mktemp("tables"))
    given = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 1000)
    documents(spark).select(*COLUMNS).unionByName(given.select(*COLUMNS)).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SMALL}/labels.parquet").withColumn("doc_id", F.col("doc_id") + 1000).write.parquet(f"{path}/labels.parquet")
    return path


def _plain(rows, model):
    left = [(d, t) for d, t in rows if sum(model.weights.get(f, 0) * v for f, v in toxicity.WORDS.of(t or "").items()) < model.thresholds[0]]
    left = [(d, None if t is None else x) for (d, t), (_, x, _, _) in zip(left, brute_lines(left))]
    first = {d for d, _, c in brute_groups(left) if d == c}
    left = [(d, t) for d, t in left if (NO_ID if d is None else d) in first]
    left = [(d, t) for (d, _), t in zip(left, brute_spans(left))]
    library, out = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for d, t in left:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        out += [(d, s, len(ids[s : s + 4096]), zlib.crc32(np.array(ids[s : s + 4096], "<u4").tobytes()), len(ids)) for s in range(0, len(ids), 4096)]
    return out


def test_pipeline_equals_its_stages_in_plain_python(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.train_toxicity(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = corpus_pipeline.run(spark, folder).collect()
    assert by_id((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == by_id(_plain(rows, model))


def test_all_stages_but_the_last_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "simhash_dedup", "substring_dedup", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).dtypes == docs.dtypes


def test_stages_take_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).collect() == []


def test_stages_keep_rows_that_are_alone(spark, folder):
    alone = documents(spark, [(k, f"Document {k} says that the number {k} has no like, so {k} stays as it is for good.") for k in range(5)])
    docs = alone.select(*COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert by_id(tuple(r) for r in stage(spark, docs, folder).collect()) == by_id(tuple(r) for r in docs.collect())
    assert len(ROWS) == 17
