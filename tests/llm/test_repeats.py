"""Repeated byte strings against a table of all windows in plain Python."""

import random
from collections import Counter

import numpy as np
import pytest
from compare import connect, difference
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.fixtures import ROWS, documents, sha

from lodeworks.llm import repeats
from lodeworks.llm.registry import QUERIES, SQL
from lodeworks.llm.textbytes import Texts


def _brute(rows, span=200):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[p : p + span] for d in data for p in range(len(d) - span + 1))
    out = []
    for (doc, _), d in zip(rows, data):
        gone = np.zeros(len(d) + 1, np.int64)
        for p in range(len(d) - span + 1):
            if seen[d[p : p + span]] > 1:
                gone[p] += 1
                gone[p + span] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        out.append((doc, len(d), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), kept))
    return out


def _words(draw, n):
    return " ".join(draw.choice(["été", "rain", "x", "over", "the", "hill", "ß", "and"]) + str(draw.randint(0, 400)) for _ in range(n))


def _made(seed=3):
    """Copies, passages of 190 to 420 bytes in many texts at all places, periodic stretches, near copies."""
    draw = random.Random(seed)
    passages = [_words(draw, n) for n in (30, 33, 40, 70)] + ["x" * 230, "ab" * 99 + "a", "tick " * 45]
    rows = [(5000 + k, _words(draw, draw.randint(0, 60)) + draw.choice(passages) + _words(draw, draw.randint(0, 60))) for k in range(60)]
    rows += [(6000 + k, rows[0][1]) for k in range(12)] + [(6100 + k, rows[1][1].replace("rain", "sun", 1 + k)) for k in range(8)]
    rows += [(6200, "z" * 199), (6201, "z" * 200), (6202, "q" * 201), (6203, "a" * 5000), (6204, passages[2] + " " + passages[2]), (None, passages[3]), (None, passages[3])]
    return rows


def _sorted(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("most", [1 << 20, 3000, 0])
def test_report_is_that_of_plain_python(spark, most):
    """Also with buckets so small that some, or all, are refined by Spark."""
    rows = [r for r in ROWS if len(r[1] or "") < 9000] + _made()
    got = [tuple(r) for r in repeats.repeat_report(documents(spark, rows), most=most).collect()]
    want = [(*b[:4], sha256(b[4])) for b in _brute(rows)]
    assert _sorted(got) == _sorted(want)
    assert sum(w[2] > 0 for w in want) > 50


def sha256(data):
    import hashlib

    return hashlib.sha256(data).hexdigest()


def test_texts_and_columns(spark):
    rows = [(1, None), (2, ""), *_made()]
    docs = documents(spark, rows)
    got = repeats.dedup_substrings(docs)
    assert got.columns == docs.columns
    want = [(d, None if t is None else b[4].decode(errors="ignore")) for (d, t), b in zip(rows, _brute(rows))]
    assert _sorted(tuple(r) for r in got.select("doc_id", "text", "n_chars").collect()) == _sorted((d, t, len(t or "")) for d, t in want)
    untouched = {r.doc_id: r for r in docs.collect()}
    assert all(r == untouched[r.doc_id] for r in got.where("doc_id < 3 or doc_id = 6200").collect())


def test_many_equal_rows_and_one_common_border(spark):
    """A third of the rows alike in id and text; a passage in all others, each with words of its own around it."""
    draw = random.Random(9)
    passage = _words(draw, 45)
    rows = [(7, "seven " + passage)] * 150 + [(100 + k, f"{k} {draw.random()} {passage} {draw.random()}") for k in range(300)]
    for most in (1 << 20, 20_000):
        got = [tuple(r) for r in repeats.repeat_report(documents(spark, rows), most=most).collect()]
        assert _sorted(got) == _sorted((*b[:4], sha256(b[4])) for b in _brute(rows))


def test_long_texts_come_in_parts():
    draw = random.Random(2)
    data = np.frombuffer((_words(draw, 3000) + "y" * 900).encode(), np.uint8)
    import pyarrow as pa

    whole = repeats.segments(Texts(0, data, np.array([0, len(data)])), 200)
    windows = {p: b for lo, hi, b in zip(whole["lo"].tolist(), whole["hi"].tolist(), whole["bucket"].tolist()) for p in range(lo, hi + 1)}
    again = {}
    for some, at in repeats._some(pa.array([data.tobytes().decode()]), 200, 1000):
        found = repeats.segments(some, 200)
        for lo, hi, b in zip(found["lo"].tolist(), found["hi"].tolist(), found["bucket"].tolist()):
            for p in range(lo + at, hi + at + 1):
                assert again.setdefault(p, b) == b
    assert again == windows and len(windows) == len(data) - 199


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=90), min_size=1, max_size=5), st.sampled_from([8, 11, 16, 24, 40]))
def test_refined_buckets_are_sorted_strings(texts, span):
    contents = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(contents), np.uint8)
    room = np.concatenate([np.arange(len(c), 0, -1) for c in contents]) if len(data) else np.zeros(0, np.int64)
    starts, bucket = repeats.refined(data, room, np.flatnonzero(room >= span), span)
    strings = [data[s : s + span].tobytes() for s in starts]
    assert strings == sorted(strings) and len(strings) == sum(max(0, len(c) - span + 1) for c in contents)
    assert [a == b for a, b in zip(strings, strings[1:])] == (bucket[1:] == bucket[:-1]).tolist()


def test_empty_table(spark):
    assert repeats.repeat_report(documents(spark, [])).collect() == []
    assert repeats.dedup_substrings(documents(spark, [])).collect() == []


def test_query_agrees_with_sql(spark):
    assert difference(QUERIES["op13_repeated_substrings"](spark, SMALL), connect(SMALL), SQL["op13_repeated_substrings"]) is None
