"""Every passage of over 50 words that stands earlier loses words, whatever stands before it."""

import numpy as np
from llm.fixtures import documents, lower

from lodeworks.llm import spans


def _rows(wrapped):
    """One passage of 51 words in pairs of documents, its sentences of 3 to 60 words, begun and left amid sentences."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(200):
        some = [f"{x}." if rng.random() < (0, 0.05, 0.1, 0.2)[k % 4] else x for x in (f"w{n}" for n in rng.integers(0, 3000, 51))]
        for copy in range(2):
            before = [f"a{k}x{copy}x{n}" for n in range(rng.integers(0, 40))]
            after = [f"b{k}x{copy}x{n}" for n in range(rng.integers(0, 40))]
            words = [*before, *some, *after]
            gaps = ["\n" if wrapped and n % (11 + 3 * copy) == 5 else " " for n in range(len(words))]
            rows.append((1000 * copy + k, "".join(w + g for w, g in zip(words, gaps)), len(before)))
    return rows


def _windows(text, size=51):
    words = lower(text).split()
    return [tuple(words[k : k + size]) for k in range(len(words) - size + 1)]


def _left(spark, rows):
    return {r.doc_id: r.kept_text for r in spans.span_report(documents(spark, [(d, t) for d, t, _ in rows])).collect()}


def test_no_window_of_51_words_stands_twice(spark):
    rows = _rows(False)
    left = _left(spark, rows)
    seen = {w for d, t, _ in rows if d < 1000 for w in _windows(t)}
    assert all(left[d] == t for d, t, _ in rows if d < 1000)
    for d, t, _ in rows:
        if d >= 1000:
            assert any(w in seen for w in _windows(t)) and not any(w in seen for w in _windows(left[d]))
            kept = lower(left[d]).split()
            assert len(t.split()) - len(kept) >= 25 and all(w in kept for w in lower(t).split() if w[0] in "ab")


def test_broken_lines_hide_few_passages(spark):
    rows = _rows(True)
    left = _left(spark, rows)
    lost = [len(t.split()) - len(left[d].split()) >= 15 for d, t, _ in rows if d >= 1000]
    assert np.mean(lost) > 0.9


def test_cuts_are_the_bounds_of_sentences():
    for _, t, _ in _rows(True)[:40]:
        before, at = spans.cuts(t)
        assert [len(t[:a].split()) for a in at] == before and before[-1] == len(t.split()) and at[-1] == len(t)
        assert max(np.diff(before)) <= 12
    assert spans.cuts("\n\n \n") == ([0], [0]) and spans.sentences("") == [] and spans.sentences("\n\nÉté 1.") == [(0, 2), (2, 8)]
