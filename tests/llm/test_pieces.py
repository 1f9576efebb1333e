"""Documents taken apart and put back, against plain Python."""

import hashlib
import re

import pytest
from compare import connect, difference
from conftest import SMALL
from llm.fixtures import ROWS, documents, sha

from lodeworks.llm import pieces
from lodeworks.llm.pieces import Middles
from lodeworks.llm.registry import QUERIES, SQL

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
MORE = [
    *((100 + k, t) for k in range(40) for t in (f"Été {k} x\x1cy  z\n", "a <S> b", " \t\n", "\U0001f600 a\x00b c" * (k % 3), f"<P{k} <S <M > tail<")),
    (7, "<P><S><M>"), (900, "one"), (901, " one"), (902, "one "),
]


def _brute(doc, text, rate=50, spm=80):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h4 % 100 < spm else "psm"
    return doc, n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def _sorted(rows):
    return sorted(rows, key=str)


def test_report_is_that_of_plain_python(spark):
    rows = ROWS + MORE
    got = [tuple(r) for r in pieces.fill_report(documents(spark, rows)).collect()]
    want = [(*b[:5], sha(b[5]), sha(t or "")) for b, t in ((_brute(d, t), t) for d, t in rows)]
    assert _sorted(got) == _sorted(want)
    assert {w[2] for w in want} == {"plain", "spm", "psm"}


def test_texts_come_back_and_columns_stay(spark):
    rows = ROWS + MORE
    docs = documents(spark, rows)
    filled = pieces.fill_in_middle(docs, Middles(rate=100, spm=30))
    assert filled.columns == [*docs.columns, "form"]
    got = filled.select("doc_id", "text", "form").collect()
    want = [(d, None if t is None else o, f) for (d, t), (_, _, f, _, _, o) in ((r, _brute(*r, 100, 30)) for r in rows)]
    assert _sorted(tuple(r) for r in got) == _sorted(want)
    back = pieces.restore(filled, Middles(rate=100, spm=30)).drop("form")
    assert _sorted(back.collect()) == _sorted(docs.collect())


def test_empty_table(spark):
    docs = documents(spark, [])
    assert pieces.fill_report(docs).collect() == [] and pieces.restore(pieces.fill_in_middle(docs)).collect() == []


def test_cuts_split_descriptors():
    table = [(0, 10, 5), (1, 0, 3), (0, 15, 2)]
    assert pieces.split(table, 5) == table and pieces.split(table, 0) == table and pieces.split(table, 10) == table
    assert pieces.split(table, 6) == [(0, 10, 5), (1, 0, 1), (1, 1, 2), (0, 15, 2)]
    assert pieces.parts(table, (6, 6)) == [[(0, 10, 5), (1, 0, 1)], [], [(1, 1, 2), (0, 15, 2)]]
    assert pieces.parts([(0, 0, 4)], (0, 4)) == [[], [(0, 0, 4)], []]


@pytest.mark.parametrize("sentinels", [("", "a", "b"), ("a", "a", "b"), ("ab", "ba", "c"), ("abc", "b", "d"), ("aa", "b", "c")])
def test_sentinels_that_could_be_misread_are_refused(sentinels):
    with pytest.raises(ValueError):
        Middles(sentinels=sentinels)


def test_query_agrees_with_sql(spark):
    assert difference(QUERIES["op11_fill_in_middle"](spark, SMALL), connect(SMALL), SQL["op11_fill_in_middle"]) is None
