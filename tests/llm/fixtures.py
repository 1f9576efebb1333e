"""Documents with every awkward case, and plain Python versions of the operators to hold results against."""

from __future__ import annotations

import hashlib

import xxhash
from pyspark.sql import functions as F

NO_ID = 2**63 - 1
PASSAGE = (
    "The quick brown fox jumped over the lazy dog near the river bank. Nobody saw it happen that day at all. "
    "Later on, the dog woke up and went home to its quiet family. It told them nothing about the strange fox. "
    "They would not have believed it anyway, said the old dog in the end."
)
LONG = " ".join(f"word{k % 977} other{k % 31}." for k in range(9000))
ROWS = [
    (0, "Alpha beta gamma line one\nshort\nAlpha beta gamma line one\n" + PASSAGE + " A tail of its own here."),
    (1, " ALPHA beta gamma LINE one\t\nshort\nAnother line that is unique"),
    (2, None),
    (3, ""),
    (4, LONG),
    (5, "A first sentence of five. " + PASSAGE + "\nReleased under the MIT License."),
    (5, "A first sentence of five. " + PASSAGE + "\nReleased under the MIT License."),
    (6, "Été ÉTÉ ärger <|endoftext|> It's the Kİ line\x1cagain\r\nAlpha beta gamma line one"),
    (7, LONG),
    (8, LONG + " changed"),
    (9, "\n\n \n"),
    (10, "mit license MIT License apache license, version 2.0 General Public license"),
    (11, "x" * 5000),
    (None, "Alpha beta gamma line one\n" + PASSAGE),
    (None, "another text without an id"),
    (12, "tie tie tie tie"),
    (13, "tie tie tie tie"),
]
CLASHES = "doc row body whole lines kept drops left starts tails expected pos h1 print first block".split()


def documents(spark, rows=None):
    """The rows as ``documents``, with more columns whose names the operators use inside."""
    rows = ROWS if rows is None else rows
    df = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHES], F.lit(1).alias("a.b"))


def by_id(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_lines(rows, min_chars=10):
    """(doc_id, text left, lines, dropped) of each row."""
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    holders: dict[str, set] = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add(NO_ID if d is None else d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(holders[key(x)]) < 2 or min(holders[key(x)]) == (NO_ID if d is None else d)]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def brute_print(text):
    words = lower(text or "").encode().split()
    if not words:
        return 0
    spans = [words[k : k + 3] for k in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    """{doc: smallest doc reachable} with a missing id as NO_ID; prints of rows of one doc all link it."""
    prints = [(NO_ID if d is None else d, brute_print(t)) for d, t in rows]
    label = {k: k for k in range(len(prints))}
    changed = True
    while changed:
        changed = False
        for a, (_, x) in enumerate(prints):
            for b, (_, y) in enumerate(prints):
                if (x ^ y).bit_count() <= 2 and label[b] < label[a]:
                    label[a], changed = label[b], True
    smallest: dict[int, int] = {}
    for k, (d, _) in enumerate(prints):
        smallest[label[k]] = min(smallest.get(label[k], NO_ID), d)
    return [(d, x, smallest[label[k]]) for k, (d, x) in enumerate(prints)]


def brute_spans(rows, run=3, min_words=15):
    """The text left of each row, by plain comparison of the runs' words."""
    from lodeworks.llm.spans import sentences

    order = sorted(range(len(rows)), key=lambda k: (NO_ID if rows[k][0] is None else rows[k][0], _row_hash(rows[k][1])))
    bounds = [[(a, b) for a, b in sentences(t or "") if (t or "")[a:b].encode().split()] for _, t in rows]
    first: dict[tuple, tuple] = {}
    gone: list[set] = [set() for _ in rows]
    for k in order:
        d, t = rows[k]
        said = [lower(t[a:b]).encode().split() for a, b in bounds[k]]
        n, spans = len(said), set()
        enough = lambda p, q: q - p >= run and sum(map(len, said[p:q])) >= min_words
        for p in range(n + 1):
            spans |= {(p, q) for q in range(p, min(n, p + 20) + 1) if enough(p, q) and not enough(p, q - 1)}
            spans |= {(q, p) for q in range(max(0, p - 20), p) if enough(q, p) and not enough(q + 1, p)}
        for p, q in sorted(spans):
            words, at = tuple(w for x in said[p:q] for w in x), (d, t, p)
            if first.setdefault(words, at) != at:
                gone[k].update(bounds[k][p:q])
    return ["".join(t[a:b] for a, b in sentences(t) if (a, b) not in gone[k]) if t is not None else None for k, (_, t) in enumerate(rows)]


def _row_hash(text):
    h = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return h - 2**64 if h >= 2**63 else h


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
