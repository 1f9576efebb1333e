"""Fill-in-middle by piece tables: descriptors over immutable buffers are cut, permuted, hashed and put back.

The bytes of a text are never moved while a document is taken apart: a document is a list
of pieces (buffer, first byte, bytes), at first one over all its text. A cut splits the
piece it falls into, an arrangement permutes pieces and puts pieces of the sentinel buffer
between them, and the inverse permutation restores the document. What is hashed is read
piece by piece; only ``fill_in_middle`` and ``restore`` write texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.common import ship, unpacked
from lodeworks.llm.registry import query, read
from lodeworks.llm.textbytes import Texts, sha256, slices

TEXT, MARKS = 0, 1
PREFIX, SUFFIX, MIDDLE = 0, 1, 2
#: Parts of the text in the order in which each form gives them, each behind its sentinel but in plain text.
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
#: Where the parts stand in a text.
READING = (PREFIX, MIDDLE, SUFFIX)
Piece = tuple[int, int, int]


@dataclass(frozen=True)
class Middles:
    """How documents are taken apart: ``rate`` percent of them, ``spm`` percent of these suffix first."""

    rate: int = 50
    spm: int = 80
    seed: int = 42
    sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>")

    def __post_init__(self) -> None:
        for x, y in product(self.sentinels, repeat=2):
            if not x or len(set(self.sentinels)) < 3 or any(x[k:] == y[: len(x) - k] for k in range(x == y, len(x))) or (x != y and x in y):
                raise ValueError("Sentinels must not be empty, overlap or hold one another")

    @property
    def marks(self) -> tuple[bytes, list[Piece]]:
        """The sentinel buffer, and a piece of it for the prefix, the suffix and the middle."""
        coded = [s.encode() for s in self.sentinels]
        at = np.cumsum([0, *map(len, coded)]).tolist()
        return b"".join(coded), [(MARKS, a, len(s)) for a, s in zip(at, coded)]

    def draws(self, doc: int | None) -> np.ndarray:
        """Four numbers of 32 bits that depend on the seed and the id alone; a missing id is the empty one."""
        return np.frombuffer(hashlib.sha256(f"{self.seed}:{'' if doc is None else doc}".encode()).digest(), ">u4", 4).astype(np.int64)


def split(pieces: Iterable[Piece], at: int) -> list[Piece]:
    """The pieces, that which holds byte ``at`` of the document cut there. A cut at a border changes nothing."""
    out, seen = [], 0
    for buffer, first, length in pieces:
        inside = at - seen
        out += [(buffer, first, inside), (buffer, first + inside, length - inside)] if 0 < inside < length else [(buffer, first, length)]
        seen += length
    return out


def parts(pieces: list[Piece], cuts: Iterable[int]) -> list[list[Piece]]:
    """The document's pieces between the cuts (bytes, ascending), one list more than there are cuts."""
    for at in cuts:
        pieces = split(pieces, at)
    out: list[list[Piece]] = [[]]
    seen, rest = 0, list(cuts)
    for piece in pieces:
        while rest and seen >= rest[0]:
            rest.pop(0)
            out.append([])
        out[-1].append(piece)
        seen += piece[2]
    return out + [[] for _ in rest]


def arranged(three: list[list[Piece]], form: str, marks: list[Piece]) -> list[Piece]:
    """Prefix, middle and suffix (lists of pieces) in the order of the form, each behind its sentinel."""
    of = dict(zip(READING, three))
    return [piece for part in ORDERS[form] for piece in (marks[part], *of[part])]


def disarranged(output: bytes, form: str, settings: Middles) -> list[Piece]:
    """Pieces of an output, as the text buffer, in reading order: the inverse of ``arranged``.

    No text between sentinels holds one, and no two of them overlap, so each is found by its first place.
    """
    if form == "plain":
        return [(TEXT, 0, len(output))]
    found, at = {}, 0
    coded, order = [s.encode() for s in settings.sentinels], ORDERS[form]
    for k, part in enumerate(order):
        at += len(coded[part])
        stop = output.find(coded[order[k + 1]], at) if k + 1 < len(order) else len(output)
        if not output.startswith(coded[part], at - len(coded[part])) or stop < 0:
            raise ValueError(f"This output of form {form} lacks a sentinel")
        found[part] = (TEXT, at, stop - at)
        at = stop
    return [found[part] for part in READING]


def read_pieces(pieces: Iterable[Piece], buffers: tuple[memoryview, ...]) -> Iterator[memoryview]:
    for buffer, first, length in pieces:
        yield buffers[buffer][first : first + length]


def unit_ends(texts: Texts) -> np.ndarray:
    """The byte behind each unit: a word with the white space before it, or white space that ends a text."""
    space = texts.spaces()
    ends = np.zeros(len(space) + 1, bool)
    ends[1:-1] = ~space[:-1] & space[1:]
    ends[texts.bounds[1:][np.diff(texts.bounds) > 0]] = True
    return np.flatnonzero(ends)


@dataclass
class Taken:
    """A document taken apart: its units, form and pieces, and the characters of prefix and middle (none if plain)."""

    n: int
    form: str
    pieces: list[Piece]
    prefix_chars: int | None
    middle_chars: int | None


def taken_apart(texts: Texts, ids: list[int | None], settings: Middles) -> Iterator[Taken]:
    """Each document's piece table, over the bytes of ``texts`` and the sentinel buffer."""
    ends, bounds = unit_ends(texts), texts.bounds
    data = texts.data.tobytes()
    low, high = np.searchsorted(ends, bounds[:-1], "right"), np.searchsorted(ends, bounds[1:], "right")
    characters = np.r_[0, np.cumsum((texts.data & 0xC0) != 0x80)]
    refused = re.compile(b"|".join(re.escape(s.encode()) for s in settings.sentinels))
    _, marks = settings.marks
    for k, doc in enumerate(ids):
        start, stop, n = int(bounds[k]), int(bounds[k + 1]), int(high[k] - low[k])
        h1, h2, h3, h4 = settings.draws(doc)
        whole = [(TEXT, start, stop - start)]
        if start == stop or h3 % 100 >= settings.rate or refused.search(data, start, stop):
            yield Taken(n, "plain", whole, None, None)
            continue
        form = "spm" if h4 % 100 < settings.spm else "psm"
        units = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = (int(ends[low[k] + u - 1]) if u else start for u in units)
        three = parts(whole, (a - start, b - start))
        yield Taken(n, form, arranged(three, form, marks), int(characters[a] - characters[start]), int(characters[b] - characters[a]))


def _tables(batches: Iterator[pa.RecordBatch], settings: Middles, text: str = "text") -> Iterator[tuple[pa.RecordBatch, int, int, tuple, list[Taken]]]:
    """Slices of batches: the batch, its rows from and to, the buffers, and a piece table for each row."""
    marks = memoryview(settings.marks[0])
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for some in slices(batch.column(text)):
            stop = some.first + len(some)
            yield batch, some.first, stop, (memoryview(some.data), marks), list(taken_apart(some, ids[some.first : stop], settings))


def _filled(batches: Iterator[pa.RecordBatch], settings: Middles) -> Iterator[pa.RecordBatch]:
    for batch, a, b, buffers, found in _tables(batches, settings):
        out = [b"".join(read_pieces(t.pieces, buffers)).decode() for t in found]
        made = [pa.array([getattr(t, name) for t in found], kind) for name, kind in (("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column("whole").slice(a, b - a), pa.array(out, pa.string()), *made], ["whole", "filled", "n", "form", "prefix_chars", "middle_chars"])


def _digests(batches: Iterator[pa.RecordBatch], settings: Middles) -> Iterator[pa.RecordBatch]:
    for batch, a, b, buffers, found in _tables(batches, settings):
        output, restored = [], []
        for t in found:
            output.append(sha256(*read_pieces(t.pieces, buffers)))
            written = b"".join(read_pieces(t.pieces, buffers))  # what a reader of the output has
            restored.append(sha256(*read_pieces(disarranged(written, t.form, settings), (memoryview(written),))))
        columns = {name: [getattr(t, name) for t in found] for name in ("n", "form", "prefix_chars", "middle_chars")} | {"output_sha256": output, "restored_sha256": restored}
        kinds = dict(n=pa.int64(), form=pa.string(), prefix_chars=pa.int64(), middle_chars=pa.int64(), output_sha256=pa.string(), restored_sha256=pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), *[pa.array(v, kinds[c]) for c, v in columns.items()]], ["doc_id", *columns])


def _restored(batches: Iterator[pa.RecordBatch], settings: Middles) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for output, form in zip(batch.column("text").to_pylist(), batch.column("form").to_pylist()):
            if output is None:
                texts.append(None)
                continue
            data = output.encode()
            texts.append(b"".join(read_pieces(disarranged(data, form or "plain", settings), (memoryview(data),))).decode())
        yield pa.RecordBatch.from_arrays([batch.column("whole"), pa.array(texts, pa.string())], ["whole", "back"])


def _whole(docs: DataFrame) -> Column:
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("whole")


def fill_in_middle(docs: DataFrame, settings: Middles = Middles()) -> DataFrame:
    """The documents with their texts rearranged for infilling; ``form`` says how (plain, psm, spm).

    A text is cut behind two of its units (a word with the white space before it; white space
    that ends the text) that the seed and the id alone choose, so copies of a row are cut
    alike and a rerun gives the same. Empty texts and those that hold a sentinel stay plain,
    null stays null (form plain). Rows without doc_id are cut as one with an empty id. Other
    columns pass through, whatever their names; an existing ``form`` is replaced. No row
    is moved: there is no shuffle, and a text is in memory once as bytes and once as output.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _whole(docs))
    schema = rows.select("whole").schema.add("filled", "string").add("n", "long").add("form", "string").add("prefix_chars", "long").add("middle_chars", "long")
    out = rows.mapInArrow(lambda it: _filled(it, settings), schema)
    text = F.when(F.col("whole").getField("text").isNotNull(), F.col("filled"))
    columns = [*docs.columns, *([] if "form" in docs.columns else ["form"])]
    return unpacked(out, columns, text=text, form=F.col("form"))


def restore(filled: DataFrame, settings: Middles = Middles()) -> DataFrame:
    """The documents of ``fill_in_middle`` with their texts as they were, from text and form alone."""
    ship(filled.sparkSession)
    rows = filled.select("text", "form", _whole(filled))
    out = rows.mapInArrow(lambda it: _restored(it, settings), rows.select("whole").schema.add("back", "string"))
    return unpacked(out, filled.columns, text=F.col("back"))


def fill_report(docs: DataFrame, settings: Middles = Middles()) -> DataFrame:
    """Per row: doc_id, n (units), form, prefix_chars, middle_chars, and hashes of the output and of the text restored from it."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return rows.mapInArrow(lambda it: _digests(it, settings), schema)


_UNIT = "'[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+'"
_SQL = f"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
drawn AS (
  SELECT doc_id, text, regexp_extract_all(text, {_UNIT}) AS units,
         ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM hashed),
placed AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
cut AS (
  SELECT *, array_to_string(list_slice(units, 1, a), '') AS p, array_to_string(list_slice(units, a + 1, b), '') AS m,
         array_to_string(list_slice(units, b + 1, n), '') AS s
  FROM placed)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""


@query("op11_fill_in_middle", _SQL)
def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_report(read(spark, folder, "documents"))
