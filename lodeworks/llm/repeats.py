"""Dedup of repeated byte strings by suffix arrays, built with bucket-pointer refinement.

Every start of a string of ``span`` bytes is a *window*. Its place in the work is chosen by
its own bytes alone: the smallest hash of its grams of ``GRAM`` bytes. Neighbouring windows
mostly share it, so a text is a list of *segments*, unbroken ranges of windows with one such
hash, their bucket; equal windows always meet in one bucket, and no window is in two.

1. Buckets are counted; those with one segment, which repeats nothing in itself, end here.
2. Segments alike to the byte (two hashes of 64 bits) are one content. Contents that stand
   more than once are repeated from end to end and need no further comparison.
3. Where a bucket holds several contents, their bytes (once per content) are brought
   together, and a suffix array of all their windows is built: ``refined``.
4. Buckets of more than ``most`` bytes, as at the borders of a passage that very many texts
   hold, are refined by Spark in the same way, with names for the two halves of each window
   as its buckets: windows with one pair of names are one, counted in each task first.

Only step 3 and 4 see more than hashes and numbers, and only of contents that share a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.llm.common import document_key, grouped, runs, ship, stored, unpacked
from lodeworks.llm.registry import query, read
from lodeworks.llm.textbytes import Texts, sha256, slices

#: Bytes whose hashes choose a bucket; bytes of the first buckets of a suffix array.
GRAM, FIRST = 32, 8
_AT_ONCE = 8192
_SEGMENT = ["doc", "row", "lo", "hi", "bucket", "own", "h1", "h2"]
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


#: A number for each byte.
_DIGITS = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0..base^(n-1) modulo 2^64, and their inverses."""
    return tuple(np.r_[np.uint64(1), np.cumprod(np.full(n - 1, b, np.uint64))] for b in (base, pow(base, -1, 2**64)))


class Strings:
    """Hashes of any strings of some bytes, wherever these stand: numbers whose digits are the bytes."""

    def __init__(self, data: np.ndarray, base: int):
        room = 1 << max(20, len(data).bit_length())
        powers, self.back = _powers(base, room)
        self.sums = np.r_[np.uint64(0), np.cumsum(_DIGITS[data] * powers[: len(data)])]

    def of(self, first: np.ndarray, behind: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[behind] - self.sums[first]) * self.back[first] + (behind - first).astype(np.uint64))

    def all_of(self, size: int) -> np.ndarray:
        """Those of ``size`` bytes, from each byte on."""
        n = max(0, len(self.sums) - size)
        return _mixed((self.sums[size:] - self.sums[:n]) * self.back[:n] + np.uint64(size))


def _lowest(h: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        h = np.minimum(h[:-step], h[step:])
        reach += step
    return h


def segments(texts: Texts, span: int, full: bool = True) -> dict[str, np.ndarray]:
    """All segments of the texts: text, first and last window (in it), bucket, own (it may repeat itself), two hashes of its bytes."""
    width, starts = span - GRAM + 1, texts.bounds[:-1]
    strings = [Strings(texts.data, base) for base in _BASES[: 1 + full]]
    grams = strings[0].all_of(GRAM)
    low = _lowest(grams, width) if len(grams) >= width else grams[:0]
    sizes = np.maximum(np.diff(texts.bounds) - span + 1, 0)
    text = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    at = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)  # the windows that lie in one text
    bucket = low[at]
    opens = np.ones(len(at) + 1, bool)
    opens[1:-1] = (bucket[1:] != bucket[:-1]) | (text[1:] != text[:-1])
    bounds = np.flatnonzero(opens)
    first, last, of = at[bounds[:-1]], at[bounds[1:] - 1], text[bounds[:-1]]
    # one place of its hash in a segment, or several?
    own, reach = np.zeros(len(first), bool), np.arange(width)
    for k in range(0, len(first), _AT_ONCE):
        a, b = first[k : k + _AT_ONCE, None], last[k : k + _AT_ONCE, None]
        left, right = grams[a + reach].argmin(axis=1), grams[b + reach[::-1]].argmin(axis=1)
        own[k : k + _AT_ONCE] = a[:, 0] + left != b[:, 0] + width - 1 - right
    found = {"text": of, "bucket": bucket[bounds[:-1]].view(np.int64), "own": own}
    if full:
        found |= {"lo": (first - starts[of]).astype(np.int32), "hi": (last - starts[of]).astype(np.int32)}
        found |= {f"h{k + 1}": x.of(first, last + span).view(np.int64) for k, x in enumerate(strings)}
    return found


def _some(column: pa.Array, span: int, most: int = 1 << 22) -> Iterator[tuple[Texts, int]]:
    """Texts of a batch, some at a time, and the byte they begin with: one of over ``most`` bytes comes in parts.

    Parts share all but one byte of a window, so each window is in one part. A segment may come
    as two, which no more than any two of a bucket are taken for different ones unseen.
    """
    for some in slices(column):
        n = len(some.data)
        for at in range(0, max(1, n - span + 1), most) if n > most and len(some) == 1 else (0,):
            part = some.data if n <= most or len(some) > 1 else some.data[at : at + most + span - 1]
            yield (some if part is some.data else Texts(some.first, part, np.array([0, len(part)]))), at


def _segments(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, row = batch.column("doc").to_numpy(), batch.column("row").to_numpy()
        for some, at in _some(batch.column("body"), span):
            found = segments(some, span)
            of = found.pop("text") + some.first
            if len(of):
                found |= {"doc": doc[of], "row": row[of], "lo": found["lo"] + np.int32(at), "hi": found["hi"] + np.int32(at)}
                yield pa.RecordBatch.from_arrays([pa.array(found[c]) for c in _SEGMENT], _SEGMENT)


def _buckets(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some, _ in _some(batch.column("body"), span):
            found = segments(some, span, full=False)
            if len(found["text"]):
                yield pa.RecordBatch.from_arrays([pa.array(found["bucket"]), pa.array(1 + found["own"].astype(np.int32))], ["bucket", "seen"])


def refined(data: np.ndarray, room: np.ndarray, wanted: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, ``span`` bytes deep, of the wanted starts, and the bucket each of them is in.

    ``room`` says how many bytes follow from each byte on to the end of its string. Starts are
    sorted into buckets by their first eight bytes. A bucket of several is refined by the
    buckets of the starts as many bytes on as all have in common; these pointers are those of
    the refinement before, so what is known doubles each time. Buckets of one are done.
    Equal buckets at last are equal strings; buckets are numbered in the strings' order.
    """
    n = len(data)
    padded = np.r_[data, np.zeros(FIRST, np.uint8)]
    at = np.flatnonzero(room >= FIRST)
    key, pointer, depth = np.zeros(len(at), np.uint64), np.zeros(n, np.int64), FIRST
    for k in range(FIRST):
        key = (key << np.uint64(8)) | padded[at + k]
    while len(at):
        order = np.argsort(key, kind="stable")
        place, key = at[order], key[order]
        old, count = pointer[place], np.arange(len(place))
        cut, border = (np.r_[True, x[1:] != x[:-1]] for x in (key, old))
        first = np.maximum.accumulate(np.where(cut, count, 0))
        # the first place of the old bucket, and how far behind it the new one begins
        pointer[place] = old + first - np.maximum.accumulate(np.where(border, count, 0))
        if depth >= span:
            break
        several = np.zeros(n, bool)
        several[place[~(cut & np.r_[cut[1:], True])]] = True
        step = min(depth, span - depth)
        at = at[(room[at] >= depth + step) & several[at]]
        key = pointer[at] * (n + 1) + pointer[at + step]
        depth += step
    starts = wanted[np.argsort(pointer[wanted], kind="stable")]
    return starts, pointer[starts]


def repeated_windows(contents: list[bytes], span: int) -> tuple[np.ndarray, np.ndarray]:
    """Content and window (first byte) of all windows that stand more than once among all windows of the contents."""
    sizes = np.array([len(c) for c in contents])
    data = np.frombuffer(b"".join(contents), np.uint8)
    bounds = np.r_[0, np.cumsum(sizes)]
    of = np.repeat(np.arange(len(sizes)), sizes)
    room = bounds[1:][of] - np.arange(len(data))
    starts, bucket = refined(data, room, np.flatnonzero(room >= span), span)
    same = bucket[1:] == bucket[:-1]
    several = np.r_[False, same] | np.r_[same, False] if len(starts) else np.zeros(0, bool)
    found = np.sort(starts[several])
    return of[found], found - bounds[of[found]]


def _ranges(of: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (of, at) as unbroken ranges: of, first, last."""
    broken = (np.diff(of) != 0) | (np.diff(at) != 1)
    first, last = np.r_[True, broken][: len(of)], np.r_[broken, True][: len(of)]
    return of[first], at[first], at[last]


_KEY = ["bucket", "h1", "h2"]
_RANGES = T.ArrayType(T.StructType().add("lo", "integer").add("hi", "integer"))


def _compared(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """For whole buckets: the windows, as ranges, that stand more than once, of contents that stand once."""
    for table, _ in runs(batches, ["bucket"]):
        of, at = repeated_windows(table.column("content").to_pylist(), span)
        once = table.column("n").to_numpy()[of] == 1
        of, lo, hi = _ranges(of[once], at[once])
        if len(of):
            kept = table.select(_KEY).take(pa.array(of)).combine_chunks()
            pairs = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (lo, hi)], ["lo", "hi"])
            each = pa.ListArray.from_arrays(pa.array(np.arange(len(of) + 1, dtype=np.int32)), pairs)
            yield pa.RecordBatch.from_arrays([*(kept.column(c).chunk(0) for c in _KEY), each], [*_KEY, "ranges"])


_CUT = "bucket long, h1 long, h2 long, n long, content binary, left array<long>, right array<long>"


def _contents(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the contents looked for, or the names of their windows' halves where the bucket is a large one.

    Rows alike in id and text hold them alike, so a task takes them from the first.
    """
    half, seen = span // 2, set()
    for batch in batches:
        out: list[tuple] = []
        for doc, row, body, wanted in zip(*(batch.column(c).to_pylist() for c in ("doc", "row", "body", "wanted"))):
            if (doc, row) in seen:
                continue
            seen.add((doc, row))
            data = body.encode()
            for w in wanted:
                content, left, right = data[w["lo"] : w["hi"] + span], None, None
                if w["large"]:
                    names, n = Strings(np.frombuffer(content, np.uint8), _BASES[0]), w["hi"] - w["lo"] + 1
                    left, right = names.all_of(half)[:n].view(np.int64), names.all_of(span - half)[half : half + n].view(np.int64)
                    content = None
                out.append((w["bucket"], w["h1"], w["h2"], w["n"], content, left, right))
                if len(out) >= 2000:
                    yield _cut_batch(out)
                    out = []
        if out:
            yield _cut_batch(out)


def _cut_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary()] + [pa.list_(pa.int64())] * 2
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], ["bucket", "h1", "h2", "n", "content", "left", "right"])


def _repeats(rows: DataFrame, span: int, most: int) -> DataFrame:
    """doc, row, spans (array of lo, hi): bytes from lo up to hi that windows which stand elsewhere too begin with."""
    bodies = rows.select("doc", "row", "body")
    seen = bodies.select("body").mapInArrow(lambda it: _buckets(it, span), "bucket long, seen int")
    several = stored(seen.groupBy("bucket").agg(F.sum("seen").alias("n")).where("n > 1").select("bucket"))
    every = bodies.mapInArrow(lambda it: _segments(it, span), "doc long, row long, lo int, hi int, bucket long, own boolean, h1 long, h2 long")
    # both sides are plain, so adaptive execution may split a hot bucket
    shared = stored(every.join(several, "bucket"))
    at = F.struct("doc", "row", "lo", "hi", "own")
    contents = stored(shared.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("at")).select(*_KEY, "n", "at.*"))
    size = (F.col("hi") - F.col("lo") + span).cast("long")
    full = contents.groupBy("bucket").agg(F.count(F.lit(1)).alias("contents"), F.min("n").alias("least"), F.max("own").alias("own"), F.sum(size).alias("bytes"))
    full = stored(full.where("least = 1 and (contents > 1 or own)").select("bucket", (F.col("bytes") > most).alias("large")))
    wanted = contents.join(full, "bucket").groupBy("doc", "row").agg(F.collect_list(F.struct(*_KEY, "n", "lo", "hi", "large")).alias("wanted"))
    cut = stored(bodies.join(stored(wanted), ["doc", "row"]).mapInArrow(lambda it: _contents(it, span), _CUT))
    small = cut.where("content is not null").select(*_KEY, "n", "content")
    compared = grouped(small, ["bucket"]).mapInArrow(lambda it: _compared(it, span), small.select(*_KEY).schema.add("ranges", _RANGES))
    from_end_to_end = F.array(F.struct(F.lit(0).alias("lo"), (F.col("hi") - F.col("lo")).alias("hi"))).cast(_RANGES)
    found = stored(contents.where("n > 1").select(*_KEY, from_end_to_end.alias("ranges")).unionByName(compared).unionByName(_large(cut)))
    spans = shared.select("doc", "row", *_KEY, F.col("lo").alias("from")).join(found, _KEY)
    spans = spans.select("doc", "row", "from", F.inline("ranges")).select("doc", "row", F.struct((F.col("from") + F.col("lo")).alias("lo"), (F.col("from") + F.col("hi") + span).alias("hi")).alias("span"))
    return stored(spans.groupBy("doc", "row").agg(F.collect_set("span").alias("spans")))


def _large(cut: DataFrame) -> DataFrame:
    """The same for large buckets: windows named by their halves, which Spark brings together."""
    names = cut.where("content is null").select(*_KEY, "n", F.posexplode(F.arrays_zip("left", "right")).alias("at", "of"))
    names = names.select(*_KEY, "n", "at", "of.left", "of.right")
    several = stored(names.groupBy("left", "right").agg(F.sum("n").alias("windows")).where("windows > 1").select("left", "right"))
    found = names.where("n = 1").join(several, ["left", "right"])
    return found.select(*_KEY, F.array(F.struct(F.col("at").alias("lo"), F.col("at").alias("hi"))).cast(_RANGES).alias("ranges"))


def _merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _kept(data: bytes, gone: list[tuple[int, int]]) -> list[bytes]:
    bounds = [0, *[x for span in gone for x in span], len(data)]
    return [data[a:b] for a, b in zip(bounds[::2], bounds[1::2])]


def _cleaned(batches: Iterator[pa.RecordBatch], passing: str, kinds: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for body, spans in zip(batch.column("body").to_pylist(), batch.column("spans").to_pylist()):
            data, gone = body.encode(), _merged(spans)
            kept = _kept(data, gone)
            # a character of which some bytes are gone goes as a whole where text is wanted
            left = b"".join(kept).decode(errors="ignore") if gone and "kept_text" in kinds else None
            rows.append({"n_bytes": len(data), "n_removed": sum(b - a for a, b in gone), "n_spans": len(gone), "kept_sha256": sha256(*kept), "kept_text": left})
        yield pa.RecordBatch.from_arrays([batch.column(passing), *[pa.array([r[c] for r in rows], t) for c, t in kinds.items()]], [passing, *kinds])


def _joined(docs: DataFrame, whole: Column, span: int, most: int) -> DataFrame:
    if span < 2 * GRAM:
        raise ValueError(f"Strings of {2 * GRAM} bytes or more are found")
    ship(docs.sparkSession)
    rows = docs.select(*document_key(), whole.alias("whole"))
    return rows.join(_repeats(rows, span, most), ["doc", "row"], "left").select("whole", "body", "spans")


def dedup_substrings(docs: DataFrame, span: int = 200, most: int = 1 << 20) -> DataFrame:
    """The documents without the bytes of strings of ``span`` bytes that also start anywhere else.

    No copy is kept. Texts are compared as UTF-8 bytes, as given; a match never crosses
    documents, but may lie in one and overlap itself. A character of which a byte goes is left
    out as a whole. Null text stays null; each row is a document, so repeated rows lose all
    that is long enough. Other columns pass through, whatever their names; n_chars, if there,
    follows the text. An empty table gives an empty table. ``most`` bounds the bytes of a
    bucket that one task compares; larger ones are compared by Spark, with equal results.
    """
    whole = F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns])
    joined = _joined(docs, whole, span, most)
    out = joined.mapInArrow(lambda it: _cleaned(it, "whole", {"kept_text": pa.string()}), joined.select("whole").schema.add("kept_text", "string"))
    text = F.coalesce("kept_text", F.col("whole").getField("text"))
    new = {"text": text}
    if "n_chars" in docs.columns:
        cut = F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.coalesce(cut, F.col("whole").getField("n_chars"))
    return unpacked(out, docs.columns, **new)


def repeat_report(docs: DataFrame, span: int = 200, most: int = 1 << 20) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (unbroken runs of removed bytes) and the hash of the bytes that stay."""
    kinds = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()}
    schema = "whole long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    joined = _joined(docs, F.col("doc_id").cast("long"), span, most)
    return joined.mapInArrow(lambda it: _cleaned(it, "whole", kinds), schema).withColumnRenamed("whole", "doc_id")


_SQL = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, hex(coalesce(text, '')) AS bytes, strlen(coalesce(text, '')) AS n FROM documents),
blocks AS (
  SELECT doc_id, b.at, substr(bytes, 2 * b.at + 1, 2 * (512 + 199)) AS part
  FROM texts, LATERAL (SELECT unnest(range(0, greatest(n - 199, 0), 512)) AS at) b),
windows AS (
  SELECT doc_id, blocks.at + w.at AS p, md5(substr(part, 2 * w.at + 1, 400)) AS string
  FROM blocks, LATERAL (SELECT unnest(range(0, least(512, length(part) // 2 - 199))) AS at) w),
shared AS (SELECT string FROM windows GROUP BY string HAVING count(*) > 1),
hits AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM windows SEMI JOIN shared USING (string)),
numbered AS (SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p - before > 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM hits),
spans AS (SELECT doc_id, span, min(p) AS lo, max(p) + 200 AS hi FROM numbered GROUP BY doc_id, span),
gaps AS (
  SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM spans),
cut AS (
  SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS last,
         string_agg(substr(bytes, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) AS kept
  FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       CASE WHEN cut.doc_id IS NULL THEN sha256(text) ELSE sha256(unhex(kept || substr(bytes, 2 * last + 1))) END AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
"""


@query("op13_repeated_substrings", _SQL)
def op13_repeated_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return repeat_report(read(spark, folder, "documents"))
