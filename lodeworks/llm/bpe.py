"""BPE encoding and decoding: a minimal acyclic transducer gives the ids of frequent words, merges those of the rest."""

from __future__ import annotations

import hashlib
import heapq
import mmap
import tempfile
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.common import document_key, ship, texts
from lodeworks.llm.ordinal import known_id
from lodeworks.llm.registry import query, read
from lodeworks.llm.wordbpe import Encoder, Memory, Vocabulary

TOKENIZER = "word_bpe_49k.json"
_NEVER = 1 << 60
#: Symbols of a word up to which a plain search for the best pair is the faster way to the same ids.
_SHORT = 48


def merged(word: str, v: Vocabulary) -> list[int]:
    """The ids of a word by its merges: always the best-ranked pair, the leftmost of equals."""
    s = v.symbols(word)
    s[-1] += v.end
    rank = v.merges.get
    if len(s) <= _SHORT:
        ranks = [rank(p, _NEVER) for p in zip(s, s[1:])]
        while ranks and (best := min(ranks)) < _NEVER:
            at = ranks.index(best)
            s[at : at + 2] = [s[at] + s[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank((s[at - 1], s[at]), _NEVER)
            if at < len(ranks):
                ranks[at] = rank((s[at], s[at + 1]), _NEVER)
        return [v.ids[x] for x in s]
    # a long word: the same order from a heap, over a linked list
    after, before = [*range(1, len(s)), -1], [-1, *range(len(s) - 1)]
    heap = [(r, k, p) for k, p in enumerate(zip(s, s[1:])) if (r := rank(p)) is not None]
    heapq.heapify(heap)
    while heap:
        _, k, pair = heapq.heappop(heap)
        n = after[k]
        if s[k] is None or n < 0 or (s[k], s[n]) != pair:
            continue
        s[k], s[n] = s[k] + s[n], None
        after[k] = after[n]
        if after[n] >= 0:
            before[after[n]] = k
        for x in (before[k], k):
            if x >= 0 and (y := after[x]) >= 0 and (r := rank((s[x], s[y]))) is not None:
                heapq.heappush(heap, (r, x, (s[x], s[y])))
    return [v.ids[x] for x in s if x is not None]


class Transducer:
    """Words as bytes -> their number in sorted order, and from there their ids.

    States that accept the same endings are one (the automaton is minimal). An edge adds the
    count of words that go before those through it, so the sums along a path are the word's
    number. All of it is a few flat arrays, which ``packed`` joins into one file to map.
    """

    FIELDS = (("edge", "<i8"), ("target", "<i4"), ("adds", "<i4"), ("final", "u1"), ("at", "<i4"), ("ids", "<u4"))

    def __init__(self, **arrays: np.ndarray) -> None:
        self.__dict__.update(arrays)

    @classmethod
    def compile(cls, words: dict[bytes, list[int]]) -> Transducer:
        """From words and their ids; the empty word is left out."""
        kept, registered = sorted(w for w in words if w), {}
        states: list[tuple[bool, tuple]] = []  # final, ((label, target), ...)

        def settle(node: list) -> int:
            key = (node[0], tuple(node[1]))
            if key not in registered:
                registered[key] = len(states)
                states.append(key)
            return registered[key]

        path, last = [[False, []]], b""
        for w in [*kept, b""]:
            same = 0
            while same < min(len(w), len(last)) and w[same] == last[same]:
                same += 1
            while len(path) > same + 1:
                done = settle(path.pop())
                path[-1][1].append((last[len(path) - 1], done))
            for _ in w[same:]:
                path.append([False, []])
            if w:
                path[-1][0] = True
            last = w
        root = settle(path[0])
        # children are settled before their parents, so one pass counts the words below each state
        below = []
        edge, target, adds = [], [], []
        for k, (final, arcs) in enumerate(states):
            n = int(final)
            for label, to in arcs:
                edge.append(k << 8 | label)
                target.append(to)
                adds.append(n)
                n += below[to]
            below.append(n)
        ids = [words[w] for w in kept]
        return cls(
            edge=np.array(edge, "<i8"), target=np.array(target, "<i4"), adds=np.array(adds, "<i4"), final=np.array([s[0] for s in states], "u1"),
            at=np.cumsum([0, *map(len, ids)], dtype="<i4"), ids=np.array([i for x in ids for i in x], "<u4"), root=root,
        )

    def packed(self) -> bytes:
        arrays = [getattr(self, name).tobytes() for name, _ in self.FIELDS]
        head = np.array([self.root, *map(len, arrays)], "<i8").tobytes()
        return head + b"".join(a + b"\0" * (-len(a) % 8) for a in arrays)

    @classmethod
    def mapped(cls, data: bytes) -> Transducer:
        """The packed form as a memory map of an unnamed file, whose pages are loaded as they are read."""
        with tempfile.TemporaryFile() as f:
            f.write(data)
            f.flush()
            view = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        head = np.frombuffer(view, "<i8", len(cls.FIELDS) + 1)
        arrays, start = {}, head.nbytes
        for (name, kind), size in zip(cls.FIELDS, head[1:].tolist()):
            arrays[name] = np.frombuffer(view, kind, size // np.dtype(kind).itemsize, start)
            start += size + -size % 8
        return cls(root=int(head[0]), **arrays)

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """The ids of each word as bytes, None if it is not in here. All words take a step at a time."""
        n = len(words)
        if not n or not len(self.edge):
            return [None] * n
        lengths = np.array([len(w) for w in words])
        flat, start = np.frombuffer(b"".join(words), np.uint8), np.cumsum(lengths) - lengths
        state, number = np.full(n, self.root, np.int64), np.zeros(n, np.int64)
        alive = np.flatnonzero(lengths > 0)
        state[lengths == 0] = -1
        step = 0
        while len(alive):
            key = state[alive] << 8 | flat[start[alive] + step]
            e = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            hit = self.edge[e] == key
            state[alive] = np.where(hit, self.target[e], -1)
            number[alive] += self.adds[e]
            step += 1
            alive = alive[hit & (lengths[alive] > step)]
        known = (state >= 0) & (self.final[np.maximum(state, 0)] > 0)
        raw = self.ids.tobytes()
        a = self.at[np.where(known, number, 0)].astype(np.int64) * 4
        b = self.at[np.where(known, number + 1, 0)].astype(np.int64) * 4
        return [raw[x:y] if k else None for k, x, y in zip(known.tolist(), a.tolist(), b.tolist())]


def _word_counts(batches: Iterator[pa.RecordBatch], path: str, most: int = 300_000) -> Iterator[pa.RecordBatch]:
    v, counts = Vocabulary(path), Counter()

    def found() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        counts.clear()
        return out

    for batch in batches:
        for text in texts(batch.column("body")):
            counts.update(v.words(text))
            if len(counts) > most:
                yield found()
    yield found()


def lexicon(docs: DataFrame, tokenizer: str, words: int = 50_000) -> Transducer:
    """The ``words`` most frequent words over all documents, compiled with their ids.

    ``words`` bounds what reaches the driver and the workers; words outside of it are merged
    where they occur, so it does not change any result.
    """
    ship(docs.sparkSession)
    rows = docs.select(*document_key()).select("body")
    counts = rows.mapInArrow(lambda it: _word_counts(it, tokenizer), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = counts.where("word not like ' %'")  # special strings have ids of their own
    top = counts.orderBy(F.desc("n"), "word").limit(words).select("word").toArrow().column("word").to_pylist()
    v = Vocabulary(tokenizer)
    return Transducer.compile({w.encode(): merged(w, v) for w in top})


class Codec(Memory):
    """Word -> (ids as bytes, the text they spell), by the transducer and, for words it lacks, by merges."""

    def __init__(self, tokenizer: str, packed: bytes, most: int = 300_000) -> None:
        self.v, self.lexicon = Vocabulary(tokenizer), Transducer.mapped(packed)
        self.encoder = Encoder(self.v, self._words)
        super().__init__(self._both, most)

    def _words(self, new: list[str]) -> list[bytes]:
        found = self.lexicon.find([w.encode() for w in new])
        return [array("I", merged(w, self.v)).tobytes() if x is None else x for w, x in zip(new, found)]

    def _both(self, new: list[str]) -> list[tuple[bytes, str]]:
        names = self.v.names
        return [(x, " ".join([names[i] for i in array("I", x)])) for x in self.encoder.fill(new)]


@lru_cache(1)
def _codec(tokenizer: str, lexicon: bytes) -> Codec:
    """One per worker process, which keeps what it has learnt from task to task."""
    return Codec(tokenizer, lexicon)


def _coded(batches: Iterator[pa.RecordBatch], tokenizer: str, packed) -> Iterator[tuple[int, pa.RecordBatch, list[tuple[bytes, str]]]]:
    """Parts of batches: where each begins, its batch, and ids and decoded text of its rows."""
    codec = _codec(tokenizer, packed.value)
    for batch in batches:
        bodies = texts(batch.column("body"))
        for first in range(0, len(bodies), 256):
            split = [codec.v.words(t) for t in bodies[first : first + 256]]
            codec.learn(set().union(*split))
            pairs = [[codec[x] for x in s] for s in split]
            yield first, batch, [(b"".join([x for x, _ in p]), " ".join([t for _, t in p])) for p in pairs]


def _encoded(batches: Iterator[pa.RecordBatch], tokenizer: str, packed) -> Iterator[pa.RecordBatch]:
    for first, batch, coded in _coded(batches, tokenizer, packed):
        docs = batch.column("doc").slice(first, len(coded))
        ids = [np.frombuffer(x, "<u4").astype(np.int32) for x, _ in coded]
        yield pa.RecordBatch.from_arrays([docs, pa.array(ids, pa.list_(pa.int32())), pa.array([t for _, t in coded], pa.string())], ["doc", "ids", "decoded"])


def _digested(batches: Iterator[pa.RecordBatch], tokenizer: str, packed) -> Iterator[pa.RecordBatch]:
    for first, batch, coded in _coded(batches, tokenizer, packed):
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc").slice(first, len(coded)), pa.array([len(x) // 4 for x, _ in coded], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x, _ in coded]), pa.array([hashlib.sha256(t.encode()).hexdigest() for _, t in coded]),
            ],
            ["doc", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def _run(docs: DataFrame, form, schema: str, tokenizer: str | None, words: int) -> DataFrame:
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    packed = docs.sparkSession.sparkContext.broadcast(lexicon(docs, path, words).packed())
    found = docs.select(*document_key()).select("doc", "body").mapInArrow(lambda it: form(it, path, packed), schema)
    return found.select(known_id().alias("doc_id"), *found.columns[1:])


def encode_documents(docs: DataFrame, tokenizer: str | None = None, words: int = 50_000) -> DataFrame:
    """Per row doc_id, ids (array) and decoded: the ids of the whole text, and the text they spell.

    As the tokenizers library with add_special_tokens=False and without truncation; decoded
    as its decode(ids, skip_special_tokens=False). The file has no decoder, so that is its
    tokens' names with spaces between. Special strings inside a text are one id each.

    Null and empty texts have no ids and decode to an empty text. Rows come out as often as
    they come in, a missing doc_id as null; other columns are not read; an empty table gives
    no rows.
    """
    return _run(docs, _encoded, "doc long, ids array<int>, decoded string", tokenizer, words)


def encoding_report(docs: DataFrame, tokenizer: str | None = None, words: int = 50_000) -> DataFrame:
    """Per row doc_id, n_tokens and the SHA-256 of ids and decoded text of ``encode_documents``."""
    return _run(docs, _digested, "doc long, n_tokens long, ids_sha256 string, decoded_sha256 string", tokenizer, words)


@query("op7_bpe_encoding")
def op7_bpe_encoding(spark: SparkSession, folder: str) -> DataFrame:
    return encoding_report(read(spark, folder, "documents"))
