"""License scans: a positional index of rare licence words, aligned by relative position, verified by key phrases.

DataFrame functions only: all of a file's work is done in its own row, and nothing is shuffled
but one row per licence word and task, for the words' document frequencies.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.common import lower_ascii
from lodeworks.llm.registry import query, read

#: Labels and the words of notices and licence texts. Key phrases, all of which must stand, in brackets.
NOTICES = (
    ("mit", "released under the [mit license]"),
    ("apache", "licensed under the [apache license]"),
    ("gpl", "licensed under the gnu [general public license]"),
    ("mit", "[permission is hereby granted free of charge] to any person obtaining a copy of this [software and associated documentation files]"),
    ("apache-2.0", "licensed under the [apache license version 2 0]"),
    ("gpl-2.0", "licensed under the [gnu general public license version 2]"),
    ("gpl-3.0", "licensed under the [gnu general public license version 3]"),
    ("lgpl", "under the terms of the [gnu lesser general public license]"),
    ("agpl-3.0", "under the terms of the [gnu affero general public license version 3]"),
    ("mpl-2.0", "subject to the terms of the [mozilla public license v 2 0]"),
    ("bsd", "[redistribution and use in source and binary forms] with or without modification [are permitted]"),
    ("isc", "[permission to use copy modify and or distribute this software] for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is [free and unencumbered software released into the public domain]"),
    ("cc-by-4.0", "licensed under [cc by 4 0]"),
    ("cc-by-sa-4.0", "licensed under [cc by sa 4 0]"),
    ("cc-by-nc-4.0", "licensed under [cc by nc 4 0]"),
    ("cc-by-nd-4.0", "licensed under [cc by nd 4 0]"),
    ("cc0-1.0", "dedicated under [cc0 1 0]"),
)
#: The first notices, whose one key phrase is counted at every place.
N_BASE = 3
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    #: Where each key phrase starts, and its words.
    keys: tuple[tuple[int, tuple[str, ...]], ...]

    @classmethod
    def parse(cls, label: str, text: str) -> Template:
        words, keys = [], []
        for k, part in enumerate(re.split(r"[\[\]]", text)):
            if k % 2:
                keys.append((len(words), tuple(part.split())))
            words += part.split()
        return cls(label, tuple(words), tuple(keys))

    @property
    def key_words(self) -> dict[str, int]:
        """Words of the key phrases, each with the first place of it there."""
        places = [(w, start + k) for start, phrase in self.keys for k, w in enumerate(phrase)]
        return dict(reversed(places))


TEMPLATES = tuple(Template.parse(*x) for x in NOTICES)


def _strings(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def words_of(text: Column) -> Column:
    """Runs of digits, ASCII letters in lower case and all characters beyond ASCII."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _BREAK, -1), "")


def word_weights(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, float]:
    """1 + ln((documents + 1) / (documents with the word + 1)) of each template word, over all documents.

    What reaches the driver is a row per word of the templates.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    held = docs.select(F.array_intersect(words_of(F.col("text")), _strings(vocabulary)).alias("held"))
    counts = held.select(F.explode(F.concat("held", F.array(F.lit("")))).alias("word")).groupBy("word").count()
    seen = {r["word"]: r["count"] for r in counts.collect()}
    n = seen.pop("", 0)  # the empty word stands for the document itself
    return {w: 1 + math.log((n + 1) / (seen.get(w, 0) + 1)) for w in vocabulary}


def _aligned(t: Template, weights: dict[str, float], anchors: int) -> Column:
    """Offsets in ``words`` at which the template's rarest key words, and then all its key phrases, stand.

    A file that holds the template holds its key words, so the rarest of them are the file's
    highest-weight words of this template. Their places, moved by their places in the
    template, are intersected before any phrase is compared.
    """
    words, n = F.col("words"), F.col("n_words").cast("int")
    rare = sorted(t.key_words.items(), key=lambda x: (-weights[x[0]], x[1]))[:anchors]

    def places(word: str, at: int) -> Column:
        every = F.transform(words, lambda w, i: F.when(w == word, i - at))
        return F.filter(every, lambda i: i.isNotNull())

    offsets = reduce(F.array_intersect, [places(w, at) for w, at in rare])

    def stands(o: Column) -> Column:
        tests = [
            F.when((o + start >= 0) & (o + start + len(phrase) <= n), F.slice(words, o + start + 1, len(phrase)) == _strings(phrase)).otherwise(False)
            for start, phrase in t.keys
        ]
        return reduce(lambda a, b: a & b, tests)

    held = F.size(F.array_intersect(F.col("held"), _strings(t.key_words))) == len(t.key_words)
    return F.when(held, F.filter(offsets, stands)).otherwise(F.array().cast("array<int>"))


def _share(t: Template, weights: dict[str, float], offsets: str) -> Column:
    """The best share of the template's weight that stands in place at one of the offsets."""
    total = sum(weights[w] for w in t.words)

    def share(o: Column) -> Column:
        return reduce(lambda a, b: a + b, [F.when(F.get(F.col("words"), o + k) == w, weights[w]).otherwise(0.0) for k, w in enumerate(t.words)])

    return F.array_max(F.transform(offsets, share)) / total


def _moved(offsets: str, by: int) -> Column:
    return F.transform(offsets, lambda o: (o + by).cast("long"))


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, base: int = N_BASE, anchors: int = 3) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, notices.

    The first ``base`` templates have one key phrase each: n_base counts its places, first_word
    and last_word are the smallest and largest start (words from 0; null without any),
    base_labels the labels found so. labels has those of all templates. Both are distinct,
    sorted and joined by commas. score is the best share of a template's weight that stands in
    place (0 to 1, six digits), notices an array of (label, the words at which it
    would start, best share).

    Null text is a text without words: no labels, score 0. Rows come out as they come in, with a
    null doc_id or a repeated one as well. Other columns are not read. An empty table gives none.
    """
    weights = word_weights(docs, templates)
    keys = sorted({w for t in templates for w in t.key_words})
    rows = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    rows = rows.select("doc_id", "words", F.size("words").cast("long").alias("n_words"), F.array_intersect("words", _strings(keys)).alias("held"))
    # nearly all files lack some key word of every template and go no further
    possible = reduce(lambda a, b: a | b, [F.size(F.array_intersect(F.col("held"), _strings(t.key_words))) == len(t.key_words) for t in templates])
    rows = rows.withColumn("words", F.when(possible, F.col("words")).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("held", F.when(possible, F.col("held")).otherwise(F.array().cast("array<string>")))
    found = rows.select("doc_id", "n_words", "words", *[_aligned(t, weights, anchors).alias(f"t{k}") for k, t in enumerate(templates)])
    notices = [
        F.when(F.size(f"t{k}") > 0, F.struct(F.lit(t.label).alias("label"), F.col(f"t{k}").alias("offsets"), _share(t, weights, f"t{k}").alias("share")))
        for k, t in enumerate(templates)
    ]
    starts = F.concat(*[_moved(f"t{k}", t.keys[0][0]) for k, t in enumerate(templates[:base])])
    based = [F.when(F.size(f"t{k}") > 0, F.lit(t.label)) for k, t in enumerate(templates[:base])]
    found = found.select("doc_id", "n_words", starts.alias("starts"), F.array(*based).alias("based"), F.filter(F.array(*notices), lambda x: x.isNotNull()).alias("notices"))
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(F.filter(c, lambda x: x.isNotNull()))), ",")
    return found.select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").alias("first_word"), F.array_max("starts").alias("last_word"),
        listed(F.col("based")).alias("base_labels"), listed(F.transform("notices", lambda x: x["label"])).alias("labels"),
        F.round(F.coalesce(F.array_max(F.transform("notices", lambda x: x["share"])), F.lit(0.0)), 6).alias("score"), "notices",
    )


def _sql() -> str:
    rows = [
        f"({k}, '{t.label}', {p}, '{w}', {any(s <= p < s + len(x) for s, x in t.keys)}, {sum(len(x) for _, x in t.keys)}, {t.keys[0][0]})"
        for k, t in enumerate(TEMPLATES) for p, w in enumerate(t.words)
    ]
    return f"""
WITH template(t, label, pos, word, is_key, n_keys, first_key) AS (VALUES {", ".join(rows)}),
texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS words
  FROM documents),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM texts),
frequency AS (SELECT word, count(DISTINCT doc_id) AS df FROM placed WHERE word IN (SELECT word FROM template) GROUP BY word),
weight AS (
  SELECT DISTINCT word, 1 + ln(((SELECT count(*) FROM documents) + 1) / (coalesce(df, 0) + 1)) AS idf
  FROM template LEFT JOIN frequency USING (word)),
total AS (SELECT t, sum(idf) AS total FROM template JOIN weight USING (word) GROUP BY t),
notice AS (
  SELECT doc_id, t, any_value(label) AS label, p.pos - x.pos AS start, any_value(first_key) AS first_key, sum(idf) AS got
  FROM placed p JOIN template x USING (word) JOIN weight USING (word)
  GROUP BY doc_id, t, p.pos - x.pos HAVING count(*) FILTER (is_key) = any_value(n_keys)),
found AS (
  SELECT doc_id, count(*) FILTER (t < {N_BASE}) AS n_base,
         min(start + first_key) FILTER (t < {N_BASE}) AS first_word, max(start + first_key) FILTER (t < {N_BASE}) AS last_word,
         list(DISTINCT label) FILTER (t < {N_BASE}) AS base_labels, list(DISTINCT label) AS labels, max(got / total) AS score
  FROM notice JOIN total USING (t) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base_labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(labels), ','), '') AS labels, round(coalesce(score, 0), 6) AS score
FROM texts LEFT JOIN found USING (doc_id)
"""


@query("op1_license_scan", _sql())
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(read(spark, folder, "documents")).drop("notices")
