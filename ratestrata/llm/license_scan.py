"""Licence scan by a positional index of rare words.

Each template is a text with mandatory key phrases. Its index entries are its rarest words, by inverse document
frequency over all documents, with their positions in the template. A file looks up those of its words that are in
the index, rarest first; each posting votes for the relative position (place in the file less place in the template), and
where enough votes meet, the template is laid against the file and its key phrases are verified word by word.

Phrase templates are their own key phrase: every word of theirs that is looked up must agree, so that
all places are found, and one word is enough to look up.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ratestrata.llm.common import raw_texts, slices, texts_of, words_of

#: Words of a template in the index.
RARE_WORDS = 6
#: Share of a template's indexed words that must meet at one relative position before it is verified.
VOTES = 0.5
#: Share of a template's words that must stand at their places for its label, key phrases apart.
MATCH = 0.7

# ---- fixed values: phrases, and well-known sentences of public licences -------------------------

BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
MORE_PHRASES = {
    "cc by sa": "cc-by-sa",
    "cc by 4": "cc-by",
    "creative commons zero": "cc0",
    "gnu general public license version 3": "gpl-3",
    "gnu general public license version 2": "gpl-2",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "under the bsd license": "bsd",
    "all rights reserved": "all-rights-reserved",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
#: label, text, mandatory key phrases
TEXTS = [
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation"
        " files the software to deal in the software without restriction",
        ["permission is hereby granted free of charge"],
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following"
        " conditions are met",
        ["redistribution and use in source and binary forms"],
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ["permission to use copy modify and or distribute this software"],
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as"
        " published by the free software foundation",
        ["gnu general public license"],
    ),
]

# ---- index --------------------------------------------------------------------------------------

#: Bytes that are no part of a word; words are [0-9A-Za-z and all beyond ASCII].
BREAKS = np.ones(256, bool)
BREAKS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    keys: tuple[tuple[int, int], ...]  # ranges of words that must agree
    base: bool

    @property
    def is_phrase(self) -> bool:
        return self.keys == ((0, len(self.words)),)


def _phrase_range(words: list[bytes], phrase: str) -> tuple[int, int]:
    own = phrase.encode().split()
    at = next(i for i in range(len(words)) if words[i : i + len(own)] == own)
    return at, at + len(own)


def templates() -> list[Template]:
    out = []
    for phrases, base in ((BASE_PHRASES, True), (MORE_PHRASES, False)):
        for phrase, label in phrases.items():
            words = phrase.encode().split()
            out.append(Template(label, tuple(words), ((0, len(words)),), base))
    for label, text, keys in TEXTS:
        words = text.encode().split()
        out.append(Template(label, tuple(words), tuple(_phrase_range(words, key) for key in keys), False))
    return out


class Index:
    """Postings `word -> [(template, position), ...]` of the rarest words of every template."""

    def __init__(self, all_templates: list[Template], idf: dict[bytes, float]) -> None:
        self.templates, self.idf = all_templates, idf
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.indexed = []
        for number, template in enumerate(all_templates):
            rare = sorted(set(template.words), key=lambda w: (-idf[w], w))[: 1 if template.is_phrase else RARE_WORDS]
            places = [(i, w) for i, w in enumerate(template.words) if w in rare]
            if template.is_phrase:
                places = places[:1]  # one place of the rarest word: a match has exactly one vote
            self.indexed.append(len(places))
            for i, word in places:
                self.postings[word].append((number, i))
        self.rarest_first = sorted(self.postings, key=lambda w: (-idf[w], w))

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], float]:
        """`(template, place)` of every match, and the largest share of a template found."""
        places = defaultdict(list)
        for i, word in enumerate(words):
            if word in self.postings:
                places[word].append(i)
        if not places:
            return [], 0.0
        votes: Counter = Counter()
        for word in self.rarest_first:
            for number, position in self.postings[word] if word in places else ():
                votes.update((number, i - position) for i in places[word])
        found, score = [], 0.0
        for (number, start), n in votes.items():
            template = self.templates[number]
            if n < VOTES * self.indexed[number]:
                continue
            here = [0 <= start + i < len(words) and words[start + i] == word for i, word in enumerate(template.words)]
            share = sum(here) / len(here)
            if all(all(here[a:b]) for a, b in template.keys) and share >= MATCH:
                found.append((number, start))
                score = max(score, share)
        return found, score


def document_frequencies(docs: DataFrame, vocabulary: set[bytes]) -> tuple[dict[bytes, int], int]:
    """In how many of all documents each word of the templates stands. What returns is bounded by the templates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = Counter(), 0
        for batch in slices(batches):
            n += batch.num_rows
            for words in _words(raw_texts(batch)):
                counts.update(vocabulary.intersection(words))
        yield pa.record_batch(
            [pa.array([None, *counts], pa.binary()), pa.array([n, *counts.values()], pa.int64())], names=["word", "n"]
        )

    totals = texts_of(docs).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {None if row["word"] is None else bytes(row["word"]): row["n"] for row in totals}
    return {word: found.get(word, 0) for word in vocabulary}, found.get(None, 0)


def _words(texts: list[bytes]) -> list[list[bytes]]:
    words = words_of(texts, lower=True, breaks=BREAKS)
    table = bytes(words.buffer)
    spans = list(zip(words.starts.tolist(), words.ends.tolist()))
    return [[table[s:e] for s, e in spans[a:b]] for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist())]


def licences(docs: DataFrame) -> DataFrame:
    """One row per row of `docs(doc_id, text)`.

    `doc_id, n_words`; of the base phrases `n_base` (all places), `first_word`, `last_word` (null without any) and
    `base_labels`; `labels` of all templates found, distinct, sorted and joined by commas; `score`, the largest share of a
    template's words found at their places; `matches` with label, place and length. Null and empty texts have no words.
    """
    known = templates()
    frequency, n = document_frequencies(docs, {word for template in known for word in template.words})
    index = Index(known, {word: math.log((n + 1) / (count + 1)) for word, count in frequency.items()})
    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
        " score double, matches array<struct<label:string,word:long,length:int>>"
    )
    match = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("length", pa.int32())]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), match]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for words in _words(raw_texts(batch)):
                found, score = index.scan(words)
                base = sorted(start for number, start in found if known[number].base)
                labels = [sorted({known[k].label for k, _ in found if known[k].base or every}) for every in (False, True)]
                rows.append((
                    len(words), len(base), base[0] if base else None, base[-1] if base else None, *(",".join(x) for x in labels), score,
                    [{"label": known[k].label, "word": s, "length": len(known[k].words)} for k, s in sorted(found, key=lambda x: (x[1], x[0]))],
                ))
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))], names=names)

    return texts_of(docs).mapInArrow(run, schema)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("matches")
