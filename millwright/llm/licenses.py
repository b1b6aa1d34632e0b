"""Licence notices by a positional index of rare tokens.

Templates are short notices, standard notices and whole texts. Each is looked up by its
words of highest IDF, which is taken over all documents. A word of a file that is such an
anchor names, by the index, template and place in it; the difference of the places in file
and template is where the notice would start. Starts named by several anchors within a few
words are candidates. A candidate is a match if its mandatory phrases stand there word for
word and enough of the template's other words do at their relative places. All of that is
done on sorted places, for all candidates of a template together: a text takes time and
memory in proportion to its words, whatever it repeats.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import bytes_of, slices, take
from millwright.llm.license_texts import TEXTS

#: Lower-case words: runs of ASCII digits and letters and of all other characters from U+0080.
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Phrases that name a label wherever they stand.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices of public licences; a phrase in brackets is mandatory.
TEMPLATES = {
    "agpl-3.0": "licensed under the [gnu affero general public license] version 3",
    "apache-2.0": "licensed under the [apache license] [version 2 0]",
    "bsd": "[redistribution and use in source and binary forms] with or without modification are permitted",
    "bsd-3-clause": "licensed under the [bsd 3 clause] license",
    "bsl-1.0": "distributed under the [boost software license] version 1 0",
    "cc-by-4.0": "licensed under a [creative commons attribution 4 0] international license",
    "cc-by-nc": "licensed under [cc by nc] 4 0",
    "cc-by-sa": "licensed under [cc by sa] 4 0",
    "cc0": "[cc0 1 0] universal public domain dedication",
    "epl-2.0": "made available under the terms of the [eclipse public license] 2 0",
    "gpl-2.0": "licensed under the gnu [general public license version 2]",
    "gpl-3.0": "licensed under the gnu [general public license version 3]",
    "isc": "[permission to use copy modify] and or [distribute this software for any purpose] with or without fee is hereby granted",
    "lgpl": "licensed under the gnu [lesser general public license]",
    "mit": "released under the [mit license]",
    "mit/short": "[permission is hereby granted free of charge to any person obtaining a copy] of this software",
    "mpl-2.0": "subject to the terms of the [mozilla public license] v 2 0",
    "unlicense": "this is [free and unencumbered software] released into the public domain",
}
PART = 8 << 20


class Template:
    def __init__(self, name: str, text: str):
        self.label = name.split("/")[0]
        self.words = WORDS.findall(text.replace("[", " ").replace("]", " ").lower().encode())
        self.phrases = []
        at = 0
        for outside, inside in re.findall(r"([^\[]*)(?:\[([^\]]*)\])?", text):
            at += len(WORDS.findall(outside.lower().encode()))
            phrase = WORDS.findall(inside.lower().encode())
            if phrase:
                self.phrases.append((at, phrase))
            at += len(phrase)


def within(places: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether a place stands between low and high, both included. places is sorted."""
    return np.searchsorted(places, low) < np.searchsorted(places, high, "right")


class Index:
    """Postings of the anchors: word to (template, place). idf: of every template word."""

    def __init__(self, templates: list[Template], phrases: Mapping[str, str], idf: Mapping[bytes, float], anchors: int):
        rarity = lambda w: (-idf.get(w, math.inf), w)
        self.templates, self.idf = templates, idf
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.needed = []
        for t, template in enumerate(templates):
            chosen = sorted(set(template.words), key=rarity)[: max(anchors, len(template.words) // 10)]
            for at, word in enumerate(template.words):
                if word in chosen:
                    self.postings[word].append((t, at))
            self.needed.append(min(2, len(chosen)))
        self.base = defaultdict(list)
        for phrase, label in phrases.items():
            words = WORDS.findall(phrase.encode())
            rarest = min(range(len(words)), key=lambda i: rarity(words[i]))
            self.base[words[rarest]].append((rarest, words, label))
        self.wanted = set(self.postings) | set(self.base)
        self.vocabulary = {w for t in templates for w in t.words}

    def scan(self, words: list[bytes], slack: int, coverage: float) -> tuple:
        """(base places, first, last, base labels, labels, score) of a file's words."""
        places = positions(words, self.wanted)
        starts, base = [], set()
        for word, entries in self.base.items():
            for at in places.get(word, ()):
                for offset, phrase, label in entries:
                    if at >= offset and words[at - offset : at - offset + len(phrase)] == phrase:
                        starts.append(int(at) - offset)
                        base.add(label)
        labels, score = set(base), 1.0 if base else 0.0
        votes: dict[int, dict[bytes, list[np.ndarray]]] = defaultdict(lambda: defaultdict(list))
        for word, found in places.items():
            for t, at in self.postings.get(word, ()):
                votes[t][word].append(found - at)
        everything = None
        for t, named in votes.items():
            if len(named) < self.needed[t]:
                continue
            template = self.templates[t]
            near = slack + len(template.words) // 20  # words left out or put in move the rest of a long text
            each = [np.unique(np.concatenate(v)) for v in named.values()]
            begins = np.unique(np.concatenate(each))
            agree = sum(within(e, begins - near, begins + near).astype(np.int64) for e in each)
            begins = begins[agree >= self.needed[t]]
            if len(begins):
                everything = positions(words, self.vocabulary) if everything is None else everything
                share = self.verify(everything, template, begins, near)
                if share >= coverage:
                    labels.add(template.label)
                    score = max(score, share)
        return len(starts), min(starts, default=None), max(starts, default=None), base, labels, score

    def verify(self, places: Mapping[bytes, np.ndarray], template: Template, begins: np.ndarray, slack: int) -> float:
        """The largest share, by IDF, of the template's words near their places; 0 without a phrase."""
        none = np.zeros(0, np.int64)
        for at, phrase in template.phrases:
            hits = places.get(phrase[0], none)
            for i, word in enumerate(phrase[1:], 1):
                hits = np.intersect1d(hits, places.get(word, none) - i, assume_unique=True)
            begins = begins[within(hits, begins + (at - slack), begins + (at + slack))]
        if not len(begins):
            return 0.0
        weights = [self.idf.get(w, 1.0) for w in template.words]
        there = np.zeros(len(begins))
        for i, (word, weight) in enumerate(zip(template.words, weights, strict=True)):
            there += weight * within(places.get(word, none), begins + (i - slack), begins + (i + slack))
        return min(1.0, float(there.max()) / sum(weights)) if sum(weights) else 1.0


def positions(words: list[bytes], wanted: set[bytes]) -> dict[bytes, np.ndarray]:
    """Where the wanted words stand, in ascending order."""
    found: dict[bytes, array] = defaultdict(lambda: array("q"))
    for i, word in enumerate(words):
        if word in wanted:
            found[word].append(i)
    return {word: np.frombuffer(at, np.int64) for word, at in found.items()}


def _words(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    for part in slices(batch, pc.binary_length(batch.column(column)), PART):
        yield part, [WORDS.findall(t.lower()) for t in bytes_of(part.column(column))]


def idf(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, float]:
    """Of the vocabulary's words over all documents; what no document has is rarest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, counts = 0, Counter()
        for batch in batches:
            for _, lists in _words(batch, 0):
                total += len(lists)
                for words in lists:
                    counts.update(vocabulary.intersection(words))
        # Without any word, "" stands for the number of documents.
        words = [b"", *counts]
        numbers = pa.array([total, *counts.values()], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), numbers], names=["word", "n"])

    rows = take(docs, "text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {bytes(r.word): r.n for r in rows.collect()}  # a row for each word of the templates
    total = found.pop(b"", 0)
    return {w: math.log((total + 1) / (found.get(w, 0) + 1)) + 1 for w in vocabulary}


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES | TEXTS,
    phrases: Mapping[str, str] = PHRASES,
    anchors: int = 3,
    slack: int = 2,
    coverage: float = 0.6,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    For every row of docs; a null text counts as empty. Labels are sorted and joined by
    commas; a template's is its name up to a slash. score: 1 if a base phrase stands in the text, else the largest share, by IDF,
    of a matched template's words, else 0. A template matches from a share of `coverage`.
    """
    made = [Template(n, t) for n, t in templates.items()]
    vocabulary = {w for t in made for w in t.words} | {w for p in phrases for w in WORDS.findall(p.encode())}
    index = Index(made, phrases, idf(docs, vocabulary), anchors)
    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double"
    )
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, lists in _words(batch, 1):
                rows = []
                for words in lists:
                    n, first, last, base, labels, score = index.scan(words, slack, coverage)
                    rows.append((len(words), n, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=names)

    return take(docs, "doc_id", "text").mapInArrow(run, schema)
