"""Licence scan with a positional index of rare licence words.

Templates are short passages of licence notices (``TEMPLATES``) and whole licence texts
(``license_texts.WHOLE``). Their words carry IDF weights from the document frequencies of all documents. The
index holds, for each template, its words of the highest IDF with their
positions: ``INDEX_WORDS`` of a passage, one in ``INDEX_SHARE`` of a whole text. A document's occurrences of index words are looked up, and the
postings are intersected by relative position: word at p, template position q
vote for a start at p - q. Copies of a whole text have words of their own between its parts, such as the
name of a holder, so the places of its words may drift by one in ``SLACK_SHARE`` of its length: votes are gathered in cells of that
width, twice over, half a width apart. A start with enough weight is verified: the words that stand at their
places have to hold enough of the template's whole weight, and each mandatory
key phrase has to stand at its place, word by word.

Base phrases are plain sequences of words; each place counts, and their labels
always stay.

Words are the runs ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z
lower-cased.

Defined cases: a null or empty text has no words, no label and score 0.
Overlapping places all count. Repeated rows are scanned each for itself. An
empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import math
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, batches_of, byte_table, in_arrow, sliced
from .license_texts import WHOLE

IS_WORD = byte_table(keep=string.ascii_lowercase + string.digits)

#: Phrases and labels of the base scan.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Fixed values from public licence texts and notices: label, passage, mandatory key phrase.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    ("apache-2.0", "you may not use this file except in compliance with the license", "except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", "attribution noncommercial"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license", "attribution sharealike"),
    ("cc0", "cc0 1 0 universal public domain dedication", "public domain dedication"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "distribute this software"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "free of charge to any person"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
)

INDEX_WORDS = 4
"""Words of a passage that the index holds, those of the highest IDF."""
INDEX_SHARE = 8
"""The index holds one in this many words of a whole text."""
SLACK_SHARE = 8
"""The words of a whole text may be off their places by its length divided by this."""
LEAST_WEIGHT = 0.6
"""Share of a template's indexed weight, and of its whole weight, that a place has to have."""


def plain(text: str) -> str:
    """The words of a template, parted by spaces."""
    return " ".join(re.findall("[a-z0-9]+", text.lower()))


def vocabulary() -> list[str]:
    texts = [*BASE, *(p for _, p, _ in TEMPLATES), *(plain(t) for t, _ in WHOLE.values())]
    return sorted({w for t in texts for w in t.split()})


def _word_hashes(words: list[str]) -> np.ndarray:
    return Words([w.encode() for w in words], IS_WORD).hashes()


class Lexicon:
    """Numbers the licence words: -1 for any other."""

    def __init__(self, words: list[str]):
        hashes = _word_hashes(words)
        self.number = {w: i for i, w in enumerate(words)}
        self._order = np.argsort(hashes)
        self._hashes = hashes[self._order]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self._hashes, hashes), len(self._hashes) - 1)
        return np.where(self._hashes[at] == hashes, self._order[at], -1)


def document_frequencies(batches: Iterator[pa.RecordBatch], words: list[str]) -> Iterator[pa.RecordBatch]:
    """(text) to (word, n): documents of a batch that hold a licence word; word -1 counts documents."""
    lexicon = Lexicon(words)
    for batch in batches:
        counts = np.zeros(len(words) + 1, dtype=np.int64)
        for _, run in batches_of(batch.column(0).to_pylist()):
            found = Words(run, IS_WORD)
            numbers = lexicon.numbers(found.hashes())
            at = np.flatnonzero(numbers >= 0)
            doc = np.searchsorted(found.first, at, side="right") - 1
            pairs = np.unique(doc * len(words) + numbers[at])
            counts[:-1] += np.bincount(pairs % len(words), minlength=len(words))
            counts[-1] += len(run)
        yield pa.RecordBatch.from_arrays([pa.array([*range(len(words)), -1]), pa.array(counts)], ["word", "n"])


@dataclass
class Template:
    """A template as word numbers, the bounds of its mandatory phrases, and how far its words may be off their places."""

    label: str
    tokens: np.ndarray
    weights: np.ndarray
    phrases: list[tuple[int, int]]
    slack: int
    indexed: float = 0.0

    def share(self, numbers: np.ndarray, low: int, high: int, start: int) -> float:
        """The share of its weight that stands at its places from ``start`` on, within the document from
        ``low`` to ``high``; 0 if a mandatory phrase doesn't."""
        at = start + np.arange(len(self.tokens))[:, None] + np.arange(-self.slack, self.slack + 1)
        same = (numbers[np.clip(at, low, high - 1)] == self.tokens[:, None]) & (at >= low) & (at < high)
        if not all(same[a:b].all(axis=0).any() for a, b in self.phrases):
            return 0.0
        return float(self.weights[same.any(axis=1)].sum() / self.weights.sum())


@dataclass
class Index:
    """Templates, and postings (template, position) of the rare words."""

    idf: list[float]
    postings: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    templates: list[Template] = field(default_factory=list)

    @classmethod
    def build(cls, words: list[str], idf: list[float]) -> Index:
        out, number = cls(idf), {w: i for i, w in enumerate(words)}
        for label, passage, key in TEMPLATES:
            out._add(label, [number[w] for w in passage.split()], [[number[w] for w in key.split()]], INDEX_WORDS, 0)
        for label, (text, keys) in WHOLE.items():
            tokens = [number[w] for w in plain(text).split()]
            out._add(label, tokens, [[number[w] for w in k.split()] for k in keys], len(tokens) // INDEX_SHARE, len(tokens) // SLACK_SHARE)
        return out

    def _add(self, label: str, tokens: list[int], keys: list[list[int]], n_indexed: int, slack: int) -> None:
        starts = [next(i for i in range(len(tokens)) if tokens[i : i + len(k)] == k) for k in keys]
        weights = np.array([self.idf[w] for w in tokens])
        rare = sorted(range(len(tokens)), key=lambda i: (-weights[i], i))[:n_indexed]
        for q in rare:
            self.postings.setdefault(tokens[q], []).append((len(self.templates), q))
        phrases = [(a, a + len(k)) for a, k in zip(starts, keys, strict=True)]
        self.templates.append(Template(label, np.array(tokens), weights, phrases, slack, float(weights[rare].sum())))

    def candidates(self, places: np.ndarray, documents: np.ndarray, numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(document, template, start) that enough of the index words at ``places`` vote for."""
        votes: dict[tuple[int, int, int, int], dict[int, int]] = {}
        for p, d, w in zip(places.tolist(), documents.tolist(), numbers.tolist(), strict=True):
            for t, q in self.postings[w]:
                width = max(1, self.templates[t].slack)
                for series in (0, width // 2) if width > 1 else (0,):
                    votes.setdefault((d, t, series, (p - q + series) // width), {}).setdefault(q, p - q)
        seen = set()
        for (d, t, _, _), starts in votes.items():
            template = self.templates[t]
            if sum(template.weights[q] for q in starts) < LEAST_WEIGHT * template.indexed:
                continue
            weight: dict[int, float] = {}
            for q, start in starts.items():
                weight[start] = weight.get(start, 0.0) + template.weights[q]
            best = min(weight, key=lambda s: (-weight[s], s))  # the start that most of the weight asks for
            if (d, t, best) not in seen:
                seen.add((d, t, best))
                yield d, t, best


SCANNED = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_texts(texts: list[str | None], index: Index, lexicon: Lexicon) -> Iterator[tuple]:
    """The columns of SCANNED for each text."""
    base = [([lexicon.number[w] for w in p.split()], label) for p, label in BASE.items()]
    for _, run in batches_of(texts):
        found = Words(run, IS_WORD)
        numbers, first = lexicon.numbers(found.hashes()), found.first
        padded = np.concatenate([numbers, np.full(8, -1)])
        document = lambda at: np.searchsorted(first, at, side="right") - 1
        places: dict[int, list[int]] = {}
        labels: dict[int, set[str]] = {}
        for phrase, label in base:
            at = np.flatnonzero(numbers == phrase[0])
            for i, w in enumerate(phrase[1:], 1):
                at = at[padded[at + i] == w]
            for p, d in zip(at.tolist(), document(at).tolist(), strict=True):
                if p + len(phrase) <= first[d + 1]:
                    places.setdefault(d, []).append(p - int(first[d]))
                    labels.setdefault(d, set()).add(label)
        more: dict[int, dict[str, float]] = {}
        at = np.flatnonzero(np.isin(numbers, list(index.postings)))
        for d, t, start in index.candidates(at, document(at), numbers[at]):
            template = index.templates[t]
            share = template.share(numbers, int(first[d]), int(first[d + 1]), start)
            if share >= LEAST_WEIGHT:
                best = more.setdefault(d, {})
                best[template.label] = max(best.get(template.label, 0.0), share)
        for d in range(len(run)):
            own, of_method, spots = labels.get(d, set()), more.get(d, {}), places.get(d, [])
            yield (
                int(first[d + 1] - first[d]),
                len(spots),
                min(spots, default=None),
                max(spots, default=None),
                ",".join(sorted(own)),
                ",".join(sorted(own | set(of_method))),
                1.0 if own else min(1.0, max(of_method.values(), default=0.0)),
            )


def scan_batches(batches: Iterator[pa.RecordBatch], words: list[str], idf: list[float]) -> Iterator[pa.RecordBatch]:
    lexicon, index = Lexicon(words), Index.build(words, idf)
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    names = ["doc_id"] + [c.split()[0] for c in SCANNED.split(", ")]
    for batch in sliced(batches):
        columns = list(zip(*scan_texts(batch.column(1).to_pylist(), index, lexicon), strict=True)) or [[]] * len(types)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id and the columns of ``SCANNED`` for every row of ``docs`` (doc_id, text).

    The document frequencies that come to the driver are one number for each
    licence word: their count is that of the fixed vocabulary."""
    words = vocabulary()
    counted = in_arrow(docs.select("text"), lambda it: document_frequencies(it, words), "word long, n long")
    counts = {r.word: r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    idf = [math.log((counts.get(-1, 0) + 1) / (counts.get(i, 0) + 1)) + 1e-3 for i in range(len(words))]
    return in_arrow(docs.select("doc_id", "text"), lambda it: scan_batches(it, words, idf), "doc_id long, " + SCANNED)
