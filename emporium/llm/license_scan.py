r"""License scans: an exact set-similarity join of text blocks with templates.

A block is a run of words of the text, wherever its lines end (a notice may be
wrapped): for a template of t words, repeats included, every t + ``SLACK``
words in a row, or the whole of a shorter text.  A block matches a template
when it holds at least ``THRESHOLD`` of the template's distinct words.  Words
are runs of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z.

1. Pass one counts how often each template word occurs in all documents; the
   words are ranked by that global frequency, rarest first.
2. Pass two joins.  Prefix filter: a template of t distinct words that must
   share o of them has to share one of its t - o + 1 rarest; an index holds
   only those, and only blocks around their occurrences are looked at.  Length
   filter: a text, or a stretch of such blocks, with fewer than o of the
   template's words cannot match.  Positional filter: with the words of both
   sides in rank order, a shared word at position i of the template and j of
   the stretch leaves room for at most min(t - i, b - j) shared words.  What
   is left is slid over and counted exactly.

The templates are a fixed list, so what a task holds does not grow.  Beside
the templates, fixed phrases are found at every place where their words
stand in a row.

Defined results: null and empty texts have no words and no labels.  Ties and
repeated rows are answered one by one, an empty table gives no rows, other
columns are not read, very long texts are scanned whole.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.9
#: Words that a block has beyond the template's: what may stand between its
#: words ("under the terms of the", marks of comment lines).
SLACK = 8

# Phrases and their labels
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices (from the licenses themselves) and their labels
TEMPLATES = [
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ("Released under the MIT License", "mit-notice"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files", "mit-notice"),
    ("GNU General Public License, version 3", "gpl-3.0"),
    ("GNU General Public License, version 2", "gpl-2.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms "
     "of the GNU General Public License as published by the Free Software Foundation", "gpl-notice"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc-4.0"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa-4.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License",
     "cc-by-4.0"),
    ("Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License", "mpl-2.0"),
]

# Bytes of words stay, A-Z become a-z, everything else is a space
_WORDS = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else
               c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORDS).split() if text else []


_TEMPLATE_WORDS = [sorted(set(words_of(t))) for t, _ in TEMPLATES]
_BLOCK_WORDS = [len(words_of(t)) + SLACK for t, _ in TEMPLATES]
_VOCABULARY = {w: i for i, w in enumerate(sorted({w for t in _TEMPLATE_WORDS for w in t}))}
_PHRASE_WORDS = [(tuple(words_of(p)), label) for p, label in PHRASES.items()]
_PHRASES_BY_FIRST = {}
for _words, _label in _PHRASE_WORDS:
    _PHRASES_BY_FIRST.setdefault(_words[0], []).append((_words, _label))


def phrase_places(words: list[bytes]) -> list[tuple[int, str]]:
    """``(start, label)`` of every place of a phrase."""
    found = []
    for first, phrases in _PHRASES_BY_FIRST.items():
        at = -1
        for _ in range(words.count(first)):
            at = words.index(first, at + 1)
            found += [(at, label) for p, label in phrases if tuple(words[at:at + len(p)]) == p]
    return found


class TemplateIndex:
    """The templates in global rank order, with the prefix index."""

    def __init__(self, frequency: dict[bytes, int]):
        order = sorted(_VOCABULARY, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(order)}
        self.templates, self.need = [], []
        self.prefix: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for words in _TEMPLATE_WORDS:
            ranks = sorted(self.rank[w] for w in words)
            # (the threshold in hundredths: no rounding of 0.9 x t)
            need = math.ceil(round(THRESHOLD * 100) * len(ranks) / 100)
            for i, r in enumerate(ranks[:len(ranks) - need + 1]):
                self.prefix[r].append((len(self.templates), i))
            self.templates.append(frozenset(ranks))
            self.need.append(need)
        self.least = min(self.need)

    def matches(self, words: list[bytes]) -> dict[int, float]:
        """template → best containment in a block, for the templates the text meets."""
        present = {self.rank[w] for w in set(words) if w in self.rank}
        if len(present) < self.least:  # length filter, for all templates
            return {}
        tried = {t for r in present for t, _ in self.prefix.get(r, ())
                 if len(present & self.templates[t]) >= self.need[t]}
        if not tried:
            return {}
        places = [(k, self.rank[w]) for k, w in enumerate(words) if w in self.rank]
        found = {}
        for t in sorted(tried):
            own = [(k, r) for k, r in places if r in self.templates[t]]
            shared = max((self._best(t, part) for part in self._stretches(t, own)), default=0)
            if shared >= self.need[t]:
                found[t] = shared / len(self.templates[t])
        return found

    def _stretches(self, t: int, own: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
        """The template's words ``(place, rank)`` within reach of a block that
        holds a prefix word, stretches that overlap as one."""
        order = sorted(self.templates[t])
        prefix = set(order[:len(order) - self.need[t] + 1])
        at, reach = 0, _BLOCK_WORDS[t] - 1
        spans: list[list[int]] = []
        for k, r in own:
            if r in prefix:
                if spans and k - reach <= spans[-1][1]:
                    spans[-1][1] = k + reach
                else:
                    spans.append([k - reach, k + reach])
        for low, high in spans:
            while own[at][0] < low:
                at += 1
            first = at
            while at < len(own) and own[at][0] <= high:
                at += 1
            part = own[first:at]
            ranks = sorted({r for _, r in part})
            i = order.index(ranks[0])  # the first shared word, at place 0 of the stretch
            if min(len(order) - i, len(ranks)) >= self.need[t]:
                yield part

    @staticmethod
    def _best(t: int, part: list[tuple[int, int]]) -> int:
        """Most distinct template words in a block."""
        held: Counter = Counter()
        best = first = 0
        for k, r in part:
            held[r] += 1
            while part[first][0] <= k - _BLOCK_WORDS[t]:
                gone = part[first][1]
                held[gone] -= 1
                if not held[gone]:
                    del held[gone]
                first += 1
            best = max(best, len(held))
        return best


def scan(text: str | None, index: TemplateIndex) -> dict:
    """Phrases and matched templates of one text."""
    words = words_of(text)
    places = phrase_places(words)
    base = sorted({label for _, label in places})
    starts = [at for at, _ in places]
    best: dict[str, float] = {}
    for t, share in index.matches(words).items():
        label = TEMPLATES[t][1]
        best[label] = max(share, best.get(label, 0.0))
    return {"n_words": len(words), "n_base": len(places),
            "first_word": min(starts, default=None), "last_word": max(starts, default=None),
            "base_labels": ",".join(base), "labels": ",".join(sorted({*base, *best})),
            "score": 1.0 if base else max(best.values(), default=0.0)}


def word_frequency(docs: DataFrame, text_col: str = "text") -> dict[bytes, int]:
    """Occurrences of each template word in all documents (a row per template
    word, so the result is bounded by the templates)."""
    names = [w.decode() for w in _VOCABULARY]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for pdf in batches:
            for text in pdf["text"]:
                found = [w for w in words_of(text) if w in _VOCABULARY]
                total.update(found)
        yield pd.DataFrame({"word": names, "n": [total[w] for w in _VOCABULARY]})

    counted = docs.select(F.col(text_col).alias("text")).mapInPandas(count, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n"))
    return {r.word.encode(): r.n for r in counted.collect()}


SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the scan of every row of ``docs``: words, places of
    phrases (count, smallest and largest start), phrase labels, all labels,
    and the best containment (1 where a phrase stands)."""
    index = docs.sparkSession.sparkContext.broadcast(TemplateIndex(word_frequency(docs, text_col)))
    fields = [f.split()[0] for f in SCHEMA.split(", ")]

    @F.pandas_udf(SCHEMA)
    def licenses(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame([scan(t, index.value) for t in batch], columns=fields)
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    return docs.select(docs[id_col].alias("doc_id"),
                       licenses.asNondeterministic()(docs[text_col]).alias("s")) \
        .select("doc_id", "s.*")
