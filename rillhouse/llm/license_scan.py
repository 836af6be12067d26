"""Licence scans: exact phrases, and an exact set-similarity join of text blocks with templates.

A block is any window of a text's words, across lines, that is half as long again as the template.
The tokens of the templates are ordered by their frequency over all documents, rarest first. A
window that holds a share `containment` of a template's tokens must hold one of its first tokens
(prefix filter), and its text must hold enough of them anywhere (length filter) and enough from the
place of the first common token on (positional filter). Words further than a window from every
such first token are passed over; the windows left are counted exactly.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import alnum_words

CONTAINMENT = 0.9
#: Words of a window for each word of its template: room for line marks and inserted words.
WIDTH = 1.5
#: Phrases whose presence gives a label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Licence statements as they commonly stand in texts, with the labels they give.
TEMPLATES = (
    ("gpl-notice", "this work is licensed under the gnu general public license version 3"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl-notice", "this library is free software licensed under the gnu lesser general public license"),
    ("apache-notice", "licensed under the apache license version 2 0"),
    ("apache-notice", "you may not use this file except in compliance with the license"),
    ("mit-notice", "released under the mit license"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-notice", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by-nc-notice", "licensed under cc by nc 4 0"),
    ("cc-by-sa-notice", "licensed under cc by sa 4 0"),
    ("cc-by-notice", "this work is licensed under a creative commons attribution international license"),
)
RESULT = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, blocks array<struct<line:int,label:string,containment:double>>"
)


def template_sets(templates=TEMPLATES) -> list[tuple[str, frozenset[bytes]]]:
    return [(label, frozenset(alnum_words(text))) for label, text in templates]


def _count(frames: Iterator[pd.DataFrame], tokens: frozenset[bytes]) -> Iterator[pd.DataFrame]:
    counts: Counter = Counter()
    for frame in frames:
        for text in frame["text"]:
            counts.update(tokens.intersection(alnum_words(text or "")))
    yield pd.DataFrame(list(counts.items()), columns=["token", "n"])


def token_counts(docs: DataFrame, templates=TEMPLATES) -> dict[bytes, int]:
    """Documents that hold each template token, over all documents; as many entries as tokens."""
    tokens = frozenset().union(*(words for _, words in template_sets(templates)))
    found = docs.select("text").mapInPandas(lambda f: _count(f, tokens), "token binary, n bigint")
    return {bytes(r["token"]): r["n"] for r in found.groupBy("token").agg(F.sum("n").alias("n")).collect()}


class Matcher:
    """Templates with their tokens in global order, and an index of their prefixes."""

    def __init__(self, counts: dict[bytes, int], templates=TEMPLATES, containment: float = CONTAINMENT):
        self.templates, self.prefixes = [], {}
        for at, (label, tokens) in enumerate(template_sets(templates)):
            ordered = sorted(tokens, key=lambda t: (counts.get(t, 0), t))
            need = math.ceil(containment * len(ordered) - 1e-9)
            n_words = len(alnum_words(templates[at][1]))
            self.templates.append((label, ordered, need, n_words, int(WIDTH * n_words)))
            for place, token in enumerate(ordered[: len(ordered) - need + 1]):
                self.prefixes.setdefault(token, []).append((at, place))

    def blocks(self, words: list[bytes]) -> list[tuple[int, str, float]]:
        """`(word, label, containment)` of the windows that contain enough of a template.

        Of the windows that start within a template's length of the first one, the fullest is given,
        the last of equally full ones, and so on from the next window.
        """
        known, first, out = set(words), {}, []
        for token in self.prefixes.keys() & known:
            for at, place in self.prefixes[token]:
                first[at] = min(place, first.get(at, place))
        for at, place in first.items():
            label, ordered, need, n_words, width = self.templates[at]
            if len(known) < need or len(known.intersection(ordered[place:])) < need:
                continue
            best = begun = None
            for word, shared in self._windows(words, at):
                if best and word >= begun + n_words:
                    out.append((best[1], label, best[0] / len(ordered)))
                    best = None
                if not best:
                    begun = word
                if not best or shared >= best[0]:
                    best = (shared, word)
            if best:
                out.append((best[1], label, best[0] / len(ordered)))
        return sorted(out)

    def _windows(self, words: list[bytes], at: int) -> Iterator[tuple[int, int]]:
        """Start and number of distinct tokens of each window that starts with a token and has enough."""
        _, ordered, need, _, width = self.templates[at]
        tokens, prefix = set(ordered), set(ordered[: len(ordered) - need + 1])
        near = [i for i, w in enumerate(words) if w in prefix]
        hits = [
            (i, w) for i, w in enumerate(words)
            if w in tokens and bisect_right(near, i - width) < bisect_left(near, i + width)
        ]
        inside: Counter = Counter()
        end = 0
        for i, token in hits:
            while end < len(hits) and hits[end][0] < i + width:
                inside[hits[end][1]] += 1
                end += 1
            if len(inside) >= need:
                yield i, len(inside)
            inside[token] -= 1
            if not inside[token]:
                del inside[token]


def phrase_places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """Starts of all places where the phrase's words stand consecutively."""
    out, at = [], -1
    try:
        while True:
            at = words.index(phrase[0], at + 1)
            if words[at : at + len(phrase)] == phrase:
                out.append(at)
    except ValueError:
        return out


def scanned(counts: dict[bytes, int], text: Column, templates=TEMPLATES, containment: float = CONTAINMENT) -> Column:
    """A struct column of type RESULT for a text column; a null text counts as empty."""
    matcher = Matcher(counts, templates, containment)
    phrases = [(alnum_words(p), label) for p, label in PHRASES.items()]

    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            words = alnum_words(text or "")
            known = set(words)
            places, base = [], set()
            for phrase, label in phrases:
                if known.issuperset(phrase) and (found := phrase_places(words, phrase)):
                    places += found
                    base.add(label)
            blocks = []
            if not known.isdisjoint(matcher.prefixes):
                if found := matcher.blocks(words):
                    ends = list(accumulate(len(alnum_words(line)) for line in text.split("\n")))
                    blocks = [(bisect_right(ends, word), label, share) for word, label, share in found]
            labels = base | {label for _, label, _ in blocks}
            score = 1.0 if base else max((share for *_, share in blocks), default=0.0)
            rows.append((
                len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), score, blocks,
            ))
        columns = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"]
        return pd.DataFrame(rows, columns=columns).astype({"first_word": "Int64", "last_word": "Int64"})

    return F.pandas_udf(scan, RESULT)(text)


def scan_documents(docs: DataFrame) -> DataFrame:
    """`doc_id` and the columns of RESULT for every row of `docs`.

    `blocks` lists the windows that reach a template's threshold, by the line they start in. Null and empty texts have no words,
    labels or places. Repeated rows and null ids stay; other columns are ignored.
    """
    counts = token_counts(docs)
    return docs.select("doc_id", scanned(counts, F.col("text")).alias("s")).select("doc_id", "s.*")
