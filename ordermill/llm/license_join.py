"""License scan: an exact set-similarity join of text blocks with templates.

A block is a line, or of a line of more than ``BLOCK`` words every run of
``BLOCK`` words that starts at a multiple of half of it. The whole text's words are
cut like one line too, so wording of up to half a block and one word is found
wherever its lines are broken. A block meets a template if it has at least
``THRESHOLD`` of the template's distinct words.

Words are ordered by how often they occur in the whole corpus, rare ones first.
A block that lacks a template's first words - as many as may be missing, and one
more - can't meet it (prefix filter); nor can one with too few template words
(length filter), nor one whose first common word stands so far back, in either
order, that too few are left (positional filter). What passes is counted out, so
the join finds every block that meets the threshold and no other.

Only words of templates are counted: their number is fixed by the templates. A
null text has no words. Nothing is found in an empty table.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 40
THRESHOLD = 0.9
# Labels, and the wording by which each licence is announced.
TEMPLATES = (
    ("agpl", "licensed under the gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("bsd", "redistribution and use in source and binary forms with or without "
            "modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by-nc 4.0"),
    ("cc-by-nd", "licensed under cc by-nd 4.0"),
    ("cc-by-sa", "licensed under cc by-sa 4.0"),
    ("cc0", "to the extent possible under law the author has waived all copyright"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy "
            "of this software and associated documentation files"),
    ("mpl-2.0", "subject to the terms of the mozilla public license version 2.0"),
)
PHRASES = (("cc-by", "cc by"), ("gpl", "general public license"),
           ("reserved", "all rights reserved"))
#: A-Z in lower case, every other ASCII character but digits and letters a blank.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
               else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_PLAIN).split()


class Join:
    """Templates with their words in the corpus's order."""

    def __init__(self, frequency: dict[bytes, int], templates=TEMPLATES,
                 threshold: float = THRESHOLD, block: int = BLOCK):
        self.block = block
        vocabulary = {w for _, t in templates for w in words_of(t)}
        ranked = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(ranked)}
        self.templates, self.by_prefix = [], {}
        for i, (label, text) in enumerate(templates):
            ranks = sorted({self.rank[w] for w in words_of(text)})
            need = math.ceil(threshold * len(ranks) - 1e-9)
            self.templates.append((label, ranks, set(ranks), need))
            for place, r in enumerate(ranks[:len(ranks) - need + 1]):
                self.by_prefix.setdefault(r, []).append((i, place))
        self.first_words = {ranked[r] for r in self.by_prefix}

    def blocks(self, text: str, words: list[bytes]) -> Iterator[list[bytes]]:
        """Blocks with a template's first word."""
        wanted = self.first_words
        lines = text.split("\n")
        for line in [words, *(map(words_of, lines) if len(lines) > 1 else ())]:
            if wanted.isdisjoint(line):
                continue
            if len(line) <= self.block:
                yield line
            else:
                for at in range(0, len(line) - self.block // 2, self.block // 2):
                    part = line[at:at + self.block]
                    if not wanted.isdisjoint(part):
                        yield part

    def matches(self, block: list[bytes]) -> Iterator[tuple[str, float]]:
        """Labels of the templates that the block meets, with the containment."""
        rank = self.rank
        own = sorted({rank[w] for w in block if w in rank})
        tried = set()
        for at, r in enumerate(own):
            for i, place in self.by_prefix.get(r, ()):
                if i in tried:
                    continue
                tried.add(i)
                label, ranks, members, need = self.templates[i]
                # r is the first common word: what stands before it has no match.
                if len(own) < need or min(len(own) - at, len(ranks) - place) < need:
                    continue
                common = sum(x in members for x in own)
                if common >= need:
                    yield label, common / len(ranks)


def word_counts(docs: DataFrame, text: str, templates=TEMPLATES) -> dict[bytes, int]:
    """How often each template word occurs in all texts; as many rows as such words."""
    vocabulary = {w for _, t in templates for w in words_of(t)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for t in batch["t"]:
                counts.update(filter(vocabulary.__contains__, words_of(t.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()),
                                          pa.array(list(counts.values()), pa.int64())],
                                         ["word", "n"])

    rows = (docs.select(F.coalesce(F.col(text), F.lit("")).alias("t"))
            .mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    return {bytes(r["word"]): r["n"] for r in rows.collect()}


def places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """Starts of the places where the phrase's words stand consecutively."""
    out, at, n = [], -1, len(phrase)
    while True:
        try:
            at = words.index(phrase[0], at + 1)
        except ValueError:
            return out
        if words[at:at + n] == phrase:
            out.append(at)


COLUMNS = ("n_words long, n_base long, first_word long, last_word long, base_labels string, "
           "labels string, score double")


def scan(docs: DataFrame, key: str, text: str, templates=TEMPLATES, phrases=PHRASES,
         threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``key``, the phrases' places and labels, the templates' labels, and the
    score: 1 with a phrase, else the best containment of a template that was met."""
    shared = docs.sparkSession.sparkContext.broadcast(word_counts(docs, text, templates))
    phrases = [(label, words_of(p)) for label, p in phrases]
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join = Join(shared.value, templates, threshold)
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        for batch in batches:
            rows = []
            for t in batch[text]:
                t = t.as_py() or ""
                words = words_of(t)
                there = set(words)
                starts, base = [], set()
                for label, phrase in phrases:
                    if there.issuperset(phrase) and (found := places(words, phrase)):
                        starts += found
                        base.add(label)
                labels, score = set(base), float(bool(base))
                if not join.first_words.isdisjoint(there):
                    for block in join.blocks(t, words):
                        for label, share in join.matches(block):
                            labels.add(label)
                            score = max(score, share)
                rows.append((len(words), len(starts), min(starts, default=None),
                             max(starts, default=None), ",".join(sorted(base)),
                             ",".join(sorted(labels)), score))
            yield pa.RecordBatch.from_arrays(
                [batch[key], *[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]],
                [key, *names])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, {COLUMNS}")
