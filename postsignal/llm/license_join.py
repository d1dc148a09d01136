"""License scans: an exact join of text blocks with license templates by containment.

A block is a line of a text, as the set of its words. A template matches a block that holds at least
``CONTAINMENT`` of its words. Template words are ordered by how many blocks of all documents hold them,
rarest first. A matching block must hold a word of the template's prefix, so only blocks with such a word
are looked at; the length filter and the positional filter drop blocks whose number of words, or whose first
common place in the order, leaves too few words, and the rest are counted exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsignal.llm.common import ALPHANUMERIC, Texts, batches, slices

#: Part of a template's distinct words that a block must hold, as a ratio of whole numbers.
CONTAINMENT = (4, 5)

# Phrases and labels that are always reported.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices by which licenses are named in texts, and their labels.
TEMPLATES = {
    "mit-notice": "Released under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "lgpl": "under the terms of the GNU Lesser General Public License",
    "agpl": "under the terms of the GNU Affero General Public License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0": "Licensed under a Creative Commons Attribution 4.0 International License",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
}


def words_of(text: str) -> np.ndarray:
    return Texts(range(1), [text.encode()]).tokens(ALPHANUMERIC)[2]


@dataclass(frozen=True)
class Index:
    """Templates over the sorted hashes of their words."""

    labels: tuple[str, ...]
    words: np.ndarray  # sorted hashes
    member: np.ndarray  # word x template
    sizes: np.ndarray
    needed: np.ndarray
    place: np.ndarray  # a word's place in each template's order, or -1
    prefix: np.ndarray  # word x template: in the prefix


def index(templates: dict[str, str], counts: dict[int, int], containment: tuple[int, int] = CONTAINMENT) -> Index:
    sets = [np.unique(words_of(text)) for text in templates.values()]
    words = np.unique(np.concatenate(sets)) if sets else np.empty(0, np.uint64)
    often = np.array([counts.get(i, 0) for i in range(len(words))])
    member = np.array([np.isin(words, s) for s in sets]).reshape(len(sets), -1).T
    sizes = member.sum(axis=0)
    needed = -(-sizes * containment[0] // containment[1])
    place = np.full(member.shape, -1)
    for t in range(member.shape[1]):
        own = np.flatnonzero(member[:, t])
        place[own[np.lexsort((own, often[own]))], t] = np.arange(len(own))
    return Index(tuple(templates), words, member, sizes, needed, place, (place >= 0) & (place < sizes - needed + 1))


def _lines(texts: Texts, starts: np.ndarray) -> np.ndarray:
    """The line of each word, counted over the slice; every text begins a new one."""
    return np.cumsum(texts.data == 10)[starts]


def _template_words(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Each word's place among the template words, or -1."""
    if not len(known):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at, -1)


def block_counts(documents: DataFrame, words: np.ndarray) -> dict[int, int]:
    """Blocks of all documents that hold each template word."""

    def work(parts):
        total = np.zeros(len(words), np.int64)
        for part in parts:
            for texts in slices(part.column(0)):
                starts, _, hashes, _ = texts.tokens(ALPHANUMERIC)
                word = _template_words(words, hashes)
                at = np.flatnonzero(word >= 0)
                pairs = np.unique(_lines(texts, starts[at]) * len(words) + word[at])
                total += np.bincount(pairs % len(words), minlength=len(words))
        yield pa.record_batch([pa.array(np.arange(len(words))), pa.array(total)], ["word", "n"])

    rows = batches(documents.select("text"), work, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {row.word: row.n for row in rows.collect()}


def matches(texts: Texts, known: Index, tokens: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, template and containment of every match of a block of the slice."""
    starts, _, hashes, bounds = tokens
    word = _template_words(known.words, hashes)
    at = np.flatnonzero(word >= 0)
    line = _lines(texts, starts)
    hit = np.unique(line[at[known.prefix.any(axis=1)[word[at]]]]) if len(at) else np.empty(0, np.int64)
    at = at[np.isin(line[at], hit)]
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    pairs = np.unique(line[at] * len(known.words) + word[at])
    block, own = np.searchsorted(hit, pairs // len(known.words)), pairs % len(known.words)
    first, last = np.searchsorted(line, hit), np.searchsorted(line, hit, side="right")
    distinct = np.array([len(np.unique(hashes[a:b])) for a, b in zip(first, last)])
    # Length and positional filters: words left from the first common place on must suffice.
    earliest = np.full((len(hit), len(known.labels)), np.iinfo(np.int64).max)
    np.minimum.at(earliest, block, np.where(known.place[own] >= 0, known.place[own], np.iinfo(np.int64).max))
    may = (distinct[:, None] >= known.needed) & (earliest <= known.sizes - known.needed)
    shared = np.zeros((len(hit), len(known.labels)), np.int64)
    np.add.at(shared, block, known.member[own].astype(np.int64))
    found, template = np.nonzero(may & (shared >= known.needed))
    text = np.searchsorted(bounds, first[found], side="right") - 1
    return text, template, shared[found, template] / known.sizes[template]


def licenses(documents: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None) -> DataFrame:
    """Per row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts the places of all phrases; ``score`` is the largest containment of a matched template, 1
    where a phrase occurs and nothing more is found, else 0. A null or empty text has 0 words, no labels and
    score 0. Repeated rows stay. Other columns are not read.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = index(templates, block_counts(documents, index(templates, {}).words))
    runs = [(words_of(phrase), label) for phrase, label in phrases.items()]

    def work(parts):
        for part in parts:
            n = part.num_rows
            total, base = np.zeros(n, np.int64), np.zeros(n, np.int64)
            first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            score, own, more = np.zeros(n), [set() for _ in range(n)], [set() for _ in range(n)]
            for texts in slices(part.column(1)):
                tokens = texts.tokens(ALPHANUMERIC)
                hashes, bounds = tokens[2], tokens[3]
                low = texts.rows.start
                total[low : texts.rows.stop] = np.diff(bounds)
                for run, label in runs:
                    at = np.flatnonzero(hashes == run[0])
                    for i in range(1, len(run)):
                        at = at[at + i < len(hashes)]
                        at = at[hashes[at + i] == run[i]]
                    text = np.searchsorted(bounds, at, side="right") - 1
                    whole = at + len(run) <= bounds[text + 1]
                    at, text = at[whole], text[whole]
                    np.add.at(base, low + text, 1)
                    np.minimum.at(first, low + text, at - bounds[text])
                    np.maximum.at(last, low + text, at - bounds[text])
                    for row in np.unique(text):
                        own[low + row].add(label)
                for row, template, share in zip(*matches(texts, known, tokens)):
                    more[low + row].add(known.labels[template])
                    score[low + row] = max(score[low + row], share)
            score = np.where((score == 0) & (base > 0), 1.0, score)
            none = base == 0
            yield pa.record_batch(
                [
                    part.column(0),
                    pa.array(total),
                    pa.array(base),
                    pa.array(first, mask=none),
                    pa.array(last, mask=none),
                    pa.array([",".join(sorted(x)) for x in own], pa.string()),
                    pa.array([",".join(sorted(x | y)) for x, y in zip(own, more)], pa.string()),
                    pa.array(score),
                ],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return batches(documents, work, schema)
