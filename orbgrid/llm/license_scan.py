"""License texts in documents: an exact set-similarity join of text blocks with templates.

A text is cut into overlapping blocks of words.  A block meets a template if
it holds the wanted share of the template's distinct words (containment).
Words are ordered by their frequency in the whole corpus, rarest first: a
block that shares t words with a template has one of the template's first
|T| - t + 1 (prefix filter), has t words of the templates at all (length
filter), and of the first word they share on, both have t left (positional
filter).  What passes is counted out, so nothing is missed and nothing is
reported that is not there.

Phrases are templates that need all their words; in the blocks found, the
places where the words stand one after the other are located.  Templates are
few and short, so tasks hold them; documents are read and never move.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbgrid.llm.byte_words import byte_class, slices, split_words

#: Words of a block and from one block's start to the next; a passage of BLOCK_WORDS - STEP_WORDS + 1 words lies whole in a block.
STEP_WORDS = 48
BLOCK_WORDS = 2 * STEP_WORDS
CONTAINMENT = 0.8

WORD_CHARS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

#: Phrases and their labels.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

#: Statements and opening words of widespread public licenses, and their labels.
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("apache-2", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an as is basis, without warranties or conditions of any kind, either express or implied"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

MATCH = "struct<label: string, phrase: boolean, block: long, shared: int, words: int, places: array<long>>"


def words_of(text: str) -> list[str]:
    return split_words(pa.array([text]), byte_class(WORD_CHARS))[0].to_pylist()


@dataclass(frozen=True)
class Templates:
    """Templates as sets of word numbers; numbers go from the rarest word of the corpus to the most frequent."""

    labels: list[str]
    texts: list[list[str]]
    phrase: list[bool]
    vocabulary: list[str]
    containment: float

    @classmethod
    def of(cls, phrases: list[tuple[str, str]], notices: list[tuple[str, str]], containment: float) -> Templates:
        both = [*phrases, *notices]
        texts = [words_of(t) for _, t in both]
        longest = BLOCK_WORDS - STEP_WORDS + 1
        if any(not 0 < len(t) <= longest for t in texts):
            raise ValueError(f"templates have 1 to {longest} words; cut longer ones")
        words = sorted({w for t in texts for w in t})
        return cls([n for n, _ in both], texts, [k < len(phrases) for k in range(len(both))], words, containment)

    def ordered(self, frequency: dict[str, int]) -> Templates:
        words = sorted(self.vocabulary, key=lambda w: (frequency.get(w, 0), w))
        return Templates(self.labels, self.texts, self.phrase, words, self.containment)

    @cached_property
    def number(self) -> dict[str, int]:
        return {w: k for k, w in enumerate(self.vocabulary)}

    @cached_property
    def sets(self) -> list[np.ndarray]:
        return [np.unique([self.number[w] for w in t]) for t in self.texts]

    @cached_property
    def needed(self) -> np.ndarray:
        """Words that a block must share with each template."""
        share = [1.0 if p else self.containment for p in self.phrase]
        return np.array([max(1, int(np.ceil(s * len(t) - 1e-9))) for s, t in zip(share, self.sets, strict=True)])

    @cached_property
    def holds(self) -> np.ndarray:
        out = np.zeros((len(self.sets), len(self.vocabulary)), bool)
        for k, t in enumerate(self.sets):
            out[k, t] = True
        return out

    @cached_property
    def prefixes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By word number: where its entries start, and the entries' templates and words from there on."""
        rows = sorted((int(w), k, len(t) - i) for k, t in enumerate(self.sets) for i, w in enumerate(t[: len(t) - self.needed[k] + 1]))
        word, template, left = np.array(rows, np.int64).reshape(-1, 3).T
        return np.searchsorted(word, np.arange(len(self.vocabulary) + 1)), template, left


def _spread(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All of start .. start+size-1, and the row that each belongs to."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[row], row


def join_blocks(block: np.ndarray, word: np.ndarray, t: Templates) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks and templates that meet, and how many words they share; ``block`` and ``word`` are the pairs there are."""
    size = len(t.vocabulary)
    there = np.unique(block * size + word)
    block, word = there // size, there % size
    heads = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(heads, len(block)))
    of = np.repeat(np.arange(len(heads)), sizes)
    behind = np.repeat(heads + sizes, sizes) - np.arange(len(block))  # words of the block from this one on
    first, template, left = t.prefixes
    entry, at = _spread(first[word], first[word + 1] - first[word])
    needed = t.needed[template[entry]]
    passing = (sizes[of[at]] >= needed) & (np.minimum(left[entry], behind[at]) >= needed)
    wanted = np.unique(of[at][passing] * len(t.sets) + template[entry][passing])
    which, template = wanted // len(t.sets), wanted % len(t.sets)
    place, pair = _spread(heads[which], sizes[which])
    shared = np.bincount(pair, t.holds[template[pair], word[place]], minlength=len(wanted)).astype(np.int64)
    met = shared >= t.needed[template]
    return block[heads[which[met]]], template[met], shared[met]


def _scanned(t: Templates):
    inside = byte_class(WORD_CHARS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = pa.array(t.vocabulary, pa.string())
        phrases = [np.array([t.number[w] for w in x]) for x in t.texts]
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                words, row = split_words(batch.column("text").slice(lo, hi - lo), inside)
                n_words = np.bincount(row, minlength=hi - lo)
                starts = np.cumsum(n_words) - n_words
                number = pc.fill_null(pc.index_in(words, value_set=values), -1).to_numpy()
                hit = np.flatnonzero(number >= 0)
                at = hit - starts[row[hit]]
                # Blocks are numbered through the slice; each word stands in its own and in the one before.
                blocks = -(-n_words // STEP_WORDS)
                base = np.cumsum(blocks) - blocks
                own = at // STEP_WORDS
                earlier = own > 0
                block = np.concatenate([base[row[hit]] + own, (base[row[hit]] + own - 1)[earlier]])
                found, template, shared = join_blocks(block, np.concatenate([number[hit], number[hit][earlier]]), t)
                doc = np.searchsorted(base, found, side="right") - 1
                matches: list[list[dict]] = [[] for _ in range(hi - lo)]
                for b, d, k, s in zip(found.tolist(), doc.tolist(), template.tolist(), shared.tolist(), strict=True):
                    nth, places = b - base[d], []
                    if t.phrase[k]:
                        # A place belongs to the block whose step it starts in.
                        x = phrases[k]
                        first = nth * STEP_WORDS
                        size = min(STEP_WORDS, n_words[d] - len(x) + 1 - first)
                        if size > 0:
                            seen = number[starts[d] + first : starts[d] + first + size + len(x) - 1]
                            windows = np.lib.stride_tricks.sliding_window_view(seen, len(x))
                            places = (np.flatnonzero((windows == x).all(axis=1)) + first).tolist()
                        if not places:
                            continue
                    matches[d].append({"label": t.labels[k], "phrase": t.phrase[k], "block": int(nth), "shared": s, "words": len(t.sets[k]), "places": places})
                kind = pa.list_(pa.struct([("label", pa.string()), ("phrase", pa.bool_()), ("block", pa.int64()), ("shared", pa.int32()), ("words", pa.int32()), ("places", pa.list_(pa.int64()))]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, hi - lo), pa.array(n_words), pa.array(matches, kind)], ["id", "n_words", "matches"]
                )

    return run


def _frequencies(values: list[str]):
    inside = byte_class(WORD_CHARS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(values), np.int64)
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                words, _ = split_words(batch.column("text").slice(lo, hi - lo), inside)
                number = pc.index_in(words, value_set=pa.array(values, pa.string())).drop_null().to_numpy()
                total += np.bincount(number, minlength=len(values))
        yield pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array(total)], ["word", "n"])

    return run


def scan(
    spark: SparkSession,
    docs: DataFrame,
    phrases: list[tuple[str, str]] = PHRASES,
    notices: list[tuple[str, str]] = NOTICES,
    containment: float = CONTAINMENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, ``n_words`` and ``matches``, one row for each document.

    A match is a block (block k starts at word k * STEP_WORDS and has
    BLOCK_WORDS words) and a template that meet: label, whether it is a
    phrase, words shared, distinct words of the template, and for phrases the
    places (words from 0) in the block's own step where it stands; a phrase
    without such a place is no match.

    Words are runs of digits, letters and any characters beyond ASCII, A-Z
    lower-cased, over the whole text.  Null and empty texts have none; null
    and repeated ids are kept as they are; an empty table gives an empty
    result; other columns are not read.  The frequencies of the templates'
    words (as many rows as words) reach the driver; they decide the order of
    the words, never the result.
    """
    whole = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    templates = Templates.of(phrases, notices, containment)
    counted = whole.select("text").mapInArrow(_frequencies(templates.vocabulary), "word string, n long")
    often = {r.word: r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    kind = docs.schema[id_col].dataType.simpleString()
    out = whole.mapInArrow(_scanned(templates.ordered(often)), f"id {kind}, n_words long, matches array<{MATCH}>")
    return out.withColumnRenamed("id", id_col)


def summary(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, ends and labels of each document's matches; ``score`` is the largest share of a template it holds."""
    places = F.flatten(F.transform("matches", lambda m: m["places"]))
    listed = lambda rows: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(rows, lambda m: m["label"]))))
    share = F.transform("matches", lambda m: m["shared"] / m["words"])
    return found.select(
        id_col, "n_words", F.size(places).cast("long").alias("n_base"), F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        listed(F.filter("matches", lambda m: m["phrase"])).alias("base_labels"), listed(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(share), F.lit(0.0)).alias("score"),
    )
