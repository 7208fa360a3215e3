"""Licence texts and notices inside documents, by an exact containment join with templates.

A template is a set of words and a share of it that must be found. A block of a document is a run
of as many words as the template has (a shorter document is one block), at any place. The join
finds every block whose words hold the share of the template's set:

* the words of all templates are counted over all documents and ordered by frequency, rarest first;
* of a template of m words, c of which are needed, every such block holds one of the m - c + 1
  rarest (the prefix), so only blocks around these words are looked at;
* a document of fewer than c words is out (length), and so is a prefix word without c words of the
  template as near as a block reaches (position);
* for all blocks that are left the words are counted exactly, block by block, with differences.

A phrase is a template whose whole set is needed, found by its rarest word, whose words then must
stand in its order.

Templates are a parameter and small: what is sent to the tasks is at most `MOST_WORDS` words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.contamination import words_of
from tidemark.llm.text import map_arrow, slices

MOST_WORDS = 1 << 20


class Template(NamedTuple):
    label: str
    text: str
    share: float = 0.8


# Phrases and their labels.
PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)

# Words of well-known notices (the whole notice is needed) and of licence texts.
TEMPLATES = (
    Template("mit", "the mit license", 1.0),
    Template("apache-2.0", "apache license version 2.0", 1.0),
    Template("gpl-2.0", "gnu general public license version 2", 1.0),
    Template("gpl-3.0", "gnu general public license version 3", 1.0),
    Template("lgpl", "gnu lesser general public license", 1.0),
    Template("agpl", "gnu affero general public license", 1.0),
    Template("mpl-2.0", "mozilla public license version 2.0", 1.0),
    Template("bsd-2-clause", "bsd 2 clause license", 1.0),
    Template("bsd-3-clause", "bsd 3 clause license", 1.0),
    Template("cc-by-sa", "cc by sa", 1.0),
    Template("cc-by-nc", "cc by nc", 1.0),
    Template("cc-by-nd", "cc by nd", 1.0),
    Template("cc0", "cc0 1.0 universal", 1.0),
    Template("cc-by", "creative commons attribution 4.0 international license", 1.0),
    Template("cc-by-sa", "creative commons attribution sharealike 4.0 international license", 1.0),
    Template("cc-by-nc", "creative commons attribution noncommercial 4.0 international license", 1.0),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions",
    ),
    Template(
        "apache-2.0",
        "licensed under the apache license version 2.0 the license you may not use this file except in compliance "
        "with the license you may obtain a copy of the license at",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2.0 if a copy of the mpl was "
        "not distributed with this file you can obtain one at",
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish "
        "use compile sell or distribute this software",
    ),
    Template(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held "
        "liable for any damages arising from the use of this software",
    ),
    Template(
        "cc0",
        "to the extent possible under law the author has waived all copyright and related or neighboring rights to "
        "this work",
    ),
)


def _words(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return words_of(data, np.array([0, len(data)]))[0]


class _Plan:
    """Templates and phrases over one sorted vocabulary; `order` fixes their prefixes."""

    def __init__(self, templates, phrases) -> None:
        self.labels = [t.label for t in templates] + [label for label, _ in phrases]
        texts = [_words(t.text) for t in templates]
        said = [_words(text) for _, text in phrases]
        if any(not len(w) for w in texts + said):
            raise ValueError("a template has one word at least")
        if sum(map(len, texts + said)) > MOST_WORDS:
            raise ValueError(f"templates hold at most {MOST_WORDS} words")
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *texts, *said]))
        self.sizes = [len(w) for w in texts]
        self.sets = [np.searchsorted(self.vocabulary, np.unique(w)) for w in texts]
        self.needed = [max(1, int(np.ceil(t.share * len(s) - 1e-9))) for t, s in zip(templates, self.sets)]
        self.phrases = [np.searchsorted(self.vocabulary, w) for w in said]
        self.prefixes: list[np.ndarray] = []
        self.anchors: list[int] = []

    def order(self, counts: np.ndarray) -> None:
        place = np.empty(len(counts), np.int64)
        place[np.lexsort((self.vocabulary, counts))] = np.arange(len(counts))
        self.prefixes = [s[np.argsort(place[s])][: len(s) - c + 1] for s, c in zip(self.sets, self.needed)]
        self.anchors = [int(np.argmin(place[p])) for p in self.phrases]

    def find(self, words: np.ndarray) -> np.ndarray:
        """Each word's place in the vocabulary, or -1."""
        if not len(self.vocabulary):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at, -1)

    def said(self, index: int, found: np.ndarray, hits, rows, first):
        """Places of a phrase: its rarest word proposes them, then all words are compared."""
        phrase, anchor = self.phrases[index], self.anchors[index]
        start = hits[found[hits] == phrase[anchor]] - anchor
        row = rows[start + anchor]
        start = start[(start >= first[row]) & (start + len(phrase) <= first[row + 1])]
        for j, word in enumerate(phrase):
            start = start[found[start + j] == word]
        return start, start + len(phrase), np.ones(len(start))

    def blocks(self, index: int, found: np.ndarray, hits, rows, first):
        """Spans of words covered by blocks that hold the needed share, with their best share."""
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        mine, size, needed = self.sets[index], self.sizes[index], self.needed[index]
        inside = np.zeros(len(self.vocabulary), bool)
        inside[self.prefixes[index]] = True
        proposed = hits[inside[found[hits]]]
        if not len(proposed):
            return none
        inside[mine] = True
        at = hits[inside[found[hits]]]
        row = rows[proposed]
        # Length, then position: template words within reach of the prefix word, in its document.
        low = np.maximum(proposed - size + 1, first[row])
        high = np.minimum(proposed + size, first[row + 1])
        near = np.searchsorted(at, high) - np.searchsorted(at, low)
        row = row[(high - low >= needed) & (near >= needed)]
        if not len(row):
            return none
        wanted = np.zeros(len(first), bool)
        wanted[row] = True
        at = at[wanted[rows[at]]]
        # The last place of the same word in the same document, or -1.
        order = np.lexsort((at, found[at]))
        before = np.full(len(at), -1)
        same = found[at[order][1:]] == found[at[order][:-1]]
        before[order[1:][same]] = at[order][:-1][same]
        row = rows[at]
        width = np.minimum(size, first[row + 1] - first[row])
        # A word counts once in each block, by its first place there: for these first words.
        begin = np.maximum(np.maximum(before + 1, at - width + 1), first[row])
        end = np.minimum(at, first[row + 1] - width)
        some = begin <= end
        change = np.zeros(len(found) + 1, np.int64)
        np.add.at(change, begin[some], 1)
        np.add.at(change, end[some] + 1, -1)
        held = np.cumsum(change[:-1])
        start = np.flatnonzero(held >= needed)
        if not len(start):
            return none
        row = rows[start]
        stop = start + np.minimum(size, first[row + 1] - first[row])
        fresh = np.r_[True, (start[1:] >= stop[:-1]) | (row[1:] != row[:-1])]
        group = np.flatnonzero(fresh)
        share = np.maximum.reduceat(held[start] / len(mine), group)
        return start[group], stop[np.r_[group[1:] - 1, len(start) - 1]], share


def _count(sent):
    """How often each word of the templates occurs, summed per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = sent.value
        total = np.zeros(len(plan.vocabulary), np.int64)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                found = plan.find(words_of(data, offsets)[0])
                total += np.bincount(found[found >= 0], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    return run


_BLOCK = pa.struct(
    [
        ("label", pa.string()),
        ("phrase", pa.bool_()),
        ("first_word", pa.int64()),
        ("end_word", pa.int64()),
        ("share", pa.float64()),
    ]
)
_BLOCKS = "array<struct<label: string, phrase: boolean, first_word: bigint, end_word: bigint, share: double>>"


def _scan(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = sent.value
        labels = pa.array(plan.labels, pa.string())
        for batch in batches:
            for low, high, data, offsets in slices(batch.column(1)):
                words, rows, first = words_of(data, offsets)
                found = plan.find(words)
                hits = np.flatnonzero(found >= 0)
                spans = [plan.blocks(i, found, hits, rows, first) for i in range(len(plan.sets))]
                spans += [plan.said(i, found, hits, rows, first) for i in range(len(plan.phrases))]
                which = np.repeat(np.arange(len(spans)), [len(s[0]) for s in spans])
                start, stop, share = (np.concatenate([np.zeros(0), *x]) for x in zip(*spans)) if spans else (np.zeros(0),) * 3
                start, stop = start.astype(np.int64), stop.astype(np.int64)
                order = np.lexsort((which, start))
                which, start, stop, share = which[order], start[order], stop[order], share[order]
                row = rows[start] if len(start) else start
                base = first[row] if len(start) else start
                values = pa.StructArray.from_arrays(
                    [
                        labels.take(pa.array(which)),
                        pa.array(which >= len(plan.sets)),
                        pa.array(start - base),
                        pa.array(stop - base),
                        pa.array(share),
                    ],
                    fields=list(_BLOCK),
                )
                edges = np.searchsorted(row, np.arange(high - low + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(np.diff(first)),
                        pa.ListArray.from_arrays(pa.array(edges), values),
                    ],
                    names=["id", "n_words", "blocks"],
                )

    return run


class LicenseScan:
    """Blocks of documents that hold a licence's words.

    Words are runs of [0-9A-Za-z] and non-ASCII bytes, A-Z in lower case, compared by 64-bit
    hashes. Overlapping blocks of one template are one span. A null or empty text has no words
    and no blocks; repeated rows are scanned alike, an empty table gives no rows. Of a document's
    columns only the id and the text are read, whatever the others are called.
    """

    def __init__(
        self,
        docs: DataFrame,
        templates: tuple[Template, ...] = TEMPLATES,
        phrases: tuple[tuple[str, str], ...] = PHRASES,
        id_col: str = "doc_id",
        text_col: str = "text",
    ) -> None:
        self.id_col = id_col
        self.narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
        context = docs.sparkSession.sparkContext
        plan = _Plan(templates, phrases)
        counts = np.zeros(len(plan.vocabulary), np.int64)
        seen = map_arrow(self.narrow.select("text"), _count(context.broadcast(plan)), "at long, n long")
        for r in seen.groupBy("at").agg(F.sum("n").alias("n")).collect():
            counts[r["at"]] = r["n"]
        plan.order(counts)
        self.plan = context.broadcast(plan)

    def scanned(self) -> DataFrame:
        """id, n_words and blocks of every document, blocks by their first word."""
        kind = self.narrow.schema["id"].dataType.simpleString()
        found = map_arrow(self.narrow, _scan(self.plan), f"id {kind}, n_words long, blocks {_BLOCKS}")
        return found.withColumnRenamed("id", self.id_col)

    def blocks(self) -> DataFrame:
        """One row per block found: id, label, phrase, first_word, end_word (exclusive), share."""
        return self.scanned().select(self.id_col, F.inline("blocks"))


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Places of phrases, labels and the best share found (1 for a phrase, 0 for none)."""

    def joined(blocks):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(blocks, lambda b: b["label"]))), ",")

    said = F.filter("blocks", lambda b: b["phrase"])
    starts = F.transform(said, lambda b: b["first_word"])
    share = F.array_max(F.transform("blocks", lambda b: b["share"]))
    return scanned.select(
        id_col,
        "n_words",
        F.size(said).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(said).alias("base_labels"),
        joined(F.col("blocks")).alias("labels"),
        F.coalesce(share, F.lit(0.0)).alias("score"),
    )
