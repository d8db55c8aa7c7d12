"""Licence notices by an exact containment join with prefix, length and positional filters
(operator 9).

Every text is cut into overlapping blocks of ``2 * STRIDE`` words, so that any passage of
``STRIDE`` words lies whole in one of them.  A block matches a template when it holds at
least ``threshold`` of the template's distinct words.  Template words are ordered by
the number of blocks of all documents that hold them, rarest first; a template of n
words that needs m of them must share one of its first n - m + 1 (prefix).  A block that
first meets the template at place i of this order can share n - i words at most
(positional bound), and no more than it has distinct words (length bound).  What is left
is compared in full.  An ordered template (a phrase) needs all its words, and its
places are those where the words stand consecutively.

Null or wordless text: no match.  Null or repeated doc_id: each row by itself.  Empty
input: empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statframe.llm.common import alnum_words, id_text, text_groups

#: blocks begin every STRIDE words and hold twice as many; no template is longer
STRIDE = 48


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    threshold: float = 0.8
    ordered: bool = False


#: the phrases whose places are counted, and their labels
PHRASES = (
    Template("gpl", "gnu general public license", 1.0, True),
    Template("apache", "apache license", 1.0, True),
    Template("cc-by", "cc by", 1.0, True),
    Template("mit", "mit license", 1.0, True),
)

#: opening sentences of widely used public notices
NOTICES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy "
             "of this software and associated documentation files, to deal in the Software "
             "without restriction"),
    Template("apache", "Licensed under the Apache License, Version 2.0; you may not use this file "
             "except in compliance with the License. You may obtain a copy of the License at"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under "
             "the terms of the GNU General Public License as published by the Free Software "
             "Foundation"),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it "
             "under the terms of the GNU Lesser General Public License"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without "
             "modification, are permitted provided that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any "
             "purpose with or without fee is hereby granted"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 "
             "International License"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)

MATCHES = ("doc_id long, n_words long, phrases array<struct<label:string,start:long>>, "
           "blocks array<struct<label:string,start:long,end:long,containment:double>>")


def _blocks(n_words: int) -> range:
    """First words of a text's blocks."""
    return range(0, max(1, n_words - STRIDE), STRIDE) if n_words else range(0)


def _block_counts(rows: DataFrame, words: frozenset[bytes]) -> Counter:
    """Blocks of all documents that hold each template word."""

    def run(batches):
        got = Counter()
        for b in text_groups(batches):
            for t in b.column("text").to_pylist():
                ws = alnum_words(t)
                if not words.isdisjoint(ws):
                    for s in _blocks(len(ws)):
                        got.update(words.intersection(ws[s:s + 2 * STRIDE]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(got), pa.binary()), pa.array(got.values(), pa.int64())],
            names=["word", "n"])

    # as many rows as template words at most
    counts = rows.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n")).collect()
    return Counter({bytes(r.word): r.n for r in counts})


class _Index:
    def __init__(self, templates: Iterable[Template], counts: Counter):
        self.templates = []
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        for k, t in enumerate(templates):
            seq = alnum_words(t.text)
            own = sorted(set(seq), key=lambda w: (counts[w], w))
            need = max(1, ceil(t.threshold * len(own) - 1e-9))
            self.templates.append((t, seq, frozenset(own), need))
            for i, w in enumerate(own[:len(own) - need + 1]):
                self.prefix.setdefault(w, []).append((k, i))
        self.first = frozenset(self.prefix)

    def matches(self, words: list[bytes]) -> tuple[list[dict], list[dict]]:
        if self.first.isdisjoint(words):
            return [], []
        last = len(_blocks(len(words))) - 1
        found: dict[int, dict[int, int]] = {}  # block -> template -> first place in its order
        for p, w in enumerate(words):
            for k, i in self.prefix.get(w, ()):
                for b in {min(p // STRIDE, last), max(0, min(p // STRIDE - 1, last))}:
                    if b * STRIDE <= p < (b + 2) * STRIDE:
                        at = found.setdefault(b, {})
                        at[k] = min(i, at.get(k, i))
        phrases, blocks = set(), []
        for b, at in sorted(found.items()):
            s = b * STRIDE
            block = words[s:s + 2 * STRIDE]
            have = set(block)
            for k, i in sorted(at.items()):
                t, seq, own, need = self.templates[k]
                if len(own) - i < need or len(have) < need:
                    continue
                share = len(own & have)
                if share < need:
                    continue
                if t.ordered:
                    n = len(seq)
                    phrases.update((s + j, t.label) for j in range(len(block) - n + 1)
                                   if block[j] == seq[0] and block[j:j + n] == seq)
                else:
                    blocks.append({"label": t.label, "start": s, "end": s + len(block),
                                   "containment": share / len(own)})
        return [{"label": x, "start": p} for p, x in sorted(phrases)], blocks


def scan(docs: DataFrame, templates: Iterable[Template] = PHRASES + NOTICES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, phrases, blocks) of every row: the places of each phrase, and every
    block that meets a notice's threshold, with its containment."""
    templates = tuple(templates)
    words = [alnum_words(t.text) for t in templates]
    if not all(0 < len(w) <= STRIDE for w in words):
        raise ValueError(f"a template must have 1 to {STRIDE} words")
    rows = id_text(docs, id_col, text_col)
    index = _Index(templates, _block_counts(rows, frozenset(x for w in words for x in w)))

    def run(batches):
        phrase = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
        block = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()),
                                    ("end", pa.int64()), ("containment", pa.float64())]))
        for b in text_groups(batches):
            n, ps, bs = [], [], []
            for t in b.column("text").to_pylist():
                ws = alnum_words(t)
                p, q = index.matches(ws)
                n.append(len(ws))
                ps.append(p)
                bs.append(q)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ps, phrase),
                 pa.array(bs, block)], names=["doc_id", "n_words", "phrases", "blocks"])

    return rows.mapInArrow(run, MATCHES)
