"""License scans: fixed phrases and an exact containment join of text blocks with templates.

A block is as many consecutive words of a text as the template has (all of them, if it has fewer), wherever lines
end, so that wrapped templates are found and words that stand far apart are not. A template is in a block if at
least THRESHOLD of its distinct words are, and all of them if it has fewer than SHORT: four of five words of a short
one are ordinary prose. Template words are ordered by how many documents hold them, counted over the whole corpus:
of a template that needs a of its n words, one of the n - a + 1 rarest must be in the block (prefix filter), the text
must hold a of its words (length filter), and the words from the first common one onward must suffice (positional
filter). Only over texts that pass do blocks slide, and what is in them is counted exactly. The templates are a short
fixed list, so they are broadcast; documents are never shuffled.

Defined cases: null text is empty and has no words; null and repeated doc_id stay rows of their own;
extra columns are ignored; equal labels are given once.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import release, words_of

THRESHOLD = 0.8
#: Templates of fewer distinct words must be there as a whole.
SHORT = 8
#: Phrases of the base scan and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Wording of public licences.
TEMPLATES = (
    ("agpl", "GNU Affero General Public License as published by the Free Software Foundation"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "You may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under a Creative Commons Attribution-ShareAlike International License"),
    ("cc0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("reserved", "Copyright. All rights reserved"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)


def frequencies(docs: DataFrame, words: set[bytes]) -> dict[bytes, int]:
    """In how many documents each of the given words is; words are a bounded list."""
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = dict.fromkeys(sorted(sent.value), 0)
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for k in range(len(texts)):
                for w in sent.value.intersection(words_of(texts[k].as_py() or b"")):
                    seen[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    counted = docs.select("text").mapInArrow(tally, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return {**dict.fromkeys(words, 0), **{bytes(r.word): r.n for r in counted.collect()}}  # one row a template word


def needed(n: int, threshold: float = THRESHOLD) -> int:
    """How many of a template's n distinct words a block must hold."""
    return n if n < SHORT else math.ceil(threshold * n - 1e-9)


class Templates:
    """Templates as word sets in the global order, with an index over their prefixes."""

    def __init__(self, templates: tuple[tuple[str, str], ...], often: dict[bytes, int], threshold: float) -> None:
        self.rank = {w: k for k, w in enumerate(sorted(often, key=lambda w: (often[w], w)))}
        self.sets: list[tuple[str, list[bytes], int]] = []
        self.lengths: list[int] = []
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        for label, text in templates:
            self.lengths.append(len(words_of(text.encode())))
            words = sorted(set(words_of(text.encode())), key=self.rank.__getitem__)
            need = needed(len(words), threshold)
            for i, w in enumerate(words[: len(words) - need + 1]):
                self.prefix.setdefault(w, []).append((len(self.sets), i))
            self.sets.append((label, words, need))

    def match(self, text: list[bytes]) -> Iterator[tuple[str, float]]:
        """(label, largest containment) of every template that a block of a text holds."""
        held = set(text)
        first: dict[int, int] = {}  # the place in each template of its rarest word here
        for w in self.prefix.keys() & held:
            for t, i in self.prefix[w]:
                first[t] = min(i, first.get(t, i))
        for t, i in sorted(first.items()):
            label, words, need = self.sets[t]
            own = held.intersection(words)
            if len(own) < need or len(words) - i < need:
                continue
            inside: dict[bytes, int] = {}
            places: deque[tuple[int, bytes]] = deque()
            best = 0
            for i, w in enumerate(text):
                if w not in own:
                    continue
                places.append((i, w))
                inside[w] = inside.get(w, 0) + 1
                while places[0][0] <= i - self.lengths[t]:
                    _, gone = places.popleft()
                    inside[gone] -= 1
                    if not inside[gone]:
                        del inside[gone]
                best = max(best, len(inside))
            if best >= need:
                yield label, best / len(words)


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD):
    """A column function text -> struct of word count, phrase places, labels and score."""
    every = {w for _, t in templates for w in words_of(t.encode())}
    sent = docs.sparkSession.sparkContext.broadcast(Templates(templates, frequencies(docs, every), threshold))
    phrases = [(b" " + p.encode() + b" ", label) for p, label in PHRASES.items()]
    kind = pa.struct(
        [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
    )

    @F.arrow_udf("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double")
    def look(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index: Templates = sent.value
        rare = set(index.prefix)
        for batch in batches:
            texts = batch.cast(pa.binary())
            out = []
            for k in range(len(texts)):
                words = words_of(texts[k].as_py() or b"")
                joined = b" " + b" ".join(words) + b" "
                places, base = [], set()
                for phrase, label in phrases:
                    at, word, seen = joined.find(phrase), 0, 0
                    while at >= 0:
                        word, seen = word + joined.count(b" ", seen, at), at
                        places.append(word)
                        base.add(label)
                        at = joined.find(phrase, at + 1)
                labels, best = set(base), 1.0 if base else 0.0
                if not rare.isdisjoint(words):
                    for label, share in index.match(words):
                        labels.add(label)
                        best = max(best, share)
                out.append((len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best))
            yield pa.StructArray.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), kind, strict=True)] if out else [pa.array([], t.type) for t in kind], fields=list(kind))
        release()

    return look
