"""Licence scans with a positional index of rare words.

Licence texts are word sequences.  An index over them holds, for words in few of them, which text has the word
where.  A file's licence words with the highest inverse document frequency are looked up there: a word at place p
of the file that is word q of a licence proposes that the licence begins at p - q.  Proposals are intersected with the
places of the licence's other rare words, each of which may be ``DRIFT`` words off; the share of their weight that is
met is the score.  A licence counts where its score is ``MIN_SCORE`` or more and all of its key phrases stand
there word by word.

Proposals come from a licence's rarest words until these hold more than 1 - ``MIN_SCORE`` of its weight, so a place
with that score has one of them; none is capped.  Base phrases are found by the same index: their rarest word is
looked up and the others checked beside it.  Everything happens in one pass over whole texts, without a shuffle;
the index is a fixed table of the licence texts below.

Defined cases: a null or empty text has no words, no labels and score 0.  A licence inside the place of another one
that has more of its weight there (two clauses within three) is not reported.  Rows are scanned one by one, repeated
rows and null ids alike; ties between places of one licence go to the first.  An empty table gives an empty table.
Columns of the input are returned as they are; added ones start with ``_l_``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoptally.llm.words import SEPARATORS, slices, split_words

# Phrases with a label each.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Label, licence text or notice, key phrases (separated by /) that have to stand in it.
LICENCES = (
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "permission is hereby granted free of charge / to deal in the software without restriction",
    ),
    ("mit", "SPDX-License-Identifier: MIT", "spdx license identifier mit"),
    (
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
        "apache license version 2 / except in compliance with the license",
    ),
    ("apache-2", "SPDX-License-Identifier: Apache-2.0", "spdx license identifier apache 2"),
    (
        "gpl-2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License",
        "gnu general public license / version 2",
    ),
    ("gpl-2", "licensed under the GNU General Public License, version 2", "gnu general public license / version 2"),
    (
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License",
        "gnu general public license / version 3",
    ),
    ("gpl-3", "licensed under the GNU General Public License, version 3", "gnu general public license / version 3"),
    (
        "lgpl",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "gnu lesser general public license",
    ),
    ("lgpl", "licensed under the GNU Lesser General Public License", "gnu lesser general public license"),
    ("agpl-3", "under the terms of the GNU Affero General Public License", "gnu affero general public license"),
    ("mpl-2", "subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public license / 2 0"),
    ("epl-2", "made available under the terms of the Eclipse Public License 2.0", "eclipse public license / 2 0"),
    (
        "bsd-2-clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution",
        "redistribution and use in source and binary forms / must reproduce the above copyright notice",
    ),
    (
        "bsd-3-clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission",
        "redistribution and use in source and binary forms / neither the name of / prior written permission",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
        "with or without fee is hereby granted",
    ),
    (
        "zlib",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software",
        "without any express or implied warranty / arising from the use of this software",
    ),
    (
        "bsl-1",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license",
        "to any person or organization obtaining a copy",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain",
        "free and unencumbered software",
    ),
    (
        "cc-by-nc",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "creative commons attribution noncommercial",
    ),
    (
        "cc-by-sa",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "creative commons attribution sharealike",
    ),
    (
        "cc-by",
        "licensed under a Creative Commons Attribution 4.0 International License",
        "creative commons attribution 4 0",
    ),
    ("cc0", "CC0 1.0 Universal Public Domain Dedication", "cc0 1 0 universal"),
    ("all-rights-reserved", "All rights reserved", "all rights reserved"),
)

MIN_SCORE = 0.6
DRIFT = 8
#: A word is rare that is in this share of the licences at most.
RARE = 1 / 3
TEXT_BYTES = 8 << 20

FOUND = "array<struct<label: string, start: long, end: long, score: double, base: boolean>>"


def words_of(text: str) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    return [w for w in re.split(SEPARATORS, lowered) if w]


class Licence:
    """Rare words of one licence: their places, weights, and which of them propose a place."""

    def __init__(self, label: str, words: list[str], phrases: list[list[int]], idf: dict[str, float], number: dict[str, int]) -> None:
        self.label, self.length, self.phrases = label, len(words), phrases
        rare = [q for q, w in enumerate(words) if w in idf]
        self.places = np.array(rare)
        self.numbers = [number[words[q]] for q in rare]
        self.weights = np.array([idf[words[q]] for q in rare])
        self.weight = float(self.weights.sum())
        proposing, held = [], 0.0
        for k in sorted(range(len(rare)), key=lambda k: -self.weights[k]):
            if held > (1 - MIN_SCORE) * self.weight + 1e-9:
                break
            proposing.append(k)
            held += float(self.weights[k])
        self.proposing = proposing


class Index:
    """All words of licences and phrases by number, and the licences."""

    def __init__(self) -> None:
        texts = [words_of(text) for _, text, _ in LICENCES]
        phrases = [[words_of(p) for p in keys.split("/")] for _, _, keys in LICENCES]
        self.base = [(words_of(p), label) for p, label in BASE.items()]
        every = [*texts, *(p for keys in phrases for p in keys), *(p for p, _ in self.base)]
        self.words = sorted({w for words in every for w in words})
        number = {w: i for i, w in enumerate(self.words)}
        in_texts = Counter(w for words in texts for w in set(words))
        idf = {w: math.log(len(texts) / n) for w, n in in_texts.items() if n <= RARE * len(texts)}
        #: A word in no licence counts as rarest.
        self.idf = np.array([math.log(len(texts) / max(in_texts[w], 0.5)) for w in self.words])
        self.phrases = [[number[w] for w in p] for p, _ in self.base]
        self.labels = [label for _, label in self.base]
        self.licences = [
            Licence(label, words, [[number[w] for w in p] for p in keys], idf, number)
            for (label, _, _), words, keys in zip(LICENCES, texts, phrases, strict=True)
        ]


@cache
def index() -> Index:
    return Index()


class Scan:
    """Places of licence words in a batch of texts, counted over all its words."""

    def __init__(self, texts: pa.Array) -> None:
        self.index = index()
        words, row = split_words(texts)
        there = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
        known = pc.index_in(words, value_set=pa.array(self.index.words, pa.large_string()))
        self.row = row[there]
        self.number = known.fill_null(-1).to_numpy(zero_copy_only=False)[there]
        self.begins = np.searchsorted(self.row, np.arange(len(texts) + 1))
        at = np.flatnonzero(self.number >= 0)
        order = np.argsort(self.number[at], kind="stable")
        self.at, numbers = at[order], self.number[at][order]
        self.bounds = np.searchsorted(numbers, np.arange(len(self.index.words) + 1))

    def places(self, number: int) -> np.ndarray:
        return self.at[self.bounds[number] : self.bounds[number + 1]]

    def phrase(self, phrase: list[int]) -> np.ndarray:
        """Where the phrase begins: its rarest word is looked up, the others are checked beside it."""
        rarest = max(range(len(phrase)), key=lambda j: self.index.idf[phrase[j]])
        at = self.places(phrase[rarest])
        starts = at - rarest
        inside = (starts >= self.begins[self.row[at]]) & (starts + len(phrase) <= self.begins[self.row[at] + 1])
        starts = starts[inside]
        for j, number in enumerate(phrase):
            starts = starts[self.number[starts + j] == number]
        return starts

    def licence(self, licence: Licence) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, start and score of every proposal of a licence, the weight met exactly, and whether it counts."""
        proposed = [self.places(licence.numbers[k]) for k in licence.proposing]
        starts = np.concatenate([at - licence.places[k] for at, k in zip(proposed, licence.proposing, strict=True)])
        rows = np.concatenate([self.row[at] for at in proposed])
        order = np.lexsort((starts, rows))
        starts, rows = starts[order], rows[order]
        new = np.ones(len(starts), bool)
        new[1:] = (starts[1:] != starts[:-1]) | (rows[1:] != rows[:-1])
        starts, rows = starts[new], rows[new]
        first, end = self.begins[rows], self.begins[rows + 1]
        met, exact = np.zeros(len(starts)), np.zeros(len(starts))
        for q, number, weight in zip(licence.places, licence.numbers, licence.weights, strict=True):
            at = self.places(number)
            low, high = np.maximum(starts + q - DRIFT, first), np.minimum(starts + q + DRIFT + 1, end)
            met += weight * (np.searchsorted(at, low) < np.searchsorted(at, high))
            here = np.clip(starts + q, first, end - 1)
            exact += weight * ((here == starts + q) & (self.number[here] == number))
        score = np.minimum(met / licence.weight, 1.0)
        counts = score >= MIN_SCORE - 1e-9
        for phrase in licence.phrases:
            at = self.phrase(phrase)
            low = np.maximum(starts - DRIFT, first)
            high = np.minimum(starts + licence.length + DRIFT, end) - len(phrase) + 1
            counts &= np.searchsorted(at, low) < np.searchsorted(at, high)
        return rows, starts, score, exact, counts


def _best(found: list[tuple]) -> list[tuple]:
    """Of places (label, start, end, score, weight, exact weight) those that are best among their label's, and in no heavier one."""
    kept: list[tuple] = []
    for place in sorted(found, key=lambda f: (-round(f[4], 6), -round(f[5], 6), f[1], f[0])):
        label, start, end = place[:3]
        if not any(
            (start < k[2] and k[1] < end) if k[0] == label else (k[1] <= start and end <= k[2]) for k in kept
        ):
            kept.append(place)
    return sorted(kept, key=lambda f: (f[1], f[0]))


def found_in(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[list[dict]]]:
    """For each text its number of words, its best score, and the places of licences, base phrases first."""
    scan = Scan(texts)
    n_words = np.diff(scan.begins)
    scores = np.zeros(len(texts))
    places: list[list[dict]] = [[] for _ in range(len(texts))]
    for phrase, label in zip(scan.index.phrases, scan.index.labels, strict=True):
        starts = scan.phrase(phrase)
        rows = scan.row[starts]
        scores[rows] = 1.0
        for row, start in zip(rows.tolist(), (starts - scan.begins[rows]).tolist(), strict=True):
            places[row].append({"label": label, "start": start, "end": start + len(phrase), "score": 1.0, "base": True})
    found: dict[int, list[tuple]] = {}
    for licence in scan.index.licences:
        rows, starts, score, exact, counts = scan.licence(licence)
        np.maximum.at(scores, rows, score)
        starts = starts - scan.begins[rows]
        for i in np.flatnonzero(counts).tolist():
            row, start, met = int(rows[i]), int(starts[i]), float(score[i])
            end = min(start + licence.length, int(n_words[row]))
            place = (licence.label, max(start, 0), end, met, met * licence.weight, float(exact[i]))
            found.setdefault(row, []).append(place)
    for row, several in found.items():
        for label, start, end, score, *_ in _best(several):
            places[row].append({"label": label, "start": start, "end": end, "score": score, "base": False})
    return n_words, np.round(scores, 9), places


def scan(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with ``_l_words``, ``_l_score`` and ``_l_found``: places in words, end exclusive."""
    names = docs.columns
    fields = StructType.fromDDL(f"_l_words long, _l_score double, _l_found {FOUND}")
    place = pa.struct(
        [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_BYTES):
            n_words, scores, places = found_in(batch.column("text"))
            added = [pa.array(n_words.astype(np.int64)), pa.array(scores), pa.array(places, pa.list_(place))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*names, *fields.fieldNames()])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *fields.fields]))


def report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: places of the base phrases, and the labels of these and of all licences."""
    found = scan(docs.select("doc_id", "text")).drop("text")
    found = found.withColumn("_l_base", F.filter("_l_found", lambda f: f["base"]))
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda f: f["label"]))), ",")
    starts = F.transform("_l_base", lambda f: f["start"])
    return found.select(
        "doc_id",
        F.col("_l_words").alias("n_words"),
        F.size("_l_base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels("_l_base").alias("base_labels"),
        labels("_l_found").alias("labels"),
        F.col("_l_score").alias("score"),
    )
