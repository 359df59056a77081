"""License scans by diagonal voting.

Templates are phrases that name a license and the notices that put a text under one. All
rolling word k-grams of a document are joined with the positions at which templates have them.
A hit at word p of the document and word t of a template votes for the diagonal p - t, the place
where the template would begin.

1. ``_hits``: the k-grams of all documents (k is 3, or 2 for templates of two words) meet the few
   template positions in a broadcast join, so only hits go on.
2. ``_spans``: votes are counted by diagonal. Neighbouring diagonals, which inserted or missing
   words cause, are merged; a span needs a share of the votes that the whole template would give.
   Phrases stand for themselves: their diagonals are never merged and need all votes.
3. ``scan``: spans are verified on the words of the text: phrases and short notices (fewer than
   ``SHORT`` words) word by word, longer ones by the share of their words that occur in order,
   which must reach ``LEAST``.

Words: after lower-casing A-Z, runs of anything but ASCII signs, i.e. ``[0-9a-z\\x80-]+``. Equal
texts are verified alike and share their spans.

Rows: null and empty texts have no words and no spans; a null id stays null; repeated rows are all
reported; an empty table gives an empty result; whole texts are read, however long; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallystream.llm.words import SLICE_BYTES, as_bytes, in_arrow, slices, window_hashes, word_hashes
from tallystream.session import cut_lineage

GRAM = 3
SHARE = 0.3  # of a notice's votes
LEAST = 0.8
SHORT = 12
NAMED = 0.5  # score of a document that only names a license
BROADCAST_SPANS = 200_000
BATCH_ROWS = 65_536

# Phrases that name a license, by label.
PHRASES = {
    "mit": "mit license",
    "apache": "apache license",
    "gpl": "general public license",
}

# Notices (public license texts, and the lines that are commonly put into works).
NOTICES = [
    ("mit", "released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
    ("apache", "licensed under the Apache License, Version 2.0"),
    (
        "apache",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("gpl", "licensed under the GNU General Public License"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    ),
    ("cc-by", "licensed under CC BY 4.0"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by", "Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc0", "CC0 1.0 Universal Public Domain Dedication"),
]

_SIGNS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def words_of(data: bytes | None) -> list[bytes]:
    return (data or b"").lower().translate(_SIGNS).split()


class Template:
    def __init__(self, label: str, text: str, base: bool) -> None:
        self.label, self.base, self.words = label, base, words_of(text.encode())
        self.size = len(self.words)
        self.gram = min(GRAM, self.size)
        self.reach = 0 if base else max(1, self.size // 5)  # diagonals that far apart are merged
        grams = self.size - self.gram + 1
        self.votes = grams if base or self.size < SHORT else max(1, int(np.ceil(SHARE * grams)))

    def similarity(self, words: list[bytes]) -> tuple[float, int, int]:
        """Share of the template's words that occur in order, and the first and last place of one."""
        row = np.zeros(len(words) + 1, np.int64)
        table = [row]
        here = np.array(words, object)
        for word in self.words:
            kept = np.maximum(row[1:], np.where(here == word, row[:-1] + 1, 0))
            row = np.concatenate([[0], np.maximum.accumulate(kept)])
            table.append(row)
        t, at, places = self.size, len(words), []
        while t and at:  # back along one longest common sequence
            if table[t][at] == table[t][at - 1]:
                at -= 1
            elif table[t][at] == table[t - 1][at]:
                t -= 1
            else:
                places.append(at - 1)
                t, at = t - 1, at - 1
        return len(places) / self.size, places[-1] if places else 0, places[0] if places else -1

    def verified(self, words: list[bytes], first: int, last: int) -> tuple[int, int, float] | None:
        """(start, stop, similarity) of the template between the diagonals ``first`` and ``last``."""
        if self.size < SHORT:
            for start in range(max(0, first), last + 1):
                if words[start : start + self.size] == self.words:
                    return start, start + self.size, 1.0
            return None
        start = max(0, first - self.reach)
        share, a, b = self.similarity(words[start : last + self.size + self.reach])
        return (start + a, start + b + 1, share) if share >= LEAST else None


TEMPLATES = [Template(label, text, True) for label, text in PHRASES.items()] + [Template(label, text, False) for label, text in NOTICES]


def _grams(hashes: np.ndarray, size: int) -> np.ndarray:
    return (window_hashes(hashes, size) + np.uint64(size)).view(np.int64)


def _positions(docs: DataFrame) -> DataFrame:
    """gram, template, place: where the templates have which k-gram (a few hundred rows)."""
    rows = [
        (gram, number, place)
        for number, t in enumerate(TEMPLATES)
        for place, gram in enumerate(_grams(word_hashes(t.words), t.gram).tolist())
    ]
    return docs.sparkSession.createDataFrame(rows, "gram long, template int, place int")


def _key(text: str) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), F.col(text)).alias("k2")]


def _hits(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row a document (row, doc_id, k1, k2, n_words), and one a hit (row, template, diagonal); written out."""
    sizes = sorted({t.gram for t in TEMPLATES})
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, b in slices(batches, 4, SLICE_BYTES):
            part = batch.slice(a, b - a)
            rows = part.column(0).to_pylist()
            counts, grams = [], {size: [] for size in sizes}
            for data in as_bytes(part.column(4)):
                hashes = word_hashes(words_of(data))
                counts.append(len(hashes))
                for size in sizes:
                    grams[size].append(_grams(hashes, size))
            n = len(rows)
            yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(counts, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names)
            for found in grams.values():
                each = [len(g) for g in found]
                row, pos, gram = np.repeat(rows, each), np.concatenate([np.arange(k) for k in each]), np.concatenate(found)
                for at in range(0, len(gram), BATCH_ROWS):
                    piece = [pa.array(c[at : at + BATCH_ROWS]) for c in (row, pos, gram)]
                    n = len(piece[0])
                    none = [pa.nulls(n, c.type) for c in part.columns[1:4]] + [pa.nulls(n, pa.int64())]
                    yield pa.RecordBatch.from_arrays([piece[0], *none, *piece[1:]], names)

    names = ["row", "doc_id", "k1", "k2", "n_words", "pos", "gram"]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), *_key(text), F.col(text).alias("text"))
    grams = rows.transform(in_arrow, run, f"row long, doc_id {kind}, k1 long, k2 long, n_words long, pos long, gram long")
    met = grams.join(F.broadcast(_positions(docs)), "gram", "left").filter("n_words is not null or template is not null")
    return cut_lineage(met.select("row", "doc_id", "k1", "k2", "n_words", "template", (F.col("pos") - F.col("place")).alias("diagonal")))


def _spans(hits: DataFrame) -> DataFrame:
    """row, template, first, last: merged diagonals with enough votes."""
    about = hits.sparkSession.createDataFrame([(i, t.reach, t.votes) for i, t in enumerate(TEMPLATES)], "template int, reach int, needed int")
    votes = hits.filter("template is not null").groupBy("row", "template", "diagonal").agg(F.count(F.lit(1)).alias("votes"))
    along = W.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > F.col("reach"), F.lit(True))
    runs = votes.join(F.broadcast(about), "template").withColumn("run", apart.cast("int"))
    merged = runs.withColumn("run", F.sum("run").over(along.rowsBetween(W.unboundedPreceding, 0))).groupBy("row", "template", "run", "needed")
    found = merged.agg(F.sum("votes").alias("votes"), F.min("diagonal").alias("first"), F.max("diagonal").alias("last"))
    return found.filter(F.col("votes") >= F.col("needed")).select("row", "template", "first", "last")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, licenses: the verified spans of each document, in order of their start.

    A span has ``label``, ``base`` (a phrase), ``start`` and ``stop`` (words from 0, stop
    exclusive) and ``similarity``.
    """
    hits = _hits(docs, doc_id, text)
    heads = hits.filter("n_words is not null").select("row", "doc_id", "k1", "k2", "n_words")
    spans = _spans(hits).join(heads.select("row", "k1", "k2"), "row").select("k1", "k2", "template", "first", "last").distinct()
    spans = cut_lineage(spans)
    few = spans.limit(BROADCAST_SPANS + 1).count() <= BROADCAST_SPANS
    held = F.broadcast if few else lambda df: df
    listed = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("template", "first", "last")).alias("spans"))  # of one text

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, b in slices(batches, 3, SLICE_BYTES):
            part = batch.slice(a, b - a)
            out: list[list] = [[] for _ in range(7)]
            for k1, k2, wanted, data in zip(*(part.column(i).to_pylist() for i in range(3)), as_bytes(part.column(3))):
                words = words_of(data)
                for span in wanted:
                    template = TEMPLATES[span["template"]]
                    if found := template.verified(words, span["first"], span["last"]):
                        for column, value in zip(out, (k1, k2, template.label, template.base, *found)):
                            column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["k1", "k2", "label", "base", "start", "stop", "similarity"])

    texts = docs.select(*_key(text), F.col(text).alias("text")).join(held(listed), ["k1", "k2"]).select("k1", "k2", "spans", "text")
    sure = texts.transform(in_arrow, verify, "k1 long, k2 long, label string, base boolean, start long, stop long, similarity double")
    found = sure.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.struct("start", "stop", "label", "base", "similarity"))).alias("licenses"))
    found = cut_lineage(found)
    none = F.array().cast(found.schema["licenses"].dataType)
    return heads.join(held(found), ["k1", "k2"], "left").select("doc_id", "n_words", F.coalesce("licenses", none).alias("licenses"))


def score(licenses: Column) -> Column:
    """How sure it is that a license is meant: the similarity of the best notice, less if one is only named."""
    best = F.array_max(F.transform(licenses, lambda s: F.when(s["base"], NAMED).otherwise(s["similarity"])))
    return F.coalesce(best, F.lit(0.0))


def labels(licenses: Column) -> Column:
    """Distinct labels, sorted and comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(licenses, lambda s: s["label"]))), ",")
