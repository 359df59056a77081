"""Benchmark decontamination with suffix arrays of the training text.

Documents are dealt out in shards of a few MB. Each shard gets the sorted array of its
suffixes (those that begin like some test suffix; no other can match), every test suffix is
binary-searched in it, and the run found gives all locations of a verbatim match, which are
then extended to the longest one. Affected documents are removed.

The benchmark is the stated query set. It is cut into blocks of at most about ``BLOCK_BYTES``;
each is searched against all documents, and a document's hits of all blocks are merged.

Words: after lower-casing A-Z, runs of digits, letters a-z and anything beyond ASCII. A window
is ten words of an item; an item of fewer words is one window; one without words has none.

Rows: null or empty texts have no words and no hits; a null item id counts as an empty id;
repeated documents are judged each, repeated items count once by id; an empty benchmark hits
nothing. Other columns, whatever their names, pass through ``keep_clean`` unread.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallystream.llm.words import as_bytes, in_arrow, slices

WINDOW = 10
SHARD_BYTES = 4_000_000
BLOCK_BYTES = 8_000_000
_TABLE_BITS = 22
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def item_words(data: bytes | None) -> list[bytes]:
    return (data or b"").translate(_TABLE).split()


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        return 0


class TestSuffixes:
    """All windows of a block of items, ready to be searched."""

    __test__ = False

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW) -> None:
        self.window = window
        self.names = [name for name, _ in items]
        self.vocabulary = _Vocabulary()
        texts, owner, start, length = [], [], [], []
        for i, (_, data) in enumerate(items):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in item_words(data)]
            texts.append(np.array(ids, np.int64))
            n = max(len(ids) - window + 1, 1) if ids else 0
            owner += [i] * n
            start += range(n)
            length += [min(window, len(ids))] * n
        self.owner, self.start, self.length = (np.array(x, np.int64) for x in (owner, start, length))
        # Items one after the other; -1 ends each, so that an extension stops there.
        self.item_at = np.cumsum([0, *[len(t) + 1 for t in texts]])[:-1].astype(np.int64)
        self.words = np.concatenate([*[np.append(t, -1) for t in texts], np.full(window + 1, -1)])
        where = self.item_at[self.owner] + self.start if len(owner) else np.empty(0, np.int64)
        rows = self.words[where[:, None] + np.arange(window)]
        inside = np.arange(window) < self.length[:, None]
        self.low = self._keys(np.where(inside, rows, 0))
        self.high = self._keys(np.where(inside, rows, 0xFFFFFFFF))
        self.prefix = int(min(3, self.length.min())) if len(owner) else 1
        self.begins = np.zeros(1 << _TABLE_BITS, bool)
        self.begins[self._places(rows.T)] = True

    def _keys(self, rows: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * self.window}").ravel()

    def _places(self, columns) -> np.ndarray:
        code = np.zeros(len(columns[0]), np.uint64)
        for i in range(self.prefix):
            code += (columns[i].astype(np.uint64) + np.uint64(i)) * _MULTIPLIERS[i]
        return (code >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def search(self, docs: list[bytes | None]):
        """(words per document, and of every location: document, word, test suffix, match length).

        Only the leftmost location of a match carries its full length; others have 0.
        """
        split = [item_words(d) for d in docs]
        counts = np.array([len(s) for s in split], np.int64)
        first = np.cumsum(counts + 1) - counts - 1
        ids = np.zeros(int(counts.sum()) + len(docs) + self.window + 1, np.int64)
        get = self.vocabulary.__getitem__
        for at, words in zip(first.tolist(), split):
            ids[at : at + len(words)] = np.fromiter(map(get, words), np.int64, len(words))
        n = len(ids) - self.window - 1
        none = np.empty(0, np.int64)
        if not len(self.owner) or n <= 0:
            return counts, none, none, none, none
        likely = self.begins[self._places([ids[i : n + i] for i in range(self.prefix)])] & (ids[:n] > 0)
        suffixes = np.flatnonzero(likely)
        keys = self._keys(ids[suffixes[:, None] + np.arange(self.window)])
        order = np.argsort(keys, kind="stable")
        suffixes, keys = suffixes[order], keys[order]  # the shard's suffix array
        low, high = np.searchsorted(keys, self.low, "left"), np.searchsorted(keys, self.high, "right")
        found = high - low
        test = np.repeat(np.arange(len(found)), found)
        at = suffixes[np.repeat(low - (np.cumsum(found) - found), found) + np.arange(int(found.sum()))]
        doc = np.searchsorted(first, at, "right") - 1
        item = self.item_at[self.owner[test]] + self.start[test]
        opens = (self.start[test] == 0) | (at == first[doc]) | (ids[at - 1] != self.words[item - 1])
        reach = np.where(opens, self.length[test], 0)
        going = np.flatnonzero(opens)
        while len(going):
            same = ids[np.minimum(at[going] + reach[going], len(ids) - 1)] == self.words[item[going] + reach[going]]
            going = going[same]
            reach[going] += 1
        return counts, doc, at - first[doc], test, reach

    def hits(self, docs: list[bytes | None]) -> tuple[np.ndarray, list[tuple[list, list, list] | None]]:
        """Words per document, and for each with hits: covered word ranges, item names, matches."""
        counts, doc, word, test, reach = self.search(docs)
        out: list = [None] * len(docs)
        order = np.lexsort((word, doc))
        doc, word, test, reach = doc[order], word[order], test[order], reach[order]
        cuts = np.flatnonzero(np.diff(doc, prepend=-1))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(doc)]):
            cover = np.zeros(counts[doc[a]] + 1, np.int64)
            np.add.at(cover, word[a:b], 1)
            np.add.at(cover, word[a:b] + self.length[test[a:b]], -1)
            edge = np.flatnonzero(np.diff(np.cumsum(cover) > 0, prepend=False))
            items = sorted({self.names[i] for i in np.unique(self.owner[test[a:b]])})
            whole = [i for i in range(a, b) if reach[i]]
            matches = [(self.names[self.owner[test[i]]], int(word[i]), int(self.start[test[i]]), int(reach[i])) for i in whole]
            out[doc[a]] = (list(zip(edge[::2].tolist(), edge[1::2].tolist())), items, matches)
        return counts, out


def _blocks(benchmark: DataFrame, item_id: str, text: str, window: int) -> list:
    """The benchmark's suffixes as broadcast blocks of at most about ``BLOCK_BYTES`` of text each."""
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).cast("binary").alias("text")
    )
    size = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n = max(1, math.ceil(size / BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    context = benchmark.sparkSession.sparkContext
    return [
        context.broadcast(TestSuffixes([(r.item, None if r.text is None else bytes(r.text)) for r in items.filter(block == b).collect()], window))
        for b in range(n)
    ]


_RANGES = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))
_MATCHES = pa.list_(pa.struct([("item_id", pa.string()), ("word", pa.int64()), ("item_word", pa.int64()), ("n_words", pa.int64())]))


def _union_size(ranges: Column) -> Column:
    """Words in the union of [first, stop) ranges."""
    start = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        F.array_sort(ranges),
        start,
        lambda acc, x: F.struct(
            F.greatest(acc["upto"], x["stop"]).alias("upto"),
            (acc["n"] + F.greatest(F.lit(0).cast("long"), x["stop"] - F.greatest(x["first"], acc["upto"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids), matches (item_id, word, item_word, n_words: the
    longest verbatim matches and where they are) and contaminated, for every row of ``docs``."""
    key = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = (
        f"doc_id {kind}, text_hash long, n_words long, counted int, ranges array<struct<first:long,stop:long>>, items array<string>,"
        " matches array<struct<item_id:string,word:long,item_word:long,n_words:long>>"
    )

    def searched(block, counted: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            suffixes = block.value
            for batch, start, stop in slices(batches, 2, SHARD_BYTES):
                part = batch.slice(start, stop - start)
                counts, hits = suffixes.hits(as_bytes(part.column(2)))
                empty = ([], [], [])
                columns = [
                    part.column(0),
                    part.column(1),
                    pa.array(counts, pa.int64()),
                    pa.array([counted] * len(hits), pa.int32()),
                    pa.array([[{"first": a, "stop": b} for a, b in (h or empty)[0]] for h in hits], _RANGES),
                    pa.array([(h or empty)[1] for h in hits], pa.list_(pa.string())),
                    pa.array([[dict(zip(("item_id", "word", "item_word", "n_words"), m)) for m in (h or empty)[2]] for h in hits], _MATCHES),
                ]
                rows = pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_words", "counted", "ranges", "items", "matches"])
                yield rows if counted else rows.filter(pa.array([h is not None for h in hits], pa.bool_()))

        return key.transform(in_arrow, run, schema)

    parts = [searched(block, int(i == 0)) for i, block in enumerate(_blocks(benchmark, item_id, item_text, window))]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    # One row a document and block; equal rows of docs meet here and part again below.
    merged = rows.groupBy("doc_id", "text_hash", "n_words").agg(
        F.sum("counted").alias("copies"),
        F.max(F.size("ranges") > 0).alias("contaminated"),
        F.array_distinct(F.flatten(F.collect_set(F.when(F.size("ranges") > 0, F.col("ranges"))))).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(F.size("items") > 0, F.col("items")))))).alias("items"),
        F.array_distinct(F.flatten(F.collect_set(F.when(F.size("matches") > 0, F.col("matches"))))).alias("matches"),
    )
    return merged.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        "doc_id", "n_words", _union_size(F.col("ranges")).alias("n_hit"), "items", "matches", "contaminated"
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that no window of the benchmark occurs in, with all their columns."""
    at = docs.columns.index(text)

    def without(rows: DataFrame, block) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            suffixes = block.value
            for batch, start, stop in slices(batches, at, SHARD_BYTES):
                part = batch.slice(start, stop - start)
                hit = np.bincount(suffixes.search(as_bytes(part.column(at)))[1], minlength=part.num_rows)
                yield part.filter(pa.array(hit == 0))

        return rows.transform(in_arrow, run, docs.schema)

    for block in _blocks(benchmark, item_id, item_text, window):
        docs = without(docs, block)
    return docs
