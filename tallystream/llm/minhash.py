"""Near-duplicates by MinHash with tensored banding.

Two collections of ten bands of three hashes each are made for a document's set of shingles;
a table's key joins one band of either collection, so 60 hashes serve 100 tables of six. Two
documents meet in some table exactly if they share a band of both collections: at similarity
0.85 that fails once in some 7,000 pairs. Bands nobody shares are dropped before keys are
joined, so most documents never reach a table.

1. Documents with equal sets become one class (linked by definition), so a group of copies
   counts once from here on.
2. In each table every class is paired with the smallest one. Pairs whose hashes agree in too
   few places are left out; the rest are confirmed on full sets, and components follow.
3. What tables still hold of different components is compared in blocks, with full sets and
   without being emitted: only links between different components come out. Components are
   then final. So no candidate link is lost, and no group is emitted as pairs.

Words: after lower-casing A-Z, runs of anything but ASCII white space; shingles of five words,
or the whole sequence if there are fewer. Links: 100 * intersection >= 85 * union.

Rows: null or empty texts have an empty set, link with nothing and are kept; a null id takes
part by its text and gets the smallest id of its component; ``kept`` compares ids, so it holds for
every row that has that id, and for all rows of a component of null ids. ``one_of_each`` leaves
exactly one row of a component, that of the smallest (id, text hash), null ids last; repeated rows
(same id and text) are both reported by ``duplicates``; an empty table gives an empty result; other columns are not
read, and ``one_of_each`` passes them on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, NumericType

from tallystream.llm.components import component_labels
from tallystream.llm.runs import runs
from tallystream.llm.words import SLICE_BYTES, as_bytes, in_arrow, mix, slices, window_hashes, word_hashes
from tallystream.session import cut_lineage

SHINGLE = 5
BANDS = 10
BAND_SIZE = 3
HASHES = 2 * BANDS * BAND_SIZE
PERCENT = 85
AGREEING = 40  # of 60 hashes; at similarity 0.85 fewer agree once in some 10,000 pairs
BLOCK_ROWS = 512
BROADCAST_ROWS = 200_000  # keys of up to 32 bytes, some 10 MB

_SEEDS = np.random.default_rng(1).integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)


def shingle_set(data: bytes | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    words = (data or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(word_hashes(words), min(SHINGLE, len(words))))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest of each of the 60 hashes, over pieces of the set, so memory stays small."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4_096):
        part = mix(shingles[at : at + 4_096][None, :] * _SEEDS[:, None])
        np.minimum(least, part.min(axis=1), out=least)
    return least


def _signed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text_hash, n_shingles, node (a hash of the set), bands, marks (a byte a hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, a, b in slices(batches, 2, SLICE_BYTES):
            batch = whole.slice(a, b - a)
            size, node, bands, marks = [], [], [], []
            for data in as_bytes(batch.column(2)):
                shingles = shingle_set(data)
                size.append(len(shingles))
                node.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                if not len(shingles):
                    bands.append([])
                    marks.append(b"")
                    continue
                s = signature(shingles)
                rows = s.reshape(2 * BANDS, BAND_SIZE)
                bands.append(window_hashes_of_rows(rows))
                marks.append((s & np.uint64(255)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(size, pa.int64()),
                    pa.array(node, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(marks, pa.binary()),
                ],
                ["doc_id", "text_hash", "n_shingles", "node", "bands", "marks"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text")).transform(
        in_arrow, run, f"doc_id {kind}, text_hash long, n_shingles long, node binary, bands array<long>, marks binary"
    )


def window_hashes_of_rows(rows: np.ndarray) -> np.ndarray:
    """One hash a row of a matrix of hashes."""
    acc = rows[:, 0].copy()
    for i in range(1, rows.shape[1]):
        acc = mix(acc) + rows[:, i]
    return mix(acc).view(np.int64)


def _tables(classes: DataFrame) -> DataFrame:
    """key, p, q, node, pivot: the classes of every table key that more than one has.

    ``p`` and ``q`` are the two bands the key is made of, ``pivot`` its smallest class.
    """
    bands = classes.filter(F.col("n_shingles") > 0).select("node", F.posexplode("bands").alias("band", "h"))
    shared = bands.groupBy("band", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("band", "h")
    live = bands.join(shared, ["band", "h"]).groupBy("node").agg(F.collect_list(F.struct("band", "h")).alias("live"))  # 20 at most
    live = cut_lineage(live)
    keys = (
        live.select("node", "live", F.explode("live").alias("a"))
        .filter(F.col("a.band") < BANDS)
        .select("node", "a", F.explode("live").alias("b"))
        .filter(F.col("b.band") >= BANDS)
    )
    rows = keys.select(
        F.xxhash64("a.band", "a.h", "b.band", "b.h").alias("key"), F.col("a.band").alias("p"), F.col("b.band").alias("q"), "node"
    )
    pivots = rows.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return cut_lineage(rows.join(pivots, "key"))


def _held(keys: DataFrame) -> DataFrame:
    """``keys`` to be broadcast if they are few and of fixed width; beyond that Spark shuffles the texts."""
    fixed = all(isinstance(f.dataType, (NumericType, BooleanType)) or f.name == "node" for f in keys.schema)
    return F.broadcast(keys) if fixed and keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else keys


def _sets(docs: DataFrame, nodes: DataFrame, doc_id: str, text: str) -> DataFrame:
    """node, shingles (sorted hashes) of the classes in ``nodes`` (node, rep, rep_hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, a, b in slices(batches, 1, SLICE_BYTES):
            batch = whole.slice(a, b - a)
            sets = [np.sort(shingle_set(x).view(np.int64)) for x in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    texts = docs.select(F.col(doc_id).alias("rep"), F.xxhash64(F.col(text)).alias("rep_hash"), F.col(text).alias("text"))
    held = _held(nodes)
    same = texts["rep"].eqNullSafe(held["rep"]) & (texts["rep_hash"] == held["rep_hash"])
    return texts.join(held, same).select("node", "text").transform(in_arrow, run, "node binary, shingles array<long>").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The (u, v) of ``pairs`` that are links, by their full sets."""
    nodes = cut_lineage(
        pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
        .join(classes.select("node", "rep", "rep_hash"), "node")
    )
    sets = cut_lineage(_sets(docs, nodes, doc_id, text))
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    both = pairs.join(left, "u").join(right, "v")
    common = F.size(F.array_intersect("a", "b"))
    return both.filter(100 * common >= PERCENT * (F.size("a") + F.size("b") - common)).select("u", "v")


def _plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The (u, v) of ``pairs`` whose sizes and hashes allow a link."""

    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, HASHES) for i in (2, 3)
            )
            yield batch.filter(pa.array((a == b).sum(axis=1) >= AGREEING)).select(["u", "v"])

    size = classes.select("node", "n_shingles", "marks")
    left = size.select(F.col("node").alias("u"), F.col("n_shingles").alias("a"), F.col("marks").alias("p"))
    right = size.select(F.col("node").alias("v"), F.col("n_shingles").alias("b"), F.col("marks").alias("q"))
    sized = pairs.join(left, "u").join(right, "v").filter(100 * F.least("a", "b") >= PERCENT * F.greatest("a", "b"))
    return cut_lineage(sized.select("u", "v", "p", "q").transform(in_arrow, agreeing, "u binary, v binary"))


def _left_over(tables: DataFrame, labels: DataFrame, classes: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Links (u, v) of different components among the classes that still meet in some table.

    These classes are grouped by the bands of the first collection, with their full sets. A
    large group is cut into blocks of about ``BLOCK_ROWS``, and every two blocks are compared
    in some task: a pair is looked at under the first band it shares, must share one of the
    second collection too, and is confirmed at once. Components met are merged on the way, so
    a block emits fewer links than it has rows.
    """
    named = tables.join(labels, "node", "left").select("key", "p", "node", F.coalesce("component", "node").alias("component"))
    mixed = named.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter(F.col("a") != F.col("b")).select("key")
    open_ = named.join(mixed, "key").select("p", "node", "component").distinct()
    rows = cut_lineage(
        open_.join(classes.select("node", "n_shingles", "bands", "marks"), "node").withColumn("h", F.element_at("bands", F.col("p") + 1))
    )
    nodes = cut_lineage(rows.select("node").distinct().join(classes.select("node", "rep", "rep_hash"), "node"))
    sets = cut_lineage(_sets(docs, nodes, doc_id, text))
    blocks = rows.groupBy("p", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("p", "h", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    rows = rows.join(blocks, ["p", "h"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.join(sets, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "h", "p", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        "own", "n_shingles", "node", "component", "bands", "marks", "shingles",
    )
    dealt = rows.repartition("h", "p", "x", "y").sortWithinPartitions("h", "p", "x", "y")

    def arrays(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        def binary(i: int, kind, width: int) -> np.ndarray:
            return np.frombuffer(b"".join(batch.column(i).to_pylist()), kind).reshape(-1, width)

        sets = np.empty(batch.num_rows, object)
        for i in range(batch.num_rows):
            sets[i] = batch.column(10)[i].values.to_numpy()
        return {k: batch.column(i).to_numpy() for i, k in enumerate(("h", "p", "x", "y", "own", "size"))} | {
            "node": binary(6, "V16", 1)[:, 0],
            "component": binary(7, np.uint64, 2),
            "bands": batch.column(8).flatten().to_numpy().reshape(-1, 2 * BANDS),
            "marks": binary(9, np.uint8, HASHES),
            "sets": sets,
        }

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches, arrays, ["h", "p", "x", "y"]):
            label = np.unique(block["component"], axis=0, return_inverse=True)[1].ravel()
            x, y, p = (block[k][0] for k in ("x", "y", "p"))
            size, marks, bands, sets = (block[k] for k in ("size", "marks", "bands", "sets"))
            right = np.flatnonzero(block["own"] == y)
            u, v = [], []
            for i in np.flatnonzero(block["own"] == x).tolist():
                j = right[right > i] if x == y else right
                j = j[label[j] != label[i]]
                j = j[100 * np.minimum(size[j], size[i]) >= PERCENT * np.maximum(size[j], size[i])]
                j = j[(marks[j] == marks[i]).sum(axis=1) >= AGREEING]
                if not len(j):
                    continue
                same = bands[j] == bands[i]
                j = j[(same[:, :BANDS].argmax(axis=1) == p) & same[:, BANDS:].any(axis=1)]
                if not len(j):
                    continue
                joined = np.concatenate([sets[k] for k in j])
                at = np.minimum(np.searchsorted(sets[i], joined), size[i] - 1)
                starts = np.cumsum(size[j]) - size[j]
                common = np.add.reduceat((sets[i][at] == joined).astype(np.int64), starts)
                for k in j[100 * common >= PERCENT * (size[i] + size[j] - common)].tolist():
                    if label[k] != label[i]:
                        label[label == label[k]] = label[i]
                        u.append(block["node"][i].tobytes())
                        v.append(block["node"][k].tobytes())
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], ["u", "v"])

    return cut_lineage(dealt.transform(in_arrow, compared, "u binary, v binary").distinct())


def duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id (the smallest id linked, over any number of
    links) and kept (the row has that id), for every row of ``docs``."""
    return _judged(docs, doc_id, text).drop("stays")


def _judged(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The columns of ``duplicates``, and stays: the row is the one of its component that
    ``one_of_each`` leaves, or equal to it in id and text."""
    signed = cut_lineage(_signed(docs, doc_id, text))
    classes = cut_lineage(
        signed.groupBy("node", "n_shingles", "bands", "marks")
        .agg(
            F.min(F.struct("doc_id", "text_hash")).alias("first"),
            F.min("doc_id").alias("least_id"),
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("head"),
        )
        .select("node", "n_shingles", "bands", "marks", "least_id", "head", F.col("first.doc_id").alias("rep"), F.col("first.text_hash").alias("rep_hash"))
    )
    tables = _tables(classes)
    stars = tables.filter(F.col("node") != F.col("pivot")).select(F.col("pivot").alias("u"), F.col("node").alias("v")).distinct()
    edges = cut_lineage(_confirmed(_plausible(stars, classes), classes, docs, doc_id, text))
    labels = cut_lineage(component_labels(edges))
    more = _left_over(tables, labels, classes, docs, doc_id, text)
    spine = labels.filter(F.col("node") != F.col("component")).select(F.col("node").alias("u"), F.col("component").alias("v"))
    labels = component_labels(spine.unionByName(more))

    # Empty sets are all one class by their hash, but stay apart.
    full = classes.filter(F.col("n_shingles") > 0).join(labels, "node", "left")
    full = cut_lineage(full.select("node", "least_id", "head", F.coalesce("component", "node").alias("component")))
    least = full.groupBy("component").agg(F.min("least_id").alias("component_id"), F.min("head").alias("head"))
    named = full.drop("head").join(least, "component").select("node", "component_id", "head")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    is_head = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_hash") == F.col("head.text_hash"))
    return signed.select("doc_id", "text_hash", "n_shingles", "node").join(named, "node", "left").select(
        "doc_id",
        "text_hash",
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
        F.when(F.col("n_shingles") > 0, is_head).otherwise(True).alias("stays"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component one with the smallest id, and every empty one.

    Only rows that go or repeat are looked up; the others pass with all their columns.
    """
    found = cut_lineage(_judged(docs, doc_id, text))
    odd = (
        found.groupBy(F.col("doc_id").alias("odd_id"), F.col("text_hash").alias("odd_hash"))
        .agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("copies"), F.max("n_shingles").alias("n"))
        .filter(~F.col("stays") | ((F.col("copies") > 1) & (F.col("n") > 0)))
    )
    odd = cut_lineage(odd.select("odd_id", "odd_hash", "stays"))

    def looked_up(wanted: DataFrame, how: str) -> DataFrame:
        same = docs[doc_id].eqNullSafe(wanted["odd_id"]) & (F.xxhash64(docs[text]) == wanted["odd_hash"])
        return docs.join(_held(wanted), same, how)

    passed = looked_up(odd, "left_anti")
    again = odd.filter("stays")
    if again.isEmpty():
        return passed
    return passed.unionByName(looked_up(again, "left_semi").dropDuplicates([doc_id, text]))
