"""Hard negatives for anchors, by segment summary filtering.

For every anchor: its positives, the ``POSITIVES`` best rows of its label, and for each of them
the ``NEGATIVES`` best rows of other labels whose score lies between ``LEAST`` percent of the
positive's score and that score itself. Scores are integer inner products; of equal scores the
smaller vec_id comes first.

1. Every vector is stored with the mean and the deviation of each of its segments. For two
   vectors the product of a segment's means (times its length), plus or minus the product of its
   deviations, bounds the segment's share of the score.
2. Anchors are the query set. They are cut into blocks, and each block meets all rows it has to
   be compared with, cell by cell: rows of its label for the positives, then all rows for the
   negatives. A task holds one block and streams the rows.
3. There the bounds are taken over the whole vector first and then over ever shorter segments;
   what cannot come among the best leaves at once, and only the rest is scored exactly. The
   scores that an anchor has to beat rise as a task goes on.
4. A task sends the few best of each anchor, and the best of these are the result. So no row is
   left out anywhere, and no group of rows, hot labels or copies, is ever in one place.

Vectors: component x becomes floor(256 * x), x as double. Labels: where vec_id is divisible by 7
the label first becomes (label + 1) % 10, as planted wrong labels.

Rows: null vec_ids, labels or vectors, and vectors with a null or non-finite component or a
squared length (after scaling) of 2^56 or more, whose scores a long could not hold, take no part.
Only vectors of equal length are compared. "Other" rows are rows of another vec_id; if a vec_id
repeats, each of its rows takes part, as an anchor too. Empty vectors score 0. An anchor without
positives, or without rows in the range, has no result; an empty table gives none. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from tallystream.llm.words import in_arrow
from tallystream.operators.sizing import broadcast_if_small
from tallystream.session import cut_lineage

SCALE = 256
EVERY = 100  # rows whose vec_id it divides are anchors
POSITIVES = 5
NEGATIVES = 5
LEAST = 80  # percent of the positive's score
SEGMENTS = (1, 4, 16)  # each a refinement of the one before
ANCHOR_BLOCK = 32_768
CELL_ROWS = 65_536
TILE = 1 << 21  # pairs that are bounded at once

_MOST = float(1 << 56)
_ROW = "row long, vec_id long, label long, dim int, vector binary, means binary, devs binary"


def _cuts(dim: int, segments: int) -> np.ndarray:
    return np.array([dim * i // segments for i in range(segments + 1)])


def _summaries(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean (times the root of the segment's length) and deviation of the shortest segments."""
    finest, total = SEGMENTS[-1], np.concatenate([np.zeros((len(x), 1)), np.cumsum(x, axis=1)], axis=1)
    cuts = _cuts(x.shape[1], finest)
    size = np.maximum(np.diff(cuts), 1)
    mean = (total[:, cuts[1:]] - total[:, cuts[:-1]]) / size
    away = (x - np.repeat(mean, np.diff(cuts), axis=1)) ** 2
    total = np.concatenate([np.zeros((len(x), 1)), np.cumsum(away, axis=1)], axis=1)
    deviation = np.sqrt(np.maximum(total[:, cuts[1:]] - total[:, cuts[:-1]], 0))
    return (mean * np.sqrt(size)).astype(np.float32), deviation.astype(np.float32)


def _coarser(mean: np.ndarray, deviation: np.ndarray, dim: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of longer segments, from those of the shortest ones."""
    finest = mean.shape[1]
    if segments == finest:
        return mean, deviation
    each, step = np.diff(_cuts(dim, finest)), finest // segments
    group = lambda v: v.reshape(len(v), segments, step).sum(axis=2)
    size = np.maximum(each.reshape(segments, step).sum(axis=1), 1)
    whole = group(mean * np.sqrt(each)) / np.sqrt(size)
    squares = group(mean.astype(np.float64) ** 2 + deviation.astype(np.float64) ** 2)
    return whole.astype(np.float32), np.sqrt(np.maximum(squares - whole.astype(np.float64) ** 2, 0)).astype(np.float32)


def prepared(vectors: DataFrame) -> DataFrame:
    """The rows that take part, numbered, as scaled integers with the summaries of their segments; written out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(3)
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            values = column.flatten()
            starts = np.concatenate([[0], np.cumsum(sizes)])
            x = np.floor(values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False) * SCALE)
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                m = x[starts[at][:, None] + np.arange(dim)]
                with np.errstate(over="ignore", invalid="ignore"):
                    fits = (m**2).sum(axis=1) < _MOST  # false for what is not a number
                at, m = at[fits], m[fits]
                if not len(at):
                    continue
                mean, deviation = _summaries(m)
                small = np.int16 if not m.size or np.abs(m).max() < 1 << 15 else np.int64
                packed = lambda v: pa.array([r.tobytes() for r in v], pa.binary())
                rows = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:3], pa.array(np.full(len(at), dim), pa.int32()), packed(m.astype(small)), packed(mean), packed(deviation)],
                    ["row", "vec_id", "label", "dim", "vector", "means", "devs"],
                )

    there = vectors.filter("vec_id is not null and label is not null and embedding is not null")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = there.select(F.monotonically_increasing_id(), F.col("vec_id").cast("long"), label.cast("long"), "embedding")
    return cut_lineage(rows.transform(in_arrow, run, _ROW))


class Rows:
    """Some rows of one dimension inside a task."""

    def __init__(self, row: np.ndarray, ids: np.ndarray, labels: np.ndarray, dim: int, vector: np.ndarray, mean: np.ndarray, deviation: np.ndarray):
        self.row, self.ids, self.labels, self.dim = row, ids, labels, dim
        self.vector, self.mean, self.deviation = vector, mean, deviation
        self.length = np.sqrt((vector.astype(np.float64) ** 2).sum(axis=1))

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Rows:
        column = lambda name: batch.column(batch.schema.get_field_index(name))
        n, dim = batch.num_rows, int(column("dim")[0].as_py())
        vector = np.empty((n, dim), np.int64)
        stored = column("vector").to_pylist()
        wide = np.fromiter(map(len, stored), np.int64, n) > 2 * dim
        for kind, which in ((np.int16, ~wide), (np.int64, wide)):
            if which.any():
                vector[which] = np.frombuffer(b"".join([stored[i] for i in np.flatnonzero(which)]), kind).reshape(which.sum(), dim)
        floats = lambda name: np.frombuffer(b"".join(column(name).to_pylist()), np.float32).reshape(n, SEGMENTS[-1])
        number = lambda name: column(name).to_numpy(zero_copy_only=False)
        return cls(number("row"), number("vec_id"), number("label"), dim, vector, floats("means"), floats("devs"))

    def take(self, which: np.ndarray) -> Rows:
        return Rows(
            self.row[which], self.ids[which], self.labels[which], self.dim, self.vector[which], self.mean[which], self.deviation[which]
        )


def scores(anchors: Rows, others: Rows, least: np.ndarray, most: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) of the ``wanted`` pairs whose score lies between ``least`` and ``most`` of their anchor.

    Bounds over ever shorter segments thin out the pairs, and others that no anchor wants any
    more leave; what is left is scored exactly.
    """
    none = np.empty(0, np.int64)
    left = np.flatnonzero(wanted.any(axis=0))
    wanted = wanted[:, left]
    longest = others.length.max(initial=0)
    slack = (1e-5 * anchors.length * longest + 1).astype(np.float64)  # what rounding can hide
    low, high = (least - slack)[:, None], (most + slack)[:, None]
    for segments in SEGMENTS:
        if not len(left):
            return none, none, none
        m, d = _coarser(anchors.mean, anchors.deviation, anchors.dim, segments)
        n, e = _coarser(others.mean[left], others.deviation[left], others.dim, segments)
        middle, reach = m @ n.T, d @ e.T
        wanted &= (middle + reach >= low) & (middle - reach <= high)
        kept = wanted.any(axis=0)
        left, wanted = left[kept], wanted[:, kept]
    limit = anchors.length.max(initial=0) * longest
    kind = np.float32 if limit < 1 << 24 else np.float64 if limit < 1 << 53 else np.int64  # exact up to there
    exact = anchors.vector.astype(kind) @ others.vector[left].astype(kind).T
    off = 1e-12  # a long beyond 2^53 is rounded as the float it is compared with
    i, j = np.nonzero(wanted & (exact >= (least - off * np.abs(least))[:, None]) & (exact <= (most + off * np.abs(most))[:, None]))
    return i, left[j], exact[i, j].astype(np.int64)


class Best:
    """The best few (score, id) of each of many groups."""

    _NONE = -(1 << 62)

    def __init__(self, groups: int, few: int) -> None:
        self.few, self.worst = few, np.full(groups, -np.inf)  # the score to beat, once there are enough
        self.count = np.zeros(groups, np.int64)
        self.score, self.id = np.full((groups, few), self._NONE), np.zeros((groups, few), np.int64)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(group):
            return
        touched, new = np.unique(group, return_counts=True)
        group = np.concatenate([group, np.repeat(touched, self.few)])
        score, ids = np.concatenate([score, self.score[touched].ravel()]), np.concatenate([ids, self.id[touched].ravel()])
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        place = np.arange(len(group)) - np.searchsorted(group, group, side="left")
        kept = place < self.few
        self.score[group[kept], place[kept]], self.id[group[kept], place[kept]] = score[kept], ids[kept]
        self.count[touched] = np.minimum(self.count[touched] + new, self.few)
        full = touched[self.count[touched] == self.few]
        self.worst[full] = self.score[full, -1]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(group, score, id)"""
        group, place = np.nonzero(np.arange(self.few) < self.count[:, None])
        return group, self.score[group, place], self.id[group, place]


def _tiles(anchors: Rows, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, Rows]]:
    """Some anchors and some rows at a time."""
    step = max(1, min(len(anchors.row), 2_048))
    for a in range(0, batch.num_rows, TILE // step):
        others = Rows.of(batch.slice(a, TILE // step))
        for b in range(0, len(anchors.row), step):
            yield np.arange(b, min(b + step, len(anchors.row))), others


def _cells(anchors: DataFrame, rows: DataFrame, on: list[str], task, schema: str) -> DataFrame:
    """Every block of anchors and the rows with equal ``on``, cell by cell, in tasks: ``task`` gets the
    anchors of a block and an iterator over batches of rows."""
    spark = rows.sparkSession
    cells = max(1, -(-rows.count() // CELL_ROWS), min(2 * spark.sparkContext.defaultParallelism, -(-rows.count() // 2_048)))
    sizes = anchors.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / ANCHOR_BLOCK).cast("int").alias("blocks"))
    sizes = broadcast_if_small(cut_lineage(sizes))
    block = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    cell = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(cells)).cast("int")
    columns = rows.columns
    all_cells, all_blocks = F.explode(F.sequence(F.lit(0), F.lit(cells - 1))), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    here = anchors.join(sizes, on).withColumn("block", block).withColumn("cell", all_cells).withColumn("kind", F.lit(0))
    there = rows.join(sizes, on).withColumn("block", all_blocks).withColumn("cell", cell).withColumn("kind", F.lit(1))
    extra = [c for c in anchors.columns if c not in columns]
    key = [*on, "block", "cell"]
    both = here.unionByName(there, allowMissingColumns=True).select(F.xxhash64(*key).alias("key"), *key, "kind", *[c for c in columns if c not in on], *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple[tuple, pa.RecordBatch]]:
            """Stretches of one key and kind."""
            for batch in batches:
                marks = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(key) + 2)]
                changes = np.any([m[1:] != m[:-1] for m in marks], axis=0) if batch.num_rows else np.empty(0, bool)
                edges = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
                for a, b in zip(edges, edges[1:]):
                    if b > a:
                        yield tuple(int(m[a]) for m in marks), batch.slice(a, b - a)

        stretches, ahead = parts(), None
        ahead = next(stretches, None)
        while ahead:
            mine, held = ahead[0][:-1], []
            while ahead and ahead[0] == (*mine, 0):
                held.append(ahead[1])
                ahead = next(stretches, None)

            def others() -> Iterator[pa.RecordBatch]:
                nonlocal ahead
                while ahead and ahead[0] == (*mine, 1):
                    yield ahead[1]
                    ahead = next(stretches, None)

            if held:
                yield from task(pa.Table.from_batches(held).combine_chunks().to_batches()[0], others())
            for _ in others():
                pass

    parts_ = max(cells, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return both.repartition(parts_, "key").sortWithinPartitions("key", *key, "kind").transform(in_arrow, run, schema)


def positives(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """row (of the anchor), positive_ids and positive_scores, best first."""

    def task(held: pa.RecordBatch, others: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Rows.of(held)
        best = Best(len(block.row), POSITIVES)
        for batch in others:
            for some, rest in _tiles(block, batch):
                mine = block.take(some)
                wanted = mine.ids[:, None] != rest.ids[None, :]
                i, j, score = scores(mine, rest, best.worst[some], np.full(len(some), np.inf), wanted)
                best.add(some[i], score, rest.ids[j])
        group, score, ids = best.found()
        yield pa.RecordBatch.from_arrays([pa.array(block.row[group]), pa.array(score), pa.array(ids)], ["row", "score", "id"])

    found = _cells(anchors, rows, ["dim", "label"], task, "row long, score long, id long")
    first = W.partitionBy("row").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= POSITIVES)
    listed = F.sort_array(F.collect_list(F.struct("rank", "id", "score")))  # POSITIVES at most
    return ranked.groupBy("row").agg(listed.alias("p")).select("row", F.col("p.id").alias("positive_ids"), F.col("p.score").alias("positive_scores"))


def _lists(column: pa.Array, width: int, fill: float) -> np.ndarray:
    out = np.full((len(column), width), fill)
    for i, values in enumerate(column.to_pylist()):
        out[i, : len(values)] = values
    return out


def _negatives(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """row (of the anchor), place (of the positive), id, score."""

    def task(held: pa.RecordBatch, others: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Rows.of(held)
        column = held.column(held.schema.get_field_index("positive_scores"))
        high = _lists(column, POSITIVES, np.nan)  # nan: no such positive, never reached
        low = np.ceil(high * LEAST / 100)
        whole = [[*map(int, s), *[0] * (POSITIVES - len(s))] for s in column.to_pylist()]
        exact_low = np.array([[-(-LEAST * s // 100) for s in row] for row in whole], np.int64).reshape(-1, POSITIVES)
        exact_high = np.array(whole, np.int64).reshape(-1, POSITIVES)
        real = ~np.isnan(high)
        best = Best(len(block.row) * POSITIVES, NEGATIVES)
        for batch in others:
            for some, rest in _tiles(block, batch):
                mine = block.take(some)
                worst = best.worst.reshape(-1, POSITIVES)[some]
                need = np.where(real[some], np.maximum(low[some], worst), np.inf).min(axis=1)
                most = np.where(real[some], high[some], -np.inf).max(axis=1)
                wanted = (mine.labels[:, None] != rest.labels[None, :]) & (mine.ids[:, None] != rest.ids[None, :])
                i, j, score = scores(mine, rest, need, most, wanted)
                for k in range(POSITIVES):
                    fits = real[some[i], k] & (score >= exact_low[some[i], k]) & (score <= exact_high[some[i], k])
                    best.add(some[i][fits] * POSITIVES + k, score[fits], rest.ids[j][fits])
        group, score, ids = best.found()
        place = (group % POSITIVES).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.row[group // POSITIVES]), pa.array(place), pa.array(ids), pa.array(score)], ["row", "place", "id", "score"]
        )

    found = _cells(anchors, rows, ["dim"], task, "row long, place int, id long, score long")
    first = W.partitionBy("row", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= NEGATIVES)


def mine(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = prepared(vectors.select("vec_id", "embedding", "label"))
    anchors = rows.filter(F.col("vec_id") % EVERY == 0)
    told = cut_lineage(anchors.join(positives(rows, anchors), "row").filter(F.col("positive_scores")[0] >= 0))
    found = _negatives(rows, told)
    named = told.select("row", F.col("vec_id").alias("anchor_id"), "positive_ids", "positive_scores")
    return found.join(named, "row").select(
        "anchor_id",
        F.get("positive_ids", F.col("place")).alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        F.get("positive_scores", F.col("place")).alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
