"""Removal of repeated passages by super-k-mer partitioning.

A window is 20 consecutive words of a document; its minimiser is the smallest hash among its
13 runs of 8 words. Consecutive windows that share a minimiser form a super-k-mer.

1. Every task sends its distinct minimisers, packed, to bins. A minimiser met only once cannot
   belong to a repeated window, so its super-k-mers need not travel. What repeats within a
   task is settled there, and one record stands for it.
2. The others do: a super-k-mer travels as one packed string of its words to the bucket of its
   minimiser. Windows that repeat within a task travel once, so a passage shared by a third of
   all documents is one string a task, not a string a document.
   Buckets are counted first. The windows of one above ``BUCKET_BYTES`` (a short run in ever
   different surroundings) travel singly, each to the bucket of its own hash; equal ones still
   meet there, at most one from a slice.
3. Sorting a bucket's windows counts them exactly (word by word; hashes only order them), and
   all but the first (smallest id, then start) are marked.
   Rows of one doc value (null ids, a repeated id) may have a window at the same place: in a
   slice one of them leads and travels, and what is marked in it is marked in those it leads.
4. Marks meet the texts again, and marked windows' words go.

Words are runs of anything but ASCII white space, unchanged. Windows are judged on the input.

Rows: null or empty texts, and those of fewer than 20 words, lose nothing; ids are whole
numbers, a null id counts as later than any other; rows that repeat an id are the same
document, so a window at the same place in both is not a repetition; other columns are not
read; an empty table gives an empty result. Texts are whole: very long ones are cut nowhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame, functions as F

from tallystream.llm.words import as_bytes, in_arrow, slices, window_hashes, word_hashes, word_numbers
from tallystream.session import cut_lineage

WINDOW = 20
MINIMISER = 8
SLICE_BYTES = 4_000_000
BUCKET_BYTES = 4_000_000
BINS_A_PARTITION = 4
NO_ID = np.iinfo(np.int64).max


def window_minimisers(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The minimiser of every window, and the hashes of all runs of ``MINIMISER`` words."""
    runs = window_hashes(word_hashes(words), MINIMISER)
    span = WINDOW - MINIMISER + 1
    least, size = runs, 1
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < span:
        least = np.minimum(least[: len(least) - (span - size)], least[span - size :])
    return least, runs


def repeated_windows(words: list[bytes], at: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Among the windows beginning at ``at`` in ``words``: is it later, in (doc, start), than the
    first with the same words; and which window stands for all with its words."""
    numbers, _ = word_numbers(words)
    rows = numbers.astype(np.int32)[at[:, None] + np.arange(WINDOW)]
    code = np.zeros(len(at), np.uint64)
    for i in range(WINDOW):
        code = code * np.uint64(0x9E3779B97F4A7C15) + rows[:, i].astype(np.uint64) + np.uint64(1)
    order = np.lexsort((start, doc, code))
    ordered = rows[order]
    same = code[order][1:] == code[order][:-1]
    equal = (ordered[1:] == ordered[:-1]).all(axis=1)
    if (same & ~equal).any():  # two windows under one hash: order by the words themselves
        order = np.lexsort((start, doc, *rows.T))
        ordered = rows[order]
        equal = (ordered[1:] == ordered[:-1]).all(axis=1)
    opens = np.concatenate([[True], ~equal]) if len(at) else np.empty(0, bool)
    first = np.flatnonzero(opens)[np.cumsum(opens) - 1] if len(at) else np.empty(0, np.int64)
    d, s = doc[order], start[order]
    later = np.zeros(len(at), bool)
    later[order] = (d != d[first]) | (s != s[first])
    leader = np.empty(len(at), np.int64)
    leader[order] = order[first]
    return later, leader


def _ranges(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]])))
    return edge[::2], edge[1::2]


def codes_of(minimisers: np.ndarray) -> np.ndarray:
    return (minimisers >> np.uint64(32)).astype(np.uint32).view(np.int32) ^ minimisers.astype(np.uint32).view(np.int32)


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(int(NO_ID))).alias("doc"),
        F.col(doc_id).isNull().alias("no_id"),
        F.xxhash64(F.col(doc_id), F.col(text)).alias("row"),
        F.col(text).alias("text"),
    )


def repeated_minimisers(keyed: DataFrame) -> DataFrame:
    """row, codes: of those of a row's minimisers that are met more than once in all texts.

    A code is half of the hash. Within a bin codes differ as hashes do but for one in billions;
    a wrong match only lets a super-k-mer travel in vain.
    """
    bins = BINS_A_PARTITION * int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "bin int, settled boolean, rows array<long>, codes array<int>"

    def packed(bin_: list, settled: bool, rows: list, codes: list) -> pa.RecordBatch:
        columns = [
            pa.array(bin_, pa.int32()),
            pa.array([settled] * len(bin_), pa.bool_()),
            pa.array(rows, pa.list_(pa.int64())),
            pa.array(codes, pa.list_(pa.int32())),
        ]
        return pa.RecordBatch.from_arrays(columns, ["bin", "settled", "rows", "codes"])

    def by_row(rows: np.ndarray, values: np.ndarray) -> tuple[list, list]:
        order = np.argsort(rows, kind="stable")
        rows, values = rows[order], values[order]
        cuts = np.flatnonzero(np.diff(rows)) + 1
        heads = rows[np.concatenate([[0], cuts])] if len(rows) else []
        return [[int(r)] for r in heads], np.split(values, cuts) if len(rows) else []

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, b in slices(batches, 1, SLICE_BYTES):
            part = batch.slice(a, b - a)
            values, rows, twice = [], [], []
            for row, data in zip(part.column(0).to_pylist(), as_bytes(part.column(1))):
                words = (data or b"").split()
                if len(words) < WINDOW:
                    continue
                least, runs = window_minimisers(words)
                own = np.unique(least)
                runs.sort()
                values.append(own)
                rows.append(np.full(len(own), row, np.int64))
                twice.append(np.searchsorted(runs, own, "right") - np.searchsorted(runs, own, "left") > 1)
            if not values:
                continue
            value, row, again = np.concatenate(values), np.concatenate(rows), np.concatenate(twice)
            order = np.argsort(value, kind="stable")
            value, row, again = value[order], row[order], again[order]
            opens = np.concatenate([[True], value[1:] != value[:-1]])
            group = np.cumsum(opens) - 1
            settled = np.bincount(group, weights=1 + again) > 1  # met twice here already
            local = settled[group]
            heads, own = by_row(row[local], codes_of(value[local]))
            if heads:
                yield packed([int(h[0]) % bins for h in heads], True, heads, own)
            # A settled one goes out twice, for no row, so that others learn that it repeats.
            once = ~local
            told = value[opens][settled]
            value = np.concatenate([value[once], told, told])
            row = np.concatenate([row[once], np.zeros(2 * len(told), np.int64)])
            to = (value % np.uint64(bins)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            cuts = np.flatnonzero(np.diff(to[order])) + 1
            names = to[order][np.concatenate([[0], cuts])]
            yield packed(names, False, np.split(row[order], cuts), np.split(codes_of(value[order]), cuts))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name = [], None

        def done() -> pa.RecordBatch:
            rows, codes = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(codes, kind="stable")
            rows, codes = rows[order], codes[order]
            opens = np.concatenate([[True], codes[1:] != codes[:-1]])
            group = np.cumsum(opens) - 1
            many = (np.bincount(group) > 1)[group] & (rows != 0)
            heads, own = by_row(rows[many], codes[many])
            return packed([name] * len(heads), True, heads, own)

        for batch in batches:
            yield batch.filter(batch.column(1))
            rest = batch.filter(pa.compute.invert(batch.column(1)))
            for i, own in enumerate(rest.column(0).to_pylist()):
                if held and own != name:
                    yield done()
                    held = []
                name = own
                held.append(tuple(rest.column(k)[i].values.to_numpy() for k in (2, 3)))
        if held:
            yield done()

    sent = keyed.select("row", "text").transform(in_arrow, send, schema)
    met = sent.repartition("bin").sortWithinPartitions("bin").transform(in_arrow, meet, schema)
    found = met.select(F.col("rows")[0].alias("row"), "codes")
    return found.groupBy("row").agg(F.flatten(F.collect_list("codes")).alias("codes"))


_PARTS = (
    "kind int, doc long, no_id boolean, row long, text binary, n_words long, digest string, bucket long, start long, packed binary,"
    " first long, stop long, led long"
)
_ARROW = {
    "kind": pa.int32(), "doc": pa.int64(), "no_id": pa.bool_(), "row": pa.int64(), "text": pa.binary(), "n_words": pa.int64(),
    "digest": pa.string(), "bucket": pa.int64(), "start": pa.int64(), "packed": pa.binary(), "first": pa.int64(), "stop": pa.int64(),
    "led": pa.int64(),
}
UNTOUCHED, TEXT, STRING, MARK, LED = range(5)


def _rows(kind: int, **columns) -> pa.RecordBatch:
    n = len(columns["doc"])
    columns["kind"] = [kind] * n
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in _ARROW.items()], list(_ARROW)
    )


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts cross the network twice; compressed here, they do so in half the bytes."""
    press = zstandard.ZstdCompressor(level=3)
    for whole, a, b in slices(batches, 3, SLICE_BYTES):
        batch = whole.slice(a, b - a)
        own = as_bytes(batch.column(3))
        texts, size = [press.compress(x or b"") for x in own], [len(x or b"") for x in own]
        columns = [*[batch.column(i) for i in range(3)], pa.array(texts, pa.binary()), pa.array(size, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc", "no_id", "row", "text", "size"])


def _split_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (doc, no_id, row, text, size, codes): finished rows, texts to come back to,
    super-k-mers, and marks of windows that repeat within this slice."""
    unpress = zstandard.ZstdDecompressor()
    for batch, a, b in slices(batches, 4, SLICE_BYTES):
        part = batch.slice(a, b - a)
        doc, no_id, row = (part.column(i).to_pylist() for i in range(3))
        texts = map(unpress.decompress, part.column(3).to_pylist())
        done: dict[str, list] = {k: [] for k in ("doc", "no_id", "row", "n_words", "digest")}
        kept: list[int] = []
        words, at, owner, start, bucket = [], [], [], [], []
        for i, data in enumerate(texts):
            own = data.split()
            flagged = part.column(5)[i].values
            least = window_minimisers(own)[0] if flagged is not None and len(own) >= WINDOW else np.empty(0, np.uint64)
            mine = np.flatnonzero(np.isin(codes_of(least), flagged.to_numpy())) if len(least) else least
            if not len(mine):
                for k, v in zip(done, (doc[i], no_id[i], row[i], len(own), _digest(own))):
                    done[k].append(v)
                continue
            kept.append(i)
            at.append(mine + len(words))
            owner.append(np.full(len(mine), i))
            start.append(mine)
            bucket.append(least.view(np.int64)[mine])
            words += own
        if done["doc"]:
            yield _rows(UNTOUCHED, **done)
        if not kept:
            continue
        chosen = pa.array(kept, pa.int32())
        yield _rows(TEXT, doc=part.column(0).take(chosen), no_id=part.column(1).take(chosen), row=part.column(2).take(chosen), text=part.column(3).take(chosen))
        at, owner, start, bucket = (np.concatenate(x) for x in (at, owner, start, bucket))
        docs = np.array(doc, np.int64)
        own_rows = np.array(row, np.int64)
        later, leader = repeated_windows(words, at, docs[owner], start)
        yield from _marks(owner, start, later, docs, own_rows)
        yield from _led(owner, start, later, leader, docs, own_rows)
        stands = leader == np.arange(len(leader))
        # Standing windows that follow each other with one minimiser travel together.
        owner, start, bucket, at = (x[stands] for x in (owner, start, bucket, at))
        opens = np.concatenate([[True], (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1) | (bucket[1:] != bucket[:-1])])
        head = np.flatnonzero(opens)
        size = np.diff(np.append(head, len(owner)))
        yield _rows(
            STRING,
            doc=docs[owner[head]],
            row=np.array(row, np.int64)[owner[head]],
            bucket=bucket[head],
            start=start[head],
            packed=(packed := [b" ".join(words[p : p + n + WINDOW - 1]) for p, n in zip(at[head].tolist(), size.tolist())]),
            stop=[len(x) for x in packed],  # its size, for the count of the buckets
        )


def _marks(owner: np.ndarray, start: np.ndarray, later: np.ndarray, doc: np.ndarray, row: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Marked windows as ranges of starts; ``owner`` and ``start`` are in order."""
    owner, start = owner[later], start[later]
    if len(owner):
        opens = np.concatenate([[True], (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)])
        head = np.flatnonzero(opens)
        size = np.diff(np.append(head, len(owner)))
        own = owner[head]
        yield _rows(MARK, doc=doc[own], row=row[own], first=start[head], stop=start[head] + size)


def _led(owner: np.ndarray, start: np.ndarray, later: np.ndarray, leader: np.ndarray, doc: np.ndarray, row: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Ranges of starts of the row ``led`` whose windows another ``row`` of its doc value stands for."""
    ahead = owner[leader]
    chosen = ~later & (row[ahead] != row[owner])
    owner, start, ahead = owner[chosen], start[chosen], ahead[chosen]
    if len(owner):
        opens = np.concatenate([[True], (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1) | (ahead[1:] != ahead[:-1])])
        head = np.flatnonzero(opens)
        size = np.diff(np.append(head, len(owner)))
        yield _rows(LED, doc=doc[owner[head]], row=row[ahead[head]], led=row[owner[head]], first=start[head], stop=start[head] + size)


def _singly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of super-k-mers, each for the bucket of its own hash, and marks of those that
    repeat within this slice."""
    for batch, a, b in slices(batches, 4, SLICE_BYTES // 8):  # windows take some eight times the bytes
        part = batch.slice(a, b - a)
        doc, row, begin = (part.column(i).to_numpy() for i in (1, 2, 3))
        words, at, owner, start, bucket = [], [], [], [], []
        for i, data in enumerate(part.column(4).to_pylist()):
            own = data.split()
            n = len(own) - WINDOW + 1
            at.append(np.arange(n) + len(words))
            owner.append(np.full(n, i))
            start.append(np.arange(n) + begin[i])
            bucket.append(window_hashes(word_hashes(own), WINDOW).view(np.int64))
            words += own
        at, owner, start, bucket = (np.concatenate(x) for x in (at, owner, start, bucket))
        later, _ = repeated_windows(words, at, doc[owner], start)
        yield from _marks(owner, start, later, doc, row)
        owner, start, bucket, at = (x[~later] for x in (owner, start, bucket, at))
        packed = [b" ".join(words[p : p + WINDOW]) for p in at.tolist()]
        yield _rows(STRING, doc=doc[owner], row=row[owner], bucket=bucket, start=start, packed=packed, stop=[len(x) for x in packed])


def bounded(strings: DataFrame, limit: int) -> DataFrame:
    """Super-k-mers (bucket, doc, row, start, packed, stop) so that no bucket holds more than
    ``limit`` bytes but for equal windows, and the marks found on the way."""
    sizes = strings.groupBy("bucket").agg(F.sum("stop").alias("size"))
    large = cut_lineage(sizes.filter(F.col("size") > limit).select("bucket"))
    columns = ["bucket", "doc", "row", "start", "packed"]
    if large.isEmpty():
        return strings
    singly = cut_lineage(strings.join(large, "bucket", "left_semi").select(*columns).transform(in_arrow, _singly, _PARTS))
    return strings.join(large, "bucket", "left_anti").select(*_ARROW).unionByName(singly)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks from (bucket, doc, row, start, packed) sorted by bucket; whole buckets at a time."""
    held: list[tuple] = []

    def done() -> Iterator[pa.RecordBatch]:
        words, at, owner, start = [], [], [], []
        for i, (_, _, _, begin, data) in enumerate(held):
            own = data.split()
            n = len(own) - WINDOW + 1
            at.append(np.arange(n) + len(words))
            owner.append(np.full(n, i))
            start.append(np.arange(n) + begin)
            words += own
        at, owner, start = (np.concatenate(x) for x in (at, owner, start))
        doc, row = (np.array([h[k] for h in held], np.int64) for k in (1, 2))
        later, _ = repeated_windows(words, at, doc[owner], start)
        yield from _marks(owner, start, later, doc, row)

    size, bucket = 0, None
    for batch in batches:
        for record in zip(*[batch.column(i).to_pylist() for i in range(5)]):
            if size > SLICE_BYTES and record[0] != bucket:
                yield from done()
                held, size = [], 0
            bucket = record[0]
            held.append(record)
            size += len(record[4])
    if held:
        yield from done()


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, no_id, n_words, n_removed, kept_sha256 and kept_text from texts and their marks."""
    unpress = zstandard.ZstdDecompressor()
    for batch in batches:
        n_words, n_removed, digest, kept_text = [], [], [], []
        for data, marks in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            words = unpress.decompress(data).split()
            gone = np.zeros(len(words) + 1, np.int64)
            for m in marks or ():
                gone[m["first"]] += 1
                gone[m["stop"] + WINDOW - 1] -= 1
            gone = np.cumsum(gone)[:-1] > 0
            kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
            n_words.append(len(words))
            n_removed.append(int(gone.sum()))
            digest.append(hashlib.sha256(kept).hexdigest())
            kept_text.append(kept.decode())
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        columns = [pa.array(c, t) for c, t in zip((n_words, n_removed, digest, kept_text), kinds)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *columns], ["doc", "no_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
        )


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row, and kept_text (the words left, joined
    by one space; null where none was removed)."""
    keyed = _keyed(docs, doc_id, text)
    flagged = repeated_minimisers(keyed)
    pressed = keyed.transform(in_arrow, _compressed, "doc long, no_id boolean, row long, text binary, size long")
    joined = pressed.join(flagged, "row", "left").select("doc", "no_id", "row", "text", "size", "codes")
    parts = cut_lineage(joined.transform(in_arrow, _split_up, _PARTS))
    travelling = bounded(parts.filter(F.col("kind") == STRING), BUCKET_BYTES)
    strings = travelling.filter(F.col("kind") == STRING).select("bucket", "doc", "row", "start", "packed")
    counted = strings.repartition("bucket").sortWithinPartitions("bucket").transform(in_arrow, _count, _PARTS)
    led = parts.filter(F.col("kind") == LED)
    met = travelling.filter(F.col("kind") == MARK).unionByName(counted).select("doc", "row", "first", "stop")
    if not led.isEmpty():
        met = cut_lineage(met)
        theirs = led.select("doc", "row", "led", F.col("first").alias("led_first"), F.col("stop").alias("led_stop"))
        inherited = met.join(theirs, ["doc", "row"]).select(
            "doc", F.col("led").alias("row"), F.greatest("first", "led_first").alias("first"), F.least("stop", "led_stop").alias("stop")
        )
        met = met.unionByName(inherited.filter("first < stop").distinct())
    marks = parts.filter(F.col("kind") == MARK).select("doc", "row", "first", "stop").unionByName(met)
    marks = marks.groupBy("doc", "row").agg(F.collect_list(F.struct("first", "stop")).alias("marks"))
    texts = parts.filter(F.col("kind") == TEXT).select("doc", "no_id", "row", "text")
    finished = (
        texts.join(marks, ["doc", "row"], "left")
        .select("doc", "no_id", "text", "marks")
        .transform(in_arrow, _finish, "doc long, no_id boolean, n_words long, n_removed long, kept_sha256 string, kept_text string")
    )
    untouched = parts.filter(F.col("kind") == UNTOUCHED).select(
        "doc", "no_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("digest").alias("kept_sha256"), F.lit(None).cast("string").alias("kept_text")
    )
    kind = docs.schema[doc_id].dataType
    return finished.unionByName(untouched).select(
        F.when(~F.col("no_id"), F.col("doc").cast(kind)).alias("doc_id"), "n_words", "n_removed", "kept_sha256", "kept_text"
    )
