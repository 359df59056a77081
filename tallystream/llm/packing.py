"""Packing of documents into sequences: shortest pack first over the length histogram.

Documents become pieces of at most ``limit`` tokens (full ones and a rest). The histogram of
piece lengths, at most ``limit`` rows, is packed on the driver: longest length first, each
into the packs with the most room, many packs at a time as a pattern with a count. Patterns
then meet the pieces by length and rank, in Spark.

Rows: a null or empty text is the end token alone; repeated rows are packed each, and a null
id stays null; ties in length are ranked by table part, id and start; an empty table gives no
sequence. Other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallystream.llm.ranks import ranked, stored_with_parts
from tallystream.llm.tokens import VOCABULARY, encoder
from tallystream.llm.words import in_arrow, slices

LIMIT = 2048
END = 1
SLICE_BYTES = 1_000_000


def token_pieces(
    docs: DataFrame, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, with_ids: bool = False
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ids): every document cut after each ``limit`` tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch, begin, stop in slices(batches, 1, SLICE_BYTES):
            ids, counts = encode(batch.column(1).slice(begin, stop - begin))
            ids = np.insert(ids, np.cumsum(counts), END).astype("<u4")
            doc, start, length, crc, total, own = [], [], [], [], [], []
            at = 0
            for i, n in enumerate((counts + 1).tolist()):
                for cut in range(0, n, limit):
                    piece = ids[at + cut : at + min(cut + limit, n)]
                    doc.append(begin + i)
                    start.append(cut)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(n)
                    if with_ids:
                        own.append(piece)
                at += n
            columns = [batch.column(0).take(pa.array(doc, pa.int32())), *[pa.array(x, pa.int64()) for x in (start, length, crc, total)]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(own, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).transform(
        in_arrow,
        run,
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids,
        keeps=True,
    )


def shortest_pack_first(histogram: dict[int, int], limit: int = LIMIT) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, longest first) and how many sequences follow each.

    Every length splits at most one group of packs and opens at most one
    new one, so there are at most two patterns a length, whatever the number of documents.
    """
    room: list[tuple[int, int, tuple[int, ...], int]] = []  # (minus the room left, age, pattern, count)
    done: list[tuple[tuple[int, ...], int]] = []
    made = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if room and -room[0][0] >= length:
                free, order, pattern, count = heapq.heappop(room)
                taken = min(left, count)
                if taken < count:
                    heapq.heappush(room, (free, order, pattern, count - taken))
                made += 1
                entry = (free + length, made, (*pattern, length), taken)
            else:
                taken = left
                made += 1
                entry = (length - limit, made, (length,), taken)
            left -= taken
            if entry[0] == 0:
                done.append(entry[2:])
            else:
                heapq.heappush(room, entry)
    return done + [(pattern, count) for _, _, pattern, count in sorted(room)]


def segments(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, sequences, first sequence, offset, copies): which sequences take which ranks of a length.

    A pattern holds at most 63 different lengths (1 + 2 + ... + 63 = 2,016), so there are at
    most 64 rows a pattern: some 10 MB at the default limit, whatever the input.
    """
    rank: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, count in patterns:
        offset = 0
        for length, same in groupby(pattern):
            copies = len(list(same))
            out.append((length, rank.get(length, 0), count, sequence, offset, copies))
            rank[length] = rank.get(length, 0) + count * copies
            offset += length * copies
        sequence += count
    return out


def pack(docs: DataFrame, limit: int = LIMIT, **reading) -> DataFrame:
    """The pieces of ``token_pieces`` with sequence_id and offset."""
    pieces = stored_with_parts(token_pieces(docs, limit, **reading))
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = segments(shortest_pack_first(histogram, limit))
    table = docs.sparkSession.createDataFrame(
        rows, "seg_length long, first_rank long, sequences long, first_sequence long, first_offset long, copies long"
    )
    at = F.col("rank") - F.col("first_rank")
    placed = ranked(pieces, ["length"], ["doc_id", "start", "doc_tokens", "ids_crc32"]).join(
        F.broadcast(table),  # bounded by the limit, see segments()
        (F.col("length") == F.col("seg_length")) & (at >= 0) & (at < F.col("sequences") * F.col("copies")),
    )
    names = [c for c in pieces.columns if c != "part"]
    return placed.select(
        *names,
        (F.col("first_sequence") + at % F.col("sequences")).alias("sequence_id"),
        (F.col("first_offset") + F.floor(at / F.col("sequences")) * F.col("length")).alias("offset"),
    )
