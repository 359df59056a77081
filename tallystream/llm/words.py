"""Words, windows and their hashes inside a task, on UTF-8 bytes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

SLICE_BYTES = 2_000_000
BATCH_BYTES = 4_000_000
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xD6E8FEB86659FD93)
_S = np.uint64(32)


# What a worker keeps from one task to the next of the same kind.
KEPT: dict[str, object] = {}


def give_back() -> None:
    """Return freed memory to the system; an idle worker would hold it through later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def in_arrow(
    df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, keeps: bool = False
) -> DataFrame:
    """``mapInArrow`` on batches of about ``BATCH_BYTES``, whatever the length of the texts.

    Rows differ in size by orders of magnitude, so a bound in rows bounds no memory. A session
    that sets the size itself keeps it; batches never change a result. A task ends by giving
    its memory back, and drops what other tasks have ``KEPT`` unless it ``keeps`` it too.
    """

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            KEPT.clear()
        yield from task(batches)
        give_back()

    conf = df.sparkSession.conf
    if conf.get(_BATCH_SETTING) == _BATCH_DEFAULT:
        conf.set(_BATCH_SETTING, f"{BATCH_BYTES}b")
    return df.mapInArrow(tidy, schema)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 of a string column, None for null."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def slices(batches, sized: int, limit: int):
    """(batch, start, stop) over Arrow batches so that each slice has about ``limit`` bytes of
    column ``sized`` (texts, or a column of numbers that says their sizes)."""
    for batch in batches:
        column = batch.column(sized)
        sizes = pc.fill_null(column if pa.types.is_integer(column.type) else pc.binary_length(column), 0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch, start, i
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch, start, len(sizes)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _S)) * _B
    return h ^ (h >> _S)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash per window of ``size`` words; none if there are fewer words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = hashes[:n].copy()
    for i in range(1, size):
        acc *= _A
        acc += hashes[i : i + n]
    return mix(acc)


def word_numbers(words: list[bytes]) -> tuple[np.ndarray, int]:
    """Each word's number (equal words, equal numbers) and how many there are."""
    known = dict.fromkeys(words)
    known = dict(zip(known, range(len(known))))
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words)), len(known)
