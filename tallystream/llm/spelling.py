"""Spelling variants of a vocabulary, by reduced-alphabet generation.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. A
word's form is its near word of largest count (ties: the smallest), if that count is at least
ten times the word's own; following forms leads to the word's root.

1. Letters are hashed to ``SYMBOLS`` symbols, which turns a word into a reduced word. Its full
   one-edit neighbourhood over these few symbols is small: every reduced word one insertion,
   deletion or replacement away, and the reduced word itself.
2. The neighbourhoods are joined with the reduced vocabulary. Words are cut into ``PARTS``
   parts; an edit leaves all parts but one as they were, so a key also holds these in their
   original letters. That splits the crowds which few symbols make: words that share a reduced
   word only never meet. Keys are 64-bit hashes; each pair of words counts under one key only.
3. What meets is verified on the original strings, in time linear in their length.
4. Forms are followed in rounds that double the way: counts grow tenfold from word to form, so
   a handful of rounds is enough.

Words of documents: maximal runs ``[A-Za-z\\u00C0-\\u00FF]+``, A-Z lower-cased, with the planted
misspellings of ``misspelt``; ``vocabulary`` keeps those of ``MIN_LENGTH`` code points and
``MIN_COUNT`` occurrences.

Rows: null texts have no words; a null id counts as an empty one; repeated rows count each time;
an empty table gives an empty vocabulary and no rows; other columns are not read. Long runs of
letters are words like any other. Words of a vocabulary are distinct and not null.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallystream.llm.words import SLICE_BYTES, as_bytes, in_arrow, mix, slices
from tallystream.session import cut_lineage

MIN_LENGTH = 7
MIN_COUNT = 2
FORM_RATIO = 10
DELETED = 31  # one word in so many has a letter deleted
SYMBOLS = 2
PARTS = 4  # at most 4: the part is kept in two bits of a key
LONG = 64
HELD_WORDS = 200_000
MATRIX = 1 << 20

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_B = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse
_B_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_HALF = np.uint64(0xD6E8FEB86659FD93)
_SYMBOL = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def misspelt(doc_id: object, run: str) -> str:
    """``run`` (lower-cased) as the document has it, or with one letter deleted."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % DELETED:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: the words of all documents with their number of occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch, a, b in slices(batches, 1, SLICE_BYTES):
            part = batch.slice(a, b - a)
            for i, data in zip(part.column(0).to_pylist(), as_bytes(part.column(1))):
                if not data:
                    continue
                for word, n in Counter(_RUN.findall(data.lower().decode())).items():
                    if len(word) >= MIN_LENGTH:
                        word = misspelt(i, word)
                        if len(word) >= MIN_LENGTH:
                            held[word] += n
            if len(held) >= HELD_WORDS:
                yield flush()
        if held:
            yield flush()

    found = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).transform(in_arrow, run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def _powers(n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, _B, np.uint64))])


def _sums(values: np.ndarray) -> np.ndarray:
    """Sums of the first 0, 1, ... columns."""
    return np.concatenate([np.zeros((len(values), 1), np.uint64), np.cumsum(values, axis=1, dtype=np.uint64)], axis=1)


def _parts(length: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The part that position ``at`` lies in, how many letters are before it and how many behind it."""
    bounds = np.array([length * p // PARTS for p in range(PARTS + 1)])
    part = np.clip(np.searchsorted(bounds, at, side="right") - 1, 0, PARTS - 1)
    return part, bounds[part], length - bounds[part + 1]


class Reduced:
    """Reduced words of one length with the hashes that their neighbourhoods are built from.

    A reduced word is the sum of its symbols times powers of an odd number, modulo 2^64, so an
    edit changes the sum by what is before, at and behind it.
    """

    def __init__(self, letters: np.ndarray) -> None:
        self.n = letters.shape[1]
        code = mix(letters.astype(np.uint64) * _HALF + np.uint64(1))
        self.power = _powers(self.n + 1)
        self.symbol = _SYMBOL[(code % np.uint64(SYMBOLS)).astype(np.int64)]
        self.before = _sums(self.symbol * self.power[: self.n])
        self.whole = self.before[:, -1:]
        exact = code * self.power[: self.n]
        self.first = _sums(exact)
        self.last = _sums(code[:, ::-1] * self.power[: self.n])

    def _keys(self, reduced: np.ndarray, length: int, at: np.ndarray) -> np.ndarray:
        """Keys of neighbours of ``length`` made by an edit at ``at``: all parts but the edited one are exact."""
        part, first, last = _parts(length, at)
        exact = self.first[:, first] + mix(self.last[:, last])
        salt = mix(np.uint64(length) + part.astype(np.uint64) * _HALF)
        # the lowest bits say which part is reduced
        return (mix(mix(reduced + salt) + exact) << np.uint64(2)) | part.astype(np.uint64)

    def own(self) -> np.ndarray:
        """The keys of the word itself, with each part reduced."""
        at = np.array([self.n * p // PARTS for p in range(PARTS)])
        return self._keys(np.repeat(self.whole, PARTS, axis=1), self.n, at)

    def neighbourhood(self) -> np.ndarray:
        """Keys of the word itself and of everything one edit away."""
        n, at = self.n, np.arange(self.n)
        behind = self.whole - self.before
        out = [self.own(), self._keys(self.before[:, :-1] + behind[:, 1:] * _B_INVERSE, n - 1, at)]
        gaps = np.arange(n + 1)
        for s in _SYMBOL:
            changed = self.whole + (s - self.symbol) * self.power[:n]
            out.append(self._keys(changed, n, at))
            grown = self.before + s * self.power[: n + 1] + behind * _B
            out.append(self._keys(grown, n + 1, gaps))
        return np.sort(np.concatenate(out, axis=1), axis=1)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, Reduced]]:
    """Places of words of one length with their reduced words, in pieces of bounded size."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == n)
        step = max(1, MATRIX // ((2 * SYMBOLS + 2) * n))
        for a in range(0, len(places), step):
            some = places[a : a + step]
            text = "".join([words[i] for i in some]).encode("utf-32-le")
            yield some, Reduced(np.frombuffer(text, np.uint32).reshape(len(some), n))


def _keyed(words: DataFrame, whole: bool) -> DataFrame:
    """key, id and the row of the word: under its own keys, or under its whole neighbourhood. Words longer
    than ``LONG`` are named by their id only, so that a word's rows grow as its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, reduced in _by_length(batch.column(0).to_pylist()):
                keys = reduced.neighbourhood() if whole else np.sort(reduced.own(), axis=1)
                new = np.ones(keys.shape, bool)
                new[:, 1:] = keys[:, 1:] != keys[:, :-1]
                where = pa.array(np.repeat(places, new.sum(axis=1)))
                columns = [c.take(where) for c in batch.columns[1:]]
                word = batch.column(0).take(where) if reduced.n <= LONG else pa.nulls(len(where), batch.column(0).type)
                yield pa.RecordBatch.from_arrays([pa.array(keys[new].view(np.int64)), word, *columns], ["key", *batch.schema.names])

    word = words.columns[0]
    named = words.select(word, F.when(F.length(word) > LONG, F.xxhash64(word)).alias(f"{word}_id"), *words.columns[1:])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema.fields)
    return named.transform(in_arrow, run, f"key long, {kinds}")


def near_pairs(words: DataFrame) -> DataFrame:
    """word, near, near_n: every ordered pair of near words of ``words`` (word, n), once."""
    mine = _keyed(words.select("word"), True)
    theirs = _keyed(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), False)
    met = mine.join(theirs, "key")
    long = words.select("word").filter(F.length("word") > LONG)
    pairs = met.filter("word is not null and near is not null").select("key", "word", "near", "near_n")
    if not long.isEmpty():
        spelt = lambda c: long.select(F.xxhash64("word").alias(f"{c}_id"), F.col("word").alias(f"{c}_long"))
        rest = met.filter("word is null or near is null").join(spelt("word"), "word_id", "left").join(spelt("near"), "near_id", "left")
        pairs = pairs.unionByName(rest.select("key", F.coalesce("word", "word_long").alias("word"), F.coalesce("near", "near_long").alias("near"), "near_n"))
    # a pair counts under the part in which the words first differ
    part = F.lit(0)
    for p in range(1, PARTS):
        ahead = F.floor(F.length("near") * p / PARTS).cast("int")
        same = F.substring(F.col("word"), F.lit(1), ahead) == F.substring(F.col("near"), F.lit(1), ahead)
        part = F.when(same, p).otherwise(part)
    once = part == F.col("key").bitwiseAND(3)
    return pairs.filter(once & (F.levenshtein("word", "near", 1) == 1)).select("word", "near", "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of the way from word to form to form."""
    at = cut_lineage(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")))
    while not at.filter("open").isEmpty():
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        at = cut_lineage(
            at.join(onward, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("open"))
        )
    return at.select("word", "root")


def variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``words`` (word, n)."""
    words = cut_lineage(words)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    around = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    found = F.when(-F.col("best.less") >= FORM_RATIO * F.col("n"), F.col("best"))
    judged = cut_lineage(
        words.join(around, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), found["near"].alias("form"), (-found["less"]).alias("form_n")
        )
    )
    roots = _roots(judged.filter("form is not null"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
