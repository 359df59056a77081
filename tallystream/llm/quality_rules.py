"""Quality rules as a short-circuit cascade.

A bounded sample tells each rule's cost (seconds a document, measures it needs included) and
selectivity (share of documents it rejects). Rules then run in the order of rejection per
cost, and a rejected document is spared the rules that follow. The order never changes the
verdict, as a document is kept only if no rule rejects it.

Rows: a null text counts as an empty one and fails the rule on few words; repeated rows are
judged one by one; other columns, whatever their names, pass through; an empty table gives an
empty result in the rules' given order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallystream.llm.words import SLICE_BYTES, as_bytes, in_arrow, slices, word_numbers

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
SAMPLE_SHARE = 0.05
SAMPLE_ROWS = 1_000


class Measures:
    """What the rules look at; each measure is made when first asked for."""

    def __init__(self, data: bytes | None) -> None:
        self.data = data or b""

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.data.translate(None, SPACES).decode())

    @cached_property
    def n_symbols(self) -> int:
        return len(self.data) - len(self.data.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.data.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        n = self.n_words
        if n < 4:
            return 0
        ids, kinds = word_numbers(self.words)
        pair = ids[:-1] * kinds + ids[1:]
        if kinds >= 1 << 20:  # three numbers no longer fit into 63 bits
            pair = np.unique(pair, return_inverse=True)[1]
        window = pair[:-1] * kinds + ids[2:]
        ordered = np.sort(window)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            return 0
        at = np.isin(window, twice)
        covered = np.zeros(n, bool)
        for i in range(3):
            covered[i : n - 2 + i] |= at
        return int(covered.sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], bool]
    base: bool = False


RULES = (
    Rule("few_words", lambda m: m.n_words < 50, True),
    Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > 50 * m.n_words, True),
    Rule("symbols", lambda m: 10 * m.n_symbols > 3 * m.n_words),
    Rule("repeated_lines", lambda m: 2 * m.n_dup_lines > len(m.lines)),
    Rule("word_length", lambda m: not 2 * m.n_words <= m.word_chars <= 20 * m.n_words),
)


def sampled_order(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejection per cost, both measured on about ``rows`` documents.

    The sample is drawn by Spark and taken from as few partitions as hold it, so its cost
    does not grow with the table; every rule judges every sampled document on fresh measures.
    """
    rules = list(rules)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data in as_bytes(batch.column(0)):
                for i, rule in enumerate(rules):
                    began = time.perf_counter()
                    rejected = rule.rejects(Measures(data))
                    out.append((i, time.perf_counter() - began, rejected))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int32(), pa.float64(), pa.bool_()))],
                ["rule", "cost", "rejected"],
            )

    sample = docs.select(F.col(text).alias("text")).sample(SAMPLE_SHARE, seed=7)
    seen = sample.transform(in_arrow, measure, "rule int, cost double, rejected boolean").take(rows * len(rules))
    cost, lost = [1e-9] * len(rules), [0] * len(rules)
    for row in seen:
        cost[row.rule] += row.cost
        lost[row.rule] += row.rejected
    return sorted(rules, key=lambda r: -lost[rules.index(r)] / cost[rules.index(r)])


def first_rejecting(measures: Measures, ordered: Sequence[Rule]) -> str | None:
    return next((rule.name for rule in ordered if rule.rejects(measures)), None)


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows no rule rejects, with all their columns."""
    ordered, at = sampled_order(docs, rules, text), docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, a, b in slices(batches, at, SLICE_BYTES):
            batch = whole.slice(a, b - a)
            good = [first_rejecting(Measures(x), ordered) is None for x in as_bytes(batch.column(at))]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.transform(in_arrow, keep, docs.schema)


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, all measures, base_failed, kept and rejected_by (the first rule of the cascade
    that rejects) for every row."""
    ordered = sampled_order(docs, rules, text)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, a, b in slices(batches, 1, SLICE_BYTES):
            batch = whole.slice(a, b - a)
            columns: dict[str, list] = {k: [] for k in (*names, "base_failed", "kept", "rejected_by")}
            for data in as_bytes(batch.column(1)):
                m = Measures(data)
                why = first_rejecting(m, ordered)
                for k in names:
                    columns[k].append(getattr(m, k))
                columns["base_failed"].append(any(r.base and r.rejects(m) for r in ordered))
                columns["kept"].append(why is None)
                columns["rejected_by"].append(why)
            kinds = [pa.int64()] * len(names) + [pa.bool_(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(v, kind) for v, kind in zip(columns.values(), kinds)]], ["doc_id", *columns]
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).transform(
        in_arrow, run, f"doc_id {kind}, " + ", ".join(f"{k} long" for k in names) + ", base_failed boolean, kept boolean, rejected_by string"
    )
