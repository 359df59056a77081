"""Token counts from an exact histogram of encoded lengths.

Documents are reduced to their length in tokens and counted by length before anything is
shuffled. Suffix sums over the histogram answer, for every context limit: how many documents
reach it, how many tokens they hold, and what is left if each document is cut there.

Rows: a null or empty text has length 0 and is counted; repeated rows count each; ties share
a row; an empty table gives an empty histogram. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tallystream.llm.tokens import VOCABULARY, encoder
from tallystream.llm.words import in_arrow, slices
from tallystream.session import cut_lineage

SLICE_BYTES = 1_000_000
BLOCK = 4_096


def with_token_counts(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """One row (n_tokens) a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch, start, stop in slices(batches, 0, SLICE_BYTES):
            counts = encode(batch.column(0).slice(start, stop - start))[1]
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], ["n_tokens"])

    return docs.select(F.col(text).alias("text")).transform(in_arrow, run, "n_tokens long", keeps=True)


def length_histogram(counts: DataFrame) -> DataFrame:
    """n_tokens, n_docs from one row a document."""
    return counts.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """Adds, for the limit n_tokens: docs_at_least, tokens_at_least, tokens_truncated (every
    document cut at the limit), docs_total, tokens_total.

    Sums run within blocks of 4,096 lengths; only one row a block goes through the one task
    that carries the sums of the later blocks over.
    """
    rows = cut_lineage(histogram.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)))  # read twice, tokenized once
    sums = rows.groupBy("block").agg(
        F.sum("n_docs").alias("block_docs"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("block_tokens")
    )
    later = W.orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    every = W.orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    carried = sums.select(
        F.col("block").alias("at_block"),
        F.coalesce(F.sum("block_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("block_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("block_docs").over(every).alias("docs_total"),
        F.sum("block_tokens").over(every).alias("tokens_total"),
    )
    inside = W.partitionBy("block").orderBy(F.desc("n_tokens"))
    summed = rows.withColumn("docs_in", F.sum("n_docs").over(inside)).withColumn(
        "tokens_in", F.sum(F.col("n_docs") * F.col("n_tokens")).over(inside)
    )
    at_least, tokens = F.col("docs_in") + F.col("later_docs"), F.col("tokens_in") + F.col("later_tokens")
    return summed.join(carried, F.col("block") == F.col("at_block")).select(
        "n_tokens",
        "n_docs",
        at_least.alias("docs_at_least"),
        tokens.alias("tokens_at_least"),
        (F.col("tokens_total") - tokens + at_least * F.col("n_tokens")).alias("tokens_truncated"),
        "docs_total",
        "tokens_total",
    )


def truncated_totals(sums: DataFrame, limits: Sequence[int]) -> list[tuple[int, int]]:
    """(limit, tokens left if every document is cut there) for any limits, known lengths or not.

    At a limit between two lengths the answer lies on the line through the next longer one.
    """
    out = []
    for limit in limits:
        row = sums.filter(F.col("n_tokens") >= limit).orderBy("n_tokens").head()
        if row is None:
            row = sums.select("tokens_total").head()
            out.append((limit, row.tokens_total if row else 0))
        else:
            out.append((limit, row.tokens_truncated - row.docs_at_least * (row.n_tokens - limit)))
    return out


def quantiles(sums: DataFrame, shares: Sequence[float]) -> list[tuple[float, int | None]]:
    """(share, smallest length that at least this share of the documents does not exceed)."""
    out = []
    for share in shares:
        reached = F.col("docs_total") - F.col("docs_at_least") + F.col("n_docs")
        row = sums.filter(reached >= F.ceil(F.lit(share) * F.col("docs_total"))).orderBy("n_tokens").head()
        out.append((share, row.n_tokens if row else None))
    return out
