"""Document quality by hierarchical empirical Bayes.

A logistic classifier of hashed words and a few text measures, fitted on a bounded sample of
labelled rows, gives each document's own evidence. The documents of a host and of a path below
it say what is usual there: sums per path, then per host, are shrunk towards the host and the
global prior with strengths estimated from all groups (method of moments), so sparse sites stay
near the prior and large ones speak for themselves. Site and document odds then multiply; a
document's own evidence is taken out of its site first.

Only sums per group, global sums and the labelled sample reach the driver.

Rows: a null text counts as empty; null hosts and paths are groups of their own; repeated rows
are scored each; without labels of both kinds every document scores the prior 0.5 and is
kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallystream.llm.decontaminate import item_words
from tallystream.llm.quality_rules import Measures
from tallystream.llm.words import SLICE_BYTES, as_bytes, in_arrow, slices, word_hashes
from tallystream.session import cut_lineage

SAMPLE = 8_000  # labelled rows a model is fitted on, at most
WORD_SLOTS = 65_536
TELLING = 4.5  # standard errors by which a word's share must differ between the labels
DENSE = 6
ROUNDS = 300
RATE, DECAY = 0.5, 1e-4
STRENGTH = (1.0, 1e6)  # bounds of a prior's strength, in documents


def features(data: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the words that occur, and the dense measures."""
    m = Measures(data)
    n = max(1, m.n_words)
    words = item_words(m.data)
    slots = np.unique(word_hashes(words) % np.uint64(WORD_SLOTS)).astype(np.int32)
    dense = (
        min(m.n_symbols / n, 3.0),
        m.n_dup_lines / max(1, len(m.lines)),
        m.n_repeat_words / n,
        np.log1p(m.n_words) / 5,
        min(m.word_chars / n, 20.0) / 5,
        float(m.n_words < 50),
    )
    return slots, np.array(dense)


class Classifier:
    """Weights of the words that tell the labels apart, and of dense measures."""

    def __init__(self) -> None:
        self.words = np.zeros(WORD_SLOTS)
        self.dense = np.zeros(DENSE)
        self.bias = 0.0

    def fit(self, slots: list[np.ndarray], dense: np.ndarray, target: np.ndarray) -> Classifier:
        """Logistic regression, full gradients with per-weight rates."""
        if not 0 < target.sum() < len(target):
            return self
        flat = np.concatenate(slots).astype(np.int64)
        row = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
        yes, no = target.sum(), len(target) - target.sum()
        with_yes, with_any = np.bincount(flat, target[row], WORD_SLOTS), np.bincount(flat, minlength=WORD_SLOTS)
        share = with_any / len(target)
        error = np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / yes + 1 / no))
        telling = np.abs(with_yes / yes - (with_any - with_yes) / no) > TELLING * error
        flat, row = flat[telling[flat]], row[telling[flat]]
        seen_w, seen_d, seen_b = np.full(WORD_SLOTS, 1e-8), np.full(DENSE, 1e-8), 1e-8
        for _ in range(ROUNDS):
            z = np.bincount(row, self.words[flat], len(slots)) + dense @ self.dense + self.bias
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
            g_w = np.bincount(flat, error[row], WORD_SLOTS) / len(slots) + DECAY * self.words
            g_d = error @ dense / len(slots) + DECAY * self.dense
            g_b = error.mean()
            seen_w, seen_d, seen_b = seen_w + g_w**2, seen_d + g_d**2, seen_b + g_b**2
            self.words -= RATE * g_w / np.sqrt(seen_w)
            self.dense -= RATE * g_d / np.sqrt(seen_d)
            self.bias -= RATE * g_b / np.sqrt(seen_b)
        return self

    def probability(self, slots: np.ndarray, dense: np.ndarray) -> float:
        z = self.words[slots].sum() + dense @ self.dense + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fitted(docs: DataFrame, labels: DataFrame, targets: dict[str, str], doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> dict[str, Classifier]:
    """One classifier a target, fitted on at most ``sample`` labelled rows chosen by a hash of the id."""
    chosen = labels.filter(F.col(doc_id).isNotNull()).orderBy(F.xxhash64(doc_id), doc_id).limit(sample)
    chosen = chosen.select(F.col(doc_id).alias("label_id"), *[F.col(c).cast("double").alias(f"label_{t}") for t, c in targets.items()])
    # As many small rows as the sample has.
    held = docs.select(doc_id, text).join(F.broadcast(chosen), F.col(doc_id) == F.col("label_id")).select(F.col(text).alias("text"), *[f"label_{t}" for t in targets])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(x) for x in as_bytes(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([s for s, _ in made], pa.list_(pa.int32())),
                    pa.array([d for _, d in made], pa.list_(pa.float64())),
                    *[batch.column(i) for i in range(1, batch.num_columns)],
                ],
                ["slots", "dense", *[f"label_{t}" for t in targets]],
            )

    schema = "slots array<int>, dense array<double>, " + ", ".join(f"label_{t} double" for t in targets)
    rows = sorted(held.transform(in_arrow, run, schema).collect(), key=str)  # any order of tasks, one model
    out = {}
    for t in targets:
        own = [r for r in rows if r[f"label_{t}"] is not None]
        slots = [np.array(r.slots, np.int32) for r in own]
        dense = np.array([r.dense for r in own]).reshape(-1, DENSE)
        out[t] = Classifier().fit(slots, dense, np.array([r[f"label_{t}"] for r in own]))
    return out


def evidence(docs: DataFrame, models: dict[str, Classifier], host: Column, path: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, host, path and a probability p_<target> a model."""
    names = [f"p_{t}" for t in models]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, a, b in slices(batches, 3, SLICE_BYTES):
            batch = whole.slice(a, b - a)
            out: list[list[float]] = [[] for _ in models]
            for data in as_bytes(batch.column(3)):
                made = features(data)
                for own, model in zip(out, models.values()):
                    own.append(model.probability(*made))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(3)], *[pa.array(x, pa.float64()) for x in out]], ["doc_id", "host", "path", *names]
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(host.cast("string"), F.lit("")).alias("host"),
        F.coalesce(path.cast("string"), F.lit("")).alias("path"),
        F.col(text).alias("text"),
    )
    return rows.transform(in_arrow, run, f"doc_id {kind}, host string, path string, " + ", ".join(f"{n} double" for n in names))


def _strength(groups: DataFrame, total: Column, prior: Column) -> float:
    """How many documents a prior is worth, from how far group means (total / n) lie from it.

    Spread beyond what chance gives groups of their sizes is real; p (1 - p) / real - 1 is the
    strength of the beta prior with that spread.
    """
    mean, n = total / F.col("n"), F.col("n")
    r = groups.agg(
        F.sum(n * (mean - prior) ** 2).alias("spread"),
        F.sum(prior * (1 - prior)).alias("chance"),
        F.sum(n * prior * (1 - prior)).alias("variance"),
        F.sum(n).alias("n"),
    ).head()
    if not r.n:
        return STRENGTH[1]
    real = (r.spread - r.chance) / r.n
    if real <= 0:
        return STRENGTH[1]
    return min(max(r.variance / r.n / real - 1, STRENGTH[0]), STRENGTH[1])


def _odds(p: Column) -> Column:
    held = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(held / (1 - held))


def combined(scored: DataFrame, targets: list[str]) -> DataFrame:
    """doc_id, host, path and for every target t: p_t (own evidence), host_t and path_t
    (posteriors), score_t (both together)."""
    paths = cut_lineage(
        scored.groupBy("host", "path").agg(*[F.sum(f"p_{t}").alias(f"sum_{t}") for t in targets], F.count(F.lit(1)).alias("n"))
    )
    hosts = paths.groupBy("host").agg(*[F.sum(f"sum_{t}").alias(f"host_sum_{t}") for t in targets], F.sum("n").alias("n"))
    overall = hosts.agg(*[F.sum(f"host_sum_{t}").alias(t) for t in targets], F.sum("n").alias("n")).head()
    prior = {t: overall[t] / overall.n if overall.n else 0.5 for t in targets}
    for t in targets:
        strength = _strength(hosts, F.col(f"host_sum_{t}"), F.lit(prior[t]))
        hosts = hosts.withColumn(f"host_{t}", (F.col(f"host_sum_{t}") + strength * prior[t]) / (F.col("n") + strength))
    hosts = cut_lineage(hosts.select("host", *[f"host_{t}" for t in targets]))
    paths = paths.join(hosts, "host")
    strengths = {t: _strength(paths, F.col(f"sum_{t}"), F.col(f"host_{t}")) for t in targets}
    out = scored.join(paths, ["host", "path"])
    for t in targets:
        above, k = F.col(f"host_{t}"), strengths[t]
        site = (F.col(f"sum_{t}") - F.col(f"p_{t}") + k * above) / (F.col("n") - 1 + k)
        odds = _odds(F.col(f"p_{t}")) + _odds(site) - _odds(F.lit(prior[t]))
        out = out.withColumn(f"path_{t}", (F.col(f"sum_{t}") + k * above) / (F.col("n") + k)).withColumn(f"score_{t}", 1 / (1 + F.exp(-odds)))
    return out.select("doc_id", "host", "path", *[f"{x}_{t}" for t in targets for x in ("p", "host", "path", "score")])


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, host, path, evidence, posteriors and score of quality and toxicity, and kept:
    quality of 0.5 or more and toxicity below 0.5."""
    models = fitted(docs, labels, {"quality": "quality", "toxic": "toxic"}, doc_id, text)
    scored = cut_lineage(evidence(docs, models, host, path, doc_id, text))
    fits = any(m.words.any() or m.dense.any() for m in models.values())
    kept = (F.col("score_quality") >= 0.5) & (F.col("score_toxic") < 0.5) if fits else F.lit(True)
    return combined(scored, list(models)).withColumn("kept", kept)


def url_levels(url: Column) -> tuple[Column, Column]:
    """Host and first path segment of a URL, as levels for ``classify``."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return host, F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^/?#]*)", 1)
