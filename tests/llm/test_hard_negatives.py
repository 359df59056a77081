"""Hard negatives against brute force, with odd rows and several blocks."""

import math
from collections import Counter

import numpy as np
import pytest

from tallystream.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, row string, means string"


def brute(rows):
    """The rules, row by row."""
    kept = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        if sum(x * x for x in q) >= 1 << 56:
            continue
        kept.append((i, q, (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for i, a, mine in kept:
        if i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(a, b)), j, label) for j, b, label in kept if j != i and len(b) == len(a)]
        best = sorted((s, j) for s, j, label in scored if label == mine)[:5]
        for s, j in best:
            fits = sorted((n, k) for n, k, label in scored if label != mine and 80 * -s <= 100 * -n <= 100 * -s)[:5]
            out += [(i, j, rank, k, -s, -n) for rank, (n, k) in enumerate(fits, 1)]
    return Counter(out)


def found(spark, rows):
    floats = lambda v: None if v is None else [None if x is None else float(x) for x in v]
    df = spark.createDataFrame([(i, floats(v), label, "x", "y") for i, v, label in rows], SCHEMA)
    got = hn.mine(df)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r) for r in got.collect())


def vectors(seed, n, dim, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dim))
    return [(50 * i, [float(x) for x in centres[i % 4] + spread * rng.normal(size=dim)], int(rng.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("dim,spread", [(64, 0.3), (5, 0.1), (1, 2.0)])
def test_against_brute_force(spark, monkeypatch, dim, spread):
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", 7)
    monkeypatch.setattr(hn, "CELL_ROWS", 40)
    rows = vectors(dim, 150, dim, spread)
    want = brute(rows)
    assert len(want) > 20 and found(spark, rows) == want


def test_odd_rows(spark):
    rows = vectors(3, 40, 6, 0.2)
    rows += [(None, rows[0][1], 1), (7001, None, 1), (7002, [], 1), (7100, [], 1), (7103, [], 2), (7003, rows[0][1], None)]
    rows += [(7004, [1.0, None, 0, 0, 0, 0], 1), (7005, [1.0, math.nan, 0, 0, 0, 0], 1), (7006, [math.inf, 0, 0, 0, 0, 0], 1)]
    rows += [(7200, [1e300] * 6, 1), (7300, [9e4, -9e4, 0, 0, 3e4, 1.0], 1), (7301, [9e4, -9e4, 0, 0, 3e4, 1.0], 1), (7302, [9e4, -9e4, 0, 0, 2.9e4, 1.0], 2)]
    rows += [(8000 + i, rows[2][1], 2) for i in range(9)]  # ties
    rows += [(9000, rows[1][1], 1), (9000, rows[1][1], 1), (9000, rows[4][1], 2)]  # a repeated id
    rows += [(9100, [0.0] * 6, 1), (9101, [0.0] * 6, 2), (9200, [1.0, 2.0], 3)]  # scores of 0, and a vector alone
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == Counter()


def test_bounds_hold_and_thin_out(spark):
    """No pair above the wanted score is lost, and segments with unlike means need no exact score."""
    rng = np.random.default_rng(5)
    x = np.floor(256 * rng.normal(size=(60, 32)) + np.repeat(rng.integers(-3, 4, (60, 4)) * 200, 8, axis=1))
    mean, deviation = hn._summaries(x)
    ids = np.arange(60)
    rows = hn.Rows(ids, ids, ids, 32, x.astype(np.int64), mean, deviation)
    exact = x @ x.T
    wide = []
    for segments in hn.SEGMENTS:
        m, d = hn._coarser(mean, deviation, 32, segments)
        slack = 1e-5 * rows.length[:, None] * rows.length[None, :] + 1
        assert (m @ m.T + d @ d.T + slack >= exact).all() and (m @ m.T - d @ d.T - slack <= exact).all()
        wide.append(float((d @ d.T).mean()))
    assert wide == sorted(wide, reverse=True)
    least = np.sort(exact, axis=1)[:, -3]
    i, j, score = hn.scores(rows, rows, least, np.full(60, np.inf), np.ones((60, 60), bool))
    assert len(i) >= 180 and (score == exact[i, j]).all() and len(i) == (exact >= least[:, None]).sum()
