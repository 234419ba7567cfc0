import math

import numpy as np
import pytest

from pyspark.sql import functions as F
from tickloom.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, every=50, positives=5, negatives=3):
    whole = {}
    for i, label, v in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            own = (label, [math.floor(256 * x) for x in v])
            whole[i] = min(whole.get(i, own), own)
    out = []
    for a, (label, v) in whole.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other == label) for i, (other, w) in whole.items() if i != a)
        for s, p, _ in [x for x in scored if x[2]][:positives]:
            fit = [x for x in scored if not x[2] and -50 * s <= -100 * x[0] <= -95 * s][:negatives]
            out += [(a, p, rank, n, -s, -t) for rank, (t, n, _) in enumerate(fit, 1)]
    return sorted(out)


def mined(df, **more):
    return sorted(tuple(r) for r in hn.mine(hn.integer_rows(df), F.col("vec_id") % 50 == 0, **more).collect())


def vectors(n, size, seed, labels=10, clusters=20):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, size))
    rows = []
    for i in range(n):
        v = centres[rng.integers(clusters)] + 0.6 * rng.normal(size=size)
        rows.append((i, int(rng.integers(labels)), (v / np.linalg.norm(v)).tolist()))
    return rows


@pytest.mark.parametrize("size", [1, 7, 64, 300])
def test_intervals_hold_the_score(size):
    """Whatever the vectors: random, sparse, equal, zero, or turned against the anchor."""
    rng = np.random.default_rng(size)
    v = np.floor(256 * rng.normal(size=(400, size))).astype(np.int64)
    v[:50] *= rng.random((50, size)) < 0.1
    v[50:60], v[60:70], v[70:80] = v[0], 0, 10_000 * v[70:80]
    v[80:120] = -v[:40]
    coder = hn.Coder(size)
    codes, times, rest, square = coder.measured(v.astype(float))
    rows = hn.Coded(np.arange(400), np.zeros(400, int), v, codes, times, rest, square)
    block = hn.Anchors(coder, np.arange(120), np.zeros(120, int), v[:120])
    least, most = block.intervals(slice(0, 120), rows)
    exact = v[:120] @ v.T
    assert (least <= exact).all() and (exact <= most).all()
    if size == 64:
        inner = slice(90, None)
        assert np.median((most - least)[inner, inner]) < np.median(np.linalg.norm(v[inner], axis=1)) ** 2


def test_filter_leaves_few_pairs():
    """Intervals leave well under all pairs of a clustered table to be scored."""
    data = vectors(2000, 64, 3)
    v = np.floor(256 * np.array([r[2] for r in data])).astype(np.int64)
    labels, ids = np.array([r[1] for r in data]), np.arange(2000)
    coder = hn.Coder(64)
    rows = hn.Coded(ids, labels, v, *coder.measured(v.astype(float)))
    block = hn.Anchors(coder, ids[::50], labels[::50], v[::50])
    best = hn.Best(40, 5)
    scored = hn.search(block, rows, best, np.full((40, 1), -(1 << 62)), np.full((40, 1), 1 << 62), True)
    assert len(best.ids) == 200 and scored < 0.25 * 40 * (labels[::50, None] == labels).sum() / 40


def test_blocks_and_batches(spark, monkeypatch):
    for name, value in (("BLOCK", 4), ("ROWS", 37), ("ANCHORS", 3)):
        monkeypatch.setattr(hn, name, value)
    rows = vectors(900, 16, 1, labels=4)
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_ties_and_repeats(spark):
    """Whole numbers tie often; one vector in a third of the rows; one label in most; each row twice."""
    rng = np.random.default_rng(2)
    rows = [(i, int(rng.choice([1, 1, 1, 2, 3])), ([1.0, 0.5, -1.0, 2.0] if i % 3 else rng.integers(-2, 3, 4).astype(float).tolist())) for i in range(400)]
    df = spark.createDataFrame(rows + rows[::2], SCHEMA)
    assert mined(df) == brute(rows + rows[::2])
    assert mined(spark.createDataFrame(rows + [(r[0], 2, [9.0] * 4) for r in rows[:200]], SCHEMA)) == brute(rows + [(r[0], 2, [9.0] * 4) for r in rows[:200]])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (50, 1, [1.0, 1.0]), (1, 1, [1.0, 0.2]), (2, 2, [0.7, 0.1]), (3, 3, [0.8, -0.1]), (4, None, [0.8, 0.1]), (5, 2, None), (6, 2, [nan, 1.0]), (7, 2, [inf, 0.0]), (8, 2, [None, 0.6]), (None, 2, [0.6, 0.6]), (9, 2, []), (10, 4, [0.0, 0.0]), (100, 9, [0.0, 0.0]), (11, 9, [0.0, 0.0]), (12, 2, [-0.3, -0.9]), (150, 7, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", v string, rank int")
    want = brute(rows)
    assert mined(df) == want and any(r[0] == 100 and r[4] == 0 for r in want)
    short = df.union(spark.createDataFrame([(13, 2, [0.9], "x", 1), (14, 2, [1e300, 1.0], "x", 1)], df.schema))
    assert mined(short) == want
    assert mined(df.limit(0)) == mined(df.where("vec_id = 0")) == mined(df.where("vec_id IN (1, 2, 3)")) == []
