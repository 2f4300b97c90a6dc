"""Hard negatives against all pairs, products against numpy and Python's integers."""

from collections import Counter
from math import floor, inf, isfinite, nan

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapledger.llm import negatives

from .frames import sf

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score string, v string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(3)


def slow(rows, positives=5, size=3, low=50, high=95):
    rows = [(i, [floor(256 * x) for x in v], y) for i, v, y in rows
            if None not in (i, v, y) and all(x is not None and isfinite(x) for x in v)]
    out = Counter()
    for a, (i, v, y) in enumerate(rows):
        if i % 50:
            continue
        scored = [(-sum(p * q for p, q in zip(v, w)), j, z) for b, (j, w, z) in enumerate(rows) if b != a]
        near = sorted(s[:2] for s in scored if s[2] == y)[:positives]
        for top, j in near:
            inside = sorted(s[:2] for s in scored if s[2] != y and low * -top <= 100 * -s[0] <= high * -top)
            for rank, (s, k) in enumerate(inside[:size], 1):
                out[i, j, rank, k, -top, -s] += 1
    return out


def mined(df, **rest):
    return Counter(map(tuple, negatives.mine(df, F.col("vec_id") % 50 == 0, **rest).collect()))


def test_table(spark):
    df = sf(spark, "embeddings")
    want = slow([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])
    assert sum(want.values()) > 20
    for tile in (2048, 37):
        assert mined(df, tile=tile) == want


def vectors(n, seed, width=6, labels=3):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in rng.integers(-3, 4, width) / 4], int(y))
            for i, y in zip(rng.permutation(n), rng.integers(0, labels, n))]


def test_ties_repeats_and_a_common_vector(spark):
    """Few values, so that most scores are equal; a third of the rows have one vector."""
    rows = vectors(400, 1, 3) + [(1000 + i, [0.5, 0.5, 0.25], i % 2) for i in range(200)]
    rows += rows[:120]
    assert mined(frame(spark, rows), tile=50) == slow(rows)
    assert mined(frame(spark, rows), tile=700, positives=2, negatives=1, low=10, high=100) == slow(
        rows, 2, 1, 10, 100)


def test_awkward_rows(spark):
    good = vectors(60, 2)
    rows = good + [
        (None, [1.0] * 6, 1), (50, None, 1), (100, [1.0] * 6, None), (150, [1.0, None, *[1.0] * 4], 1),
        (200, [nan] * 6, 1), (250, [inf, *[1.0] * 5], 1), (300, [], 1), (350, [1.0, 0.5], 1),
        (400, [1.0] * 9, 7), (450, [-1.0] * 6, 2), (-50, [0.75] * 6, 1)]
    assert mined(frame(spark, rows), tile=16) == slow(rows)
    assert not mined(frame(spark, []))
    assert not mined(frame(spark, [(i, [1.0], 1) for i in range(1, 9)]))   # no anchor
    assert not mined(frame(spark, [(i * 50, [1.0], 1) for i in range(9)]))  # no other label


def test_wide_numbers_are_exact(spark):
    """Products beyond 2 ** 53, then scores beyond a long."""
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 3e5, 8)], int(i % 3)) for i in range(300)]
    assert mined(frame(spark, rows)) == slow(rows)
    rows = [(i, [1e15 * (1 + i % 7)] * 3, i % 3) for i in range(120)]
    top = 2 ** 63 - 1
    assert {r[4] for r in mined(frame(spark, rows))} <= {top}


@pytest.mark.parametrize("m,n,k", [(1, 1, 1), (33, 40, 50), (64, 64, 64), (65, 67, 129), (128, 300, 96), (0, 5, 3),
                                   (5, 0, 3), (40, 40, 0)])
def test_strassen(m, n, k, monkeypatch):
    rng = np.random.default_rng(m + n + k)
    a, b = rng.integers(-1000, 1000, (m, k)), rng.integers(-1000, 1000, (n, k))
    for leaf in (negatives.LEAF, 2):
        monkeypatch.setattr(negatives, "LEAF", leaf)
        assert (negatives.multiply(a, b) == a @ b.T).all()
    wide = a.astype(object) * 10 ** 20
    assert (negatives.multiply(wide, b.astype(object)) == wide @ b.T.astype(object)).all()


def test_heaps_keep_the_first_of_equals():
    scores = np.array([[3, 5, 5, 1], [2, 2, 2, 2]])
    allowed = np.array([[True, True, True, True], [False, True, False, True]])
    found = [(r.tolist(), c.tolist()) for r, c in negatives.heap(scores, allowed, 3)]
    assert found == [([0, 1], [1, 1]), ([0, 1], [2, 3]), ([0], [0])]
