import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleslayers.llm import hard_negatives
from saleslayers.llm.hard_negatives import Best, Rows, search

SCHEMA = "vec_id long, label int, embedding array<float>, vector int, block string"


def brute(rows, positives=5, negatives=10):
    """Rows (vec_id, label, embedding) to (anchor, positive, rank, negative, positive score, negative score)."""
    good = [(i, y, [math.floor(256 * float(np.float32(x))) for x in v]) for i, y, v in rows if None not in (i, y, v) and all(x is not None and math.isfinite(x) and abs(x) < hard_negatives.TOO_LARGE for x in v)]
    out = []
    for a, (i, y, v) in enumerate(good):
        if i % 100:
            continue
        scored = [(-sum(p * q for p, q in zip(v, w)), j, z) for b, (j, z, w) in enumerate(good) if b != a and len(w) == len(v)]
        for s, j, _ in sorted(x for x in scored if x[2] == y)[:positives]:
            near = sorted(x for x in scored if x[2] != y and 30 * -s <= 100 * -x[0] <= 90 * -s)[:negatives]
            out += [(i, j, k + 1, m, -s, -t) for k, (t, m, _) in enumerate(near)]
    return sorted(out)


def mined(spark, rows, **other):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, **other)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def block(vectors, labels=None):
    vectors = np.asarray(vectors, np.int32)
    lists = np.argsort(vectors, axis=0, kind="stable").T.astype(np.uint16)
    return Rows(0, np.arange(len(vectors)), np.zeros(len(vectors), np.int64), vectors, lists)


@pytest.mark.parametrize("spread", [1, 3, 200])
def test_threshold_search_finds_the_first_rows(spread):
    """Few different values make many ties at the kth score."""
    rng = np.random.default_rng(spread)
    for _ in range(40):
        n, d, k = rng.integers(1, 300), rng.integers(1, 9), rng.integers(1, 12)
        rows = block(rng.integers(-spread, spread + 1, (n, d)))
        vector = rng.integers(-spread, spread + 1, d)
        wanted = rng.random(n) < 0.7
        scores = rows.vectors.astype(np.int64) @ vector
        ranges = [(-(10**9), 10**9), (int(np.median(scores)), int(scores.max()) - 1), (0, 0)]
        windows = [Best.empty(low, high, k) for low, high in ranges]
        search(rows, vector, wanted, windows)
        for (low, high), best in zip(ranges, windows):
            want = sorted((-s, i) for i, s in enumerate(scores.tolist()) if wanted[i] and low <= s <= high)[:k]
            assert list(zip((-best.scores).tolist(), best.ids.tolist())) == want


def test_search_stops_early():
    """One list decides: the threshold falls below the kth score long before the lists end."""
    vectors = np.zeros((4000, 2), np.int32)
    vectors[:, 0] = np.arange(4000)
    best = Best.empty(-(1 << 62), 1 << 62, 10)
    assert search(block(vectors), np.array([5, 0]), np.ones(4000, bool), [best]) <= 64
    assert best.ids.tolist() == list(range(3999, 3989, -1))


def test_scores_beyond_doubles_are_exact():
    rows = block([[2**23, 1], [2**23, 2]] * 3)
    vector = np.array([2**31 - 1, 1])
    assert rows.score(np.arange(2), vector).tolist() == [2**23 * (2**31 - 1) + 1, 2**23 * (2**31 - 1) + 2]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 64)
    rng = np.random.default_rng(5)
    rows = [(int(i), int(rng.integers(0, 4)), [float(x) for x in rng.normal(0, 0.3, 8)]) for i in range(0, 900, 4)]
    hot = rows[3][2]
    rows += [(1000 + i, int(i % 3), hot) for i in range(120)]  # one vector under many ids
    assert mined(spark, rows) == brute(rows) != []


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(None, 1, [1.0]), (100, None, [1.0, 1.0]), (200, 1, None), (300, 1, [1.0, None]), (400, 1, [nan, 1.0]), (500, 1, [inf, 1.0]), (600, 1, [1e9, 1.0]), (-100, 1, [0.5, 0.5])]
    plain = [(0, 1, [1.0, 1.0]), (7, 1, [1.0, 0.9]), (8, 1, [0.5, 0.9]), (9, 2, [0.4, 0.4]), (10, 2, [0.4, 0.4]), (11, 2, [-0.3, -0.1]), (12, 2, [0.7])]
    empty = [(700, 1, []), (701, 1, []), (702, 2, [])]
    rows = odd + plain + plain[:4] + empty  # repeated rows count again, an anchor too
    got = mined(spark, rows)
    assert got == brute(rows)
    assert (0, 0) in {g[:2] for g in got} and (700, 701, 1, 702, 0, 0) in got and {g[0] for g in got} == {0, -100, 700}
    assert mined(spark, []) == [] and mined(spark, odd[:6]) == []


def test_fewer_are_returned(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.89, 0.0]), (3, 2, [0.31, 5.0]), (4, 2, [0.2, 0.0]), (5, 2, [1.0, 0.0])]
    assert [g[3] for g in mined(spark, rows)] == [2, 3]
    assert [g[3] for g in mined(spark, rows, negatives=1)] == [2]
