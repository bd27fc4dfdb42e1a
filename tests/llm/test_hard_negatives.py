"""Hard negatives beside brute force over all pairs; SQL of the query is in test_queries."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.llm import hard_negatives as hn

from conftest_llm import CLASHES, values

SCHEMA = "id long, label int, vector array<float>"


def brute(rows, anchor, scale=256, positives=5, negatives=3):
    live = {}
    for i, label, vector in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        live[(i, label, tuple(math.floor(scale * float(np.float32(x))) for x in vector))] = 1

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for i, label, q in live:
        if not anchor(i):
            continue
        others = {(-score(q, c[2]), c[0], c[1] == label) for c in live}
        found = sorted({(s, j) for s, j, same in others if same and j != i})[:positives]
        for s, j in found:
            hard = sorted({(t, k) for t, k, same in others if not same and 50 * -s <= 100 * -t <= 95 * -s})[:negatives]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k) in enumerate(hard, 1)]
    return sorted(out)


def made(n, size=12, seed=2, spread=1.0):
    dice = random.Random(seed)
    centres = [[dice.gauss(0, spread) for _ in range(size)] for _ in range(4)]
    return [
        (i, label, [c + dice.gauss(0, 0.7 * spread) for c in centres[(label + (i % 11 == 0)) % 4]])
        for i in range(n) for label in [dice.randrange(4)]
    ]


def test_beside_brute_force(spark):
    rows = made(500)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute(rows, lambda i: i % 10 == 0)
    got = hn.mine(frame, F.col("id") % 10 == 0)
    assert [tuple(r) for r in values(got)] == want and len(want) > 300
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_rounds_and_small_blocks(spark, monkeypatch):
    rows = made(300, size=20, seed=7, spread=40.0)  # more planes, 64-bit scores
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    monkeypatch.setattr(hn, "TABLE_ANCHORS", 3)
    monkeypatch.setattr(hn, "FIRST_ROWS", 2)
    got = hn.mine(frame, F.col("id") % 5 == 0, round_anchors=17, positives=2, negatives=4)
    assert values(got) == brute(rows, lambda i: i % 5 == 0, positives=2, negatives=4)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (0, 2, [1.0, 0.25]), (None, 1, [1.0, 1.0]), (1, None, [1.0, 1.0]), (2, 1, None),
        (3, 1, [nan, 1.0]), (4, 1, [1.0, inf]), (5, 1, [None, 1.0]), (6, 1, []), (7, 1, [0.9]), (8, 1, [0.9, 0.0, 0.0]), (9, 2, [0.6, 0.2]),
        (10, 2, [0.6, 0.2]), (11, 3, [0.6, 0.2]), (11, 3, [0.6, 0.2]), (12, 3, [0.0, 0.0]), (13, 1, [-1.0, -1.0]), (14, 3, [0.61, 0.2] * 9),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    frame = frame.select("*", *[F.lit("clash").alias(c) for c in CLASHES if c not in ("label",)])
    want = brute(rows, lambda i: i % 5 == 0)
    assert want and values(hn.mine(frame, F.col("id") % 5 == 0)) == want
    assert hn.mine(frame.limit(0), F.col("id") % 5 == 0).count() == 0
    assert hn.mine(frame, F.lit(False)).count() == 0
    with pytest.raises(ValueError):
        hn.mine(spark.createDataFrame([(0, 1, [1e30])], SCHEMA), F.lit(True))


@pytest.mark.parametrize("low, high", [(0, 0), (-1, 0), (0, 1), (-256, 256), (-5000, 70), (-(2**20), 2**20)])
def test_lookups_are_the_inner_products(low, high):
    dice = np.random.default_rng(4)
    table = dice.integers(low, high + 1, (40, 24))
    table[0], table[1] = low, high
    planes = max(-1 - low, high, 0).bit_length() + 1
    bits = hn.bit_planes(table, planes)
    assert bits.shape == (40, planes, 3) and bits.dtype == np.uint8
    got = hn.scores(hn.subset_sums(table[:9], 3, hn.score_type(3, planes)), bits)
    assert (got == table @ table[:9].T).all()


def test_best_keeps_the_first_of_ties():
    best = hn.Best(2, 2)
    best.add(np.array([0, 0, 1, 0]), np.array([5, 7, 1, 5]), np.array([9, 8, 7, 3]))
    best.add(np.array([0, 0]), np.array([5, 7]), np.array([3, 8]))
    assert sorted(best.rows()) == [(0, 5, 3), (0, 7, 8), (1, 1, 7)] and best.bar(np.array([0, 1])).tolist()[0] == 5
