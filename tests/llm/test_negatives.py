"""Hard negatives against a plain loop over all rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanweave.llm import negatives

SCHEMA = "vec_id bigint, embedding array<double>, label int, score string, slot string"


def units(x):
    return 256 * int(x) if abs(x) > 2**60 else math.floor(256 * x)


def plain(rows, is_anchor, n_positive=5, n_negative=5, low=80, high=100):
    sound = [(i, [units(x) for x in v], c) for i, v, c in rows if None not in (i, v, c) and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for i, v, c in sorted((x for x in rows if x[0] is not None and is_anchor(x[0]) and (x[0], x[2]) in {(i, c) for i, _, c in sound}), key=lambda x: (x[0], x[1], x[2])):
        anchors.setdefault(i, ([units(x) for x in v], c))
    out = []
    for a, (v, label) in anchors.items():
        scored = sorted((-min(max(sum(x * y for x, y in zip(v, w)), -(2**63)), 2**63 - 1), i, c == label) for i, w, c in sound if i != a)
        positives = [(i, -s) for s, i, same in scored if same][:n_positive]
        for positive, p in positives:
            hard = [(i, -s) for s, i, same in scored if not same and low * p <= -100 * s <= high * p][:n_negative]
            out += [(a, positive, k + 1, i, p, s) for k, (i, s) in enumerate(hard)]
    return sorted(out)


def framed(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def test_equals_a_plain_loop(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 7)
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    monkeypatch.setattr(negatives, "ROWS", 50)
    r = random.Random(4)
    middle = [[r.gauss(0, 1) for _ in range(8)] for _ in range(3)]
    # a third of the rows has one label; near copies, ties, scores of zero and below
    rows = [(i, [m + r.gauss(0, 0.3) for m in middle[i % 3]], 0 if i % 3 == 0 else r.randint(1, 4)) for i in range(400)]
    rows += [(i, [0.5, *[0.0] * 7], i % 2) for i in range(400, 440)] + [(i, [0.0] * 8, i % 2) for i in range(440, 460)]
    got = negatives.mine(framed(spark, rows).repartition(3), F.col("vec_id") % 20 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain(rows, lambda i: i % 20 == 0)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100


def test_odd_rows(spark):
    rows = [(i, [i / 7, -i / 9, 2.0], i % 2) for i in range(1, 40)]
    rows += [(50, None, 1), (60, [1.0, None, 2.0], 1), (70, [math.nan] * 3, 1), (80, [math.inf] * 3, 1), (90, [1.0] * 3, None), (None, [1.0] * 3, 1), (10, [1.0], 1), (30, [], 0)]
    got = negatives.mine(framed(spark, rows), F.col("vec_id") % 10 == 0, positives=3, negatives=2)
    padded = [(i, None if v is None else (v + [0.0] * 3)[:3], c) for i, v, c in rows]
    by_first = {k: min(x for x in rows if x[0] == k and x[1] is not None and x[2] is not None) for k in (10, 30)}
    kept = [p for r, p in zip(rows, padded, strict=True) if r[0] not in by_first or r != by_first[r[0]]]
    # the smallest vector of an id is the anchor; all of that id are out of its candidates
    want = plain([*[(i, (v + [0.0] * 3)[:3], c) for i, v, c in by_first.values()], *kept], lambda i: i % 10 == 0, 3, 2)
    assert sorted(map(tuple, got.collect())) == want
    assert negatives.mine(framed(spark, []), F.col("vec_id") % 10 == 0).count() == 0


def test_large_numbers_are_exact(spark):
    rows = [(0, [2.0**45, 1.0], 0), (1, [512.0, 1 / 256], 0), (2, [511.0, 2 / 256], 1), (3, [512.0, 0.0], 1), (4, [1e308, -1e308], 1), (10, [1e308, 1.0], 1), (11, [0.25, 0.5], 0), (12, [0.25, 0.25], 1), (20, [0.5, 0.5], 0)]
    rows += [(i, [2.0 ** (i % 60), -(3.0 ** (i % 40))], i % 2) for i in range(21, 100)]
    got = negatives.mine(framed(spark, rows).coalesce(1), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == plain(rows, lambda i: i % 10 == 0)


@pytest.mark.parametrize("size", [1, 37])
def test_intervals_hold_the_score_and_close(size):
    r = np.random.default_rng(size)
    rows, queries = np.floor(256 * r.normal(size=(size, 16))), np.floor(256 * r.normal(size=(5, 16)))
    exact = rows @ queries.T
    row, col = np.nonzero(np.ones(exact.shape, bool))
    widths = []

    def keep(cols, least, most):
        assert len(cols) == exact.size
        assert (least <= exact.ravel()).all() and (exact.ravel() <= most).all()
        widths.append(float((most - least).max()))
        return np.ones(len(cols), bool)

    _, _, score = negatives.progressive(negatives.Planes(rows), queries, row, col, keep)
    assert (score == exact.ravel()).all() and widths[-1] == 0 and widths == sorted(widths, reverse=True)


def test_pairs_are_dropped_before_the_last_plane():
    r = np.random.default_rng(2)
    v = r.normal(size=(2000, 64))
    rows = np.floor(256 * v / np.linalg.norm(v, axis=1, keepdims=True))
    queries, made = rows[::100], []
    exact = rows @ queries.T
    row, col = np.nonzero(np.ones(exact.shape, bool))
    least = np.sort(exact, axis=0)[-6]
    found, _, score = negatives.progressive(negatives.Planes(rows), queries, row, col, lambda c, low, high: high >= least[c], made)
    assert sorted(score.tolist()) == sorted(exact[exact >= least].tolist()) and len(found) == 6 * 20
    assert made[-1] < 0.01 * made[0] and sum(made) < 0.75 * len(made) * made[0]
