"""Agreement of many annotators against plain counts, and a published example."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations, permutations

import pytest

from spanweave.operators import coverage

SCHEMA = "record_id int, tok_idx int, annotator string, label_id int"


def plain(votes):
    """Coincidences by definition: every ordered pair of a unit's votes weighs 1 / (m - 1)."""
    units, seen = {}, {}
    for r, t, who, label in votes:
        if label is not None:
            key = (r, t, who)
            seen[key] = min(seen.get(key, label), label)
    for (r, t, who), label in seen.items():
        units.setdefault((r, t), {})[who] = label
    units = {k: v for k, v in units.items() if len(v) > 1}
    o = Counter()
    for v in units.values():
        for a, b in permutations(v, 2):
            o[v[a], v[b]] += 1 / (len(v) - 1)
    n_c = Counter()
    for (c, _), x in o.items():
        n_c[c] += x
    n = sum(n_c.values())
    seen_apart = sum(x for (c, k), x in o.items() if c != k) / n
    by_chance = sum(n_c[c] * n_c[k] for c in n_c for k in n_c if c != k) / (n * (n - 1))
    out = {("all", "all"): (len(units), 1 - seen_apart, 1 - seen_apart / by_chance if by_chance else 1.0)}
    for a, b in combinations(sorted({w for v in units.values() for w in v}), 2):
        both = [(v[a], v[b]) for v in units.values() if a in v and b in v]
        if both:
            po = sum(x == y for x, y in both) / len(both)
            x, y = Counter(p for p, _ in both), Counter(q for _, q in both)
            pe = sum(x[c] * y[c] for c in x) / len(both) ** 2
            out[a, b] = (len(both), po, (po - pe) / (1 - pe) if pe < 1 else 1.0)
    return out


def check(spark, votes):
    got = coverage.agreement_panel(spark.createDataFrame(votes, SCHEMA)).collect()
    want = plain(votes)
    assert {(r.annotator_a, r.annotator_b) for r in got} == want.keys() and len(got) == len(want)
    for r in got:
        units, agreement, coefficient = want[r.annotator_a, r.annotator_b]
        assert (r.units, r.agreement, r.coefficient) == (units, pytest.approx(agreement, abs=1e-8), pytest.approx(coefficient, abs=1e-8))
    return {(r.annotator_a, r.annotator_b): r.coefficient for r in got}


def test_many_annotators_with_missing_votes(spark):
    rng = random.Random(1)
    votes = []
    for unit in range(200):
        true = rng.choice([0, 0, 0, 1, 2])
        for who in "vwxyz":
            if rng.random() < 0.7:
                votes.append((unit // 20, unit % 20, who, true if rng.random() < 0.8 else rng.choice([0, 1, 2])))
            elif rng.random() < 0.5:
                votes.append((unit // 20, unit % 20, who, None))
    votes += votes[:5]  # said twice
    check(spark, votes)


def test_published_example(spark):
    """Three coders, fifteen units, nominal labels, missing votes: alpha is 0.691."""
    coders = {
        "A": [None, None, None, None, None, 3, 4, 1, 2, 1, 1, 3, 3, None, 3],
        "B": [1, None, 2, 1, 3, 3, 4, 3, None, None, None, None, None, None, None],
        "C": [None, None, 2, 1, 3, 4, 4, None, 2, 1, 1, 3, 3, None, 4],
    }
    got = check(spark, [(0, k, who, x) for who, row in coders.items() for k, x in enumerate(row)])
    assert got["all", "all"] == pytest.approx(0.691, abs=5e-4)


def test_one_label_and_nothing(spark):
    assert check(spark, [(0, k, who, 5) for k in range(4) for who in "ab"]) == {("all", "all"): 1.0, ("a", "b"): 1.0}
    alone = [(0, k, "a", 5) for k in range(4)]
    assert coverage.agreement_panel(spark.createDataFrame(alone, SCHEMA)).count() == 0
    assert coverage.agreement_panel(spark.createDataFrame([], SCHEMA)).count() == 0
