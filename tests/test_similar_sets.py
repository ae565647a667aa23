"""The similarity join: parity bits leave out no similar pair, and only pairs that are nearly similar are sent token by token."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from spanweave.operators import coverage


def corpus(n: int, size: int, rng: random.Random) -> list[str]:
    """Texts over a small vocabulary, so that many share their rarest tokens, every third with a near copy."""
    vocabulary = [f"w{k}" for k in range(2 * size)]
    texts = []
    for k in range(n):
        words = rng.sample(vocabulary, size)
        texts.append(" ".join(words))
        if k % 3 == 0:
            far = int(size * rng.choice((0.02, 0.05, 0.06)))
            texts.append(" ".join([*words[far:], *(f"x{k}_{j}" for j in range(far))]))
    return texts


def test_all_similar_pairs_are_found_and_few_others_are_compared(spark, monkeypatch):
    rng = random.Random(11)
    texts = corpus(60, 40, rng) + corpus(24, 900, rng)
    df = spark.createDataFrame(list(enumerate(texts)), "record_id bigint, text string")
    stored = {}
    keep = coverage.materialize
    monkeypatch.setattr(coverage, "materialize", lambda df, label: stored.setdefault(label, keep(df, label)))
    got = coverage.token_jaccard_pairs(df, df, falling=True).collect()
    sets = {coverage_id: frozenset(t.split()) for coverage_id, t in zip([r.set_id for r in coverage.token_set_members(df).orderBy("record_id").collect()], texts, strict=True)}
    want = {(a, b): round(len(x & y) / len(x | y), 6) for a, x in sets.items() for b, y in sets.items() if a > b and len(x & y) / len(x | y) >= 0.9}
    assert {(r.left_set, r.right_set): r.jaccard for r in got} == want and len(want) > 10
    assert stored["nearer"].count() <= 1.2 * len(want)  # before: every pair that shares a prefix token


def test_a_set_and_its_parity(spark):
    rows = spark.createDataFrame([("a b c",), ("a b d",), ("",)], "text string")
    sets = coverage._token_sets(rows).select("words", F.transform("parity", lambda x: F.bit_count(x)).alias("bits")).collect()
    assert {r.words: sum(r.bits) % 2 for r in sets} == {"a b c": 1, "a b d": 1}
