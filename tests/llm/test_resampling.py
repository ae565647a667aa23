"""Importance resampling against a plain version."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tests.llm.docs import ODD, odd_docs

from spanweave.llm import resampling


def features(text, n):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def plain(rows, target, n=1, buckets=10_000, percent=10, least=20, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in features(t, n)[1])
    t = Counter(bucket(f) for x in target for f in features(x, n)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for i, text in rows:
        words, found = features(text, n)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    drawn = sorted((-x[3], x[0] is None, x[0] or 0, x[1], x[2], k) for k, x in enumerate(out) if x[4] >= least)[: percent * sum(x[4] >= least for x in out) // 100]
    rank = {d[-1]: k + 1 for k, d in enumerate(drawn)}
    return sorted(map(repr, ((*x[:4], rank.get(k)) for k, x in enumerate(out))))


@pytest.mark.parametrize("n", [1, 3])
def test_equals_a_plain_version(spark, monkeypatch, n):
    monkeypatch.setattr(resampling, "STEP_CHARS", 100)  # texts in many pieces and steps
    rows = [*ODD, *((100 + k, f"quick brown fox number {k} jumps " * (k % 9)) for k in range(80)), *((7, "the lazy dog sleeps " * 9) for _ in range(3))]
    target = ["The lazy DOG sleeps near the river", None, "naïve café 日本語", ""]
    bench = spark.createDataFrame([(k, t, "x") for k, t in enumerate(target)], "item_id bigint, text string, bucket string")
    got = resampling.resample(odd_docs(spark, rows).repartition(3), bench, percent=30, buckets=50, n=n, least_words=5).collect()
    assert sorted(map(repr, map(tuple, got))) == plain(rows, target, n, 50, 30, 5)
    assert sum(r.rank is not None for r in got) == 30 * sum(len(features(t, 1)[0]) >= 5 for _, t in rows) // 100


def test_empty_tables(spark):
    none, bench = odd_docs(spark, []), spark.createDataFrame([], "item_id bigint, text string")
    assert resampling.resample(none, bench).count() == 0
    got = resampling.resample(odd_docs(spark), bench).collect()
    assert sorted(map(repr, map(tuple, got))) == plain(ODD, [])
    assert resampling.resample(odd_docs(spark), bench, percent=0).filter("rank is not null").count() == 0


def test_draws_follow_the_target(spark):
    rows = [(k, ("target words of the wanted kind " if k % 4 == 0 else "other words from somewhere else ") * 10) for k in range(400)]
    bench = spark.createDataFrame([("target words of the wanted kind",)] * 2000, "text string")
    got = resampling.resample(spark.createDataFrame(rows, "doc_id bigint, text string"), bench)
    drawn = [r.doc_id for r in got.filter(F.col("rank").isNotNull()).collect()]
    assert len(drawn) == 40 and sum(d % 4 == 0 for d in drawn) > 35
