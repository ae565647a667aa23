"""Stateful streams against batch: over restarts, with late rows, and with state that expires."""

from __future__ import annotations

import datetime
import random
import time

from pyspark.sql import functions as F

from spanweave.operators import coverage
from spanweave.streaming import pipeline, state

RECORDS = "record_id long, text string, split string"
CHANGES = "id long, ts timestamp, version string, locked_at timestamp"


def run(spark, frames, schema, make, tmp_path, work_off=pipeline.run_available):
    """Each frame is a file that appears, worked off by a query that is started anew from its checkpoint."""
    state.use_rocksdb(spark)
    for k, rows in enumerate(frames):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = make(pipeline.read_records(spark, f"{tmp_path}/in", schema, 1))
        work_off(stream, f"{tmp_path}/out", f"{tmp_path}/check")
        yield k


def test_copies_over_restarts(spark, tmp_path):
    rng = random.Random(4)
    texts = [f"text {k}" for k in range(12)] + [None, ""]
    rows = [(rng.randint(0, 1000), rng.choice(texts) if rng.random() < 0.7 else f"own {k}", rng.choice(["dev", "test", None])) for k in range(150)]
    rows += [(5000 + k, "hot", "dev") for k in range(100)]
    rng.shuffle(rows)
    for _ in run(spark, [rows[:90], rows[90:100], rows[100:]], RECORDS, state.copies_stream, tmp_path):
        pass
    got = state.latest(spark.read.parquet(f"{tmp_path}/out")).collect()
    want = coverage.hash_duplicates(spark.createDataFrame(rows, RECORDS)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want))) and max(r.n for r in got) == 100


def test_contents_are_forgotten(spark, tmp_path):
    frames = [[(1, "a", "dev"), (2, "a", "dev")], [(3, "a", "dev")]]
    for k in run(spark, frames, RECORDS, lambda s: state.copies_stream(s, ttl_ms=1_000), tmp_path, lambda *a: pipeline.run_until_idle(*a, seconds=60)):
        if k == 0:
            time.sleep(2)
    # the third comes when the first two are forgotten, so it is no copy
    assert [tuple(r)[1:] for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [(2, 1, 1)]


def changes(n, rng):
    start = datetime.datetime(2024, 1, 1)
    rows = []
    for k in range(n):
        ts = start + datetime.timedelta(minutes=k)
        rows.append((rng.randint(0, 9), ts, f"v{k}", ts if rng.random() < 0.05 else None))
    return rows


def test_locked_records_as_in_batch_with_late_rows(spark, tmp_path):
    rng = random.Random(8)
    rows = changes(200, rng)
    # rows come up to half an hour late, across restarts
    order = sorted(range(200), key=lambda k: k + rng.uniform(0, 30))
    frames = [[rows[k] for k in order[a:b]] for a, b in ((0, 70), (70, 75), (75, 200))]
    flush = [(99, datetime.datetime(2024, 3, 1), "end", None)]
    for _ in run(spark, [*frames, flush, [(99, datetime.datetime(2024, 3, 2), "end2", None)]], CHANGES, state.guard_stream, tmp_path):
        pass
    got = sorted((r.id, r.ts, r.version, r.accepted) for r in spark.read.parquet(f"{tmp_path}/out").filter("id <> 99").collect())
    want = sorted(map(tuple, state.guard_batch(spark.createDataFrame(rows, CHANGES)).collect()))
    assert got == want and 0 < sum(not r[3] for r in got) < 200


def test_what_is_too_late_is_dropped(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    at = lambda hours, v, lock=False: (1, start + datetime.timedelta(hours=hours), v, start if lock else None)
    frames = [[at(0, "a"), at(10, "b", True)], [at(50, "c")], [at(1, "late")], [at(100, "d")], [at(200, "e")]]
    for _ in run(spark, frames, CHANGES, state.guard_stream, tmp_path):
        pass
    got = {r.version: r.accepted for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert "late" not in got and {k: got[k] for k in "abc"} == {"a": True, "b": True, "c": False}
    assert spark.read.parquet(f"{tmp_path}/out").select(F.count("*")).first()[0] == len(got)
