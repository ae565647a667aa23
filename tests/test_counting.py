"""Threshold counts over flat arrays: whole, and without a step for each token."""

from __future__ import annotations

import random
import sys

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from spanweave.operators import evaluate
from spanweave.plans import catalog
from spanweave.schema import BUCKETS

TOKENS = pa.list_(pa.struct([("c0", pa.int32()), ("c1", pa.int32()), ("label_id", pa.int32()), ("prob", pa.float32()), ("breaks", pa.bool_())]))
GOLD = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("bucket", pa.int32()), ("kind", pa.int32())]))
VALUES = evaluate.grid(0.1)


class Task:
    """Stands for a frame: what mapInArrow is given is run on one batch."""

    def __init__(self, tokens, gold):
        self.batch = pa.RecordBatch.from_arrays([pa.array(tokens, TOKENS), pa.array(gold, GOLD)], names=["tokens", "gold"])

    def select(self, *_):
        return self

    def mapInArrow(self, f, _):
        self.rows = [r for b in f(iter([self.batch])) for r in b.to_pylist()]
        raise StopIteration

    def run(self, f, *args):
        with pytest.raises(StopIteration):
            f(self, *args)
        return self.rows


def records(rng, n, shared=False):
    """Tokens that come in runs, now and then at the same place, and gold spans."""
    tokens, gold = [], []
    for _ in range(n):
        label, row, spans = 0, [], []
        for i in range(rng.randint(0, 12)):
            c = 4 * (rng.randrange(3) if shared else i)
            label = label + label % 2 if label and rng.random() < 0.7 else rng.randint(1, 10)
            row.append((c, c + 3, label, rng.randrange(11) / 10, i > 0 and rng.random() < 0.1))
            if rng.random() < 0.5:
                spans.append((c, c + 3 + 4 * rng.randrange(3), kind := rng.randrange(5), kind))
        tokens.append([dict(zip(("c0", "c1", "label_id", "prob", "breaks"), t, strict=True)) for t in row])
        gold.append([dict(zip(("start", "end", "bucket", "kind"), s, strict=True)) for s in spans])
    return tokens, gold


def plain(tokens, gold, limits):
    """(tp, pred) by kind: each record is decoded by itself."""
    tp, pred = [0] * len(BUCKETS), [0] * len(BUCKETS)
    for row, spans in zip(tokens, gold, strict=True):
        found, run = set(), None
        for t in row:
            label, kind = t["label_id"], (t["label_id"] - 1) // 2
            if np.float32(t["prob"]) < np.float32(limits[label]):
                run = None
                continue
            if label % 2 or t["breaks"] or run is None or run[2] != kind:
                if run:
                    found.add(run)
                run = (t["c0"], t["c1"], kind)
            found.discard(run)
            run = (run[0], t["c1"], kind)
            found.add(run)
        held = {(s["start"], s["end"], s["kind"]) for s in spans}
        for s in found:
            pred[s[2]] += 1
            tp[s[2]] += s in held
    return tp, pred


def table(rows):
    """tp and pred of gate_table's rows, [kind, B- value, I- value]."""
    n = len(VALUES)
    sums = np.zeros((2, len(BUCKETS), n + 1, n + 1), np.int64)
    for r in rows:
        if r["b"] >= 0:
            sums[:, r["kind"], r["b"], r["i"]] += (r["x"], r["y"])
    return sums.cumsum(2).cumsum(3)[:, :, :n, :n]


def test_counts_are_those_of_decoding_at_each_threshold():
    rng = random.Random(4)
    tokens, gold = records(rng, 60)
    task = Task(tokens, gold)
    tp, pred = table(task.run(evaluate.gate_table, VALUES))
    for b, i in [(rng.randrange(10), rng.randrange(10)) for _ in range(12)]:
        want = plain(tokens, gold, [0.0, *[VALUES[b], VALUES[i]] * 5])
        assert (tp[:, b, i].tolist(), pred[:, b, i].tolist()) == want
    alive = {(r["bucket"], r["cand"]): (r["tp"], r["pred"]) for r in task.run(evaluate.count_alive, VALUES, [0.0] * 11)}
    assert alive == {(k, c): (tp[k, c, c], pred[k, c, c]) for k in range(5) for c in range(10)}


def test_equal_spans_of_a_record_count_once():
    tokens, gold = records(random.Random(7), 80, shared=True)
    task = Task(tokens, gold)
    tp, pred = table(task.run(evaluate.gate_table, VALUES))
    alive = {(r["bucket"], r["cand"]): (r["tp"], r["pred"]) for r in task.run(evaluate.count_alive, VALUES, [0.0] * 11)}
    assert alive == {(k, c): (tp[k, c, c], pred[k, c, c]) for k in range(5) for c in range(10)}
    one = Task([[{"c0": 0, "c1": 3, "label_id": 1, "prob": p, "breaks": False} for p in (0.3, 0.8, 0.8)]], [[{"start": 0, "end": 3, "bucket": 0, "kind": 0}]])
    got = [r["pred"] for r in sorted(one.run(evaluate.count_alive, VALUES, [0.0] * 11), key=lambda r: r["cand"]) if r["bucket"] == 0]
    assert got == [int(np.float32(v) <= np.float32(0.8)) for v in VALUES]


@pytest.mark.parametrize("count", [lambda t: t.run(evaluate.gate_table, VALUES), lambda t: t.run(evaluate.count_alive, VALUES, [0.0] * 11)], ids=["gate_table", "count_alive"])
def test_no_step_is_taken_for_each_token(count):
    def calls(n):
        tokens, gold = records(random.Random(1), n)
        task, steps = Task(tokens, gold), [0]
        task.mapInArrow = lambda f, _: told(task.batch, f, steps)
        count(task)
        return steps[0]

    def told(batch, f, steps):
        task_rows = f(iter([batch]))
        sys.setprofile(lambda frame, event, arg: steps.__setitem__(0, steps[0] + 1))
        try:
            next(task_rows)
        finally:
            sys.setprofile(None)
        raise StopIteration

    Task.rows = []
    calls(10)  # what is imported at first use
    assert calls(2000) < calls(200) * 2


@pytest.mark.parametrize("name", ["sweep_global", "best_threshold"])
def test_inputs_are_made_and_counted_by_one_worker(spark, name):
    plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


@pytest.mark.parametrize(("rows", "dealt"), [(20, True), (1000, False)])
def test_large_files_are_not_dealt_however_few_tasks_they_give(spark, tmp_path, rows, dealt):
    """1,000 texts have over the 4 MB a core that may be on disk once more."""
    rng = random.Random(4)
    columns = {"doc_id": list(range(rows)), "text": [rng.randbytes(5000).hex() for _ in range(rows)], "source": ["src0"] * rows, "lang": ["en"] * rows}
    pq.write_table(pa.table(columns), tmp_path / "documents.parquet", compression="none")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        plan = catalog.queries()["best_threshold"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert ("RepartitionByExpression" in plan) == dealt


def test_few_tokens_are_counted_at_a_time(monkeypatch):
    tokens, gold = records(random.Random(9), 50)
    want = table(Task(tokens, gold).run(evaluate.gate_table, VALUES))
    monkeypatch.setattr(evaluate, "AT_ONCE", 5)
    assert (table(Task(tokens, gold).run(evaluate.gate_table, VALUES)) == want).all()


def test_long_runs_are_taken_at_once():
    n = 200_000
    for alive in (np.arange(n) // 2000, np.full(n, 5), np.r_[np.full(n - 1, 5), 1], 99 - np.arange(n) // 2000):
        first, last, lo, hi = evaluate._segments(alive, np.array([0]))
        assert len(first) == len(np.unique(alive)) and (lo < hi).sum() == len(first) - (alive.min() == 0)
        assert sorted((last - first + 1).tolist())[-1] == n
