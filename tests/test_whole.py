"""Records kept whole: the same labels and spans as the operators on rows, without windows, joins or shuffles of tokens."""

from __future__ import annotations

import random
from hashlib import md5

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanweave.functions import hashing
from spanweave.operators import evaluate, records, relocate, whole
from spanweave.operators.tokens import bio_decode, bio_encode, whitespace_tokens
from spanweave.plans import catalog
from spanweave.schema import BUCKETS

SF = "/root/testdata/sf0.001"
IN_PLACE = "argmax_decode iaa_panel trainer_metric validate_records score_batch bio_decode_lenient bio_decode_strict relocated iaa_span_f1 acceptance_gates active_learning_topk bio_encode threshold_gate iaa_kappa".split()


@pytest.mark.parametrize("name", IN_PLACE)
def test_no_token_is_dealt_sorted_or_joined(spark, name):
    plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Generate posexplode" not in plan
    assert plan.count("Join") <= 1  # the five buckets


def test_threshold_inputs_are_made_in_place(spark):
    plan = catalog._gate_inputs(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert not any(x in plan for x in ("Window", "Join", "Aggregate", "posexplode"))


def test_no_map_leaves_its_task(spark):
    plan = catalog.queries()["char_map_switches"](spark, SF)._jdf.queryExecution().optimizedPlan()
    nodes = [plan]
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(k) for k in range(node.children().size())]
        assert "array<int>" not in node.schema().simpleString() and "ArrayType(IntegerType" not in node.schema().toString()


def test_hashes_are_those_of_md5():
    rng = random.Random(3)
    ids = np.array([0, 7, -12, 10**17])
    owner = np.array([rng.randrange(4) for _ in range(20_000)])
    place = np.array([rng.choice((0, 9, 10, rng.randrange(10**9))) for _ in owner])
    want = [int(md5(f"miss|A|{ids[o]}|{p}".encode()).hexdigest()[:8], 16) for o, p in zip(owner, place, strict=True)]
    assert hashing.hash32_of("miss|A", ids, owner, place).tolist() == want
    assert hashing.hash32_of("x" * 60, ids, owner[:3], place[:3]).tolist() == [int(md5(f"{'x' * 60}|{ids[o]}|{p}".encode()).hexdigest()[:8], 16) for o, p in zip(owner[:3], place[:3], strict=True)]


def test_labels_and_spans_are_those_of_rows(spark):
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("aé€😀b") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    texts[3], texts[4], texts[20], texts[-1] = "", None, "  two  gaps ", ""
    rows, spans = list(enumerate(texts)), set()
    for k, t in rows:
        for _ in range(rng.randint(0, 6) if t else 0):
            start = rng.randrange(len(t))
            spans.add((k, start, start + rng.randint(1, 12), rng.randrange(5)))
    spans = sorted(spans)
    piece = whole.Piece(pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows]), pa.array(texts, pa.string())], names=["record_id", "text"]))
    tokens = piece.tokens()
    table = {c: np.array([s[i] for s in spans]) for i, c in enumerate(("owner", "start", "end", "kind"))}
    label = whole.encode(tokens, table)
    kinds = [(b.partition("(")[0], "NEG" if "NEG" in b else "POS") for b in BUCKETS]
    df = spark.createDataFrame(rows, "record_id bigint, text string")
    given = spark.createDataFrame([(*s[:3], *kinds[s[3]]) for s in spans], "record_id bigint, start int, end int, type string, polarity string")
    made = bio_encode(whitespace_tokens(df), given)
    assert sorted(zip(*(tokens[c].tolist() for c in ("owner", "tok_idx", "c0", "c1")), label.tolist(), strict=True)) == sorted(map(tuple, made.collect()))
    odd = np.array([rng.choice((0, x, x, x + 1, -100, 99, -1)) for x in label.tolist()])
    told = spark.createDataFrame([tuple(map(int, r)) for r in zip(*(tokens[c] for c in ("owner", "tok_idx", "c0", "c1")), odd, strict=True)], "record_id bigint, tok_idx int, c0 int, c1 int, label_id int")
    for strict in (False, True):
        found = whole.decode(tokens, odd, strict)
        got = sorted(zip(*(found[c].tolist() for c in ("owner", "start", "end")), [kinds[k] for k in found["kind"].tolist()], strict=True))
        assert got == sorted((r.record_id, r.start, r.end, (r.type, r.polarity)) for r in bio_decode(told, strict).collect())
    counted = whole.counts(found, table).to_pylist()
    pred = whole.span_rows(piece, found)
    rows_ = spark.createDataFrame([tuple(r.values()) for r in pred.to_pylist()], whole.SPANS)
    assert {r["bucket"]: (r["tp"], r["fp"], r["fn"]) for r in counted} == {r.bucket: (r.tp, r.fp, r.fn) for r in evaluate.count_matches(rows_, given).collect()}


def test_a_piece_never_cuts_a_record(spark, monkeypatch):
    monkeypatch.setattr(whole, "PIECE", 10)
    df = spark.createDataFrame([(k, "word " * (k % 7)) for k in range(50)], "record_id bigint, text string").repartition(1)

    def made(p):
        t = p.tokens()
        yield pa.RecordBatch.from_arrays([pa.array(p.ids[t["owner"]]), pa.array(t["tok_idx"])], names=["record_id", "n"])

    got = {r.record_id: r.n for r in whole.over(df, made, "record_id bigint, n bigint").groupBy("record_id").agg(F.count("*").alias("n")).collect()}
    assert got == {k: k % 7 for k in range(50) if k % 7}


def test_what_is_null_breaks_no_rule(spark):
    kind = "array<struct<type:string,text:string,start:int,end:int,polarity:string>>"
    rows = [(1, "ab cd", [(None, "ab", 0, 2, "POS"), ("ORG", None, 0, 2, None), ("ORG", "cd", None, 5, "POS"), ("ORG", "xx", 0, 2, "POS"), ("ORG", "d", 4, 6, "POS")]), (2, None, [("ORG", "ab", 0, 2, "NEG")]), (3, "x", None), (4, "x", [])]
    got = {r.record_id: r.errors for r in records.validate(spark.createDataFrame(rows, f"record_id bigint, text string, entities {kind}")).collect()}
    assert got == {1: ["other_text", "out_of_text", "overlap"], 2: ["not_negatable"], 3: None, 4: []}


def test_relocating_works_through_more_records_than_are_held_at_once(spark):
    rows = [(k, f"to {k} of us", [("ORG", str(k)), ("ORG", "missing")]) for k in range(3 * relocate.AT_ONCE + 1)]
    df = spark.createDataFrame(rows, "record_id bigint, text string, ents array<struct<type:string,text:string>>").repartition(1)
    got = {r.record_id: ([e.text for e in r.entities], [s.text for s in r.skipped]) for r in relocate.relocate(df).collect()}
    assert got == {k: ([str(k)], ["missing"]) for k, *_ in rows}
