"""Templates, noise, relocation, scores, threshold search, reports, sources and streams."""

import hashlib
import json
import random
import re
import sqlite3
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from spanweave.functions.text import PUNCTUATION, CleanConfig
from spanweave.operators import coverage, evaluate, infer, noise, relocate, templates
from spanweave.operators.records import split_valid, validate
from spanweave.schema import BUCKETS, LABELS, RECORD
from spanweave.sources import pools as pool_source
from spanweave.sources import records as record_source
from spanweave.streaming import pipeline

ENTITIES = [("PERSON", "Ada Byron", 1.0), ("PERSON", "Max Roe", 1.0), ("ORG", "Acme", 3.0), ("ORG", "Halden", 1.0), ("ADDRESS", "1 Quay, Bergen", 1.0)] + [("COMMODITY", c, 1.0) for c in ("oak", "tin", "wool")]
DECOYS = [("number", "A-1", 1.0), ("neg_cue", "does not contain", 1.0), ("contrast_cue", ", only", 1.0)]
FORMS = [
    ("{COMMODITY#1}, {COMMODITY#2}; {COMMODITY#3} for {person}.", 1.0), ("{decoy:neg_cue} {NEG_COMMODITY#1}{decoy:contrast_cue} {COMMODITY#2}.", 1.0),
    ("{{ \"org\": \"{ORG}\" }} - {decoy:number}", 1.0), ("nothing here", 1.0),
]


@pytest.fixture(scope="module")
def made(spark):
    pools = pool_source.pool_table(pool_source.in_memory(spark, "entity_pools", ENTITIES), pool_source.in_memory(spark, "decoy_pools", DECOYS))
    forms = pool_source.in_memory(spark, "templates", FORMS)
    rows = templates.generate(spark.range(400).withColumnRenamed("id", "record_id"), forms, pools, 7)
    rows.write.mode("overwrite").parquet("/tmp/spanweave-test-made")
    return spark.read.parquet("/tmp/spanweave-test-made")


def test_generated_records_hold_their_offsets(made):
    assert validate(made).filter(F.size("errors") > 0).count() == 0
    rows = made.collect()
    assert len(rows) == 400 and {r.meta.template for r in rows} == {t for t, _ in FORMS}
    for r in rows:
        names = [e.text for e in r.entities if e.type == "COMMODITY"]
        assert len(names) == len(set(names))
        assert all(r.text[e.start : e.end] == e.text for e in r.entities)
        cues = [r.text[p.start : p.end] for p in r.meta.preserve_spans]
        assert cues == (["does not contain", ", only"] if "neg_cue" in r.meta.template else [])
        if "neg_cue" in r.meta.template:
            assert [e.polarity for e in r.entities] == ["NEG", "POS"]
        if r.meta.template.startswith("{{"):
            assert r.text.startswith('{{ "org": "') and ' }} - A-1' in r.text


def test_weighted_draw_follows_the_weights(spark, made):
    orgs = Counter(e.text for r in made.collect() for e in r.entities if e.type == "ORG")
    assert 0.6 < orgs["Acme"] / sum(orgs.values()) < 0.9
    pool = spark.createDataFrame([("p", f"v{i:03d}", w) for i, w in enumerate([5.0, 0.5, 0.25, 4.0, 0.25])], "pool string, value string, weight double")
    us = [(k, "p", (k + 0.5) / 1000) for k in range(1000)]
    got = Counter(r.value for r in templates.weighted_draw(spark.createDataFrame(us, "record_id int, pool string, u double"), pool).collect())
    assert got == {"v000": 500, "v001": 50, "v002": 25, "v003": 400, "v004": 25}


def test_values_of_a_type_are_drawn_without_replacement(spark):
    forms = pool_source.in_memory(spark, "templates", [(" ".join(f"{{PERSON#{k}}}" for k in range(20)), 1.0), ("{ORG#1} {NEG_ORG#2} {ORG#3} {ORG#4} {ORG#5}", 1.0)])
    people = [("PERSON", f"p{k:02d}", 1000.0 if k == 7 else 1.0) for k in range(40)]
    pools = pool_source.in_memory(spark, "entity_pools", [*people, *(("ORG", f"o{k}", w) for k, w in enumerate((3.0, 1.0, 1.0)))])
    rows = templates.generate(spark.range(3000).withColumnRenamed("id", "record_id"), forms, pools.withColumnRenamed("entity_type", "pool"), 5).collect()
    long = [[e.text for e in r.entities] for r in rows if len(r.entities) == 20]
    assert long and all(len(set(v)) == 20 for v in long)
    assert sum("p07" == v[0] for v in long) > 0.9 * len(long)
    others = Counter(x for v in long for x in v if x != "p07")
    assert len(others) == 39 and max(others.values()) < 1.4 * min(others.values())
    short = [[e.text for e in r.entities] for r in rows if len(r.entities) == 5]
    assert all(len(set(v[:3])) == 3 for v in short) and {x for v in short for x in v[3:]} == {"o0", "o1", "o2"}
    want = {"o0": {"o1": 0.3, "o2": 0.3}, "o1": {"o0": 0.15, "o2": 0.05}, "o2": {"o0": 0.15, "o1": 0.05}}
    pairs = Counter(tuple(v[:2]) for v in short)
    assert all(abs(pairs[a, b] / len(short) - share) < 0.03 for a, told in want.items() for b, share in told.items())


def test_a_slot_without_values_is_an_error(spark):
    forms = pool_source.in_memory(spark, "templates", [("{ORG} {decoy:none}", 1.0)])
    pools = spark.createDataFrame([("ORG", "o", 1.0)], "pool string, value string, weight double")
    with pytest.raises(Exception, match="decoy:none"):
        templates.generate(spark.range(3).withColumnRenamed("id", "record_id"), forms, pools, 5).collect()


def test_missing_pools_are_named(spark):
    forms = pool_source.in_memory(spark, "templates", FORMS)
    pools = pool_source.pool_table(pool_source.in_memory(spark, "entity_pools", ENTITIES[2:]), pool_source.in_memory(spark, "decoy_pools", DECOYS[1:]))
    assert {r.pool for r in templates.unresolved_slots(forms, pools).collect()} == {"PERSON", "decoy:number"}


ALWAYS = noise.NoiseConfig(p_lowercase=1, p_drop_punct=1, drop_punct_rate=1, p_typo=1, typo_rate=1, p_truncate=1)


@pytest.mark.parametrize("config", [noise.DEFAULT, ALWAYS])
def test_noise_keeps_labels(made, config):
    before = {r.record_id: r for r in made.collect()}
    for seed in (1, 2):
        rows = noise.apply_noise(made, seed, config)
        assert validate(rows).filter(F.size("errors") > 0).count() == 0
        for r in rows.collect():
            old = before[r.record_id]
            cues = [r.text[p.start : p.end] for p in r.meta.preserve_spans]
            assert [c.lower() for c in cues] == [old.text[p.start : p.end].lower() for p in old.meta.preserve_spans][: len(cues)]
            kept = [e.text.lower() for e in r.entities]
            assert kept == [e.text.lower() for e in old.entities][: len(kept)]


def test_assembled_records_are_sound(spark):
    from spanweave.operators.assemble import assemble

    pools = pool_source.pool_table(pool_source.in_memory(spark, "entity_pools", [*ENTITIES, ("ORG", "Two  Spaces" + chr(0x200B), 5.0)]), pool_source.in_memory(spark, "decoy_pools", DECOYS))
    sound, broken = assemble(spark.range(300).withColumnRenamed("id", "record_id"), pool_source.in_memory(spark, "templates", FORMS), pools, 3, config=ALWAYS)
    assert (sound.count(), broken.count()) == (300, 0)
    rows = sound.collect()
    assert {e.text for r in rows for e in r.entities if e.type == "ORG"} >= {"Two Spaces"} and any(r.text == r.text.lower() for r in rows)
    assert all(r.text == " ".join(r.text.split()) for r in rows)


def test_punctuation_between_neighbours(spark):
    text = "ship A, B, C done"
    row = (1, text, [("COMMODITY", text[i], i, i + 1, "POS") for i in (5, 8, 11)], (None, [], []))
    out = noise.drop_punctuation(spark.createDataFrame([row], RECORD), 3, ALWAYS).first()
    assert out.text == "ship A B C done" and [(e.text, e.start) for e in out.entities] == [("A", 5), ("B", 7), ("C", 9)]


def test_lower_case_keeps_positions(spark):
    text = chr(0x130) + "ZMIR Oak"
    row = (1, text, [("COMMODITY", "Oak", 6, 9, "POS")], (None, [], []))
    out = noise.lowercase(spark.createDataFrame([row], RECORD), 3, ALWAYS).first()
    assert out.text == chr(0x130) + "zmir oak" and out.entities[0].text == "oak"


def test_truncation_is_held_off(spark):
    text = "a long enough text without"
    row = (1, text, [], (None, [(19, 26)], []))
    out = noise.truncate(spark.createDataFrame([row], RECORD), 3, ALWAYS).first()
    assert out.text == text


def test_relocation(spark):
    rows = [
        (1, "shipment by maria gonzalez at acme trading co", [("PERSON", "Maria Gonzalez"), ("ORG", "acme trading co")]),
        (2, "tin and tin and tin", [("COMMODITY", "tin"), ("COMMODITY", "tin"), ("THING", "x"), ("ORG", ""), ("ORG", "tin and"), ("PERSON", "nobody")]),
        (3, None, None),
    ]
    got = {r.record_id: r for r in relocate.relocate(spark.createDataFrame(rows, "record_id bigint, text string, ents array<struct<type:string,text:string>>")).collect()}
    assert [(e.text, e.start) for e in got[1].entities] == [("maria gonzalez", 12), ("acme trading co", 30)]
    assert [(e.type, e.start) for e in got[2].entities] == [("COMMODITY", 0), ("COMMODITY", 8)]
    assert [(s.type, s.reason) for s in got[2].skipped] == [("THING", "unknown_type"), ("ORG", "empty"), ("PERSON", "not_found"), ("ORG", "overlap")]
    assert got[3].entities == []


SPAN = "record_id bigint, start int, end int, type string, polarity string"


def spans(spark, rows):
    return spark.createDataFrame(rows, SPAN)


def random_spans(r, n):
    out = []
    for _ in range(n):
        t, s = r.choice(("PERSON", "ORG", "COMMODITY")), r.randint(0, 6)
        out.append((r.randint(0, 5), s, s + r.randint(1, 2), t, r.choice(("POS", "NEG")) if t == "COMMODITY" else "POS"))
    return out


def plain_report(pred, gold):
    p, g = set(pred), set(gold)
    name = lambda s: f"COMMODITY({s[4]})" if s[3] == "COMMODITY" else s[3]
    out = {}
    for b in (*BUCKETS, "micro"):
        tp, fp, fn = (sum(b in (name(x), "micro") for x in part) for part in (p & g, p - g, g - p))
        pr, rc = tp / (tp + fp) if tp + fp else 0.0, tp / (tp + fn) if tp + fn else 0.0
        out[b] = (pr, rc, 2 * pr * rc / (pr + rc) if pr + rc else 0.0, tp + fn, tp + fp)
    return out


def test_scores_match_set_arithmetic(spark):
    r = random.Random(6)
    for n in (0, 3, 40):
        pred, gold = random_spans(r, n), random_spans(r, 40)
        got = {x.bucket: tuple(x)[1:] for x in evaluate.evaluate(spans(spark, pred), spans(spark, gold)).collect()}
        want = plain_report(pred, gold)
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k]) for k in want)
    f1s = [v[2] for k, v in want.items() if k != "micro" and v[3]]
    assert evaluate.macro_f1(evaluate.evaluate(spans(spark, pred), spans(spark, gold))).first()[0] == pytest.approx(sum(f1s) / len(f1s))


def peaked(label, p):
    rest = (1 - p) / 10
    return [p if i == label else rest for i in range(11)]


def probs_case():
    """Right spans at .95, and wrong B-PERSON tokens at .3."""
    tokens, gold = [], []
    for k in range(6):
        tokens += [(k, 0, 0, 3, peaked(1, 0.95)), (k, 1, 4, 7, peaked(0, 0.95)), (k, 2, 8, 11, peaked(7, 0.95)), (k, 3, 12, 15, peaked(1, 0.3))]
        gold += [(k, 0, 3, "PERSON", "POS"), (k, 8, 11, "COMMODITY", "POS")]
    return tokens, gold


def test_sweep_finds_the_gate(spark):
    tokens, gold = probs_case()
    probs = spark.createDataFrame(tokens, "record_id bigint, tok_idx int, c0 int, c1 int, probs array<double>")
    found = evaluate.sweep(probs, spans(spark, gold), step=0.2)
    assert found.feasible and found.score == pytest.approx(1.0)
    assert 0.3 <= found.thresholds["B-PERSON"] < 0.95
    assert found.curve.count() == 5 + 10 * 5
    never = evaluate.sweep(probs, spans(spark, gold + [(9, 0, 3, "ORG", "POS")]), "max_f1_at_recall_floor", step=0.5, recall_floor=0.999999)
    assert not never.feasible and never.notes
    with pytest.raises(ValueError):
        evaluate.objective("f1_best")


def random_probs(spark, n=25):
    tokens, gold = probs_case()
    r = np.random.default_rng(0)
    for k in range(n):
        runs = r.integers(0, 3) == 0  # now and then one label all along, with ties
        for i in range(10):
            p = peaked(2 if r.random() < 0.9 else 1, round(0.2 + int(r.integers(0, 8)) / 10, 1)) if runs else r.dirichlet(np.ones(11) * 0.3).tolist()
            tokens.append((20 + k, i, 4 * i, 4 * i + 3, p))
            if r.random() < 0.3:
                gold.append((20 + k, 4 * i, 4 * i + 3 + 4 * int(r.integers(0, 3)), "PERSON", "POS"))
    gold += [(90, 0, 3, "ORG", "NEG"), (91, 0, 3, "COMMODITY", "NEG"), (92, 0, 3, "THING", "POS")]
    return spark.createDataFrame(tokens, "record_id bigint, tok_idx int, c0 int, c1 int, probs array<double>"), spans(spark, gold)


def plain_scores(spark, probs, gold, limits):
    from spanweave.operators.tokens import bio_decode, gated_label

    known = gold.filter("type <> 'THING'")
    report = evaluate.evaluate(bio_decode(probs.withColumn("label_id", gated_label(F.col("probs"), limits))), known)
    rows = {r.bucket: r for r in report.collect()}
    f1s = [r.f1 for k, r in rows.items() if k != "micro" and r.support]
    return rows["micro"].f1, rows["micro"].precision, rows["micro"].recall, sum(f1s) / len(f1s)


def test_curve_equals_single_evaluations(spark):
    probs, gold = random_probs(spark)
    inputs = evaluate.gate_inputs(probs, gold)
    values = [0.7, 0.0, 0.4, 0.6, 0.5]
    for label, base in ((None, [0.0] * 11), (2, [0.0, *[0.45] * 10]), (1, [0.0, *[0.3] * 10])):
        got = {x.cand: x for x in evaluate.curve(inputs, values, "f1_macro", base, label).collect()}
        assert len(got) == len(values)
        for k, t in enumerate(values):
            limits = [0.0, *[t] * 10] if label is None else [*base[:label], t, *base[label + 1 :]]
            assert (got[k].f1, got[k].precision, got[k].recall, got[k].objective) == pytest.approx(plain_scores(spark, probs, gold, limits)), (label, t)


def test_gate_table_holds_every_pair_of_thresholds(spark):
    """Against the counts for one label's values, at random thresholds of the others."""
    probs, gold = random_probs(spark)
    inputs, values = evaluate.gate_inputs(probs, gold), evaluate.grid(0.1)
    tp, pred, support, supported = evaluate.gate_table(inputs, values)
    rng = random.Random(1)
    for label in (1, 2, 7, 10):
        places = [rng.randrange(len(values)) for _ in LABELS]
        base = [0.0, *(values[x] for x in places[1:])]
        got = {(r.bucket, r.cand): (r.tp, r.pred, r.support) for r in evaluate.count_alive(inputs, values, base, label).collect()}
        for kind in range(len(BUCKETS)):
            for cand in range(len(values)):
                at = places[:label] + [cand] + places[label + 1 :]
                b, i = at[2 * kind + 1], at[2 * kind + 2]
                assert got[kind, cand] == (tp[kind, b, i], pred[kind, b, i], support[kind])
    assert supported.sum() == gold.distinct().filter("type = 'COMMODITY' OR polarity = 'POS' AND type <> 'THING'").count()


def test_sweep_is_one_job_and_notes_labels_without_support(spark):
    tokens, gold = probs_case()
    probs = spark.createDataFrame(tokens, "record_id bigint, tok_idx int, c0 int, c1 int, probs array<double>")
    spark.sparkContext.setJobGroup("sweep", "sweep")
    found = evaluate.sweep(probs, spans(spark, gold), step=0.1)
    scans = [j for j in spark.sparkContext.statusTracker().getJobIdsForGroup("sweep")]
    spark.sparkContext.setJobGroup("rest", "rest")
    assert len(scans) < 11  # adaptive execution runs every stage as a job of its own; there is one action
    held = {("B-" + ("NEG_" if p == "NEG" else "") + t) for _, _, _, t, p in gold}
    missing = [x for x in LABELS if x.startswith("B-") and x not in held]
    assert missing and [n.split()[0] for n in found.notes if "no gold spans" in n] == missing


def test_sweep_is_the_search_one_by_one(spark):
    probs, gold = random_probs(spark, 6)
    found = evaluate.sweep(probs, gold, step=0.5)
    values, limits, best = evaluate.grid(0.5), None, -2.0
    for t in values:
        got = plain_scores(spark, probs, gold, [0.0, *[t] * 10])[0]
        if got > best + 1e-12:
            best, limits = got, [0.0, *[t] * 10]
    for k in range(1, 11):
        tried = [(plain_scores(spark, probs, gold, [*limits[:k], t, *limits[k + 1 :]])[0], t) for t in values]
        top = max(tried, key=lambda x: (x[0], -x[1]))
        if top[0] > best + 1e-12:
            best, limits = top[0], [*limits[:k], top[1], *limits[k + 1 :]]
    assert found.score == pytest.approx(best) and [0.0, *found.thresholds.values()] == limits


def test_serving_path(spark):
    rows = [(1, "   "), (2, "  Ada" + chr(0x200B) + "   ships 9t"), (3, None), (4, "x " * 300 + "Zed")]
    got = {r.record_id: r.entities for r in infer.predict(spark.createDataFrame(rows, "record_id bigint, text string"), infer.toy_scorer).collect()}
    assert got[1] == got[3] == got[4] == []
    assert [(e.type, e.text, e.start) for e in got[2]] == [("PERSON", "Ada", 2), ("COMMODITY", "9t", 15)]
    for config in (CleanConfig(trim=False), CleanConfig(collapse_whitespace=False), CleanConfig(trim=False, collapse_whitespace=False), CleanConfig(nfc_normalize=True)):
        again = infer.predict(spark.createDataFrame(rows, "record_id bigint, text string"), infer.toy_scorer, config=config).filter("record_id = 2").first().entities
        assert [(e.type, e.text, e.start) for e in again] == [("PERSON", "Ada", 2), ("COMMODITY", "9t", 15)]


def test_reports(spark):
    records = spark.createDataFrame([(k, f"text {k % 3} same words here", "s" + str(k % 2), "dev" if k % 2 else "test") for k in range(40)], "record_id bigint, text string, source string, split string")
    found = spans(spark, [(k, 0, 4, "PERSON", "POS") for k in range(30)] + [(k, 5, 6, "COMMODITY", "NEG") for k in range(10)])
    sides = coverage.stratified_split(records, found, "x").collect()
    by = Counter((r.stratum, r.side) for r in sides)
    assert len(sides) == 40 and all(abs(by[s, "dev"] - by[s, "test"]) <= 1 for s, _ in by)
    pairs = {(r.type_a, r.type_b): r.records for r in coverage.cooccurrence(found).collect()}
    assert pairs == {("COMMODITY", "PERSON"): 10}
    assert {r.bucket: r.records for r in coverage.polarity_buckets(records, found).collect()} == {"neg_only": 10, "no_commodity": 30}
    mix = coverage.source_mix(records, {"s0": 0.6}).collect()
    assert {r.source: r.gap for r in mix} == {"s0": pytest.approx(-0.1), "s1": None}
    groups = {r.record_id: r.side for r in coverage.group_split(records, "source", "g").collect()}
    assert len({(k % 2, v) for k, v in groups.items()}) == 2


def test_near_duplicates_match_all_pairs(spark):
    r = random.Random(8)
    base = [" ".join(r.choices([f"w{i}" for i in range(60)], k=25)) for _ in range(12)]
    texts = base + [" ".join(t.split()[:-1] + [r.choice(["w1", "zz"])]) for t in base] + [base[0], ""]
    left = spark.createDataFrame(list(enumerate(texts)), "record_id bigint, text string")
    got = {(x.left_set, x.right_set) for x in coverage.token_jaccard_pairs(left, left).collect()}
    ids = {x.record_id: x.set_id for x in coverage.token_set_members(left).collect()}
    sets = [set(t.lower().split()) for t in texts]
    want = {(ids[i], ids[j]) for i in range(len(texts)) for j in range(len(texts)) if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.9}
    assert got == want


def test_jaccard_join_of_hot_tokens_alone(spark, monkeypatch):
    """Twelve tokens in all, each in half of the sets: every prefix is of tokens that are dealt over a grid."""
    monkeypatch.setattr(coverage, "CELL_ROWS", 20)
    rng = random.Random(3)
    words = [f"w{k}" for k in range(12)]
    sets = [frozenset(rng.sample(words, rng.randint(5, 12))) for _ in range(300)]
    df = spark.createDataFrame([(k, " ".join(rng.sample(sorted(s), len(s)))) for k, s in enumerate(sets)], "record_id long, text string")
    order = coverage.token_order(df)
    assert max(2 ** (b / 8) for b in order) / 20 > 4 and len(order) == coverage.ORDER_BUCKETS
    named = {r.set_id: sets[r.record_id] for r in coverage.token_set_members(df).collect()}
    for least in (0.5, 0.8):
        got = coverage.token_jaccard_pairs(df.filter("record_id < 200"), df.filter("record_id >= 100"), least).collect()
        pairs = {(named[r.left_set], named[r.right_set]) for r in got}
        assert len(pairs) == len(got)
        assert pairs == {(a, b) for a in sets[:200] for b in sets[100:] if len(a & b) / len(a | b) >= least}
        assert all(r.jaccard == round(len(named[r.left_set] & named[r.right_set]) / len(named[r.left_set] | named[r.right_set]), 6) for r in got)


def test_jaccard_join_of_many_candidates_and_odd_texts(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a b c"), (2, "a b d"), (3, None), (4, ""), (5, "a b c"), (6, "c b a")], "record_id long, text string")
    few = coverage.token_jaccard_pairs(df, df, 0.5).collect()
    monkeypatch.setattr(coverage, "KEYS_SENT", 0)  # by a shuffle
    assert sorted(few) == sorted(coverage.token_jaccard_pairs(df, df, 0.5).collect()) and len(few) == 4
    plan = coverage.token_jaccard_pairs(df, df)._jdf.queryExecution().toString()
    assert "Window" not in plan and "collect_list" not in plan


def test_kappa_of_known_matrix(spark):
    a = spark.createDataFrame([(1, i, int(i < 25)) for i in range(50)], "record_id int, tok_idx int, label_id int")
    b = spark.createDataFrame([(1, i, int(i < 20 or i >= 40)) for i in range(50)], "record_id int, tok_idx int, label_id int")
    got = coverage.kappa(a, b).first()
    po, pe = 35 / 50, (25 * 30 + 25 * 20) / 2500
    assert got.agreement == pytest.approx(po) and got.kappa == pytest.approx((po - pe) / (1 - pe))


def test_sources(spark, made, tmp_path):
    record_source.write_jsonl(made, f"{tmp_path}/r")
    assert record_source.read_jsonl(spark, f"{tmp_path}/r").count() == 400
    gold = record_source.load_gold(spark)
    assert split_valid(gold)[1].count() == 0 and gold.count() == 5
    (tmp_path / "lines").write_text("a\n\n  \nb\n")
    assert record_source.read_lines(spark, f"{tmp_path}/lines").count() == 2
    record_source.save_config(CleanConfig(trim=False), f"{tmp_path}/c.json")
    assert record_source.load_config(f"{tmp_path}/c.json") == CleanConfig(trim=False) and record_source.load_config(f"{tmp_path}/none") == CleanConfig()
    record_source.save_thresholds({"B-ORG": 0.5}, f"{tmp_path}/t.json")
    assert record_source.load_thresholds(f"{tmp_path}/t.json")[LABELS.index("B-ORG")] == 0.5 and record_source.load_thresholds(f"{tmp_path}/none") is None
    tables = {"entity_pools": pool_source.in_memory(spark, "entity_pools", [*ENTITIES, ("ORG", "O'Hara", 1.0)]), "decoy_pools": pool_source.in_memory(spark, "decoy_pools", DECOYS), "templates": pool_source.in_memory(spark, "templates", FORMS)}
    db = sqlite3.connect(tmp_path / "p.db")
    for name, ddl in pool_source.TABLES.items():
        db.execute(f"CREATE TABLE {name} ({ddl}, UNIQUE({', '.join(c.split()[0] for c in ddl.split(', ')[:-1])}))")
        for _ in range(2):
            for statement in pool_source.insert_statements(name, tables[name]):
                db.execute(statement)
    db.commit()
    back = pool_source.from_sqlite(spark, f"{tmp_path}/p.db")
    assert {k: v.count() for k, v in back.items()} == {k: v.count() for k, v in tables.items()}
    assert pool_source.to_parquet(back, f"{tmp_path}/pools") == {"entity_pools": 9, "decoy_pools": 3, "templates": 4}
    pool_source.check(pool_source.from_parquet(spark, f"{tmp_path}/pools")["entity_pools"], tables["templates"])
    with pytest.raises(ValueError):
        pool_source.check(tables["entity_pools"].filter("entity_type = 'ORG'"), tables["templates"])
    with pytest.raises(ValueError):
        pool_source.in_memory(spark, "entity_pools", [("THING", "x", 1.0)])
    with pytest.raises(FileNotFoundError):
        pool_source.from_sqlite(spark, f"{tmp_path}/absent.db")
    pool_source.dump(tables["entity_pools"], tables["decoy_pools"], f"{tmp_path}/d.json")
    assert json.loads((tmp_path / "d.json").read_text())["decoy_pools"]["number"] == [["A-1", 1.0]]


def test_stream_equals_batch(spark, made, tmp_path):
    made.select("record_id", F.concat(F.lit("  "), "text").alias("text")).write.parquet(f"{tmp_path}/in")
    rows = spark.read.parquet(f"{tmp_path}/in")
    stream = pipeline.clean_stream(pipeline.read_records(spark, f"{tmp_path}/in", rows.schema))
    pipeline.run_available(stream, f"{tmp_path}/out", f"{tmp_path}/check")
    from spanweave.operators.clean import clean_records

    assert sorted(spark.read.parquet(f"{tmp_path}/out").collect()) == sorted(clean_records(rows).collect())
    events = spark.createDataFrame([(k, "2024-01-01 00:00:00" if k < 5 else "2024-06-01 00:00:00", "a") for k in range(6)], "i int, t string, k string").select("i", F.to_timestamp("t").alias("ts"), "k")
    events.write.parquet(f"{tmp_path}/ev")
    counted = pipeline.daily_counts(pipeline.read_records(spark, f"{tmp_path}/ev", events.schema, 1), "ts", "k")
    pipeline.run_available(counted, f"{tmp_path}/evout", f"{tmp_path}/evcheck")
    assert {r.n for r in spark.read.parquet(f"{tmp_path}/evout").collect()} <= {5}
    days = spark.createDataFrame([("2024-01-01", "a", 2), ("2024-01-31", "a", 3), ("2024-02-01", "a", 4)], "d string, k string, n long").select(F.to_date("d").alias("day"), "k", "n")
    assert {(str(r.month), r.n) for r in pipeline.monthly_counts(days, "k").collect()} == {("2024-01-01", 5), ("2024-02-01", 4)}


def number(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16)


def share(*parts):
    return (number(*parts) + 0.5) / 2**32


def plain_noise(k, text, spans, cues, seed):
    """One record through the four steps, character by character; spans and cues as lists of [start, end]."""
    config = noise.DEFAULT

    def delete(gone):
        nonlocal text, spans, cues
        before = lambda p: sum(g < p for g in gone)
        text = "".join(c for i, c in enumerate(text) if i not in gone)
        spans = [(before_s, before_e, *rest) for s, e, *rest in spans if (before_s := s - before(s)) < (before_e := e - before(e))]
        cues = [(a, b) for s, e in cues if (a := s - before(s)) < (b := e - before(e))]

    held = lambda i: any(s <= i < e for s, e, *_ in [*spans, *cues])
    if share(seed, k, "lowercase") < config.p_lowercase:
        text = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    if share(seed, k, "drop_punct") < config.p_drop_punct:
        delete({i for i, c in enumerate(text) if c in PUNCTUATION and share(seed, k, "punct", i) < config.drop_punct_rate and not held(i)})
    if share(seed, k, "typo") < config.p_typo:
        text = "".join("abcdefghijklmnopqrstuvwxyz"[number(seed, k, "letter", i) % 26] if c.isalpha() and share(seed, k, "typo", i) < config.typo_rate and not held(i) else c for i, c in enumerate(text))
    cut = len(text) - 1 - number(seed, k, "cut") % config.truncate_max_chars
    if share(seed, k, "truncate") < config.p_truncate and len(text) > 10 and not any(s < cut < e for s, e, *_ in spans) and not any(s <= cut < e for s, e in cues):
        delete(set(range(cut, len(text))))
    return text, spans


def test_assembling_matches_a_plain_loop(spark):
    from spanweave.operators.assemble import assemble

    pools = pool_source.pool_table(pool_source.in_memory(spark, "entity_pools", [*ENTITIES, ("ORG", "Two  Spaces", 2.0)]), pool_source.in_memory(spark, "decoy_pools", DECOYS))
    forms, ids = pool_source.in_memory(spark, "templates", FORMS), spark.range(500).withColumnRenamed("id", "record_id")
    got = {r.record_id: (r.text, [(e.start, e.end, e.type, e.polarity, e.text) for e in r.entities]) for r in assemble(ids, forms, pools, 11)[0].collect()}
    made = templates.generate(ids, forms, pools, 11).collect()
    for r in made:
        text, found = r.text, [(e.start, e.end, e.type, e.polarity) for e in r.entities]
        if share(12, r.record_id, "noise") < 0.6:
            text, found = plain_noise(r.record_id, text, found, [(p.start, p.end) for p in r.meta.preserve_spans], 12)
        places, clean_ = [], ""
        for i, c in enumerate(text):
            if c != " " or clean_[-1:] not in ("", " "):
                clean_, places = clean_ + c, [*places, i]
        clean_ = clean_.rstrip(" ")
        moved = [(sum(p < s for p in places), sum(p < e for p in places), t, p) for s, e, t, p in found]
        assert got[r.record_id] == (clean_, [(s, e, t, p, clean_[s:e]) for s, e, t, p in moved if s < e])
    assert len(got) == len(made) == 500


def test_assembling_to_files(spark, tmp_path):
    from spanweave.operators.assemble import assemble_to_files

    tables = {"entity_pools": pool_source.in_memory(spark, "entity_pools", ENTITIES), "decoy_pools": pool_source.in_memory(spark, "decoy_pools", DECOYS), "templates": pool_source.in_memory(spark, "templates", FORMS)}
    config = CleanConfig(trim=False)
    path = assemble_to_files(spark.range(60).withColumnRenamed("id", "record_id"), tables, str(tmp_path), 3, cleaning=config)
    assert record_source.read_jsonl(spark, path).count() == 60
    assert record_source.load_config(f"{tmp_path}/{record_source.SIDECAR}") == config


def test_seed_contract_and_sql_files(spark, tmp_path):
    tables = {"entity_pools": pool_source.in_memory(spark, "entity_pools", ENTITIES), "decoy_pools": pool_source.in_memory(spark, "decoy_pools", DECOYS), "templates": pool_source.in_memory(spark, "templates", FORMS)}
    slots = ("number", "neg_cue", "contrast_cue")
    told = pool_source.seed_contract(*tables.values(), slots)
    assert told == {"entity_pools": {"PERSON": 2, "ORG": 2, "ADDRESS": 1, "COMMODITY": 3}, "decoy_pools": dict.fromkeys(slots, 1), "templates": 4}
    odd = pool_source.in_memory(spark, "templates", [("{decoy} {decoy:gone} {THING} {NEG_THING}", 1.0)])
    with pytest.raises(ValueError) as e:
        pool_source.seed_contract(tables["entity_pools"].filter("entity_type <> 'ORG'"), tables["decoy_pools"], odd, ("number", "title"))
    for what in ("empty entity pool: ORG", "missing decoy pool: title", "undeclared decoy pool: contrast_cue", "decoy without a name", "unknown decoy: gone", "unknown entity type: THING"):
        assert what in str(e.value)
    with pytest.raises(ValueError, match="no templates"):
        pool_source.seed_contract(tables["entity_pools"], tables["decoy_pools"], tables["templates"].limit(0), slots)
    files = []
    for name, df in tables.items():
        files.append(str(tmp_path / f"{name}.sql"))
        (tmp_path / f"{name}.sql").write_text("\n".join(pool_source.insert_statements(name, df)) * 2)
    back = pool_source.from_sql_files(spark, f"{tmp_path}/store/p.db", files, f"{tmp_path}/store/parquet")
    assert {k: sorted(v.collect()) for k, v in back.items()} == {k: sorted(v.collect()) for k, v in tables.items()}
    pool_source.build_sqlite(f"{tmp_path}/store/p.db", files[:1])
    assert pool_source.from_sqlite(spark, f"{tmp_path}/store/p.db")["templates"].count() == 0


def test_artifact_folder_and_lines(spark, tmp_path, monkeypatch):
    bare = infer.from_artifact_dir(str(tmp_path))
    assert bare.thresholds is None and bare.config == CleanConfig() and (bare.intra_threads, bare.inter_threads) == (2, 1)
    record_source.save_thresholds({"B-PERSON": 0.99}, f"{tmp_path}/{record_source.THRESHOLDS}")
    record_source.save_config(CleanConfig(trim=False), f"{tmp_path}/{record_source.SIDECAR}")
    monkeypatch.setenv("ORT_INTRA_OP", "4")
    told = infer.from_artifact_dir(str(tmp_path))
    assert told.intra_threads == 4 and told.config == CleanConfig(trim=False) and told.thresholds[1] == 0.99
    rows = spark.createDataFrame([(1, " Ada 9t")], "record_id bigint, text string")
    assert [e.text for e in infer.predict_with(rows, told, lambda a: infer.toy_scorer()).first().entities] == ["9t"]
    lines = [json.loads(r.value) for r in infer.predict_lines(rows.select("text"), infer.toy_scorer, report_latency=True).collect()]
    assert [e["text"] for e in lines[0]["entities"]] == ["Ada", "9t"] and lines[0]["latency_ms"] >= 0


def test_latency_of_every_line(spark):
    """The scorer waits a millisecond a token: long lines take longer, and the quantiles say so."""

    def slow():
        inner = infer.toy_scorer()

        def score(batch):
            time.sleep(sum(map(len, batch)) / 1000)
            return inner(batch)

        return score

    texts = ["Ada", "", " ", None] + ["Ada ships 9t"] * 40 + ["Ada " * 60] * 4
    lines = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    seen = Observation("latency")
    got = [json.loads(r.value) for r in infer.predict_lines(lines, slow, report_latency=True, observed=seen).collect()]
    plain = [json.loads(r.value) for r in infer.predict_lines(lines, infer.toy_scorer).collect()]
    strip = lambda rows: sorted(json.dumps({k: v for k, v in r.items() if k != "latency_ms"}, sort_keys=True) for r in rows)
    assert strip(got) == strip(plain) and all("latency_ms" not in r for r in plain)
    times = [r["latency_ms"] for r in got]
    assert seen.get["lines"] == len(texts) and 0 < seen.get["p50_ms"] <= seen.get["p99_ms"] <= seen.get["max_ms"]
    assert seen.get["max_ms"] == pytest.approx(max(times), abs=0.01) and sorted(times)[len(times) // 2 - 1] <= seen.get["p50_ms"] + 0.01
    assert [r["latency_ms"] for r in got if not (r.get("text") or "").strip()] == [0.0] * 3
    assert max(times) > 3 * sorted(times)[len(times) // 2]


def plain_locate(text, wanted):
    """Surfaces in order, each from the end of its type's last one, by regular expressions."""
    after, found, reasons = {}, [], []
    for kind, surface, polarity in wanted:
        if kind not in ("PERSON", "ORG", "ADDRESS", "COMMODITY"):
            reasons.append((kind, "unknown_type"))
        elif not surface:
            reasons.append((kind, "empty"))
        else:
            at = after.get(kind, 0)
            m = re.compile(re.escape(surface)).search(text, at) or re.compile(re.escape(surface), re.I).search(text, at)
            if not m:
                reasons.append((kind, "not_found"))
            elif polarity == "NEG" and kind != "COMMODITY" or polarity == "MAYBE":
                reasons.append((kind, "span_invalid"))
            else:
                after[kind] = m.end()
                found.append((m.start(), m.end(), kind, polarity))
    kept = []
    for x in sorted(found, key=lambda x: x[:2]):
        if kept and x[0] < kept[-1][1]:
            reasons.append((x[2], "overlap"))
        else:
            kept.append(x)
    return kept, reasons


def test_relocation_matches_a_plain_loop(spark):
    r = random.Random(3)
    words = ["tin", "Tin", "oak", "OAK", "ash wood", "Ash", "x"]
    rows = []
    for k in range(300):
        text = " ".join(r.choices(words, k=r.randint(0, 12)))
        rows.append((k, text, [(r.choice(("PERSON", "ORG", "COMMODITY", "THING")), r.choice([*words, "", "none such"]), r.choice(("POS", "POS", "NEG", "MAYBE"))) for _ in range(r.randint(0, 6))]))
    df = spark.createDataFrame(rows, "record_id bigint, text string, ents array<struct<type:string,text:string,polarity:string>>")
    got = {x.record_id: x for x in relocate.relocate(df).collect()}
    for k, text, wanted in rows:
        kept, reasons = plain_locate(text, wanted)
        assert [(e.start, e.end, e.type, e.polarity) for e in got[k].entities] == kept and [(s.type, s.reason) for s in got[k].skipped] == reasons
        assert all(text[e.start : e.end] == e.text for e in got[k].entities)
    with pytest.raises(Exception, match="nothing could be located"):
        relocate.relocate(df.limit(50), must_find=True).collect()
