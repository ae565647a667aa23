"""Cleaning, character maps, tokens, BIO codes, checks: against straight-line versions."""

import random
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanweave.functions.text import ZERO_WIDTH, CleanConfig, char_map, clean
from spanweave.operators.clean import clean_and_project, clean_records, project_to_clean, project_to_original, with_char_map
from spanweave.operators.records import (
    duplicate_keys,
    from_json,
    guarded_merge,
    has_overlap,
    insert_ignore,
    keep_first,
    orphans,
    split_valid,
    to_json,
    validate,
)
from spanweave.operators.tokens import bio_decode, bio_encode, gated_label, softmax, subword_tokens, whitespace_tokens
from spanweave.schema import LABELS, RECORD, label_dim

WHITE = {0x20, 9, 10, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}
ALPHABET = list("ab A.,") + [chr(c) for c in (9, 10, 11, 12, 13, 0x1C, 0x1F, 0x7F, 0x85, 0xA0, 0x200B, 0xFEFF, 0xAD, 0x2003, 0x3000, 0x130, 0x1F600, 0xE9)]


def plain_clean(text, config=CleanConfig()):
    """(text, positions) one character at a time."""
    rare = {0x0B, 0x0C, *range(0x1C, 0x20)}
    out, places, before = [], [], False
    for i, c in enumerate(text):
        o = ord(c)
        if config.strip_zero_width and c in ZERO_WIDTH or config.strip_control_chars and (o == 0x7F or (o < 32 and c not in "\t\n\r")):
            continue
        white = o in WHITE or o in rare
        if config.collapse_whitespace and white:
            if before:
                continue
            c = " "
        elif config.normalize_whitespace and o in (9, 0x0B, 0x0C, 0x0D, 0xA0, 0x2007, 0x202F, 0x3000):
            c = " "
        before = white
        out.append(c)
        places.append(i)
    blank = lambda c: ord(c) in WHITE or ord(c) in rare
    while config.trim and out and blank(out[0]):
        out.pop(0)
        places.pop(0)
    while config.trim and out and blank(out[-1]):
        out.pop()
        places.pop()
    return "".join(out), places


TEXTS = [
    "", "   \t  ", "hello" + chr(0x200B) + "world" + chr(0x200D) + "!", "Acme    Trading\t\tCo.", "   hello world   ", "a" + chr(11) + "b" + chr(12) + "c" + chr(0x1C),
    "line one\nline two\r\nend", "x " + chr(0x200B) + " y", chr(0x1F600) + " Acme", chr(0x130) + "stanbul",
]


def test_clean_and_map_match_the_loop(spark):
    r = random.Random(1)
    texts = TEXTS + ["".join(r.choices(ALPHABET, k=r.randint(0, 40))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for row in df.select("i", clean(F.col("text")).alias("c"), char_map(F.col("text")).alias("m")).collect():
        assert (row.c, row.m) == plain_clean(texts[row.i])


def test_clean_and_map_under_every_switch(spark):
    r = random.Random(2)
    texts = [" a  b ", *TEXTS] + ["".join(r.choices(ALPHABET, k=r.randint(0, 30))) for _ in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for bits in range(32):
        config = CleanConfig(*(bool(bits >> k & 1) for k in range(5)))
        for row in with_char_map(df, config).collect():
            assert (row.clean_text, row.char_map) == plain_clean(texts[row.i], config), (config, texts[row.i])


def test_projection_of_records_under_switches(spark):
    text = "  Ada" + chr(0x200B) + "  ships   9 t "
    row = (1, text, [("PERSON", "Ada", 2, 5, "POS"), ("COMMODITY", "9 t", 16, 19, "POS")], (None, [(8, 13)], []))
    for config in (CleanConfig(), CleanConfig(trim=False), CleanConfig(collapse_whitespace=False), CleanConfig(False, False, False, False, False), CleanConfig(nfc_normalize=True)):
        got = clean_and_project(spark.createDataFrame([row], RECORD), config).first()
        assert got.text == plain_clean(text, config)[0]
        assert [got.text[e.start : e.end] for e in got.entities] == [e.text for e in got.entities] == ["Ada", "9 t"]
        assert [got.text[p.start : p.end] for p in got.meta.preserve_spans] == ["ships"]
    assert clean_and_project(spark.createDataFrame([(2, " " + chr(0x200B), [], (None, [], []))], RECORD)).count() == 0


@given(st.lists(st.text(st.sampled_from(ALPHABET), max_size=30), min_size=1, max_size=30))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_clean_twice_is_clean_once(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in df.select(clean(F.col("text")).alias("a"), clean(clean(F.col("text"))).alias("b")).collect():
        assert row.a == row.b


def test_switches(spark):
    df = spark.createDataFrame([(" a" + chr(0x200B) + "\tb  c" + chr(1) + " ",)], "text string")
    off = CleanConfig(False, False, False, False, False)
    assert df.select(clean(F.col("text"), off)).first()[0] == df.first()[0]
    only = CleanConfig(collapse_whitespace=False)
    assert df.select(clean(F.col("text"), only)).first()[0] == "a b  c"
    assert clean_records(spark.createDataFrame([("e" + chr(0x301),), ("  ",)], "text string"), CleanConfig(nfc_normalize=True)).collect()[0][0] == unicodedata.normalize("NFC", "e" + chr(0x301))


def test_projection_both_ways(spark):
    raw = "  Maria  Gonzalez   from Acme Trading Co.  "
    text, places = plain_clean(raw)
    df = spark.createDataFrame([(raw, [(0, 14), (20, 36), (2, 2), (0, 100)])], "raw string, spans array<struct<start:int,end:int>>")
    moved = df.withColumn("m", char_map(F.col("raw"))).withColumn("o", project_to_original("m", F.length("raw"), "spans"))
    back = moved.withColumn("b", project_to_clean(char_map(F.col("raw")), F.length("raw"), "o")).first()
    assert [(s.start, s.end) if s else None for s in back.o] == [(2, 17), (25, 41), None, None]
    assert [(s.start, s.end) if s else None for s in back.b] == [(0, 14), (20, 36), None, None]
    assert text[20:36] == "Acme Trading Co." and places[0] == 2


def test_map_through_composition(spark):
    text = "a  e" + chr(0x301) + "e" + chr(0x301) + chr(0x323) + "x"
    got = with_char_map(spark.createDataFrame([(text,), ("",)], "text string"), CleanConfig(nfc_normalize=True)).collect()
    want = unicodedata.normalize("NFC", "a " + text[3:])
    assert got[0].clean_text == want and got[0].char_map == [0, 1, 3] + [5] * (len(want) - 4) + [8] and got[1].char_map == []


def test_subword_tokens(spark):
    import public_tokenizers

    text = "Ada " + chr(0x1F600) + " ships wool"
    rows = sorted(subword_tokens(spark.createDataFrame([(1, text), (2, None)], "record_id bigint, text string"), public_tokenizers.path("byte_bpe_50k.json"), 6).collect())
    mine = [r for r in rows if r.record_id == 1]
    assert len(mine) == 6 and (mine[0].c0, mine[0].c1, mine[-1].c0, mine[-1].c1) == (0, 0, 0, 0) and text[mine[1].c0 : mine[1].c1] == "Ad"
    assert len(rows) == 8


def plain_encode(tokens, spans):
    labels = [-100 if (a, b) == (0, 0) else 0 for a, b in tokens]
    for s, e, t, p in sorted(spans):
        name, first = ("NEG_" if p == "NEG" else "") + t, True
        for i, (a, b) in enumerate(tokens):
            if labels[i] != -100 and a < e and b > s:
                labels[i] = LABELS.index(("B-" if first else "I-") + name)
                first = False
    return labels


def plain_decode(tokens, labels, strict):
    spans, now = [], None
    for (a, b), x in zip(tokens, labels):
        if x == -100 or (a, b) == (0, 0):
            continue
        label = LABELS[x] if 0 <= x < 11 else "O"
        if label == "O":
            now = None
        elif label[0] == "B" or now is None or now[0] != label[2:]:
            now = [label[2:], a, b, label[0] == "B" or not strict]
            spans.append(now)
        else:
            now[2] = b
    return sorted((s, e, k.removeprefix("NEG_"), "NEG" if k.startswith("NEG_") else "POS") for k, s, e, ok in spans if ok)


def random_case(r):
    tokens, at = [(0, 0)], 0
    for _ in range(r.randint(1, 14)):
        n = r.randint(1, 5)
        tokens.append((at, at + n))
        at += n + 1
        if r.random() < 0.1:
            tokens.append((0, 0))
    spans = set()
    for _ in range(r.randint(0, 5)):
        s = r.randint(0, at - 1)
        t = r.choice(("PERSON", "ORG", "COMMODITY"))
        spans.add((s, s + r.randint(1, 9), t, r.choice(("POS", "NEG")) if t == "COMMODITY" else "POS"))
    return tokens, sorted(spans)


def test_bio_matches_the_loops(spark):
    r = random.Random(4)
    cases = [random_case(r) for _ in range(250)]
    tokens = spark.createDataFrame([(k, i, a, b) for k, (t, _) in enumerate(cases) for i, (a, b) in enumerate(t)], "record_id bigint, tok_idx int, c0 int, c1 int")
    spans = spark.createDataFrame([(k, *s) for k, (_, ss) in enumerate(cases) for s in ss], "record_id bigint, start int, end int, type string, polarity string")
    got = {}
    for row in bio_encode(tokens, spans).collect():
        got[row.record_id, row.tok_idx] = row.label_id
    for k, (t, ss) in enumerate(cases):
        assert [got[k, i] for i in range(len(t))] == plain_encode(t, ss)
    noisy = [[r.choice((-100, 99, *range(11))) for _ in t] for t, _ in cases]
    labels = spark.createDataFrame([(k, i, a, b, noisy[k][i]) for k, (t, _) in enumerate(cases) for i, (a, b) in enumerate(t)], "record_id bigint, tok_idx int, c0 int, c1 int, label_id int")
    for strict in (False, True):
        found = {}
        for row in bio_decode(labels, strict).collect():
            found.setdefault(row.record_id, []).append((row.start, row.end, row.type, row.polarity))
        for k, (t, _) in enumerate(cases):
            assert sorted(found.get(k, [])) == plain_decode(t, noisy[k], strict)


def test_whitespace_tokens_are_slices(spark):
    text = "a bb " + chr(0x1F600) + "c  d"
    rows = whitespace_tokens(spark.createDataFrame([(1, text), (2, "")], "record_id bigint, text string")).collect()
    assert [(r.tok_idx, r.token) for r in sorted(rows)] == [(0, "a"), (1, "bb"), (2, chr(0x1F600) + "c"), (4, "d")]
    assert all(text[r.c0 : r.c1] == r.token for r in rows)


def test_gate_and_softmax(spark):
    rows = [([0.05, 0, 0, 0, 0, 0, 0, 0.95, 0, 0, 0], 7), ([0.6, 0, 0, 0, 0, 0, 0, 0.4, 0, 0, 0], 0), ([0.45, 0.55, 0, 0, 0, 0, 0, 0, 0, 0, 0], 0), ([0.5, 0.5, 0, 0, 0, 0, 0, 0, 0, 0, 0], 0)]
    limits = [0.0, 0.8, 0, 0, 0, 0, 0, 0.5, 0, 0, 0]
    df = spark.createDataFrame([([float(x) for x in p], w) for p, w in rows], "p array<double>, want int")
    assert all(r[0] == r[1] for r in df.select(gated_label(F.col("p"), [float(x) for x in limits]), "want").collect())
    got = df.select(softmax(F.array(F.lit(1.0), F.lit(1.0), F.lit(1000.0)))).first()[0]
    assert got == pytest.approx([0, 0, 1])


def rec(k, text, *entities):
    return (k, text, [(t, x, s, e, p) for t, x, s, e, p in entities], (None, [], []))


def test_validation(spark):
    good = rec(1, "Ada at Acme", ("PERSON", "Ada", 0, 3, "POS"), ("ORG", "Acme", 7, 11, "POS"))
    bad = [
        rec(2, "abc", ("PERSON", "abc", 0, 3, "MAYBE")), rec(3, "abc", ("PERSON", "abc", 0, 3, "NEG")), rec(4, "abc", ("PERSON", "abd", 0, 3, "POS")),
        rec(5, "abcdef", ("ORG", "abcd", 0, 4, "POS"), ("ORG", "cdef", 2, 6, "POS")), rec(6, "abc", ("PERSON", "abc", 0, 30, "POS")), rec(7, "abc", ("THING", "a", 0, 1, "POS")),
        rec(8, "abc", ("PERSON", "a", -1, 1, "POS")), rec(9, "abc", ("PERSON", "", 1, 1, "POS")),
    ]
    df = spark.createDataFrame([good, *bad], RECORD)
    told = {r.record_id: r.errors for r in validate(df).collect()}
    assert told == {1: [], 2: ["unknown_polarity"], 3: ["not_negatable"], 4: ["other_text"], 5: ["overlap"], 6: ["out_of_text"], 7: ["unknown_type"], 8: ["negative_start"], 9: ["empty_span"]}
    sound, broken = split_valid(df)
    assert (sound.count(), broken.count()) == (1, 8)
    touching = spark.createDataFrame([([(0, 3), (3, 5)],), ([(3, 5), (0, 4)],), ([],)], "entities array<struct<start:int,end:int>>")
    assert [r[0] for r in touching.select(has_overlap(F.col("entities"))).collect()] == [False, True, False]


def test_json_and_defaults(spark):
    df = spark.createDataFrame([rec(1, "no oak", ("COMMODITY", "oak", 3, 6, "NEG"))], RECORD)
    back = from_json(to_json(df)).select("text", "entities").collect()
    assert back == df.select("text", "entities").collect()
    lines = spark.createDataFrame([('{"text": "x", "entities": [{"type": "ORG", "text": "x", "start": 0, "end": 1}]}',), ("  ",), ('{"text": "y"}',)], "value string")
    got = {r.text: r.entities for r in from_json(lines).collect()}
    assert got["x"][0].polarity == "POS" and got["y"] == []


def test_store_rules(spark):
    target = spark.createDataFrame([(1, "a", None), (2, "b", "t")], "id int, v string, locked_at string")
    free = spark.createDataFrame([(1, "A", None), (3, "c", None)], "id int, v string, locked_at string")
    assert sorted(r.v for r in guarded_merge(free, target).collect()) == ["A", "b", "c"]
    with pytest.raises(ValueError, match="immutable"):
        guarded_merge(free.withColumn("id", F.lit(2)), target)
    assert insert_ignore(free, target, "id").count() == 3
    rows = spark.createDataFrame([("x", 2), ("x", 1), ("y", 3)], "k string, o int")
    assert sorted(map(tuple, keep_first(rows, "k", "o").collect())) == [("x", 1), ("y", 3)]
    assert duplicate_keys(rows, "k").collect()[0].k == "x"
    assert [r.o for r in orphans(rows, spark.createDataFrame([("x",)], "name string"), "k", "name").collect()] == [3]


def test_label_contract(spark):
    rows = label_dim(spark).collect()
    assert [r.label for r in sorted(rows)] == list(LABELS) and rows[9].polarity == "NEG" and rows[9].type == "COMMODITY"
