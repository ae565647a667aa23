"""Cleaning and its maps over many texts."""

from __future__ import annotations

import itertools
import random
import re
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanweave.functions import text
from spanweave.functions.text import CleanConfig
from spanweave.plans import catalog

ODD = [*map(chr, (*range(0x21), 0x7F, 0x85, 0xA0, 0xAD, 0x1680, *range(0x2000, 0x2010), 0x2028, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF))]
SPACE = r"\t\n\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
MAPPED = r"\t\x0b\x0c\r\xa0\u2007\u202f\u3000"


def plain(t, c):
    if c.strip_zero_width:
        t = re.sub("[\u200b\u200c\u200d\u2060\ufeff\xad]", "", t)
    if c.strip_control_chars:
        t = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "", t)
    spaces = f"[{SPACE}]+" if c.strip_control_chars else rf"[{SPACE}\x0b\x0c\x1c-\x1f]+"
    if c.collapse_whitespace:
        t = re.sub(spaces, " ", t)
    elif c.normalize_whitespace:
        t = re.sub(f"[{MAPPED}]", " ", t)
    return re.sub(rf"^{spaces}|{spaces}\Z", "", t) if c.trim else t


def odd_texts(n):
    rng = random.Random(2)
    return ["".join(rng.choice(ODD) if rng.random() < 0.6 else rng.choice("ab~!^&-\u00e9\u20ac\U0001f600") for _ in range(rng.randrange(25))) for _ in range(n)]


def test_cleaning_is_the_same_for_all_switches(spark):
    texts = [*odd_texts(300), "", "  ", "[^ -~]&&[x]"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    configs = [CleanConfig(*bits) for bits in itertools.product((True, False), repeat=5)]
    for row in df.select("k", F.array(*(text.clean(F.col("t"), c) for c in configs)).alias("made")).collect():
        assert row.made == [plain(texts[row.k], c) for c in configs], repr(texts[row.k])


@pytest.mark.parametrize("together", [1, 40, 1 << 18])
def test_maps_of_many_texts_are_those_of_each(spark, monkeypatch, together):
    monkeypatch.setattr(text, "_TOGETHER", together)
    texts = [*odd_texts(200), "", None, "a b"]
    for config in (CleanConfig(), CleanConfig(trim=False), CleanConfig(False, False, False, False, True)):
        made = text._char_map(config).func(pa.array(texts, pa.string())).to_pylist()
        assert made == [text.places(t or "", config).tolist() for t in texts]
        if config.collapse_whitespace or not config.normalize_whitespace:
            same = lambda t, m: "".join(" " if re.match(f"[{SPACE}]", t[i]) and config.collapse_whitespace else t[i] for i in m)
            assert [same(t or "", m) for t, m in zip(texts, made, strict=True)] == [plain(t or "", config) for t in texts]


def test_no_map_is_made_by_itself(spark):
    def calls(n):
        steps, given = [0], pa.array(["some  words here"] * n)
        run = text._char_map(CleanConfig()).func
        sys.setprofile(lambda frame, event, arg: steps.__setitem__(0, steps[0] + (event == "call")))
        try:
            run(given)
        finally:
            sys.setprofile(None)
        return steps[0]

    calls(1)
    assert calls(1000) < calls(10) + 100


def test_scoring_keeps_all_cores_busy_on_a_small_file(spark):
    scored = catalog.queries()["score_batch"](spark, "/root/testdata/sf0.001")
    assert scored.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
