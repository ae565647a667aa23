"""Substring deduplication against a plain loop over all windows."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from tests.llm.docs import ODD, odd_docs

from spanweave.llm import repeats


def plain(texts: list[str | None], window: int) -> list[tuple[int, int, str]]:
    words = [(t or "").encode().split() for t in texts]
    often = Counter(tuple(w[k : k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {x for k in range(len(w) - window + 1) if often[tuple(w[k : k + window])] > 1 for x in range(k, k + window)}
        out.append((len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def corpus(seed: int) -> list[str | None]:
    """Random, periodic and shared stretches, some one shift apart."""
    rng = random.Random(seed)
    shared = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 80))) for _ in range(5)]
    out: list[str | None] = [None, "", " \n ", "a " * 200, "a b " * 90, "b a " * 70 + "c"]
    for _ in range(60):
        parts = [rng.choice([*shared, " ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(0, 50)))]) for _ in range(rng.randint(0, 4))]
        out.append(" ".join(parts))
    return out


@pytest.mark.parametrize("window", [1, 2, 5, 35])
def test_equals_a_plain_loop(spark, monkeypatch, window):
    texts = corpus(window)
    monkeypatch.setattr(repeats, "SLICE", 37)  # windows over the ends of slices
    monkeypatch.setattr(repeats, "CHUNK_WORDS", 400)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in repeats.remove_repeats(docs, window).collect()}
    assert [got[k] for k in range(len(texts))] == plain(texts, window)


def test_odd_documents_and_text_keys(spark):
    got = repeats.remove_repeats(odd_docs(spark), 6).select("doc_id", "n_words", "n_removed", "kept").collect()
    want = [(i, *x) for (i, _), x in zip(ODD, plain([t for _, t in ODD], 6), strict=True)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    named = spark.createDataFrame([("x", "a b c d"), ("y", "z a b c"), (None, None)], "name string, text string")
    assert sorted((r.name or "", r.kept) for r in repeats.remove_repeats(named, 3, "name").collect()) == [("", ""), ("x", "d"), ("y", "z")]
    assert repeats.remove_repeats(odd_docs(spark, [])).count() == 0


def test_more_rounds_change_nothing(spark, monkeypatch):
    texts = corpus(9)
    monkeypatch.setattr(repeats, "levels_for", lambda window: (1, 3))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in repeats.remove_repeats(docs, 20).collect()}
    assert [got[k] for k in range(len(texts))] == plain(texts, 20)


@pytest.mark.parametrize("window", [1, 2, 3, 7, 35])
def test_interiors_and_spellings_depend_on_the_window_alone(window):
    docs = [t.split() for t in corpus(window) if t] + [["q", *(["a", "b", "b"] * 30)[k:]] for k in range(3)]
    numbers: dict[str, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for d in docs for w in d])
    halves = np.array([[x & (2**64 - 1), x >> 64] for x in map(xxhash.xxh3_128_intdigest, numbers)], np.uint64)
    firsts = np.zeros(len(ids), bool)
    firsts[np.cumsum([0, *(len(d) for d in docs[:-1])])] = True
    parse = repeats.Parse((halves[ids, 0], halves[ids, 1]), firsts)
    begins = np.cumsum([0, *(len(d) for d in docs)])
    own = np.array([s + k for s, d in zip(begins, docs, strict=False) for k in range(len(d) - window + 1)], np.int64)
    said = [tuple(d[k : k + window]) for d in docs for k in range(len(d) - window + 1)]
    spelled = list(zip(*(x.tolist() for x in repeats.spelled(parse, own, own + window)), strict=True))
    assert len(set(zip(said, spelled, strict=True))) == len(set(said)) == len(set(spelled))
    for level in range(8):
        a, b = repeats.interiors(parse, own, own + window, level)
        inside = [tuple(parse.at_level(level)[0][x:y].tolist()) for x, y in zip(a, b, strict=True)]
        assert len(set(zip(said, inside, strict=True))) == len(set(said))
