"""Leak-proof splits against a plain union-find, and what they do with large components."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from spanweave.operators import splits

SCHEMA = "record_id long, grp string, stratum string, text string"


def plain_components(rows, least=0.9):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [frozenset((t or "").lower().split()) for *_, t in rows]
    for k, (_, g, _, _) in enumerate(rows):
        find(("row", k))
        if g is not None:
            parent[find(("row", k))] = find(("g", g))
        if sets[k]:
            parent[find(("row", k))] = find(("s", sets[k]))
    distinct = [s for s in set(sets) if s]
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if len(a & b) / len(a | b) >= least:
                parent[find(("s", a))] = find(("s", b))
    return [find(("row", k)) for k in range(len(rows))]


def split(spark, rows, share=0.5):
    df = spark.createDataFrame(rows, SCHEMA)
    similar = splits.similar_sets(df)
    return splits.leak_proof_split(df, similar, share), similar


def test_components_and_shares(spark):
    r = random.Random(2)
    words = [f"w{k}" for k in range(300)]
    base = [r.sample(words, 30) for _ in range(60)]
    rows = []
    for k in range(400):
        t = list(r.choice(base)) if r.random() < 0.2 else r.sample(words, 30)
        if r.random() < 0.5:
            t[0] = "zz"
        rows.append((k, None if k % 11 == 0 else f"g{r.randint(0, 300)}", r.choice(["en", "de", None]), None if k % 50 == 3 else " ".join(t)))
    out, similar = split(spark, rows)
    got = {x.record_id: x for x in out.collect()}
    want = plain_components(rows)
    assert len(got) == len(rows)
    assert len({(got[k].component, want[k]) for k in range(len(rows))}) == len({x.component for x in got.values()}) == len(set(want))
    assert splits.across(out, similar).count() == 0
    sides = defaultdict(set)
    for x in got.values():
        sides[x.component].add(x.side)
    assert all(len(s) == 1 for s in sides.values())
    # shares by the stratum that most of a component's records have
    members = defaultdict(Counter)
    for x in got.values():
        members[x.component][x.stratum] += 1
    held = defaultdict(Counter)
    for c, by in members.items():
        stratum = max(by, key=lambda s: (by[s], s is not None, s or ""))
        held[stratum][min(sides[c])] += sum(by.values())
    for by in held.values():
        assert abs(by["dev"] - sum(by.values()) / 2) <= 1


@pytest.mark.parametrize("share", [0.1, 0.5, 0.8])
def test_a_giant_component_goes_whole(spark, share):
    rows = [(k, "one" if k < 60 else f"g{k}", "en", f"text {k} of its own with word{k}") for k in range(100)]
    out, similar = split(spark, rows, share)
    sides = Counter((x.grp == "one", x.side) for x in out.collect())
    assert len([1 for (giant, _) in sides if giant]) == 1 and splits.across(out, similar).count() == 0
    dev = sides[True, "dev"] + sides[False, "dev"]
    best = min(abs(100 * share - x) for x in (*range(41), *range(60, 101)))
    assert abs(dev - 100 * share) <= best + 1


def test_small_components_are_cut_by_the_order_of_a_hash(spark, monkeypatch):
    monkeypatch.setattr(splits, "LARGE", 1)  # none is large
    rows = [(k, f"g{k // 3}", "en" if k < 150 else "de", f"text{k} word{k}") for k in range(300)]
    out, similar = split(spark, rows, 0.4)
    by = Counter((x.stratum, x.side) for x in out.collect())
    assert all(abs(by[s, "dev"] - 60) <= 3 for s in ("en", "de")) and splits.across(out, similar).count() == 0


def test_across_sees_leaks_and_empty_tables(spark):
    bad = spark.createDataFrame([(1, "g", "a", "dev"), (2, "g", "b", "test"), (3, None, "a", "test"), (4, "h", None, "dev")], "record_id long, grp string, set_id string, side string")
    similar = spark.createDataFrame([("b", "a", 0.95)], "left_set string, right_set string, jaccard double")
    got = sorted(map(tuple, splits.across(bad, similar).collect()))
    assert got == [("group", "g", "g"), ("similar", "a", "a"), ("similar", "b", "a")]
    out, _ = split(spark, [])
    assert out.count() == 0
