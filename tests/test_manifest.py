"""Merkle manifests: what they name, and what they read."""

from __future__ import annotations

import hashlib

from spanweave.operators import manifest

SCHEMA = "record_id long, split string, text string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(n):
    return [(k, "dev" if k % 3 else "test", f"text {k}") for k in range(n)]


def test_changes_name_records(spark, tmp_path):
    old = rows(300)
    new = [(k, s, t + "!" if k == 7 else t) for k, s, t in old if k not in (8, 9)] + [(1000, "dev", "new"), (1001, "edge", None)]
    before, now = (manifest.write(frame(spark, r), f"{tmp_path}/{k}") for k, r in enumerate((old, new)))
    got = sorted(map(tuple, manifest.changes(before, now).collect()))
    assert got == [("dev", "1000", "added"), ("dev", "7", "changed"), ("dev", "8", "lost"), ("edge", "1001", "added"), ("test", "9", "lost")]
    back = manifest.read(spark, f"{tmp_path}/0")
    assert sorted(map(tuple, manifest.changes(back, before).collect())) == []


def test_a_record_that_moves_between_splits_is_lost_and_added(spark, tmp_path):
    before = manifest.write(frame(spark, [(1, "dev", "a"), (2, "dev", "b")]), f"{tmp_path}/a")
    now = manifest.write(frame(spark, [(1, "test", "a"), (2, "dev", "b")]), f"{tmp_path}/b")
    assert sorted(map(tuple, manifest.changes(before, now).collect())) == [("dev", "1", "lost"), ("test", "1", "added")]


def test_only_differing_cells_are_read(spark, tmp_path):
    old = rows(600)
    new = [(k, s, "other" if k == 5 else t) for k, s, t in old]
    before, now = (manifest.write(frame(spark, r), f"{tmp_path}/{k}") for k, r in enumerate((old, new)))
    cells = manifest.differing_cells(before, now)
    assert cells == [("test" if 5 % 3 == 0 else "dev", hashlib.md5(b"5").hexdigest()[: manifest.DIGITS])]
    plan = manifest.changes(before, now)._jdf.queryExecution().executedPlan().toString()
    # both sides read one of sixteen folders, and there the row groups of one cell
    assert plan.count("PartitionFilters: [isnotnull(top") == 2 and plan.count(f"EqualTo(cell,{cells[0][1]})") == 2
    # the walk itself looks at nodes only: without its leaves' files it comes to the same cells
    for k in (0, 1):
        (tmp_path / str(k) / "leaves").rename(tmp_path / f"gone{k}")
    assert manifest.differing_cells(before, now) == cells


def test_tree_holds_its_children(spark, tmp_path):
    m = manifest.write(frame(spark, rows(100)), f"{tmp_path}/m")
    nodes = {(r.split, r.level, r.node): r for r in m.nodes.collect()}
    for (split, level, node), r in nodes.items():
        if level < manifest.DIGITS:
            below = sorted((n, x.sha, x.leaves) for (s, k, n), x in nodes.items() if s == split and k == level + 1 and n[:level] == node)
            assert 1 <= len(below) <= 16 and r.leaves == sum(x[2] for x in below)
            assert r.sha == hashlib.sha256("\n".join(f"{n} {sha}" for n, sha, _ in below).encode()).hexdigest()
    assert sum(r.leaves for k, r in nodes.items() if k[1] == 0) == 100
    empty = manifest.write(frame(spark, []), f"{tmp_path}/none")
    assert empty.nodes.count() == 0 and manifest.differing_cells(empty, empty) == []
    assert manifest.changes(empty, m).filter("change <> 'added'").count() == 0 and manifest.changes(empty, m).count() == 100


def test_odd_rows(spark, tmp_path):
    odd = [(None, "dev", "a"), (1, None, "b"), (1, "dev", None), (1, "dev", ""), (1, "dev", "")]
    before = manifest.write(frame(spark, odd), f"{tmp_path}/a")
    assert manifest.changes(before, manifest.write(frame(spark, odd[::-1]), f"{tmp_path}/b")).count() == 0
    now = manifest.write(frame(spark, odd[:-1]), f"{tmp_path}/c")
    assert [tuple(r) for r in manifest.changes(before, now).collect()] == [("dev", "1", "changed")]
