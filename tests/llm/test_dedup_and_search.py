import hashlib
import math
import random
import re
import tracemalloc

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tests.llm.docs import ODD, odd_docs

from spanweave.llm import contamination, queries, simhash, topk


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=4):
    """Smallest index reachable over all pairs within the radius."""
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def test_fingerprints_of_odd_texts():
    for _, text in ODD:
        assert simhash.fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_all_pairs(spark, seed):
    r = random.Random(seed)
    prints = [r.getrandbits(64) for _ in range(150)]
    for _ in range(200):  # chains and balls around some of them
        x = r.choice(prints)
        for b in r.sample(range(64), r.choice((0, 1, 2, 3, 4, 5, 6))):
            x ^= 1 << b
        prints.append(x)
    want = plain_components(prints)
    fps = spark.createDataFrame([(k, signed(x)) for k, x in enumerate(prints)], "doc_id bigint, fp bigint")
    nodes, placed = simhash.components(fps)
    got = {r.doc_id: r.component_id for r in fps.join(placed, "fp").collect()}
    assert got == dict(enumerate(want))


def test_dense_ball_is_worked_off_in_chunks(monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 2_000)
    r = random.Random(3)
    low = np.unique(np.array([sum(1 << b for b in r.sample(range(58), r.choice((0, 1, 2, 3)))) for _ in range(60)], np.uint64))
    left = np.full(len(low), 2)
    label = np.arange(len(low))
    for a, b in simhash._meet(low, left, 58, {}):
        label = simhash._forest(len(low), np.concatenate([a, np.arange(len(low))]), np.concatenate([b, label]))
    assert label.tolist() == plain_components([int(x) for x in low])


def dense_ball(n, seed=2):
    """Prints around one centre that share their leading bits."""
    r = random.Random(seed)
    centre = r.getrandbits(64)
    return sorted({centre ^ sum(1 << b for b in r.sample(range(34), r.randint(0, 5))) for _ in range(n)})


def test_dense_buckets_are_split_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SPLIT", 20_000)
    far = random.Random(9)
    prints = dense_ball(300) + [far.getrandbits(64) for _ in range(40)]
    nodes = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in prints], "fp bigint")
    rows = simhash.links(nodes, len(prints)).collect()
    label = {int(np.uint64(x).astype(np.int64)): i for i, x in enumerate(prints)}
    got = simhash._forest(len(prints), np.array([label[r.u] for r in rows]), np.array([label[r.v] for r in rows]))
    assert got.tolist() == plain_components(prints)


def test_classes_together_find_every_link():
    prints = np.array(dense_ball(400), np.uint64)
    whole = simhash._forest(len(prints), *map(np.concatenate, zip(*simhash._meet(prints, np.full(len(prints), 2), 64, {}))))
    parts = [simhash._meet_class(prints, np.full(len(prints), 2), 64, k, 7) for k in range(7)]
    assert (simhash._forest(len(prints), *map(np.concatenate, zip(*parts))) == whole).all()


def test_near_duplicates_of_odd_rows(spark):
    got = simhash.near_duplicates(odd_docs(spark)).collect()
    assert len(got) == len(ODD)
    prints = [plain_fingerprint(t) for _, t in ODD]
    roots = plain_components(prints)
    for row, fp in {(r.doc_id, r.fp): r for r in got}.items():
        assert signed(prints[[i for i, _ in ODD].index(row[0])]) == fp.fp or row[0] is None
    least = {}
    for k, (i, _) in enumerate(ODD):
        if i is not None:
            least[roots[k]] = min(i, least.get(roots[k], i))
    want = sorted(str((i, least.get(roots[k]))) for k, (i, _) in enumerate(ODD))
    assert sorted(str((r.doc_id, r.component_id)) for r in got) == want


@pytest.mark.parametrize("sent", [0, 500_000])
def test_keep_one_keeps_columns_and_first_rows(spark, monkeypatch, sent):
    monkeypatch.setattr(simhash, "KEYS_SENT", sent)
    docs = odd_docs(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    roots = plain_components([plain_fingerprint(t) for _, t in ODD])
    first = {}
    for k, (i, _) in enumerate(ODD):
        first[roots[k]] = min(first.get(roots[k], (True, 0)), (i is None, i or 0))
    assert ids == sorted(first.values())


def test_clashing_columns_survive(spark):
    names = ("__a", "__b", "_a", "fp", "root", "first", "n", "bucket", "__digest", "key")
    docs = odd_docs(spark).drop("fp")
    for k in names:
        docs = docs.withColumn(k, F.lit(k))
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumn("doc_id", F.lit("x")).withColumn("key", F.lit(1))
    for out in (simhash.keep_one(docs), contamination.drop_contaminated(docs, bench)):
        assert out.columns == docs.columns
        assert all(r[k] == k for r in out.collect() for k in names)
    assert simhash.near_duplicates(docs).count() == len(ODD)
    assert contamination.search(contamination.build_index(docs), bench, slop=2).count() == len(ODD)


def test_empty_tables(spark):
    none = odd_docs(spark, [])
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert contamination.search(contamination.build_index(none), bench).count() == 0
    assert topk.top_k(spark.createDataFrame([], "vec_id bigint, embedding array<float>"), F.col("vec_id") % 2 == 0).count() == 0


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def plain_hits(text, items, window, slop=0):
    w = words(text)
    hit, found = set(), set()
    for item_id, item in items:
        v = words(item)
        if item_id is None or not v:
            continue
        n = min(window, len(v))
        for i in range(len(v) - n + 1):
            for p in range(len(w)):
                # with slop the rarest word anchors; with 0 this is the plain phrase
                if p + n <= len(w) and w[p : p + n] == v[i : i + n]:
                    hit.update(range(p, p + n))
                    found.add(item_id)
    return len(w), len(hit), sorted(found)


ITEMS = [
    (1, "jumps over the lazy dog near the river bank today"),
    (2, "two three"),
    (2, "some words for"),
    (3, None),
    (4, ""),
    (None, "quick brown fox"),
    (5, "word word word word word word word word word word word word"),
    (6, "日本語"),
    (7, "the lazy dog near the river bank today and more words that are not there"),
]


@pytest.mark.parametrize(("block", "chunk"), [(5, 7), (400_000, 1_000_000)])
def test_phrases_match_brute_force(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(contamination, "BLOCK_WORDS", block)
    monkeypatch.setattr(contamination, "CHUNK", chunk)
    bench = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id bigint, text string, doc_id string")
    index = contamination.build_index(odd_docs(spark))
    got = contamination.search(index, bench).withColumn("n_hit", contamination.covered()).collect()
    want = sorted(str((i, *plain_hits(t, ITEMS, 10))) for i, t in ODD)
    assert sorted(str((r.key, r.n_words, r.n_hit, list(r["items"]))) for r in got) == want


@pytest.mark.parametrize("sent", [0, 500_000])
def test_contaminated_rows_are_dropped(spark, monkeypatch, sent):
    monkeypatch.setattr(contamination, "KEYS_SENT", sent)
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = odd_docs(spark).withColumn("digest", F.lit("x")).withColumn("key", F.lit(1))
    got = contamination.drop_contaminated(docs, bench)
    assert got.columns == docs.columns
    assert sorted(str((r.doc_id, r.text)) for r in got.collect()) == sorted(str((i, t)) for i, t in ODD if not plain_hits(t, ITEMS, 10)[1])


def test_near_matches_stay_with_their_document(spark):
    docs = spark.createDataFrame([(0, "filler words in front"), (1, "x b c d e"), (2, ""), (3, "b c d e f")], "doc_id bigint, text string").coalesce(1)
    bench = spark.createDataFrame([(9, "a b c d e")], "item_id bigint, text string")
    got = {r.key: list(r.near_items) for r in contamination.search(contamination.build_index(docs), bench, slop=2).collect()}
    assert got == {k: plain_near(t, [(9, "a b c d e")]) for k, t in ((0, "filler words in front"), (1, "x b c d e"), (2, ""), (3, "b c d e f"))}
    moved = spark.createDataFrame([(0, "filler words"), (1, "b a c d e")], "doc_id bigint, text string").coalesce(1)
    assert {r.key: list(r.near_items) for r in contamination.search(contamination.build_index(moved), bench, slop=2).collect()} == {0: [], 1: [9]}


def test_frequent_words_take_bounded_memory(monkeypatch):
    monkeypatch.setattr(contamination, "CHUNK", 50_000)
    r = random.Random(1)
    shard, block = contamination.Shard(), contamination.Block(10)
    shard.add(1, " ".join(r.choices("ab", k=60_000)).encode())
    block.add(1, r.choices([b"a", b"b"], k=1_000))
    tracemalloc.start()
    found = contamination._hits(block.close(), shard_of(shard), 0)
    assert tracemalloc.get_traced_memory()[1] < 120_000_000 and found[0][1] == {1}
    tracemalloc.stop()


def shard_of(shard):
    return shard.close()


def test_proximity_finds_moved_words(spark):
    docs = spark.createDataFrame([(1, "alpha beta x gamma delta"), (2, "alpha beta q q q q gamma delta"), (3, "alpha beta gamma delta")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(9, "alpha beta gamma delta")], "item_id bigint, text string")
    got = {r.key: (list(r["items"]), list(r.near_items)) for r in contamination.search(contamination.build_index(docs), bench, slop=2).collect()}
    assert got == {1: ([], [9]), 2: ([], []), 3: ([9], [9])}


def plain_near(text, items, slop=2):
    """Items with a window whose words are all within slop places of theirs, one of them at it."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    near, at = set(), {}
    for x, w in enumerate(words(text)):
        at.setdefault(w, set()).add(x)
    for item, t in items:
        b = words(t)
        n = min(10, len(b))
        for i in range(len(b) - n + 1) if item is not None and b else ():
            starts = {x - k for k in range(n) for x in at.get(b[i + k], ())}
            if any(all(any(p + k + d in at.get(b[i + k], ()) for d in range(-slop, slop + 1)) for k in range(n)) for p in starts):
                near.add(item)
    return sorted(near)


def test_proximity_matches_brute_force_and_is_returned(spark, tmp_path):
    said = "jumps over the lazy dog near the river bank today".split()
    moved = [" ".join(said[:k] + ["x"] * n + said[k + m :]) for k in (0, 1, 3, 5, 9) for n, m in ((1, 0), (2, 0), (3, 0), (0, 1), (1, 1))]
    rows = [*ODD, *((200 + i, t) for i, t in enumerate(moved)), (290, "over jumps lazy the dog near river the bank today"), (291, "today"), (292, "three two"), (293, "x word x word word")]
    odd_docs(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.queries()["op10_decontamination"](spark, str(tmp_path)).collect()
    sha = lambda ids: hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
    want = [(i, len(plain_near(t, ITEMS)), sha(plain_near(t, ITEMS)), sha(plain_hits(t, ITEMS, 10)[2])) for i, t in rows]
    assert sorted(str((r.doc_id, r.n_near, r.near_sha256, r.items_sha256)) for r in got) == sorted(map(str, want))
    told = {r.doc_id: r for r in got}
    assert (told[206].n_near, told[206].n_items) == (1, 0)


def units(x):
    """floor(256 x), for doubles of any size."""
    return 256 * int(x) if abs(x) > 2**60 else math.floor(256 * x)


def plain_top_k(rows, is_query, k=5):
    sound = [(i, [units(x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in sorted((i, v) for i, v in sound if is_query(i)):
        queries.setdefault(i, v)
    want = []
    for q, v in queries.items():
        scored = sorted((-min(max(sum(a * b for a, b in zip(v, w)), -(2**63)), 2**63 - 1), i) for i, w in sound if i != q)[:k]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(want)


def test_top_k_with_ties_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    r = random.Random(5)
    rows = [(i, [r.uniform(-1, 1) for _ in range(6)]) for i in range(0, 120)]
    rows += [(i, [0.5] * 6) for i in range(120, 180)]
    rows += [(200, None), (201, [None] * 6), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (None, [1.0] * 6), (204, [1.0]), (10, [9.0] * 6), (300, [1e9] * 6)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, score string")
    got = topk.top_k(df, F.col("vec_id") % 20 == 0).collect()
    assert sorted(map(tuple, got)) == plain_top_k(rows, lambda i: i % 20 == 0)


@pytest.mark.parametrize("lists", [1, 2, 5])
def test_top_k_of_large_numbers_is_exact(spark, lists):
    big = 2.0**45
    rows = [(0, [big, 1.0, 0.0]), (1, [512.0, 1 / 256, 3.0]), (2, [512.0, 2 / 256, 3.0]), (3, [512.0, 0.0, 9.0]), (4, [-512.0, 5.0, 1.0]), (5, [1e300, 0.0, 0.0]), (6, [-1e300, 1.0, 0.0]), (10, [0.25, 0.5, 1.0]), (11, [2.0**40, 2.0**40, 1.0])]
    rows += [(i, [i / 7, -i / 9, 2.0]) for i in range(12, 60)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, lists=lists).collect()
    assert sorted(map(tuple, got)) == plain_top_k(rows, lambda i: i % 10 == 0)


def test_top_k_of_the_largest_doubles(spark):
    rows = [(0, [1e308, 1.0]), (1, [-1.7e308, 2.0]), (2, [5e-324, -5e-324]), (3, [0.0, 0.0]), (10, [1.0, 0.5]), (11, [1.7e308, 1.7e308]), (12, [1e-300, 1e306])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") % 5 == 0).collect()
    assert sorted(map(tuple, got)) == plain_top_k(rows, lambda i: i % 5 == 0)


def test_top_k_resolves_few_entries(spark):
    r = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(r.normal(size=(1500, 16)))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").coalesce(2)
    got = topk.top_k(df, F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == plain_top_k(rows, lambda i: i % 50 == 0)
    assert pairs_resolved(rows, lambda i: i % 50 == 0) < 0.2 * 30 * 1500


def pairs_resolved(rows, is_query, k=5, lists=2):
    """How many totals the uniform threshold leaves to resolve, with the cutoff of a share of the rows."""
    whole = np.floor(256 * np.array([v for _, v in rows]))
    ids = np.array([i for i, _ in rows])
    q = np.flatnonzero([is_query(i) for i in ids])
    total = whole @ whole[q].T
    total[q, np.arange(len(q))] = -np.inf
    t = np.sort(total[::8], axis=0)[-k]
    parts = np.array_split(np.arange(whole.shape[1]), lists)
    known = [whole[:, p] @ whole[q][:, p].T >= t / lists for p in parts]
    return int(np.logical_or.reduce(known).sum())
