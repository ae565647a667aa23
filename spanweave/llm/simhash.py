"""SimHash near-duplicate groups by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most r bits have a common variant within r/2 flips of both. Every
distinct fingerprint therefore emits all its variants within r/2 flips, equal variants meet, and
colliding pairs are verified and deduplicated. The variants (2,081 for r = 4) are not shuffled one by
one: they are dealt by their leading bits, so a fingerprint is sent once to each prefix that one of
its variants has, and the variants of that prefix are made where they meet. Fingerprints that share a
variant are linked as a star, never as all pairs; a bucket returns a spanning forest. The variants of
every bucket are counted first: one that holds a dense group is split over as many tasks as it has
times SPLIT variants, each of which makes and compares the variants of one hash class; the others are
worked off by further bits, in bounded memory.

Components are found by alternating large-star and small-star steps on the distinct links, each
written to the shared folder.

Defined cases: null and wordless texts have fingerprint zero and are linked like any other; a null
doc_id is never the smallest of a group unless all are null, which gives a null component_id; rows
with equal ids stay rows of their own; extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import discard, fresh, join_hot, materialize, release
from spanweave.operators.components import roots

SHINGLE = 4
RADIUS = 4
#: Variants that are sorted at once.
CHUNK = 3_000_000
#: Variants of a bucket from which on it is split over tasks.
SPLIT = 12_000_000
#: Most rows of keys that are broadcast; more are joined by a shuffle.
KEYS_SENT = 500_000


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a UTF-8 text."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s : e - 1], 42) for s, e in zip([0, *ends], ends[shingle - 1 :], strict=False)]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(0, dtype=np.int64) > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """docs with the column fp: the fingerprint as a signed long."""

    @F.arrow_udf("bigint")
    def make(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            binary = texts.cast(pa.binary())
            made = np.array([fingerprint(binary[k].as_py(), shingle) for k in range(len(binary))], np.uint64)
            yield pa.array(made.view(np.int64))
        release()

    return docs.withColumn("fp", make("text"))


@cache
def _masks(bits: int, flips: int) -> np.ndarray:
    """All words of so many bits with at most so many set."""
    one = np.uint64(1) << np.arange(bits, dtype=np.uint64)
    masks = {np.uint64(0)}
    for _ in range(flips):
        masks |= {m | b for m in masks for b in one}
    return np.array(sorted(masks), np.uint64)


def _fold(v: np.ndarray) -> np.ndarray:
    return ((v ^ (v >> np.uint64(20)) ^ (v >> np.uint64(40))) & np.uint64(0xFFFFF)).astype(np.int64)


def _meet(low: np.ndarray, left: np.ndarray, bits: int, table: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(fingerprint, fingerprint) index pairs that share a variant of the low bits; left: flips to spend."""
    kinds = np.unique(left)
    sizes = {int(f): len(table.setdefault((bits, int(f)), _masks(bits, int(f)))) for f in kinds}
    total = sum(int((left == f).sum()) * n for f, n in sizes.items())
    if len(low) < 2:
        return
    if total > CHUNK and bits > 8:
        step = 4
        rest = np.uint64(bits - step)
        top = low >> rest
        for pattern in range(1 << step):
            spent = np.bitwise_count(top ^ np.uint64(pattern)).astype(np.int64)
            mine = np.flatnonzero(spent <= left)
            if len(mine) > 1:
                for a, b in _meet(low[mine] & ((np.uint64(1) << rest) - np.uint64(1)), left[mine] - spent[mine], bits - step, table):
                    yield mine[a], mine[b]
        return
    made, owner = [], []
    for f in kinds:
        mine = np.flatnonzero(left == f)
        m = table[bits, int(f)]
        made.append((low[mine, None] ^ m[None, :]).ravel())
        owner.append((mine, len(m)))
    twice = _repeated(np.concatenate(made))
    if not len(twice):
        return
    seen = np.zeros(1 << 20, bool)
    seen[_fold(twice)] = True
    group, who = [], []
    for values, (mine, n) in zip(made, owner, strict=True):
        k = np.flatnonzero(seen[_fold(values)])
        g = np.searchsorted(twice, values[k])
        ok = twice[np.minimum(g, len(twice) - 1)] == values[k]
        group.append(g[ok])
        who.append(mine[k[ok] // n])
    yield _stars(np.concatenate(group), np.concatenate(who), len(twice), len(low))


def _repeated(values: np.ndarray) -> np.ndarray:
    """The distinct values that occur more than once."""
    values.sort()
    return np.unique(values[1:][values[1:] == values[:-1]])


def _stars(group: np.ndarray, who: np.ndarray, groups: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of the members of each group to its first one; there are n owners."""
    first = np.full(groups, np.iinfo(np.int64).max)
    np.minimum.at(first, group, who)
    pairs = np.unique(who * np.int64(n) + first[group])
    a, b = pairs // n, pairs % n
    return a[a != b], b[a != b]


def _meet_class(low: np.ndarray, left: np.ndarray, bits: int, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """As _meet, for the variants of one of so many hash classes: mask by mask, so that only that class is held."""
    values, owner = [], []
    for m in _masks(bits, int(left.max(initial=0))):
        mine = np.flatnonzero(left >= int(m).bit_count())
        v = low[mine] ^ m
        keep = ((v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(parts) == part
        values.append(v[keep])
        owner.append(mine[keep].astype(np.int32))
    every, who = np.concatenate(values), np.concatenate(owner)
    twice = _repeated(every.copy())
    if not len(twice):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    g = np.minimum(np.searchsorted(twice, every), len(twice) - 1)
    ok = twice[g] == every
    return _stars(g[ok], who[ok].astype(np.int64), len(twice), len(low))


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches over the links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        old = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, old[a], low)
        np.minimum.at(label, old[b], low)
        while (label != (jump := label[label])).any():
            label = jump
        if (label == old).all():
            return label


def links(nodes: DataFrame, n: int, radius: int = RADIUS) -> DataFrame:
    """(u, v) with v < u in the same component, spanning the components of nodes(fp) bucket by bucket."""
    half = radius // 2
    prefix = min(24, max(6, math.ceil(math.log2(max(1, n) * len(_masks(64, half)) / CHUNK + 1))))
    masks = _masks(prefix, half).astype(np.int64).tolist()
    bits = 64 - prefix
    dealt = nodes.select("fp", F.explode(F.array(*map(F.lit, masks))).alias("m")).select(
        (F.shiftrightunsigned("fp", bits).bitwiseXOR(F.col("m"))).alias("bucket"), F.bit_count("m").cast("int").alias("spent"), "fp"
    )

    made = F.get(F.array(*(F.lit(len(_masks(bits, half - k))) for k in range(half + 1))), F.col("spent"))
    parts = F.ceil(F.col("variants") / SPLIT).cast("int").alias("parts")
    dense = materialize(dealt.groupBy("bucket").agg(F.sum(made).alias("variants")).filter(F.col("variants") > SPLIT).select("bucket", parts), "dense")
    n_dense = dense.count()
    if n_dense:
        dealt = dealt.join(F.broadcast(dense) if n_dense <= KEYS_SENT else dense, "bucket", "left")
        parts = F.coalesce("parts", F.lit(1))
        dealt = dealt.select("bucket", "spent", "fp", parts.alias("parts"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    else:
        dealt = dealt.select("bucket", "spent", "fp", F.lit(1).alias("parts"), F.lit(0).alias("part"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        whole, part = got[0].column(3)[0].as_py(), got[0].column(4)[0].as_py()
        fp = np.concatenate([b.column(2).to_numpy() for b in got])
        spent = np.concatenate([b.column(1).to_numpy() for b in got]).astype(np.int64)
        order = np.argsort(fp)
        fp, spent = fp[order].view(np.uint64), spent[order]
        low = fp & ((np.uint64(1) << np.uint64(bits)) - np.uint64(1))
        label = np.arange(len(fp))
        for a, b in [_meet_class(low, half - spent, bits, part, whole)] if whole > 1 else _meet(low, half - spent, bits, {}):
            near = np.bitwise_count(fp[a] ^ fp[b]) <= radius
            a, b = label[a[near]], label[b[near]]
            label = _forest(len(fp), np.concatenate([a, np.arange(len(fp))]), np.concatenate([b, label]))
        mine = np.flatnonzero(label != np.arange(len(fp)))
        yield pa.RecordBatch.from_arrays([pa.array(fp[mine].view(np.int64)), pa.array(fp[label[mine]].view(np.int64))], names=["u", "v"])
        release()

    return dealt.groupBy("bucket", "part").applyInArrow(meet, "u bigint, v bigint").distinct()


def components(fps: DataFrame, radius: int = RADIUS) -> tuple[DataFrame, DataFrame]:
    """From rows (doc_id, fp): nodes(fp, n) and the map (fp, root, component_id) of linked or single fingerprints."""
    nodes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")), "nodes")
    tree = roots(links(nodes.select("fp"), nodes.count(), radius)).withColumnRenamed("u", "fp")
    told = nodes.join(tree, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    told = materialize(told, "rooted")
    least = told.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("n"))
    least = materialize(least, "least")
    placed = join_hot(told.select("fp", "root"), least.select("root", "component_id"), "root", least.select("root", "n"))
    placed = materialize(placed.select("fp", "root", "component_id"), "placed")
    discard(told, least)
    return nodes.select("fp", "n"), placed


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, fp, root, component_id."""
    fps = materialize(with_fingerprint(docs.select("doc_id", "text"), shingle).drop("text"), "fingerprints")
    nodes, placed = components(fps, radius)
    return join_hot(fps, placed, "fp", nodes)


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """docs without all but the first document (smallest doc_id, nulls last) of each group.

    Decisions are made on two 64-bit hashes of (doc_id, text); rows equal in both are the same document, of
    which one row stays. The hashes of what goes are stored and counted; up to KEYS_SENT of them are broadcast,
    so that texts stay where they are, more are joined by a shuffle.
    """
    key = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull(), F.coalesce(F.col("text"), F.lit("")), F.col("text").isNull()]
    a, b = fresh(docs.columns, "a"), fresh(docs.columns, "b")
    marked = docs.withColumn(a, F.xxhash64(*key)).withColumn(b, F.xxhash64(F.lit("second"), *key))
    fps = materialize(with_fingerprint(marked.select("doc_id", F.col(a).alias("a"), F.col(b).alias("b"), "text"), shingle).drop("text"), "fingerprints")
    nodes, placed = components(fps, radius)
    rows = materialize(join_hot(fps, placed.select("fp", "root"), "fp", nodes).select("doc_id", "a", "b", "root"), "grouped")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "a", "b")).alias("first")
    kept = materialize(rows.groupBy("root").agg(first, F.count("*").alias("n")).select("root", "n", F.col("first.a").alias("ka"), F.col("first.b").alias("kb")), "kept")
    told = join_hot(rows, kept.drop("n"), "root", kept.select("root", "n"))
    gone = materialize(told.filter("a <> ka OR b <> kb").select(F.col("a").alias(a), F.col("b").alias(b)).distinct(), "gone")
    out = marked.join(F.broadcast(gone) if gone.count() <= KEYS_SENT else gone, [a, b], "left_anti")
    if not fps.groupBy("a", "b").count().filter("count > 1").isEmpty():
        out = out.dropDuplicates([a, b])
    discard(fps, rows, kept)
    return out.drop(a, b)
