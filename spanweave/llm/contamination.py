"""Benchmark decontamination by a distributed positional inverted index.

build_index() stores the positions of every training word, one shard of about half a million words per
row, partitioned by document: nothing is shuffled, a lost executor costs one task. search() sends
benchmark windows in bounded blocks to all shards; in a shard, the positions of each window's rarest
word, moved back by its offset, are intersected with the lists of the other words from rare to
frequent, so many positions at a time that memory stays bounded whatever the words. With slop = 0 a
match is an exact phrase, with slop > 0 each word may stand up to slop places from its offset, with at
least one word at its offset (proximity); which one does not matter, so matches do not depend on the
words that are rare in a shard. drop_contaminated() removes the documents in which an exact window is
found in the index.

Defined cases: null text has no words; an item without words or with a null item_id takes no part;
an item shorter than the window is one window; rows with equal or null doc_id stay rows of their
own; repeated items count once; extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.llm.common import discard, materialize, release, words_of

WINDOW = 10
SHARD_WORDS = 500_000
#: Words of one block of benchmark windows that is broadcast at a time.
BLOCK_WORDS = 400_000
#: Positions that are followed through the lists at once.
CHUNK = 1_000_000
#: Places by which the words of a near match may be off.
SLOP = 2
#: Most keys of documents that are broadcast to be dropped; more are joined by a shuffle.
KEYS_SENT = 500_000
#: Free positions between documents; larger than any slop, so no match crosses documents.
GAP = 16
INDEX = "shard string, keys array<{}>, ends binary, terms binary, starts binary, deltas binary"
FOUND = "key {}, shard string, doc_no int, n_words bigint, runs array<struct<s:int,e:int>>, items array<bigint>, near_items array<bigint>"


class Shard:
    """Word ids of documents laid out one after another with gaps, and their sorted postings."""

    def __init__(self) -> None:
        self.vocabulary: dict[bytes, int] = defaultdict(count().__next__)
        self.ids: list[np.ndarray] = []
        self.keys: list[int | str | None] = []
        self.words = 0

    def add(self, key: int | str | None, text: bytes | None) -> None:
        words = words_of(text or b"")
        self.ids.append(np.fromiter(map(self.vocabulary.__getitem__, words), np.int32, len(words)))
        self.keys.append(key)
        self.words += len(words)

    def close(self) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """Ends of documents, words, starts of their lists, positions by word in rising order."""
        sizes = np.array([len(x) for x in self.ids], np.int64)
        ends = np.cumsum(sizes + GAP) - GAP
        ids = np.concatenate(self.ids) if self.ids else np.zeros(0, np.int32)
        at = np.arange(len(ids)) + np.repeat(np.arange(len(sizes)) * GAP, sizes)
        order = np.argsort(ids, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=len(self.vocabulary)))]).astype(np.int64)
        return ends, list(self.vocabulary), starts, at[order].astype(np.int64)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    shard = Shard()
    for b in batches:
        texts = b.column(1).cast(pa.binary())
        for k, key in enumerate(b.column(0).to_pylist()):
            shard.add(key, texts[k].as_py())
            if shard.words >= SHARD_WORDS or len(shard.keys) >= 100_000:
                yield shard
                shard = Shard()
    if shard.keys:
        yield shard


def build_index(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The stored index of docs(key, text); a key that is not a string is a long."""
    kind = "string" if isinstance(docs.schema[key].dataType, T.StringType) else "bigint"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for k, shard in enumerate(_shards(batches)):
            ends, terms, starts, at = shard.close()
            deltas = np.diff(at, prepend=0).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{part}-{k}"]),
                    pa.array([shard.keys], pa.list_(pa.string() if kind == "string" else pa.int64())),
                    *(pa.array([x], pa.binary()) for x in (ends.tobytes(), b" ".join(terms), starts.tobytes(), deltas.tobytes())),
                ],
                names=["shard", "keys", "ends", "terms", "starts", "deltas"],
            )
        release()

    return materialize(docs.select(F.col(key).cast(kind), "text").mapInArrow(build, INDEX.format(kind)), "postings")


class Block:
    """Benchmark windows: their words as numbers of one vocabulary, their lengths and items."""

    def __init__(self, window: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[tuple[int, ...], set[int]] = defaultdict(set)
        self.window, self.words = window, 0

    def add(self, item_id: int, words: list[bytes]) -> None:
        ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
        n = min(self.window, len(ids))
        for k in range(len(ids) - n + 1):
            self.windows[tuple(ids[k : k + n])].add(item_id)
        self.words += len(words)

    def close(self) -> dict:
        table = np.full((len(self.windows), self.window), -1, np.int32)
        for k, w in enumerate(self.windows):
            table[k, : len(w)] = w
        return {"words": list(self.vocabulary), "table": table, "items": [sorted(x) for x in self.windows.values()]}


def blocks(benchmark: DataFrame, window: int = WINDOW) -> Iterator[dict]:
    """Benchmark items in blocks of bounded size; a longer item is cut, with its windows kept whole."""
    block = Block(window)
    for item_id, text in benchmark.select(F.col("item_id").cast("bigint"), "text").toLocalIterator():
        words = words_of((text or "").encode())
        if item_id is None or not words:
            continue
        for k in range(0, max(1, len(words) - window + 1), BLOCK_WORDS):
            block.add(item_id, words[k : k + BLOCK_WORDS + window - 1])
            if block.words >= BLOCK_WORDS:
                yield block.close()
                block = Block(window)
    if block.windows:
        yield block.close()


def _intersect(block: dict, terms: list[bytes], starts: np.ndarray, at: np.ndarray, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Windows, start positions of their matches, and a position that is within the document of the match, part by part.

    A part follows at most CHUNK positions of rarest words, so its memory does not depend on how frequent they are.
    """
    number = dict(zip(terms, range(len(terms)), strict=True))
    local = np.fromiter((number.get(w, -1) for w in block["words"]), np.int64, len(block["words"]))
    table = block["table"]
    used = table >= 0
    term = np.where(used, local[np.where(used, table, 0)], 0)
    whole = np.flatnonzero(((term >= 0) | ~used).all(1))
    if not len(whole):
        return
    term, used = term[whole], used[whole]
    lists = np.where(used, (starts[1:] - starts[:-1])[term], np.iinfo(np.int64).max)
    rank = np.argsort(lists, axis=1, kind="stable")
    span = int(at.max()) + GAP + 1
    keys = np.repeat(np.arange(len(terms), dtype=np.int64), starts[1:] - starts[:-1]) * span + at
    first = term[np.arange(len(whole)), rank[:, 0]]
    ends = np.cumsum(starts[first + 1] - starts[first])
    for begin in range(0, int(ends[-1]), CHUNK):
        nth = np.arange(begin, min(begin + CHUNK, int(ends[-1])))
        every = np.searchsorted(ends, nth, "right")
        held = at[starts[first[every] + 1] - ends[every] + nth]
        for moved in range(-slop, slop + 1):
            win, anchor, pos = every, held, held - rank[every, 0] + moved
            if not slop:
                win, anchor, pos = (x[pos >= 0] for x in (win, anchor, pos))
            placed = np.full(len(win), moved == 0)
            for j in range(1, table.shape[1]):
                if not len(win):
                    break
                off = rank[win, j]
                there = used[win, off]
                want = term[win, off] * span + pos + off
                lower = np.maximum(want - slop, term[win, off] * span)
                k = np.searchsorted(keys, lower)
                hit = (k < len(keys)) & (keys[np.minimum(k, len(keys) - 1)] <= want + slop)
                keep = hit | ~there
                if moved:
                    k = np.minimum(np.searchsorted(keys, want[keep]), len(keys) - 1)
                    placed = placed[keep] | there[keep] & (keys[k] == want[keep])
                else:
                    placed = placed[keep]
                win, anchor, pos = win[keep], anchor[keep], pos[keep]
            if placed.any():
                yield whole[win[placed]], pos[placed], anchor[placed]


def _hits(block: dict, shard: tuple, slop: int) -> dict[int, list]:
    """Per document number: its runs of hit words (document positions), its items, its near items."""
    ends, terms, starts, at = shard
    found: dict[int, list] = {}
    if not len(at):
        return found
    begins = np.concatenate([[0], ends[:-1] + GAP])
    length = (block["table"] >= 0).sum(1)

    def docs(pos: np.ndarray) -> np.ndarray:
        """The last document that begins at or before each position; empty ones hold none."""
        return np.searchsorted(begins, pos, "right") - 1

    every, items = [], []
    for win, pos, _ in _intersect(block, terms, starts, at, 0):
        every.append(np.unique(np.stack([pos, pos + length[win]]), axis=1))
        items.append(np.unique(np.stack([docs(pos), win]), axis=1))
    if every:
        s, e = np.unique(np.concatenate(every, axis=1), axis=1)
        for p, q, d in zip(s.tolist(), e.tolist(), docs(s).tolist(), strict=True):
            runs = found.setdefault(d, [[], set(), set()])[0]
            p, q = p - int(begins[d]), q - int(begins[d])
            if runs and p <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], q)
            else:
                runs.append([p, q])
        for d, w in np.unique(np.concatenate(items, axis=1), axis=1).T.tolist():
            found[d][1].update(block["items"][w])
    if slop:
        near = [np.unique(np.stack([docs(within), win]), axis=1) for win, _, within in _intersect(block, terms, starts, at, slop)]
        for d, w in np.unique(np.concatenate(near, axis=1), axis=1).T.tolist() if near else ():
            found.setdefault(d, [[], set(), set()])[2].update(block["items"][w])
    return found


def search(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Per document of the index: its key, n_words, the merged runs of hit words, items and near items.

    Each block of windows is one job over the stored index when there are several; their runs are
    then merged per document.
    """
    assert 0 <= slop < GAP, "slop must be below the gap between documents"
    spark = index.sparkSession
    parts = []
    for block in blocks(benchmark, window):
        parts.append(_search_block(index, spark.sparkContext.broadcast(block), slop))
        if len(parts) > 1:
            parts[-1] = materialize(parts[-1], "windows")
    if not parts:
        empty = {"words": [], "table": np.full((0, window), -1, np.int32), "items": []}
        return _search_block(index, spark.sparkContext.broadcast(empty), 0)
    if len(parts) == 1:
        return parts[0]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    joined = F.array_sort(F.flatten(F.collect_list("runs")))
    return (
        every.groupBy("shard", "doc_no")
        .agg(
            F.first("key").alias("key"),
            F.first("n_words").alias("n_words"),
            joined.alias("runs"),
            *(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("items", "near_items")),
        )
        .select("key", "shard", "doc_no", "n_words", "runs", "items", "near_items")
    )


def _search_block(index: DataFrame, sent, slop: int) -> DataFrame:
    kind = index.schema["keys"].dataType.elementType

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        for b in batches:
            for r in range(b.num_rows):
                shard, own, ends, terms, starts, deltas = (b.column(c)[r].as_py() for c in range(6))
                ends, starts = np.frombuffer(ends, np.int64), np.frombuffer(starts, np.int64)
                at = np.cumsum(np.frombuffer(deltas, np.int32), dtype=np.int64)
                begins = np.concatenate([[0], ends[:-1] + GAP])
                found = _hits(block, (ends, terms.split(b" ") if terms else [], starts, at), slop)
                got = [found.get(k, [[], (), ()]) for k in range(len(own))]
                n = len(own)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own, pa.string() if isinstance(kind, T.StringType) else pa.int64()),
                        pa.array([shard] * n),
                        pa.array(range(n), pa.int32()),
                        pa.array(ends - begins, pa.int64()),
                        pa.array([[{"s": s, "e": e} for s, e in x[0]] for x in got], pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
                        *(pa.array([sorted(x[k]) for x in got], pa.list_(pa.int64())) for k in (1, 2)),
                    ],
                    names=["key", "shard", "doc_no", "n_words", "runs", "items", "near_items"],
                )
        release()

    return index.mapInArrow(find, FOUND.format(kind.simpleString()))


def covered(runs: str = "runs"):
    """Number of positions in a sorted array of runs that may overlap."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("int").alias("to"))
    return F.aggregate(
        runs,
        zero,
        lambda a, r: F.struct(
            (a["n"] + F.greatest(F.lit(0), r["e"] - F.greatest(a["to"], r["s"]))).cast("bigint").alias("n"),
            F.greatest(a["to"], r["e"]).alias("to"),
        ),
    )["n"]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs without the rows in whose text a benchmark window occurs; all columns stay.

    Whether a row goes depends on its text only, so the index is keyed by a digest of it. The digests that the
    search finds are stored and counted; up to KEYS_SENT of them are broadcast, more are joined by a shuffle.
    """
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    index = build_index(docs.select(digest.alias("digest"), "text"), "digest")
    found = materialize(search(index, benchmark, window).filter(F.size("runs") > 0).select(F.col("key").alias("__digest")).distinct(), "leaks")
    bounded = found.count() <= KEYS_SENT
    discard(index)
    return docs.join(F.broadcast(found) if bounded else found, digest == found["__digest"], "left_anti")
