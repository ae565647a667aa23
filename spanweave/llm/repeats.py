"""Removal of repeated word windows by recompression.

A sequence of words is recompressed by steps that treat equal stretches alike: runs of one symbol become a
symbol, then pairs of a left and a right symbol (a coin of the symbol's name and the step) do, and so on. A
symbol's name is a 128-bit digest of the names that it is made of, so that names are global without a dictionary:
the same stretch has the same interior symbols in every document, whatever stands around it. From a window, what
its surroundings could have drawn into another symbol is popped at either end at each step; what is left, its
interior, depends on the window alone, and the popped symbols together spell the window.

1. build: documents are tokenised once into stored chunks.
2. Spark rounds, one for each level of levels_for: the symbols of that level are counted over the whole corpus, and windows
   with a symbol in their interior that occurs nowhere else cannot be repeated; only the others go on. A chunk
   sends each distinct name once, and the names that occur elsewhere too come back to it.
3. What still shares all its symbols is verified: the popped sequences of these windows, digested, are compared
   over the corpus, each distinct one of a chunk sent once. Windows that are equal to another one come back to
   their chunk, where the words that they cover go.

Work and shuffles are linear in the words, however often a passage occurs: nothing is compared pair by pair, and a
passage that fills a chunk is one name there. Chunks are worked off in slices that overlap by a window, so memory
does not depend on the length of a document beyond its words themselves; buckets follow from the corpus.

Defined cases: null text has no words; rows with equal or null keys stay rows of their own, and windows of
repeated rows are repeated; documents shorter than the window lose nothing; extra columns are ignored; empty
tables give empty results. Equality of windows is that of 128-bit digests of words and pairs.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.llm.common import materialize, release

WINDOW = 35
#: Words from which on a chunk is closed, and windows that are worked off at once.
CHUNK_WORDS = 1_000_000
SLICE = 1 << 18
#: Names that a bucket holds on average, and least buckets.
BUCKET_NAMES = 4_000_000
LEAST_BUCKETS = 64
#: Runs are replaced before the first of so many pair steps.
RUN_EVERY = 4
_WORDS_OF_LEVEL = 4 / 3
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
CHUNK = "chunk string, n_words bigint, keys array<{}>, sizes binary, terms binary, ids binary"
PACK = "bucket bigint, chunk string, names binary, at binary"
TOLD = "chunk string, level int, told binary"

Names = tuple[np.ndarray, np.ndarray]


def levels_for(window: int) -> tuple[int, ...]:
    """The pair steps after which symbols are counted: the last whose symbols a window's interior can be expected to hold.

    A pair step pops half a symbol at either end, a run step one; symbols grow by a third with each pair step.
    """
    popped, size, step = 0.0, 1.0, 0
    while True:
        popped += 2 * size * (0.5 + (step % RUN_EVERY == 0))
        size *= _WORDS_OF_LEVEL
        if popped + 2 * size > window:
            return (step,)
        step += 1


def _mixed(z: np.ndarray) -> np.ndarray:
    z ^= z >> np.uint64(32)
    z *= _ODD[6]
    z ^= z >> np.uint64(29)
    z *= _ODD[7]
    z ^= z >> np.uint64(32)
    return z


def _joined(x: Names, y: Names, kind: int) -> Names:
    """Names of (x, y): each half from the same halves of both."""
    a, b = _ODD[kind], _ODD[kind + 1]
    return _mixed(x[0] * a + y[0] * b), _mixed(x[1] * b + y[1] * a + a)


def _coin(names: Names, step: int) -> np.ndarray:
    """Whether a symbol is a left one in this step."""
    odd = (int(_ODD[step % 6]) + 2 * step) % 2**64
    return (names[0] * np.uint64(odd) >> np.uint64(63)).astype(bool)


class Parse:
    """The levels of one slice, made as they are asked for. firsts: where documents begin."""

    def __init__(self, names: Names, firsts: np.ndarray) -> None:
        self.steps: list[tuple] = []
        self.names, self.firsts = names, firsts

    def step(self, k: int) -> tuple:
        """(kind, names before, left symbols or ends of runs, number of each symbol's successor)."""
        while len(self.steps) <= k:
            n = len(self.steps)
            self.steps.append(self._runs() if n % (RUN_EVERY + 1) == 0 else self._pairs(n))
        return self.steps[k]

    def _runs(self) -> tuple:
        names = self.names
        starts = self.firsts.copy()
        starts[1:] |= (names[0][1:] != names[0][:-1]) | (names[1][1:] != names[1][:-1])
        at = np.flatnonzero(starts)
        ends = np.append(at[1:], len(starts))
        length = ends - at
        long = np.flatnonzero(length > 1)
        new = (names[0][at], names[1][at])
        if len(long):
            times = length[long].astype(np.uint64)
            made = _joined((new[0][long], new[1][long]), (times, times), 2)
            new[0][long], new[1][long] = made
        self.names, self.firsts = new, self.firsts[at]
        return "runs", names, (at, ends), np.cumsum(starts) - 1

    def _pairs(self, n: int) -> tuple:
        names = self.names
        left = _coin(names, n)
        starts = np.ones(len(left), bool)
        starts[1:] = ~left[:-1] | left[1:] | self.firsts[1:]
        at = np.flatnonzero(starts)
        new = (names[0][at], names[1][at])
        paired = np.flatnonzero(np.diff(np.append(at, len(starts))) == 2)
        if len(paired):
            x = at[paired]
            made = _joined((names[0][x], names[1][x]), (names[0][x + 1], names[1][x + 1]), 0)
            new[0][paired], new[1][paired] = made
        self.names, self.firsts = new, self.firsts[at]
        return "pairs", names, left, np.cumsum(starts) - 1

    def steps_to(self, level: int) -> int:
        """Steps after which so many pair steps are done."""
        return level + -(-level // RUN_EVERY) if level else 0

    def at_level(self, level: int) -> Names:
        """Names after so many pair steps."""
        n = self.steps_to(level)
        if n:
            self.step(n)
        return self.steps[n][1] if n else self.names if not self.steps else self.steps[0][1]


def _popped(step: tuple, a: np.ndarray, b: np.ndarray) -> tuple:
    """One step of windows with the interiors [a, b), none empty: (interiors behind it, symbols and numbers popped at either end)."""
    kind, names, told, after = step
    if kind == "runs":
        starts, ends = told
        first, last = after[a], after[b - 1]
        one = first == last
        n_left = np.where(one, b, ends[first]) - a
        n_right = np.where(one, 0, b - np.maximum(starts[last], a))
        return first + 1, np.where(one, first + 1, last), n_left, n_right
    left = told
    n_left = (~left[a]).astype(np.int64)
    n_right = (left[b - 1] & (a + n_left < b)).astype(np.int64)
    # a left symbol begins a new one and a right one ends it, so what is between the popped ends is whole
    full = a + n_left < b - n_right
    new_a = after[np.where(full, a + n_left, a)]
    return new_a, np.where(full, after[np.where(full, b - n_right - 1, a)] + 1, new_a), n_left, n_right


def interiors(parse: Parse, a: np.ndarray, b: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The interiors of windows [a, b) after so many pair steps; empty ones are [0, 0)."""
    a, b = a.copy(), b.copy()
    live = np.arange(len(a))
    for k in range(parse.steps_to(level)):
        a_k, b_k, *_ = _popped(parse.step(k), a[live], b[live])
        a[live], b[live] = a_k, b_k
        live = live[a_k < b_k]
    none = a >= b
    a[none] = b[none] = 0
    return a, b


def spelled(parse: Parse, a: np.ndarray, b: np.ndarray) -> Names:
    """Digests of the popped sequences of windows [a, b): equal for equal windows only, whatever surrounds them."""
    out = (np.zeros(len(a), np.uint64), np.zeros(len(a), np.uint64))
    live, k = np.flatnonzero(a < b), 0
    a, b = a[live], b[live]
    sums = (np.zeros(len(a), np.uint64), np.zeros(len(a), np.uint64))
    while len(live):
        step = parse.step(k)
        new_a, new_b, n_left, n_right = _popped(step, a, b)
        for at, n in ((a, n_left), (b - 1, n_right)):
            # a symbol and how often it is popped; the number tells whether one is
            used, times = n > 0, _mixed(n.astype(np.uint64) + np.uint64(1))
            sums = _joined(sums, tuple(np.where(used, x[at], np.uint64(0)) ^ times for x in step[1]), 4)
        k += 1
        more = new_a < new_b
        done = live[~more]
        for o, s in zip(out, sums, strict=True):
            o[done] = s[~more]
        live, a, b = live[more], new_a[more], new_b[more]
        sums = tuple(s[more] for s in sums)
    return out


def _packed(x: np.ndarray) -> bytes:
    """Numbers as compressed planes of bytes."""
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes(), 1) if len(x) else b""


def _unpacked(b: bytes, kind: type) -> np.ndarray:
    if not b:
        return np.zeros(0, kind)
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(b), np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def build(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Stored chunks of docs(key, text): keys, words of each document, distinct words, and the words by number."""
    kind = "string" if isinstance(docs.schema[key].dataType, T.StringType) else "bigint"

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), count()
        keys, ids, numbers, n_words = [], [], defaultdict(count().__next__), 0

        def close() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            row = [f"{part}-{next(number)}", n_words, keys, _packed(np.array([len(x) for x in ids], np.int32)), zstandard.compress(b" ".join(numbers), 1), _packed(flat)]
            schema = pa.schema([("chunk", pa.string()), ("n_words", pa.int64()), ("keys", pa.list_(pa.string() if kind == "string" else pa.int64())), *((c, pa.binary()) for c in ("sizes", "terms", "ids"))])
            return pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for k, name in enumerate(batch.column(0).to_pylist()):
                words = (texts[k].as_py() or b"").split()
                ids.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                keys.append(name)
                n_words += len(words)
                if n_words >= CHUNK_WORDS or len(keys) >= 100_000:
                    yield close()
                    keys, ids, numbers, n_words = [], [], defaultdict(count().__next__), 0
        if keys:
            yield close()
        release()

    return materialize(docs.select(F.col(key).cast(kind), "text").mapInArrow(chunks, CHUNK.format(kind)), "chunks")


class Chunk:
    """A stored chunk, opened."""

    def __init__(self, table: pa.Table, window: int) -> None:
        self.chunk, self.keys = table["chunk"][0].as_py(), table["keys"][0].as_py()
        self.sizes, self.ids = (_unpacked(table[c][0].as_py(), np.int32) for c in ("sizes", "ids"))
        self.terms = zstandard.decompress(table["terms"][0].as_py()).split(b" ")
        self.window, self.ends = window, np.cumsum(self.sizes, dtype=np.int64)
        digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, self.terms)), "<u8").reshape(-1, 2).astype(np.uint64)
        self.names = (np.ascontiguousarray(digests[:, 0]), np.ascontiguousarray(digests[:, 1]))

    def slices(self) -> Iterator[tuple[int, Parse, np.ndarray]]:
        """(place of the slice, its parse, starts of its windows), each window in one slice."""
        begins = self.ends - self.sizes
        whole = np.zeros(len(self.ids) + 1, np.int32)  # +1 where starts of windows begin, -1 where they end
        room = self.sizes >= self.window
        np.add.at(whole, begins[room], 1)
        np.add.at(whole, self.ends[room] - self.window + 1, -1)
        starts = np.flatnonzero(np.cumsum(whole[:-1]) > 0)
        first = np.zeros(len(self.ids) + 1, bool)
        first[begins] = True
        for s in range(0, len(self.ids), SLICE):
            own = starts[np.searchsorted(starts, s) : np.searchsorted(starts, s + SLICE)] - s
            if len(own):
                used = self.ids[s : s + SLICE + self.window - 1]
                yield s, Parse((self.names[0][used], self.names[1][used]), first[s : s + len(used)]), own


def _dealt(names: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The buckets, by leading bits, of sorted names."""
    bucket = (names >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)], strict=True):
        if e > s:
            yield int(bucket[s]), slice(s, e)


def _alive(parse: Parse, own: np.ndarray, window: int, told: dict[int, np.ndarray]) -> np.ndarray:
    """The starts of windows that share all symbols of their interiors; told: sorted names that occur elsewhere too, by level."""
    for level in sorted(told):
        here, shared = parse.at_level(level)[0], told[level]
        if len(shared):
            lone = shared[np.minimum(np.searchsorted(shared, here), len(shared) - 1)] != here
        else:
            lone = np.ones(len(here), bool)
        before = np.concatenate([[0], np.cumsum(lone)])
        a, b = interiors(parse, own, own + window, level)
        own = own[before[b] == before[a]]
    return own


def _within(parse: Parse, own: np.ndarray, window: int, level: int) -> np.ndarray:
    """Names of a level, one for each place, in the interiors of windows."""
    names = parse.at_level(level)[0]
    a, b = interiors(parse, own, own + window, level)
    change = np.zeros(len(names) + 1, np.int64)
    np.add.at(change, a[a < b], 1)
    np.add.at(change, b[a < b], -1)
    return names[np.cumsum(change[:-1]) > 0]


def _told(table: pa.Table, levels: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Sorted shared names by level, from the answers to one chunk."""
    out: dict[int, list] = {level: [np.zeros(0, np.uint64)] for level in levels}
    for level, names in zip(*(table[c].to_pylist() for c in ("level", "told")), strict=True):
        out[level].append(np.frombuffer(names, np.uint64))
    return {level: np.sort(np.concatenate(parts)) for level, parts in out.items()}


def _asked(chunks: DataFrame, told: DataFrame | None, levels: tuple[int, ...], window: int, rows_of) -> DataFrame:
    """Packs that rows_of(chunk, shared names) makes of every chunk; a first round needs no answers and no shuffle."""
    if told is not None:

        def both(own: pa.Table, known: pa.Table) -> pa.Table:
            rows = rows_of(Chunk(own, window), _told(known, levels)) if own.num_rows else []
            release()
            return _table(rows, PACK)

        return chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(both, PACK)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                rows = rows_of(Chunk(pa.Table.from_batches([b.slice(k, 1)]), window), {})
                yield from _table(rows, PACK).combine_chunks().to_batches()
        release()

    return chunks.mapInArrow(alone, PACK)


def _round(chunks: DataFrame, told: DataFrame | None, levels: tuple[int, ...], window: int, bits: int) -> DataFrame:
    """Counts the symbols of the last level over all chunks: for each chunk, those of its names that occur at another place too."""
    level = levels[-1]

    def send(chunk: Chunk, known: dict[int, np.ndarray]) -> list[tuple]:
        every = [_within(parse, _alive(parse, own, window, known), window, level) for _, parse, own in chunk.slices()]
        if not every:
            return []
        names, times = np.unique(np.concatenate(every), return_counts=True)
        return [(bucket, chunk.chunk, names[part].tobytes(), np.packbits(times[part] > 1).tobytes()) for bucket, part in _dealt(names, bits)]

    def compare(packs: pa.Table) -> pa.Table:
        names = [np.frombuffer(x.as_py(), np.uint64) for x in packs["names"]]
        often = [np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(n)).astype(bool) for x, n in zip(packs["at"], names, strict=True)]
        every, times = np.unique(np.concatenate(names), return_counts=True)
        shared = times > 1
        for n, o in zip(names, often, strict=True):
            shared[np.searchsorted(every, n[o])] = True
        rows = []
        for chunk, n in zip(packs["chunk"].to_pylist(), names, strict=True):
            if len(hit := n[shared[np.searchsorted(every, n)]]):
                rows.append((chunk, level, hit.tobytes()))
        release()
        return _table(rows, TOLD)

    packs = _asked(chunks, told, levels[:-1], window, send)
    return materialize(packs.groupBy("bucket").applyInArrow(compare, TOLD), "told")


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [(n, kinds[t]) for n, t in (x.split() for x in schema.split(", "))]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.table({n: pa.array(c, t) for (n, t), c in zip(fields, columns, strict=True)})


def _verify(chunks: DataFrame, told: DataFrame, levels: tuple[int, ...], window: int, bits: int) -> DataFrame:
    """Starts of windows that are equal to another one, by chunk: singly (level 0), or as runs of starts (level -1)."""

    def send(chunk: Chunk, known: dict[int, np.ndarray]) -> list[tuple]:
        found, places = [], []
        for s, parse, own in chunk.slices():
            own = _alive(parse, own, window, known)
            found.append(np.stack(spelled(parse, own, own + window)))
            places.append(own + s)
        return _packs(chunk.chunk, np.concatenate(found, axis=1), np.concatenate(places), bits) if found else []

    def compare(packs: pa.Table) -> pa.Table:
        names = [np.frombuffer(x.as_py(), np.uint64).reshape(2, -1) for x in packs["names"]]
        at = [np.frombuffer(x.as_py(), np.int32) for x in packs["at"]]
        every = np.concatenate(names, axis=1)
        order = _sorted(every)
        same = (every[:, order[1:]] == every[:, order[:-1]]).all(0)
        twice = np.zeros(every.shape[1], bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        rows, begin = [], 0
        for chunk, n, a in zip(packs["chunk"].to_pylist(), names, at, strict=True):
            if not n.shape[1]:
                rows.append((chunk, -1, a.tobytes()))  # known within the chunk: passed on
            elif len(hit := a[twice[begin : begin + n.shape[1]] & (a >= 0)]):
                rows.append((chunk, 0, hit.tobytes()))
            begin += n.shape[1]
        release()
        return _table(rows, TOLD)

    return _asked(chunks, told, levels, window, send).groupBy("bucket").applyInArrow(compare, TOLD)


def _sorted(names: np.ndarray) -> np.ndarray:
    """An order in which equal columns of (2, n) stand together."""
    order = np.argsort(names[0], kind="stable")
    first, second = names[0][order], names[1][order]
    if ((first[1:] == first[:-1]) & (second[1:] != second[:-1])).any():
        order = np.lexsort((names[1], names[0]))
    return order


def _packs(chunk: str, found: np.ndarray, places: np.ndarray, bits: int) -> list[tuple]:
    """What a chunk sends of its windows: each distinct digest once, with the place of a lone one, else -1; and the places of the others as runs."""
    order = _sorted(found)
    found, places = found[:, order], places[order]
    new = np.ones(len(places), bool)
    new[1:] = (found[:, 1:] != found[:, :-1]).any(0)
    begins = np.flatnonzero(new)
    alone = np.diff(np.append(begins, len(places))) == 1
    local = np.sort(places[~np.repeat(alone, np.diff(np.append(begins, len(places))))])
    at = np.where(alone, places[begins], -1).astype(np.int32)
    names = found[:, begins]
    rows = [(bucket, chunk, np.ascontiguousarray(names[:, part]).tobytes(), at[part].tobytes()) for bucket, part in _dealt(names[0], bits)]
    if len(local):
        cut = np.flatnonzero(np.diff(local) > 1) + 1
        runs = np.stack([local[np.append(0, cut)], local[np.append(cut - 1, len(local) - 1)] + 1]).astype(np.int32)
        rows.append((xxhash.xxh3_64_intdigest(chunk) >> (64 - bits), chunk, b"", runs.tobytes()))
    return rows


def remove_repeats(docs: DataFrame, window: int = WINDOW, key: str = "doc_id") -> DataFrame:
    """One row per row of docs(key, text): key, n_words, n_removed, kept (the words that stay, joined by a space).

    Every word goes that lies in a window of so many words which also starts anywhere else in docs.
    """
    chunks = build(docs, key)
    kind = chunks.schema["keys"].dataType.elementType
    n_words = chunks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    bits_for = lambda n: (max(LEAST_BUCKETS, int(n) // BUCKET_NAMES) - 1).bit_length()
    levels, told = levels_for(window), None
    for k, level in enumerate(levels):
        now = _round(chunks, told, levels[: k + 1], window, bits_for(n_words / _WORDS_OF_LEVEL**level))
        told = now if told is None else told.unionByName(now)
    found = _verify(chunks, told, levels, window, bits_for(n_words))

    def remove(own: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(own, window) if own.num_rows else None
        columns: list[list] = [[], [], [], []]
        if chunk:
            change = np.zeros(len(chunk.ids) + window + 1, np.int64)
            for form, b in zip(answers["level"].to_pylist(), answers["told"].to_pylist(), strict=True):
                at = np.frombuffer(b, np.int32).astype(np.int64)
                s, e = np.split(at, 2) if form < 0 else (at, at + 1)
                np.add.at(change, s, 1)
                np.add.at(change, e + window - 1, -1)
            kept = np.cumsum(change)[: len(chunk.ids)] == 0
            for name, size, e in zip(chunk.keys, chunk.sizes.tolist(), chunk.ends.tolist(), strict=True):
                words = chunk.ids[e - size : e][kept[e - size : e]].tolist()
                row = (name, size, size - len(words), b" ".join(map(chunk.terms.__getitem__, words)))
                for c, x in zip(columns, row, strict=True):
                    c.append(x)
        kinds = (pa.string() if isinstance(kind, T.StringType) else pa.int64(), pa.int64(), pa.int64(), pa.string())
        out = pa.table({n: pa.array(c, pa.binary() if n == "kept" else t).cast(t) for n, c, t in zip(("key", "n_words", "n_removed", "kept"), columns, kinds, strict=True)})
        release()
        return out

    out = chunks.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(remove, f"key {kind.simpleString()}, n_words bigint, n_removed bigint, kept string")
    return out.withColumnRenamed("key", key)
