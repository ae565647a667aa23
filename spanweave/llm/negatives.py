"""Hard negatives for contrastive training by bit-sliced integer products.

A vector's components are whole numbers, floor(256 x). Rows are cut into bit-planes; a score is worked off from the
most significant plane down, for all pairs that are still open. What the lower planes can add is bounded by the
anchor's positive and negative components and by the norm of what they hold, so that every pair has an interval that
narrows with each plane. A pair is dropped once its interval lies below the best scores known, or outside of every
range that is asked for; what is left after the last plane is exact.

Anchors are taken in blocks of bounded size that are broadcast. For each block the rows are read twice: first for
the anchors' positives (the best rows of the same label), then for the negatives (the best rows of other labels whose
score lies between two shares of a positive's score). A partition returns at most as many rows as are asked for of
each anchor, or anchor and positive, so labels and groups of any size take no task of their own.

Defined cases: rows with a null id, label or vector, or a null or non-finite component, take no part; shorter
vectors count as padded with zeros; of several rows with an anchor's id the smallest (vector, label) is the anchor and
none of them is its candidate; other repeated rows are candidates of their own; extra columns are ignored; empty tables
give empty results. Products that could pass 2^53 are made as unbounded whole numbers, without planes; a score
beyond 64 bits is given, compared and ranked as the nearest long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanweave.llm.common import materialize, release
from spanweave.llm.vectors import LEAST, MOST, best, chunks, padded, small, sound, unbounded, whole

ANCHOR_BLOCK = 4096
ROWS = 2048
#: Anchors whose pairs with a chunk of rows are held at once.
ANCHORS = 256
#: Pairs that are multiplied one by one at once; a denser plane is multiplied as a matrix.
PAIRS = 1 << 16
SPARSE = 1 / 8
POSITIVE = "anchor_id bigint, vec_id bigint, score bigint"
NEGATIVE = "anchor_id bigint, slot int, positive_id bigint, positive_score bigint, vec_id bigint, score bigint"

Keep = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


class Planes:
    """The bit-planes of rows of whole numbers below EXACT, each row seen from its own least component."""

    def __init__(self, rows: np.ndarray) -> None:
        self.base = rows.min(1, initial=0.0)
        self.bits = (rows - self.base[:, None]).astype(np.int64)
        self.n = int(self.bits.max(initial=0)).bit_length()

    def plane(self, b: int) -> np.ndarray:
        return (self.bits >> b & 1).astype(np.float64)

    def spread(self, b: int) -> np.ndarray:
        """By row, the norm of what the planes below b hold, seen from the middle of their range."""
        rest = (self.bits & ((1 << b) - 1)) - ((1 << b) - 1) / 2
        return np.sqrt(np.einsum("ij,ij->i", rest, rest))


def progressive(planes: Planes, queries: np.ndarray, row: np.ndarray, col: np.ndarray, keep: Keep, made: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, columns, exact scores) of the pairs that keep(columns, least, most) leaves open down to the last plane.

    made: gets the number of open pairs of each plane.
    """
    total = queries.sum(1)
    above, below = np.maximum(queries, 0).sum(1), np.minimum(queries, 0).sum(1)
    length = np.sqrt(np.einsum("ij,ij->i", queries, queries)) * (1 + 1e-9)
    score = planes.base[row] * total[col]
    for b in range(planes.n - 1, -1, -1):
        if not len(row):
            break
        if made is not None:
            made.append(len(row))
        plane = planes.plane(b)
        if len(row) > SPARSE * len(plane) * len(queries):
            product = (plane @ queries.T)[row, col]
        else:
            product = np.concatenate([np.einsum("ij,ij->i", plane[row[s : s + PAIRS]], queries[col[s : s + PAIRS]]) for s in range(0, len(row), PAIRS)])
        score = score + product * float(1 << b)
        if b:
            top = float((1 << b) - 1)
            middle = score + top / 2 * total[col]
            reach = planes.spread(b)[row] * length[col] + 1e-6
            least, most = np.maximum(score + top * below[col], middle - reach), np.minimum(score + top * above[col], middle + reach)
            # whole numbers; the slack of the norm's rounding stays on the safe side
            open_ = keep(col, np.floor(least), np.ceil(most))
            row, col, score = row[open_], col[open_], score[open_]
    open_ = keep(col, score, score)
    return row[open_], col[open_], score[open_].astype(np.int64)


def _blocks(n: int) -> Iterator[slice]:
    for s in range(0, n, ANCHORS):
        yield slice(s, s + ANCHORS)


class Anchors:
    """A block of anchors: ids in rising order, labels, vectors."""

    def __init__(self, found: list) -> None:
        self.ids = np.array([r.vec_id for r in found], np.int64)
        self.labels = np.array([r.label for r in found], np.int64)
        self.raw = padded(pa.array([r.embedding for r in found], pa.list_(pa.float64())), max(len(r.embedding) for r in found))
        self.whole = whole(self.raw)
        self.peaks = np.abs(self.whole).max(1, initial=0.0)

    def pairs(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, part: slice, same: bool) -> tuple[np.ndarray, ...]:
        """(rows, columns) of a part's candidates of the same or of other labels: those with plain products, and the others."""
        candidate = ((labels[:, None] == self.labels[None, part]) == same) & (ids[:, None] != self.ids[None, part])
        plain = small(rows, 4 * self.peaks[part])  # 4: planes add up more than the product itself
        return (*np.nonzero(candidate & plain), *np.nonzero(candidate & ~plain))


def _split(rows: np.ndarray, plain_rows: np.ndarray) -> Planes:
    """Planes of a chunk; rows that are in no plain pair count as zeros."""
    used = np.zeros(len(rows), bool)
    used[plain_rows] = True
    return Planes(np.where(used[:, None], rows, 0.0))


def _positives(rows: DataFrame, sent, k: int) -> DataFrame:
    """The k best rows of each anchor's own label, by partition."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Anchors = sent.value
        held = (np.zeros(0, np.int64),) * 3
        floor = np.full(len(own.ids), LEAST, np.int64)  # the k-th best score so far
        for batch, vectors, raw in chunks(batches, own.raw.shape[1], ROWS):
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for part in _blocks(len(own.ids)):
                row, col, big_row, big_col = own.pairs(ids, labels, vectors, part, same=True)
                wanted = floor[part].astype(np.float64)

                def keep(col: np.ndarray, least: np.ndarray, most: np.ndarray, wanted: np.ndarray = wanted) -> np.ndarray:
                    return most >= np.maximum(wanted, _kth(col, least, k, len(wanted)))[col]

                q = np.where(np.isin(np.arange(len(own.ids))[part], col + part.start)[:, None], own.whole[part], 0.0)
                row, col, score = progressive(_split(vectors, row), q, row, col, keep)
                far = [unbounded(raw[r], own.raw[part][[c]])[0] for r, c in zip(big_row, big_col, strict=True)]
                new = (np.r_[col, big_col] + part.start, ids[np.r_[row, big_row]], np.r_[score, np.array(far, np.int64)])
                held = best(*(np.concatenate([x, y]) for x, y in zip(held, new, strict=True)), k)
            floor = _floors(held[0], held[2], k, len(own.ids), LEAST)
        yield pa.RecordBatch.from_arrays([pa.array(own.ids[held[0]], pa.int64()), pa.array(held[1]), pa.array(held[2])], names=["anchor_id", "vec_id", "score"])
        release()

    found = rows.mapInArrow(find, POSITIVE)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("slot", F.row_number().over(order)).filter(F.col("slot") <= k)


def _kth(group: np.ndarray, scores: np.ndarray, k: int, n: int) -> np.ndarray:
    """The k-th largest score of each of n groups, -inf where there are fewer."""
    out = np.full(n, -np.inf)
    order = np.lexsort((-scores, group))
    group, scores = group[order], scores[order]
    at = np.searchsorted(group, np.arange(n)) + k - 1
    there = at < len(group)
    there[there] = group[at[there]] == np.flatnonzero(there)
    out[there] = scores[at[there]]
    return out


def _floors(group: np.ndarray, scores: np.ndarray, k: int, n: int, none: int) -> np.ndarray:
    """The k-th score of each group in entries sorted as best() gives them, else none."""
    out = np.full(n, none, np.int64)
    at = np.searchsorted(group, np.arange(n)) + k - 1
    there = at < len(group)
    there[there] = group[at[there]] == np.flatnonzero(there)
    out[there] = scores[at[there]]
    return out


class Ranges:
    """The scores that are asked for: for each anchor and slot of a positive, its id and score, and the least and greatest negative score."""

    def __init__(self, own: Anchors, found: list, slots: int, low: int, high: int) -> None:
        shape = (len(own.ids), slots)
        self.ids, self.scores = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        self.least, self.most = np.full(shape, MOST, np.int64), np.full(shape, LEAST, np.int64)
        for r in found:
            at = int(np.searchsorted(own.ids, r.anchor_id)), r.slot - 1
            self.ids[at], self.scores[at] = r.vec_id, r.score
            least, most = -(-low * r.score // 100), high * r.score // 100
            if least <= most:
                self.least[at], self.most[at] = max(least, LEAST), min(most, MOST)


def _negatives(rows: DataFrame, sent, asked, k: int) -> DataFrame:
    """The k best rows of other labels in each range, by partition, and then of all."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Anchors = sent.value
        ranges: Ranges = asked.value
        slots = ranges.ids.shape[1]
        held = (np.zeros(0, np.int64),) * 3
        least = ranges.least.copy()  # rises to the k-th best score so far
        for batch, vectors, raw in chunks(batches, own.raw.shape[1], ROWS):
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for part in _blocks(len(own.ids)):
                row, col, big_row, big_col = own.pairs(ids, labels, vectors, part, same=False)
                low, high = least[part], ranges.most[part]

                def keep(col: np.ndarray, least: np.ndarray, most: np.ndarray, low: np.ndarray = low, high: np.ndarray = high) -> np.ndarray:
                    out = np.zeros(len(col), bool)
                    for j in range(slots):
                        out |= (most >= low[col, j]) & (least <= high[col, j])
                    return out

                q = np.where(np.isin(np.arange(len(own.ids))[part], col + part.start)[:, None], own.whole[part], 0.0)
                row, col, score = progressive(_split(vectors, row), q, row, col, keep)
                far = [unbounded(raw[r], own.raw[part][[c]])[0] for r, c in zip(big_row, big_col, strict=True)]
                row, col, score = np.r_[row, big_row], np.r_[col, big_col], np.r_[score, np.array(far, np.int64)]
                for j in range(slots):
                    ok = (score >= low[col, j]) & (score <= high[col, j])
                    new = ((col[ok] + part.start) * slots + j, ids[row[ok]], score[ok])
                    held = tuple(np.concatenate([x, y]) for x, y in zip(held, new, strict=True))
                held = best(*held, k)
            least = np.maximum(ranges.least, _floors(held[0], held[2], k, ranges.ids.size, LEAST).reshape(ranges.ids.shape))
        a, j = held[0] // slots, held[0] % slots
        columns = [own.ids[a], j.astype(np.int32), ranges.ids[a, j], ranges.scores[a, j], held[1], held[2]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in NEGATIVE.split(", ")])
        release()

    found = rows.mapInArrow(find, NEGATIVE)
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors among the rows of vectors(vec_id, embedding, label).

    A negative's score lies between low and high hundredths of the positive's score.
    """
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound()).select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), "embedding")
    first = F.min(F.struct("embedding", "label")).alias("a")
    chosen = rows.filter(is_anchor).groupBy("vec_id").agg(first).orderBy("vec_id").select("vec_id", "a.label", "a.embedding")
    spark, parts, block = vectors.sparkSession, [], []

    def close() -> None:
        own = Anchors(block)
        sent = spark.sparkContext.broadcast(own)
        found = _positives(rows, sent, positives).collect()  # as many as there are anchors times positives at most
        asked = spark.sparkContext.broadcast(Ranges(own, found, positives, low, high))
        parts.append(_negatives(rows, sent, asked, negatives))
        block.clear()

    for r in chosen.toLocalIterator():
        if len(block) == ANCHOR_BLOCK:
            close()
            parts[-1] = materialize(parts[-1], "negatives")
        block.append(r)
    if block:
        close()
    out = parts[0] if parts else spark.createDataFrame([], NEGATIVE + ", rank int")
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
