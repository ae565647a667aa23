"""Vectors as whole numbers: floor(256 x), exact inner products, best entries. Shared by top-k search and hard-negative mining."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sums of whole numbers held as doubles are exact below this.
EXACT = 2.0**53
LEAST, MOST = -(2**63), 2**63 - 1


def sound(embedding: str = "embedding") -> Column:
    """Whether a vector is there and has neither null nor non-finite components."""
    each = F.forall(embedding, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.col(embedding).isNotNull() & each


def padded(vectors: pa.Array, dims: int) -> np.ndarray:
    """List vectors as rows of doubles, cut or padded with zeros to dims."""
    vectors = vectors.cast(pa.list_(pa.float64()))
    lens = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if len(lens) and (lens == dims).all():
        return flat.reshape(len(lens), dims)
    out = np.zeros((len(lens), dims))
    ends = np.cumsum(lens)
    for i, (e, n) in enumerate(zip(ends.tolist(), lens.tolist(), strict=True)):
        n_used = min(n, dims)
        out[i, :n_used] = flat[e - n : e - n + n_used]
    return out


def whole(raw: np.ndarray) -> np.ndarray:
    """floor(256 x) as doubles; infinite where that is beyond them, which no bound below EXACT admits."""
    with np.errstate(over="ignore"):
        return np.floor(256 * raw)


def _exact(x: float) -> int:
    return 256 * int(x) if abs(x) >= EXACT else math.floor(256 * x)


def unbounded(row: np.ndarray, others: np.ndarray) -> list[int]:
    """Exact inner products of a vector of doubles with others, both as floor(256 x), saturated at 64 bits."""
    own = [_exact(x) for x in row.tolist()]
    return [min(max(sum(x * _exact(y) for x, y in zip(own, other, strict=True)), LEAST), MOST) for other in others.tolist()]


def small(rows: np.ndarray, peaks: np.ndarray) -> np.ndarray:
    """Row by row and for each of the others' largest components, whether all sums of products stay below EXACT."""
    with np.errstate(over="ignore", invalid="ignore"):
        return np.abs(rows).max(1, initial=0.0)[:, None] * peaks[None, :] * max(1, rows.shape[1]) < EXACT


def best(group: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best entries of each group; ties to the smaller id."""
    order = np.lexsort((ids, ~scores, group))  # ~x falls as x rises, for the least long too
    group, ids, scores = group[order], ids[order], scores[order]
    begins = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
    nth = np.arange(len(group)) - np.repeat(begins, np.diff(np.r_[begins, len(group)]))
    return group[nth < k], ids[nth < k], scores[nth < k]


def chunks(batches: Iterator[pa.RecordBatch], dims: int, rows: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches of at most so many rows with their vectors (the last column) as whole numbers and as they were."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            part = batch.slice(k, rows)
            raw = padded(part.column(part.num_columns - 1), dims)
            yield part, whole(raw), raw
