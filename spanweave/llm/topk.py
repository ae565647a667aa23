"""Exact top-k inner products by the three-phase uniform threshold algorithm.

A score is the sum of the local scores of m lists, one for each stretch of dimensions.
Phase 1 gathers local score lists: every partition of a share of the rows takes, for each query and
list, its k best local scores, and only of these rows the totals; any rows will do, so the k-th best
total of a query is a safe cutoff t. Phase 2: t is broadcast with the block of queries. A row can only
reach t if one of its local scores reaches t/m, so entries below are not collected; rows come in the
order of their norms, and a list is not looked into at all for the queries that the norms of a chunk
keep below t/m. Rows whose collected local scores, with t/m for the ones left out, stay below t go as
well. Phase 3: the totals of the remaining entries are resolved exactly in whole numbers, and each
partition returns its best k. Queries are taken in blocks of bounded size; every block reads the rows
once and a share of them before, and shuffles at most k entries for each partition and query.

Defined cases: vectors that are null or hold null or non-finite components, and rows without id,
take no part; shorter vectors count as padded with zeros; of several rows with a query's id the
smallest vector is the query, and none of them is its candidate; other repeated rows are candidates
of their own; extra columns are ignored; empty tables give empty results. Finite components of any size
take part; where a sum could pass 2^53 they are multiplied as unbounded whole numbers, outside of the lists; a score beyond 64
bits is given, and ranked, as the nearest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanweave.llm.common import materialize, release
from spanweave.llm.vectors import best, padded, small, sound, unbounded, whole

QUERY_BLOCK = 4096
LISTS = 2
ROWS = 2048
#: Entries that are resolved at once.
PAIRS = 250_000
#: One row in so many gives the cutoff.
FIRST = 8
ENTRY = "query_id bigint, vec_id bigint, score bigint"


def _resolve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise exact inner products, of numbers whose sums stay below EXACT."""
    return np.einsum("ij,ij->i", a, b).astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, whole vectors and vectors as they were, the rows of a batch in falling order of their largest component."""
    for batch in batches:
        ids, raw = batch.column(0).to_numpy(), padded(batch.column(1), dims)
        order = np.argsort(-np.abs(raw).max(1, initial=0.0), kind="stable")
        for k in range(0, len(ids), ROWS):
            part = order[k : k + ROWS]
            yield ids[part], whole(raw[part]), raw[part]


def _entries(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(query_ids[q], pa.int64()), pa.array(ids, pa.int64()), pa.array(scores.astype(np.int64), pa.int64())], names=["query_id", "vec_id", "score"]
    )


def _block(vectors: DataFrame, query_ids: np.ndarray, given: np.ndarray, k: int, lists: int) -> DataFrame:
    spark = vectors.sparkSession
    queries, dims = whole(given), given.shape[1]
    cuts = [(a[0], a[-1] + 1) for a in np.array_split(np.arange(dims), min(lists, max(1, dims))) if len(a)] or [(0, 0)]
    peaks = np.abs(queries).max(1, initial=0.0)
    sent = spark.sparkContext.broadcast((query_ids, queries, peaks, given))

    def own_cells(ids: np.ndarray, qid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and columns where a row has the query's own id."""
        at = np.minimum(np.searchsorted(qid, ids), len(qid) - 1)
        own = np.flatnonzero(qid[at] == ids)
        return own, at[own]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qid, q, peak, _ = sent.value
        kept: list[tuple | None] = [None] * len(cuts)
        for ids, rows, _ in _chunks(batches, dims):
            plain = np.flatnonzero(small(rows, peak).all(1))
            ids, rows = ids[plain], rows[plain]
            own = own_cells(ids, qid)
            for b, (s, e) in enumerate(cuts):
                local = rows[:, s:e] @ q[:, s:e].T
                local[own] = -np.inf
                n = min(k, len(ids))
                if not n:
                    continue
                top = np.argpartition(-local, n - 1, axis=0)[:n]
                scores = np.take_along_axis(local, top, 0)
                total = np.stack([np.where(np.isfinite(scores[j]), np.einsum("ij,ij->i", rows[top[j]], q), -np.inf) for j in range(n)])
                new, old = (scores, ids[top], total), kept[b]
                both = new if old is None else tuple(np.concatenate([x, y]) for x, y in zip(old, new, strict=True))
                order = np.argsort(-both[0], axis=0, kind="stable")[:k]
                kept[b] = tuple(np.take_along_axis(x, order, 0) for x in both)
        found = [x for x in kept if x is not None]
        if found:
            total = np.concatenate([x[2] for x in found])
            row, col = np.nonzero(np.isfinite(total))
            ids = np.concatenate([x[1] for x in found])[row, col]
            pairs = np.unique(np.stack([col, ids, total[row, col].astype(np.int64)]), axis=1)
            yield _entries(qid, *best(*pairs, k))
        release()

    some = vectors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(FIRST)) == 0)
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = some.mapInArrow(gather, ENTRY).withColumn("nth", F.row_number().over(by_score)).filter(F.col("nth") == k).select("query_id", "score")
    cutoff = np.full(len(query_ids), -np.inf)
    for r in kth.collect():  # one row a query of this block at most
        cutoff[np.searchsorted(query_ids, r.query_id)] = r.score
    told = spark.sparkContext.broadcast(cutoff)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (qid, q, peak, raw_q), t = sent.value, told.value
        safe = t / len(cuts)
        lengths = [np.sqrt(np.einsum("ij,ij->i", q[:, s:e], q[:, s:e])) for s, e in cuts]
        kept = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))

        def keep(col: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
            nonlocal kept
            kept = best(*(np.concatenate([x, y]) for x, y in zip(kept, (col, ids, score), strict=True)), k)

        for ids, rows, raw in _chunks(batches, dims):
            own = own_cells(ids, qid)
            plain = small(rows, peak)
            if not plain.all():
                for i in np.flatnonzero(~plain.all(1)):
                    col = np.flatnonzero(~plain[i] & (qid != ids[i]))
                    keep(col, np.full(len(col), ids[i]), np.array(unbounded(raw[i], raw_q[col]), np.int64))
            else:
                plain = None
            with np.errstate(over="ignore", invalid="ignore"):
                made = []
                for (s, e), length, least in zip(cuts, lengths, [safe] * len(cuts), strict=True):
                    # no local score of this chunk can reach the cutoff where the norms do not; a little slack for rounding
                    norm = np.sqrt(np.einsum("ij,ij->i", rows[:, s:e], rows[:, s:e])).max(initial=0.0)
                    reach = np.flatnonzero(~(norm * length * (1 + 1e-9) < least))
                    local = np.full((len(ids), len(qid)), -np.inf)
                    if len(reach):
                        local[:, reach] = rows[:, s:e] @ q[reach, s:e].T
                    made.append(local)
                known = [~(x < safe) for x in made]
            enough = np.logical_or.reduce(known)
            enough[own] = False
            if plain is not None:
                enough &= plain
            row, col = np.nonzero(enough)
            bound = sum(np.where(y[row, col], x[row, col], safe[col]) for x, y in zip(made, known, strict=True))
            ok = ~(bound < t[col])
            row, col = row[ok], col[ok]
            for s in range(0, len(row), PAIRS):
                r, c = row[s : s + PAIRS], col[s : s + PAIRS]
                score = _resolve(rows[r], q[c])
                ok = ~(score < t[c])
                keep(c[ok], ids[r[ok]], score[ok])
        yield _entries(qid, *kept)
        release()

    final = vectors.mapInArrow(collect, ENTRY).withColumn("rank", F.row_number().over(by_score))
    return final.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, is_query, k: int = 5, lists: int = LISTS) -> DataFrame:
    """(query_id, rank, vec_id, score) for rows of vectors(vec_id, embedding); is_query: condition on vec_id."""
    rows = vectors.select(F.col("vec_id").cast("bigint"), "embedding").filter(F.col("vec_id").isNotNull() & sound())
    chosen = rows.filter(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding")).orderBy("vec_id")
    parts: list[DataFrame] = []
    block: list = []

    def close() -> None:
        dims = max(len(r.embedding) for r in block)
        ids = np.array([r.vec_id for r in block], np.int64)
        parts.append(_block(rows, ids, padded(pa.array([r.embedding for r in block], pa.list_(pa.float64())), dims), k, lists))
        block.clear()

    for r in chosen.toLocalIterator():
        if len(block) == QUERY_BLOCK:
            close()
            parts[-1] = materialize(parts[-1], "topk")
        block.append(r)
    if block:
        close()
    if not parts:
        return rows.limit(0).select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.col("vec_id").alias("score"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
