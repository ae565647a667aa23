"""Toxicity by non-negative positive-unlabelled learning.

Positives are texts confirmed as toxic, the rest of the training side is unlabelled. Two linear
logistic classifiers in numpy, one over words and one over word beginnings, are trained with the
class-prior-corrected risk  pi R_p(+) + max(0, R_u(-) - pi R_p(-)) : where the second part falls below
zero the step is taken against it. The class prior pi is the share of toxic rows among the labels
learned from, the one use of labels 0. Classifiers see the features that positives hold more often than
unlabelled texts by LEAST_Z, LEAST_PRECISION and LEAST_SUPPORT, at most KEPT_FEATURES of each kind. A
text holds a feature or not, however often, so that length alone does not raise its score. Training
takes bounded samples in the order of a hash of the ids, one text an id.

Defined cases: null and empty texts have no features and get the score of the bias; without a
positive example all scores are the class prior; a null doc_id teaches nothing; of rows with a
repeated doc_id the smallest text teaches; all of them are scored as rows of their own; extra columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import WORD_BYTES, release

POSITIVES = 3000
UNLABELLED = 9000
SLOTS = 1 << 20
#: Lengths in bytes of the word beginnings that are features.
STEMS = (4, 5, 6, 7, 8, 10)
VIEWS = ("words", "stems")
KEPT_FEATURES = 4096
#: Least z value of a feature's share in positives over its share in unlabelled texts.
LEAST_Z = 4.0
#: Least estimated share of toxic texts among those that hold a feature.
LEAST_PRECISION = 0.6
#: Least share of positives that hold a feature.
LEAST_SUPPORT = 0.01
#: Training texts with the same so many smallest word features count as copies of one text.
SIGNATURE = 16
STEPS, RATE, DECAY = 600, 0.1, 2e-4
#: Words whose features a task remembers.
MEMORY = 200_000


def text_words(text: str | None) -> set[bytes]:
    return set((text or "").lower().encode().translate(WORD_BYTES).split())


def word_features(word: bytes, view: str) -> tuple[int, ...]:
    if view == "words":
        return (zlib.crc32(word) & (SLOTS - 1),)
    return tuple(zlib.crc32(b"%d:" % n + word[:n]) & (SLOTS - 1) for n in STEMS if len(word) >= n)


def _sampled(docs: DataFrame, labels: DataFrame, learn: Column) -> tuple[DataFrame, float]:
    """(text, positive) of the training sample, and the class prior among learned labels."""
    told = labels.select("doc_id", "toxic").filter(learn & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    prior = told.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    order = [F.xxhash64("doc_id"), "doc_id"]
    sure = told.filter("toxic = 1").select("doc_id").distinct().orderBy(*order).limit(POSITIVES)
    rest = docs.select("doc_id").filter(learn & F.col("doc_id").isNotNull()).distinct().orderBy(*order).limit(UNLABELLED)
    drawn = sure.withColumn("positive", F.lit(True)).unionByName(rest.withColumn("positive", F.lit(False)))  # a bounded number of ids
    held = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    return held.groupBy("doc_id", "positive").agg(F.min("text").alias("text")).select("text", "positive"), prior


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> dict:
    """The model from docs(doc_id, text) and labels(doc_id, toxic) of the rows where learn holds."""
    drawn, prior = _sampled(docs, labels, learn)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, positive in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = text_words(text)
                rows.append([positive, *(np.array(sorted({f for w in words for f in word_features(w, v)}), np.int32).tobytes() for v in VIEWS)])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["positive", *VIEWS])
        release()

    sample = drawn.mapInArrow(features, "positive boolean, words binary, stems binary").toArrow()
    first: dict[tuple, int] = {}
    for k, (p, words) in enumerate(zip(sample.column("positive").to_pylist(), sample.column("words"), strict=True)):
        first.setdefault((p, words.as_py()[: 4 * SIGNATURE]), k)
    sample = sample.take(pa.array(list(first.values()), pa.int64()))
    positive = np.array(sample.column("positive").to_pylist(), bool)
    model = {"prior": prior, "views": {}}
    if positive.any() and (~positive).any() and 0 < prior < 1:
        for view in VIEWS:
            model["views"][view] = fit([np.frombuffer(x.as_py(), np.int32) for x in sample.column(view)], positive, prior)
    return model


def negative_risk(score: np.ndarray, positive: np.ndarray, prior: float) -> float:
    """R_u(-) - pi R_p(-): the estimated risk of the negatives, which only an overfitted classifier brings below zero."""
    loss = np.logaddexp(0, score)  # of a score taken as negative
    return float(loss[~positive].mean() - prior * loss[positive].mean())


def fit(rows: list[np.ndarray], positive: np.ndarray, prior: float, non_negative: bool = True) -> tuple[dict[int, float], float]:
    """Weights by feature and the bias of a logistic classifier with the non-negative PU risk."""
    n_p, n_u = int(positive.sum()), int((~positive).sum())
    lens = np.array([len(r) for r in rows])
    flat = np.concatenate(rows) if len(rows) else np.zeros(0, np.int32)
    is_p = np.repeat(positive, lens)
    in_p, in_u = (np.bincount(flat[m], minlength=SLOTS) for m in (is_p, ~is_p))
    share = (in_p + in_u + 1.0) / (n_p + n_u + 2.0)
    z = (in_p / n_p - in_u / n_u) / np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u))
    chosen = np.flatnonzero((z >= LEAST_Z) & (in_p >= max(3, LEAST_SUPPORT * n_p)) & (prior * in_p / n_p >= LEAST_PRECISION * in_u / n_u))
    chosen = chosen[np.argsort(-z[chosen], kind="stable")[:KEPT_FEATURES]]
    place = np.full(SLOTS, -1)
    place[chosen] = np.arange(len(chosen))
    col = place[flat]
    row = np.repeat(np.arange(len(rows)), lens)[col >= 0]
    col = col[col >= 0]
    w, b = np.zeros(len(chosen)), np.log(prior / (1 - prior))
    m_w, v_w, m_b, v_b = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    share_of = np.where(positive, prior / n_p, 1 / n_u)
    for step in range(1, STEPS + 1):
        score = np.bincount(row, weights=w[col], minlength=len(rows)) + b
        on = 1 / (1 + np.exp(-np.clip(score, -50, 50)))
        if not non_negative or negative_risk(score, positive, prior) >= 0:
            slope = np.where(positive, share_of * (on - 1) - share_of * on, share_of * on)
        else:
            slope = -np.where(positive, -share_of * on, share_of * on)
        g = np.bincount(col, weights=slope[row], minlength=len(w)) + DECAY * prior * w
        g_b = slope.sum()
        m_w, m_b = 0.9 * m_w + 0.1 * g, 0.9 * m_b + 0.1 * g_b
        v_w, v_b = 0.999 * v_w + 0.001 * g * g, 0.999 * v_b + 0.001 * g_b * g_b
        by = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        w -= by * m_w / (np.sqrt(v_w) + 1e-8)
        b -= by * m_b / (np.sqrt(v_b) + 1e-8)
    return dict(zip(chosen.tolist(), w.tolist(), strict=True)), float(b)


def score(model: dict, spark):
    """A column function text -> score from 0 to 1: the larger of the classifiers' probabilities."""
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def toxic(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        prior, views = sent.value["prior"], sent.value["views"]
        known: dict[bytes, tuple] = {}
        for batch in batches:
            out = []
            for k in range(len(batch)):
                held: tuple[set[int], ...] = tuple(set() for _ in views)
                for word in text_words(batch[k].as_py()):
                    if (f := known.get(word)) is None:
                        f = tuple(tuple(x for x in word_features(word, v) if x in views[v][0]) for v in views)
                        f = f if any(f) else ()
                        if len(known) >= MEMORY:
                            known.clear()
                        known[word] = f
                    for mine, new in zip(held, f, strict=False):
                        mine.update(new)
                raised = [b + sum(w[x] for x in sorted(mine)) for mine, (w, b) in zip(held, views.values(), strict=True)]
                out.append(max((1 / (1 + np.exp(-np.clip(x, -50, 50))) for x in raised), default=prior))
            yield pa.array(out, pa.float64())
        known.clear()
        release()

    return toxic
