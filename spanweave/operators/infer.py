"""Applying a pluggable scorer: raw text in, entities in the coordinates of the raw text out.

A scorer is a function from a list of token lists to a list of (tokens x labels) score arrays. It is
made once per Python worker by `make_scorer` (load a model there), and sees whole Arrow batches.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from spanweave.functions.text import DEFAULT, CleanConfig
from spanweave.operators import whole
from spanweave.operators.clean import project_to_original, with_char_map
from spanweave.schema import LABELS, MAX_CHARS, MAX_TOKENS
from spanweave.sources.records import SIDECAR, THRESHOLDS, load_config, load_thresholds

Scorer = Callable[[list[list[str]]], list[np.ndarray]]
#: Records that are scored together where their time is taken.
TIMED = 8


@dataclass(frozen=True)
class Artifact:
    """A model's folder: the model file, the tokenizer's, and what stands beside them."""

    model: str
    tokenizer: str
    thresholds: list[float] | None = None
    config: CleanConfig = DEFAULT
    intra_threads: int = 2
    inter_threads: int = 1


def from_artifact_dir(folder: str) -> Artifact:
    """The files of a model's folder; thresholds and switches of cleaning are taken from their sidecars where they are there.

    Threads come from ORT_INTRA_OP and ORT_INTER_OP. The scorer opens the model file in the worker.
    """
    return Artifact(
        f"{folder}/model.onnx", f"{folder}/tokenizer.json", load_thresholds(f"{folder}/{THRESHOLDS}"), load_config(f"{folder}/{SIDECAR}"),
        int(os.environ.get("ORT_INTRA_OP", "2")), int(os.environ.get("ORT_INTER_OP", "1")),
    )


def predict_with(records: DataFrame, artifact: Artifact, make_scorer: Callable[[Artifact], Scorer]) -> DataFrame:
    """predict() with an artifact's thresholds and cleaning; make_scorer opens its model, once a worker."""
    return predict(records, lambda: make_scorer(artifact), artifact.thresholds, artifact.config)


def predict_lines(lines: DataFrame, make_scorer: Callable[[], Scorer], report_latency: bool = False, observed: Observation | None = None, **options) -> DataFrame:
    """lines(text) as JSON objects of text and entities; with report_latency, also the milliseconds that scoring the line took.

    Lines are scored in groups of TIMED, so a line's time is that of its group by its size. observed gets, once the result
    has been computed, lines, p50_ms, p99_ms and max_ms of all of them.
    """
    numbered = lines.select(F.monotonically_increasing_id().alias("record_id"), "text")
    found = predict(numbered, make_scorer, timed=report_latency or observed is not None, kept=True, **options)
    if observed is not None:
        ms = F.col("latency_ms")
        found = found.observe(
            observed, F.count("*").alias("lines"), F.percentile_approx(ms, 0.5, 10_000).alias("p50_ms"), F.percentile_approx(ms, 0.99, 10_000).alias("p99_ms"), F.max(ms).alias("max_ms")
        )
    extra = [F.round("latency_ms", 2).alias("latency_ms")] if report_latency else []
    return found.select(F.to_json(F.struct("text", "entities", *extra)).alias("value"))


def toy_scorer() -> Scorer:
    """A deterministic stand-in for a model: capitalised words are PERSON, words with a digit COMMODITY."""

    def score(batch: list[list[str]]) -> list[np.ndarray]:
        out = []
        for tokens in batch:
            scores = np.zeros((len(tokens), len(LABELS)), np.float32)
            # a word of letters has no digit
            scores[np.arange(len(tokens)), [7 if not t.isalpha() and any(c.isdigit() for c in t) else 1 if t[:1].isupper() else 0 for t in tokens]] = 4.0
            out.append(scores)
        return out

    return score


def scored_spans(make_scorer: Callable[[], Scorer], thresholds: list[float], max_tokens: int = MAX_TOKENS, timed: bool = False):
    """A function of cleaned texts to (spans, ms): what the labels of each text's first max_tokens tokens decode to.

    A text is tokenised, scored and decoded where it stands. timed: ms is the time that the scorer took for the record's
    group of TIMED records, by their number; null for a text without tokens, which is not scored.
    """

    @F.arrow_udf("struct<spans:array<struct<start:int,end:int,type:string,polarity:string>>,ms:double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = make_scorer()
        for texts in batches:
            n = len(texts)
            piece = whole.Piece(pa.RecordBatch.from_arrays([pa.array(np.arange(n)), texts], names=["record_id", "text"]))
            t = piece.tokens()
            t = whole.take(t, np.flatnonzero(t["tok_idx"] < max_tokens))
            words, ends = piece.texts(t["from"], t["to"]).to_pylist(), np.searchsorted(t["owner"], np.arange(n + 1))
            own = np.flatnonzero(np.diff(ends))
            rows = [words[ends[k] : ends[k + 1]] for k in own.tolist()]
            scores, ms = [np.zeros((0, len(LABELS)))], np.full(n, np.nan)
            size = TIMED if timed else max(1, len(rows))
            for k in range(0, len(rows), size):
                began = time.perf_counter()
                scores += scorer(rows[k : k + size])
                ms[own[k : k + size]] = (time.perf_counter() - began) * 1000 / len(rows[k : k + size])
            flat = np.concatenate(scores).astype(np.float64)
            powers = np.exp(flat - flat.max(1, keepdims=True)) if len(flat) else flat
            spans = whole.decode(t, whole.gate(powers / powers.sum(1, keepdims=True), thresholds))
            kind, place = pa.array(spans["kind"]), lambda c: pa.array(spans[c].astype(np.int32))  # noqa: B023, E731
            made = whole.lists(spans["owner"], n, start=place("start"), end=place("end"), type=whole.TYPES.take(kind), polarity=whole.POLARITY.take(kind))
            yield pa.StructArray.from_arrays([made, pa.array(ms, from_pandas=True)], names=["spans", "ms"])

    return run


def predict(records: DataFrame, make_scorer: Callable[[], Scorer], thresholds: list[float] | None = None, config: CleanConfig = DEFAULT, timed: bool = False, kept: bool = False) -> DataFrame:
    """records(record_id, text) with entities of the raw text; records without any, and empty ones, keep an empty array.

    Serving takes the first MAX_CHARS characters of a text, cleans them, and scores what is not empty. timed: also
    latency_ms, 0 for what is not scored; kept: also the text as it was given.
    """
    cut = records.select("record_id", F.substring(F.coalesce("text", F.lit("")), 1, MAX_CHARS).alias("text"), F.col("text").alias("given"))
    mapped = with_char_map(cut, config).withColumnRenamed("text", "raw")
    scored = mapped.withColumn("scored", scored_spans(make_scorer, thresholds or [0.0] * len(LABELS), timed=timed)("clean_text"))
    placed = scored.select("record_id", "raw", "char_map", "given", "scored.spans", "scored.ms")
    moved = placed.withColumn("moved", project_to_original("char_map", F.length("raw"), F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))))
    entity = lambda x: F.struct(
        x["spans"]["type"].alias("type"),
        F.substring(F.col("raw"), x["moved"]["start"] + 1, x["moved"]["end"] - x["moved"]["start"]).alias("text"),
        x["moved"]["start"].alias("start"), x["moved"]["end"].alias("end"), x["spans"]["polarity"].alias("polarity"),
    )
    none = F.array().cast("array<struct<type:string,text:string,start:int,end:int,polarity:string>>")
    more = [F.col("given").alias("text")] * kept + [F.coalesce("ms", F.lit(0.0)).alias("latency_ms")] * timed
    return moved.select("record_id", F.coalesce(F.transform(F.arrays_zip("spans", "moved"), entity), none).alias("entities"), *more)
