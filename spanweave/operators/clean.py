"""Cleaning records and moving spans between original and cleaned text."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.functions.plan import barrier
from spanweave.functions.text import DEFAULT, CleanConfig, char_map, clean, has_text, span_text
from spanweave.schema import RANGE


def clean_records(records: DataFrame, config: CleanConfig = DEFAULT) -> DataFrame:
    """records(text) with cleaned text; rows that become empty go."""
    source = nfc("text") if config.nfc_normalize else F.col("text")
    if config == DEFAULT:
        return records.filter(has_text(F.col("text"))).withColumn("text", clean(source))
    return records.withColumn("text", clean(source, config)).filter(F.length("text") > 0)


@F.arrow_udf(T.StringType())
def nfc(texts: pa.Array) -> pa.Array:
    """NFC, which Spark lacks."""
    return pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()], pa.string())


@F.arrow_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("places", T.ArrayType(T.IntegerType()))]))
def nfc_with_places(texts: pa.Array) -> pa.Array:
    """NFC, cluster by cluster (a base and its combining marks); every character comes from its cluster's start."""
    made, places = [], []
    for text in texts.to_pylist():
        out, at = [], []
        starts = [i for i, c in enumerate(text or "") if i == 0 or not unicodedata.combining(c)]
        for s, e in zip(starts, [*starts[1:], len(text or "")], strict=False):
            cluster = unicodedata.normalize("NFC", text[s:e])
            out.append(cluster)
            at += [s] * len(cluster)
        made.append(None if text is None else "".join(out))
        places.append(at)
    return pa.StructArray.from_arrays([pa.array(made, pa.string()), pa.array(places, pa.list_(pa.int32()))], names=["text", "places"])


def with_char_map(records: DataFrame, config: CleanConfig = DEFAULT) -> DataFrame:
    """records(text) with clean_text and char_map: from positions of the cleaned to those of the given text."""
    if not config.nfc_normalize:
        return records.withColumn("clean_text", clean(F.col("text"), config)).withColumn("char_map", char_map(F.col("text"), config))
    composed = records.withColumn("__nfc", nfc_with_places("text")).withColumn("clean_text", clean(F.col("__nfc.text"), config))
    return composed.withColumn("char_map", F.transform(char_map(F.col("__nfc.text"), config), lambda i: F.get("__nfc.places", i))).drop("__nfc")


def clean_and_project(records: DataFrame, config: CleanConfig = DEFAULT) -> DataFrame:
    """Records with cleaned text; entities and protected ranges move along, those without a surviving character go.

    Records that become empty go.
    """
    none = F.array().cast(_SPAN_TYPE)
    spans = F.transform("entities", lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end")))
    mapped = with_char_map(records.filter(has_text(F.col("text"))) if config == DEFAULT else records, config)
    moved = mapped.withColumn("__spans", project_to_clean("char_map", F.length("text"), spans)).withColumn(
        "__cues", project_to_clean("char_map", F.length("text"), F.coalesce("meta.preserve_spans", none))
    )
    ready = barrier(moved.drop("char_map", "text").withColumnRenamed("clean_text", "text")).filter(F.length("text") > 0)
    kept = F.filter(F.arrays_zip("entities", F.col("__spans").alias("span")), lambda x: x["span"].isNotNull())
    entity = lambda x: x["entities"].withField("start", x["span"]["start"]).withField("end", x["span"]["end"]).withField(
        "text", span_text(F.col("text"), x["span"]["start"], x["span"]["end"])
    )
    placed = ready.withColumn("entities", F.transform(kept, entity)).withColumn("meta", F.col("meta").withField("preserve_spans", F.filter("__cues", lambda c: c.isNotNull())))
    return placed.select(*records.columns)


_SPAN_TYPE = "array<struct<start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def project_to_original(char_map, size, spans):
    """Cleaned spans to original ones: their first and last character's places; null where a span is empty or out of range.

    size, the length of the original, is not needed; it is there to match project_to_clean.
    """
    table = F.col(char_map) if isinstance(char_map, str) else char_map
    sound = lambda s: (s["start"] >= 0) & (s["start"] < s["end"]) & (s["end"] <= F.size(table))
    return F.transform(spans, lambda s: F.when(sound(s), F.struct(F.get(table, s["start"]).cast("int").alias("start"), (F.get(table, s["end"] - 1) + 1).cast("int").alias("end"))))


def _projection(move):
    """A UDF of (char_map, length of the original, spans) that moves all spans of a row at once."""

    @F.arrow_udf(T.ArrayType(RANGE))
    def project(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for maps, sizes, spans in batches:
            out = []
            for k in range(len(maps)):
                there = maps[k].values
                row = spans[k].as_py()
                table = np.zeros(0, np.int64) if there is None else there.to_numpy().astype(np.int64)
                out.append(None if row is None else [move(table, sizes[k].as_py() or 0, s) for s in row])
            yield pa.array(out, _SPANS)

    return project


def _to_clean(table: np.ndarray, size: int, span: dict | None) -> dict | None:
    if span is None:
        return None
    a, b = np.searchsorted(table, (span["start"], span["end"]))
    return {"start": int(a), "end": int(b)} if a < b else None


#: Original spans to cleaned ones: first and last surviving character; null where none survives.
project_to_clean = _projection(_to_clean)
