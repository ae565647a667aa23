"""Finding given surfaces in a text: in order, from where the last one of the type ended.

Each find depends on the one before, so a record is one fold, made in Arrow batches: linear in the
text and in the number of surfaces, where a fold in SQL would copy its state at every step.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.schema import ENTITY, ENTITY_TYPES, NEGATABLE, POLARITIES, SKIPPED


def lower_in_place(text: str) -> str:
    """Lower case that keeps every position."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def locate(text: str, wanted: list[dict], ignore_case: bool = True) -> tuple[list[dict], list[dict]]:
    """Entities found, and what was skipped with the reason."""
    low = None
    after = dict.fromkeys(ENTITY_TYPES, 0)
    found, skipped = [], []
    for e in wanted:
        kind, surface = e["type"], e["text"] or ""
        reason = "unknown_type" if kind not in after else "" if surface else "empty"
        if not reason:
            at = text.find(surface, after[kind])
            if at < 0 and ignore_case:
                low = lower_in_place(text) if low is None else low
                at = low.find(lower_in_place(surface), after[kind])
            polarity = e.get("polarity") or "POS"
            if at >= 0 and (polarity not in POLARITIES or polarity == "NEG" and kind not in NEGATABLE):
                reason = "span_invalid"
            elif at >= 0:
                after[kind] = at + len(surface)
                found.append({"type": kind, "text": text[at : after[kind]], "start": at, "end": after[kind], "polarity": polarity})
                continue
            else:
                reason = "not_found"
        skipped.append({"type": kind, "text": e["text"], "reason": reason})
    kept, lost = drop_overlaps(found)
    return kept, skipped + [{"type": e["type"], "text": e["text"], "reason": "overlap"} for e in lost]


def drop_overlaps(spans: list[dict]) -> tuple[list[dict], list[dict]]:
    """By start and end; a span that begins before the last kept one ends is lost."""
    kept, lost = [], []
    for s in sorted(spans, key=lambda s: (s["start"], s["end"])):
        (lost if kept and s["start"] < kept[-1]["end"] else kept).append(s)
    return kept, lost


#: Records whose entities are Python objects at the same time.
AT_ONCE = 64
_RESULT = T.StructType([T.StructField("entities", T.ArrayType(ENTITY)), T.StructField("skipped", T.ArrayType(SKIPPED))])
_ENTITY = pa.struct([("type", pa.string()), ("text", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("polarity", pa.string())])
_SKIPPED = pa.struct([("type", pa.string()), ("text", pa.string()), ("reason", pa.string())])


def relocate(rows: DataFrame, ignore_case: bool = True, must_find: bool = False) -> DataFrame:
    """rows(record_id, text, ents: array of type, text and maybe polarity) with entities and skipped in place of ents.

    A row in which nothing is found keeps empty entities, or, with must_find, fails the job. A found surface whose
    polarity is unknown, or negative where its type cannot be, is skipped as span_invalid.
    """

    @F.arrow_udf(_RESULT)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, wanted in batches:
            parts = []
            for k in range(0, len(texts), AT_ONCE):
                given = texts.slice(k, AT_ONCE)
                made = [locate(t or "", w or [], ignore_case) for t, w in zip(given.to_pylist(), wanted.slice(k, AT_ONCE).to_pylist(), strict=True)]
                if must_find and (lost := [k for k, m in enumerate(made) if not m[0]]):
                    raise ValueError(f"nothing could be located in: {(given[lost[0]].as_py() or '')[:80]!r}")
                parts.append(pa.StructArray.from_arrays([pa.array([m[0] for m in made], pa.list_(_ENTITY)), pa.array([m[1] for m in made], pa.list_(_SKIPPED))], names=["entities", "skipped"]))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("entities", pa.list_(_ENTITY)), ("skipped", pa.list_(_SKIPPED))]))

    return rows.withColumn("r", run("text", "ents")).select("record_id", "text", "r.entities", "r.skipped")
