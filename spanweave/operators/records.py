"""Checks on records, constraint checks on the annotation store, and guarded writes."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.schema import ENTITY_TYPES, NEGATABLE, POLARITIES, RECORD


def entity_error(text: str | None, kind: str | None, surface: str | None, start: int | None, end: int | None, polarity: str | None) -> str | None:
    """The first rule that an entity breaks; what is null breaks none."""
    if kind is not None and kind not in ENTITY_TYPES:
        return "unknown_type"
    if start is not None and start < 0:
        return "negative_start"
    if start is not None and end is not None and end <= start:
        return "empty_span"
    if polarity is not None and polarity not in POLARITIES:
        return "unknown_polarity"
    if polarity == "NEG" and kind is not None and kind not in NEGATABLE:
        return "not_negatable"
    if text is not None and end is not None and end > len(text):
        return "out_of_text"
    if None not in (text, surface, start, end) and text[start:end] != surface:
        return "other_text"
    return None


@F.arrow_udf(T.ArrayType(T.StringType()))
def _entity_errors(texts: pa.Array, entities: pa.Array) -> pa.Array:
    """The errors of each record's entities. In Python, where a slice does not walk through the text before it."""
    flat = entities.flatten()
    columns = zip(*(flat.field(c).to_pylist() for c in ("type", "text", "start", "end", "polarity")), strict=True) if len(flat) else iter(())
    made: list[list[str] | None] = []
    for t, n in zip(texts, entities.value_lengths().to_pylist(), strict=True):
        text = t.as_py()
        found = [entity_error(text, *next(columns)) for _ in range(n or 0)]
        made.append(None if n is None else [x for x in found if x])
    return pa.array(made, pa.list_(pa.string()))


def has_overlap(entities: Column) -> Column:
    """Whether two entities of an array share a character; touching is fine."""
    placed = F.array_sort(F.transform(entities, lambda e: F.struct(e["start"].alias("s"), e["end"].alias("e"))))
    pairs = F.zip_with(placed, F.slice(placed, 2, F.greatest(F.size(placed), F.lit(1))), lambda a, b: F.coalesce(b["s"] < a["e"], F.lit(False)))
    return F.exists(pairs, lambda x: x)


def validate(records: DataFrame) -> DataFrame:
    """records(text, entities) with errors (one entry a broken entity, plus overlap); empty if sound."""
    found = _entity_errors("text", "entities")
    overlap = F.when(has_overlap(F.col("entities")), F.array(F.lit("overlap"))).otherwise(F.array().cast("array<string>"))
    return records.withColumn("errors", F.concat(found, overlap))


def split_valid(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sound records, and the others with their errors."""
    checked = validate(records)
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)


def to_json(records: DataFrame) -> DataFrame:
    """One JSON object a record."""
    return records.select(F.to_json(F.struct("text", "entities", "meta")).alias("value"))


def from_json(lines: DataFrame) -> DataFrame:
    """Records of JSON lines(value); blank lines go, missing parts get their defaults."""
    parsed = lines.filter(F.trim("value") != "").select(F.from_json("value", RECORD, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    return with_defaults(parsed)


def with_defaults(records: DataFrame) -> DataFrame:
    """Missing entities become none, missing polarity POS."""
    filled = F.transform("entities", lambda e: e.withField("polarity", F.coalesce(e["polarity"], F.lit("POS"))))
    return records.withColumn("entities", F.coalesce(filled, F.array().cast(RECORD["entities"].dataType)))


def duplicate_keys(rows: DataFrame, *key: str) -> DataFrame:
    """Keys that break uniqueness, with their number of rows."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(rows: DataFrame, parents: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows whose foreign key has no parent."""
    return rows.join(parents.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def keep_first(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: the one of smallest order. A partial aggregate, not a window."""
    others = [c for c in rows.columns if c != key]
    least = rows.groupBy(key).agg(F.min_by(F.struct(*others), order).alias("r"))
    return least.select(key, *[F.col(f"r.{c}").alias(c) for c in others]).select(*rows.columns)


def locked_conflicts(changes: DataFrame, target: DataFrame, key: str = "id") -> DataFrame:
    """Changes that touch a locked row of target."""
    return changes.join(target.filter("locked_at IS NOT NULL").select(key), key, "left_semi")


def guarded_merge(changes: DataFrame, target: DataFrame, key: str = "id") -> DataFrame:
    """target with rows replaced or added from changes (same columns); locked rows may not change."""
    if locked_conflicts(changes, target, key).limit(1).count():
        raise ValueError("a locked record is immutable")
    return target.join(changes.select(key), key, "left_anti").unionByName(changes)


def insert_ignore(new: DataFrame, target: DataFrame, *key: str) -> DataFrame:
    """target and the new rows whose key it lacks."""
    return target.unionByName(new.dropDuplicates(list(key)).join(target.select(*key), list(key), "left_anti"))
