"""Records as JSON lines, configuration sidecars, plain lines of text, and a small built-in gold set."""

from __future__ import annotations

import json
from dataclasses import asdict, fields
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.functions.text import CleanConfig
from spanweave.operators.records import from_json, to_json, with_defaults
from spanweave.schema import LABELS, RECORD

#: Names of the files beside records and models.
SIDECAR, THRESHOLDS = "preprocess.json", "thresholds.json"

# The texts of the edge-case suite, with (type, surface, polarity) of what is expected in each. The
# third is ambiguous; it is resolved as an organisation. The fifth has a dash of U+2014; the ninth has a no-break
# space and a zero-width space in a name; the tenth is built to end its last entity beyond 500 characters.
EDGE_CASES = (
    ("EC-01", ""),
    ("EC-02", "   "),
    ("EC-03", "Acme", ("ORG", "Acme", "POS")),
    (
        "EC-04", "Maria Gonzalez from Acme Trading Co. confirmed refined copper cathode shipped to 42 Industrial Park Road, Rotterdam, 3011 AB.",
        ("PERSON", "Maria Gonzalez", "POS"), ("ORG", "Acme Trading Co.", "POS"), ("COMMODITY", "refined copper cathode", "POS"), ("ADDRESS", "42 Industrial Park Road, Rotterdam, 3011 AB", "POS"),
    ),
    (
        "EC-05", "Manifest: galvanized steel coil, anhydrous ammonia, raw cane sugar \u2014 ETA Felix Yu, Oceanic Freight Co.",
        ("COMMODITY", "galvanized steel coil", "POS"), ("COMMODITY", "anhydrous ammonia", "POS"), ("COMMODITY", "raw cane sugar", "POS"), ("PERSON", "Felix Yu", "POS"), ("ORG", "Oceanic Freight Co.", "POS"),
    ),
    ("EC-06", "does not contain wood", ("COMMODITY", "wood", "NEG")),
    ("EC-07", "no special wood, but ordinary wood is fine", ("COMMODITY", "special wood", "NEG"), ("COMMODITY", "ordinary wood", "POS")),
    ("EC-08", "shipment of sugar-free chocolate and stainless steel sheet", ("COMMODITY", "sugar-free chocolate", "POS"), ("COMMODITY", "stainless steel sheet", "POS")),
    ("EC-09", "Signed by Maria\u00a0Gonzalez\u200b today", ("PERSON", "Maria\u00a0Gonzalez", "POS")),
    ("EC-10", "lorem ipsum " * 41 + "Rotterdam Metals", ("ORG", "Rotterdam Metals", "POS")),
)

# Example sentences of our own with (type, surface, polarity).
GOLD = (
    ("Copper wire from Halden Metals for Ada Lindqvist.", ("COMMODITY", "Copper wire", "POS"), ("ORG", "Halden Metals", "POS"), ("PERSON", "Ada Lindqvist", "POS")),
    ("The crate holds linen, no oak boards.", ("COMMODITY", "linen", "POS"), ("COMMODITY", "oak boards", "NEG")),
    ("Deliver to 9 Quay Lane, Bergen without glass.", ("ADDRESS", "9 Quay Lane, Bergen", "POS"), ("COMMODITY", "glass", "NEG")),
    ("Signed: Tomas Reyes, Northgate Traders.", ("PERSON", "Tomas Reyes", "POS"), ("ORG", "Northgate Traders", "POS")),
    ("Nothing to declare on this page.",),
)


def write_jsonl(records: DataFrame, path: str) -> None:
    to_json(records).write.mode("overwrite").text(path)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Records of JSON lines; blank lines go, bad ones fail the job."""
    return from_json(spark.read.text(path))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(text) of every line that is not blank."""
    return spark.read.text(path).filter(F.trim("value") != "").select(F.col("value").alias("text"))


def _gold_row(k: int, text: str, found) -> tuple:
    return (k, text, [(t, s, text.index(s), text.index(s) + len(s), p) for t, s, p in found], (None, [], []))


def edge_cases(spark: SparkSession) -> DataFrame:
    """The edge-case suite as records with the column case."""
    rows = [(*_gold_row(k, text, found), case) for k, (case, text, *found) in enumerate(EDGE_CASES)]
    return spark.createDataFrame(rows, T.StructType([*RECORD.fields, T.StructField("case", T.StringType())]))


def load_gold(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Gold records from JSON lines, or the built-in ones."""
    if path:
        return read_jsonl(spark, path)
    return with_defaults(spark.createDataFrame([_gold_row(k, text, found) for k, (text, *found) in enumerate(GOLD)], RECORD))


def save_config(config: CleanConfig, path: str) -> None:
    Path(path).write_text(json.dumps(asdict(config), indent=2))


def load_config(path: str) -> CleanConfig:
    """The stored switches; defaults where the file or a switch is absent, unknown names are ignored."""
    if not Path(path).exists():
        return CleanConfig()
    known = {f.name for f in fields(CleanConfig)}
    return CleanConfig(**{k: v for k, v in json.loads(Path(path).read_text()).items() if k in known})


def save_thresholds(thresholds: dict[str, float], path: str) -> None:
    Path(path).write_text(json.dumps(thresholds, indent=2))


def load_thresholds(path: str) -> list[float] | None:
    """Thresholds by label id: O is 0, missing labels are 0; None where the file is absent."""
    if not Path(path).exists():
        return None
    told = json.loads(Path(path).read_text())
    return [0.0, *(float(told.get(label, 0.0)) for label in LABELS[1:])]
