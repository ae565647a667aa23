"""Label space, limits and row types.

Offsets are 0-based, half-open and count Unicode code points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The label contract (order = class id) and the limits.
ENTITY_TYPES = ("PERSON", "ORG", "ADDRESS", "COMMODITY")
POLARITIES = ("POS", "NEG")
NEGATABLE = ("COMMODITY",)
LABELS = (
    "O", "B-PERSON", "I-PERSON", "B-ORG", "I-ORG", "B-ADDRESS", "I-ADDRESS",
    "B-COMMODITY", "I-COMMODITY", "B-NEG_COMMODITY", "I-NEG_COMMODITY",
)
IGNORED = -100
MAX_CHARS = 500
MAX_TOKENS = 256
SPLITS = ("dev", "test", "edge_case")
BUCKETS = ("PERSON", "ORG", "ADDRESS", "COMMODITY(POS)", "COMMODITY(NEG)")

ENTITY = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("polarity", T.StringType()),
    ]
)
RANGE = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
SKIPPED = T.StructType([T.StructField(c, T.StringType()) for c in ("type", "text", "reason")])
META = T.StructType(
    [
        T.StructField("template", T.StringType()),
        T.StructField("preserve_spans", T.ArrayType(RANGE)),
        T.StructField("skipped", T.ArrayType(SKIPPED)),
    ]
)
RECORD = T.StructType(
    [
        T.StructField("record_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("entities", T.ArrayType(ENTITY)),
        T.StructField("meta", META),
    ]
)


def label_dim(spark: SparkSession) -> DataFrame:
    """(label_id, label, prefix, type, polarity): eleven rows."""
    rows = []
    for i, label in enumerate(LABELS):
        prefix, _, kind = label.partition("-")
        rows.append((i, label, prefix, kind.removeprefix("NEG_") or None, ("NEG" if kind.startswith("NEG_") else "POS") if kind else None))
    return spark.createDataFrame(rows, "label_id int, label string, prefix string, type string, polarity string")
