"""Small awkward inputs: nulls, empty and long texts, repeats, clashing extra columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ODD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (3, "the QUICK brown fox jumps over the lazy dog near the river bank today!"),
    (4, ""),
    (5, None),
    (None, "no id here but some words for the test of null ids in any column"),
    (None, None),
    (6, "   \n\t "),
    (7, "one two three"),
    (8, "word " * 30_000),
    (9, "naïve café — 日本語 テキスト, emoji 😀 it's don't    end x"),
    (10, "... ,,, !!!"),
    (11, "\U0001d4d0 \x00\x1c\x85 tail 's 'tis  'S"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, score string, n_words int, shard string, positive string, label string"


def odd_docs(spark: SparkSession, rows: list[tuple] = ODD) -> DataFrame:
    """With extra columns whose names the operators use themselves."""
    full = [(i, t, "en", "s", None if t is None else len(t), "x", "y", 7, "z", "p", "l") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)
