"""White-space tokens, BIO labels and the decision rules on label probabilities.

Tokens are rows (record_id, tok_idx, c0, c1); spans are rows (record_id, start, end, type, polarity).
All rows of a record share a partition from the first shuffle on: texts are dealt by record before
they are exploded, so the windows and joins by record below add no further exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.functions.plan import deal
from spanweave.schema import IGNORED, LABELS, MAX_TOKENS


def _by_token():
    return Window.partitionBy("record_id").orderBy("tok_idx")


def whitespace_tokens(records: DataFrame, dealt: bool = False) -> DataFrame:
    """Maximal runs without a space of records(record_id, text), where text is cleaned; dealt: by record already."""
    rows = records.select("record_id", "text")
    pieces = (rows if dealt else deal(rows, "record_id")).select("record_id", F.posexplode(F.split("text", " ")).alias("tok_idx", "token"))
    before = F.sum(F.length("token") + 1).over(_by_token().rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(before, F.lit(0)).cast("int")
    return pieces.select("record_id", "tok_idx", start.alias("c0"), (start + F.length("token")).cast("int").alias("c1"), "token").filter("c1 > c0")


def subword_tokens(records: DataFrame, tokenizer_file: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Tokens of records(record_id, text) by a tokenizer file of the tokenizers library, which is sent to the workers.

    As for training: a (0, 0) token at both ends, max_tokens in all.
    """
    spark = records.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(f.read())

    @F.arrow_udf("array<struct<tok_idx:int,c0:int,c1:int,token:string>>")
    def split(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(sent.value)
        for batch in batches:
            out = []
            for e in tokenizer.encode_batch([t or "" for t in batch.to_pylist()], add_special_tokens=False):
                own = list(zip(e.offsets, e.tokens, strict=True))[: max_tokens - 2]
                rows = [((0, 0), ""), *own, ((0, 0), "")]
                out.append([{"tok_idx": i, "c0": a, "c1": b, "token": t} for i, ((a, b), t) in enumerate(rows)])
            yield pa.array(out, pa.list_(pa.struct([("tok_idx", pa.int32()), ("c0", pa.int32()), ("c1", pa.int32()), ("token", pa.string())])))

    return records.select("record_id", F.explode(split("text")).alias("t")).select("record_id", "t.*")


def label_id(prefix: str, kind: Column, polarity: Column) -> Column:
    """The id of prefix + type, with NEG_ before the type for negative polarity."""
    name = F.concat(F.lit(f"{prefix}-"), F.when(polarity == "NEG", "NEG_").otherwise(""), kind)
    return (F.array_position(F.array(*map(F.lit, LABELS)), name) - 1).cast("int")


#: Characters in a cell of the interval join: a token meets the spans of its cell, not of its record.
CELL = 256


def _cells(start: str, end: str) -> Column:
    return F.sequence(F.floor(F.col(start) / CELL), F.floor((F.col(end) - 1) / CELL))


def bio_encode(tokens: DataFrame, spans: DataFrame) -> DataFrame:
    """tokens with label_id. A token of two spans takes the later-starting one; (0, 0) tokens are ignored."""
    special = "c0 = 0 AND c1 = 0"
    t = tokens.select("record_id", "tok_idx", "c0", "c1")
    s = spans.select("record_id", "start", "end", "type", "polarity")
    own = t.filter(f"NOT ({special})").withColumn("cell", F.explode(_cells("c0", "c1")))
    hit = own.join(s.withColumn("cell", F.explode(_cells("start", "end"))), ["record_id", "cell"]).filter("c0 < end AND c1 > start")
    hit = hit.filter(F.col("cell") == F.floor(F.greatest("c0", "start") / CELL)).drop("cell")  # a pair counts where its overlap begins
    nth = F.row_number().over(Window.partitionBy("record_id", "start", "end", "type", "polarity").orderBy("tok_idx"))
    named = hit.withColumn("label_id", F.when(nth == 1, label_id("B", F.col("type"), F.col("polarity"))).otherwise(label_id("I", F.col("type"), F.col("polarity"))))
    chosen = named.groupBy("record_id", "tok_idx").agg(F.max_by("label_id", F.struct("start", "end", "type", "polarity")).alias("label_id"))
    return t.join(chosen, ["record_id", "tok_idx"], "left").withColumn("label_id", F.expr(f"CASE WHEN {special} THEN {IGNORED} ELSE coalesce(label_id, 0) END"))


def bio_decode(labels: DataFrame, strict: bool = False) -> DataFrame:
    """Spans (record_id, start, end, type, polarity) of tokens with label_id, by gaps and islands.

    Ignored and (0, 0) tokens neither open nor close a span. I- continues a span of the same type and
    polarity; otherwise it opens one (lenient) or is dropped with what follows it (strict). Tokens dealt by
    record are not shuffled again.
    """
    known = labels.filter(f"label_id <> {IGNORED} AND NOT (c0 = 0 AND c1 = 0)")
    names = F.array(*map(F.lit, LABELS))
    label = F.coalesce(F.get(names, F.when(F.col("label_id") >= 0, F.col("label_id"))), F.lit("O"))
    split = known.withColumn("label", label).withColumn("prefix", F.substring("label", 1, 1)).withColumn("kind", F.substring("label", 3, 40))
    last = F.lag("kind").over(_by_token())
    opens = (F.col("prefix") == "B") | ((F.col("prefix") == "I") & (last.isNull() | (last != F.col("kind"))))
    islands = split.withColumn("opens", opens.cast("int")).withColumn("island", F.sum("opens").over(_by_token())).filter("prefix <> 'O'")
    made = islands.groupBy("record_id", "island").agg(
        F.min("c0").alias("start"), F.max("c1").alias("end"), F.first("kind").alias("kind"), F.min_by("prefix", "tok_idx").alias("prefix")
    )
    if strict:
        made = made.filter("prefix = 'B'")
    neg = F.col("kind").startswith("NEG_")
    return made.select("record_id", "start", "end", F.regexp_replace("kind", "^NEG_", "").alias("type"), F.when(neg, "NEG").otherwise("POS").alias("polarity"))


def softmax(scores: Column) -> Column:
    """Probabilities of an array of scores, shifted by their maximum."""
    powers = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    return F.transform(powers, lambda p: p / F.aggregate(powers, F.lit(0.0), lambda a, x: a + x))


def best_label(probs: Column) -> Column:
    """Index of the first largest value."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def gated_label(probs: Column, thresholds: list[float] | Column) -> Column:
    """best_label, or O where a label other than O stays below its threshold (compared as floats)."""
    limits = F.array(*map(F.lit, thresholds)).cast("array<float>") if isinstance(thresholds, list) else thresholds
    best = best_label(probs)
    return F.when((best != 0) & (F.array_max(probs).cast("float") < F.get(limits, best)), 0).otherwise(best)
