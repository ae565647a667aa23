"""From raw documents to token ids: language, near-duplicates, benchmark leaks, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanweave.llm import bpe, contamination, language, pii, simhash
from spanweave.llm.common import crc_mod, discard, hold, shared_dir, table

#: Least share of its main language that a document must have.
LEAST_SHARE = 0.5
#: For demonstration; a deployment passes its own secret.
KEY = b"corpus pipeline pseudonyms"


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or without a language that holds at least LEAST_SHARE of them, go."""
    told = language.predict(language.train(docs, crc_mod(F.col("doc_id"), 5) != 0), spark)("text")
    return docs.filter((told["lang_pred"] != "und") & (told["share"] >= LEAST_SHARE))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates the document with the smallest doc_id stays."""
    return simhash.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return contamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced, in its own format."""
    return docs.withColumn("text", pii.pseudonyms(KEY)("text")["text"]).withColumn("n_chars", F.length("text").cast("bigint"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32 bits) and the digest of what they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", keep_known_languages),
    ("near-duplicates", keep_one_of_each_group),
    ("decontamination", drop_benchmark_leaks),
    ("pii", pseudonymise),
    ("bpe", encode),
]

#: Trained, iterative and keyed stages have no SQL twin; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between is written to the shared folder.

    A stage's folder goes as soon as the next stage is written; the last one, which the result is read from, goes
    when the process ends.
    """
    docs = table(spark, sf_dir, "documents")
    top = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            hold(spark, f"{top}-{k}")
            out.write.parquet(f"{top}-{k}")
            docs = spark.read.parquet(f"{top}-{k}")
            if k:
                discard(f"{top}-{k - 1}")
    return out
