"""Empty tables, and tables whose extra columns have the names that operators use."""

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tests.llm.docs import ODD, odd_docs

from spanweave.llm import extraction, language, licenses, pii, secrets, toxicity


def test_text_operators_of_no_rows(spark):
    none = odd_docs(spark, [])
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert none.select(toxicity.score(toxicity.train(none, labels, F.lit(True)), spark)("text")).count() == 0
    assert none.select(language.predict(language.train(none, F.lit(True)), spark)("text")).count() == 0
    assert none.select(licenses.scan(none)("text")).count() == 0
    assert none.select(pii.pseudonyms(b"k")("text")).count() == 0
    assert none.select(extraction.extractor(spark)("text")).count() == 0
    assert secrets.find(none, secrets.train(none)).count() == 0


def test_pipeline_of_no_rows(spark, tmp_path):
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = odd_docs(spark, [])
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.count() == 0


def test_pipeline_keeps_extra_columns(spark, tmp_path):
    spark.createDataFrame([(None, None), (1, "zzz")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = odd_docs(spark, ODD)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.count() == 7
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 7
    assert public_tokenizers.PATTERN


def test_one_very_long_text(spark):
    long = "Some words, card 4111 1111 1111 1111 and mail a.b@c.org; token = abcdef0123456789abcdef\n" * 3_000
    docs = odd_docs(spark, [(1, long), (2, "x" * 1_000_000), (3, " " * 200_000)])
    assert [r[0] for r in docs.select(pii.pseudonyms(b"k")("text")["n_found"]).collect()] == [6_000, 0, 0]
    found = secrets.find(docs, secrets.train(odd_docs(spark))).select(secrets.count_of("base", "assign").alias("a"), secrets.count_of("base", "hex").alias("h"))
    assert found.filter("a = 3000 AND h = 3000").count() == 1
