"""Every query of the subpackage against DuckDB or a brute-force version, and the pipeline stage by stage."""

import hashlib
import zlib

import corpus_pipeline
import duckdb
import pytest
from tests.llm.docs import ODD, odd_docs

from spanweave.llm import contamination, pii, queries, simhash

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_twin(spark, name):
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "pages", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    assert sorted(want.columns) == columns
    place = [want.columns.index(c) for c in columns]
    assert sorted(str([r[k] for k in place]) for r in want.fetchall()) == sorted(str(list(r)) for r in df.select(*columns).collect())


def test_scores_are_whole_and_held_out_is_marked(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for name, mod, rest in (("op1_toxicity", 3, 1), ("op6_language", 5, 0)):
        got = queries.queries()[name](spark, SF).collect()
        assert len(got) == len(docs)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == rest) and 0 <= r.score <= 1 for r in got)
    right = [r.lang_pred == docs[r.doc_id].lang for r in got if r.held_out]
    assert sum(right) / len(right) > 0.95


def test_pipeline_stages_on_odd_documents(spark, tmp_path):
    docs = odd_docs(spark, [*ODD, (70, "write to bob.11@mail.example.org about the plan we made for the summer trip")]).select("doc_id", "text", "lang", "source", "n_chars")
    bench = spark.createDataFrame([(1, "jumps over the lazy dog near the river bank today")], "item_id bigint, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = docs.collect()
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "language":
            assert {r.doc_id for r in before} - {r.doc_id for r in after} == {4, 5, 6, 10}
        if name == "near-duplicates":
            assert [r.doc_id for r in after].count(1) == 1 and 2 not in {r.doc_id for r in after}
            assert len({simhash.fingerprint(r.text.encode()) for r in after}) == len(after)
        if name == "decontamination":
            assert {r.doc_id for r in before} - {r.doc_id for r in after} == {1, 3}
        if name == "pii":
            assert sorted((r.doc_id or 0, r.text) for r in after) == sorted((r.doc_id or 0, pii.pseudonymise(r.text, corpus_pipeline.KEY)[0]) for r in before)
            assert "bob" not in "".join(r.text for r in after)
        if name == "bpe":
            assert sorted((r.doc_id or 0, r.decoded_sha256) for r in after) == sorted((r.doc_id or 0, hashlib.sha256(r.text.encode()).hexdigest()) for r in before)


def test_pipeline_runs_whole(spark):
    got = corpus_pipeline.run(spark, SF)
    assert 0 < got.count() <= 200 and contamination.WINDOW == 10
