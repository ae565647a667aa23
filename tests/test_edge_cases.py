"""The edge-case suite through cleaning, encoding, decoding and back to the places of the given text."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanweave.functions.text import ZERO_WIDTH
from spanweave.operators.clean import project_to_clean, project_to_original, with_char_map
from spanweave.operators.tokens import bio_decode, bio_encode, whitespace_tokens
from spanweave.plans import catalog
from spanweave.sources import records as record_source


def through_all(spark):
    """The edge-case suite through cleaning, encoding, decoding and back to the places of the given text."""
    given = record_source.edge_cases(spark).withColumnRenamed("text", "raw")
    mapped = with_char_map(given.withColumn("text", F.col("raw"))).drop("text")
    plain = F.transform("entities", lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end")))
    moved = mapped.withColumn("spans", project_to_clean("char_map", F.length("raw"), plain))
    spans = moved.select("record_id", F.explode(F.arrays_zip("entities", "spans")).alias("x")).select("record_id", "x.spans.start", "x.spans.end", "x.entities.type", "x.entities.polarity")
    tokens = whitespace_tokens(mapped.select("record_id", F.col("clean_text").alias("text")))
    back = bio_decode(bio_encode(tokens, spans)).groupBy("record_id").agg(F.collect_list(F.struct("start", "end", "type", "polarity")).alias("found"))
    placed = mapped.join(back, "record_id", "left").withColumn("at", project_to_original("char_map", F.length("raw"), F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))))
    rows = placed.select("case", "raw", F.explode_outer(F.arrays_zip("found", "at")).alias("x"))
    text = F.substring(F.col("raw"), F.col("x.at.start") + 1, F.col("x.at.end") - F.col("x.at.start"))
    return rows.select("case", "x.at.start", "x.at.end", "x.found.type", "x.found.polarity", text.alias("text"))


def expected():
    """What is expected, except that a token lends its closing marks to its span: ends move to the end of the token."""
    for case, text, *found in record_source.EDGE_CASES:
        for kind, surface, polarity in found:
            s = text.index(surface)
            e = next((k for k in range(s + len(surface), len(text)) if text[k].isspace() or text[k] in ZERO_WIDTH), len(text))
            yield (case, s, e, kind, polarity, text[s:e])
        if not found:
            yield (case, None, None, None, None, None)


def test_edge_case_suite(spark):
    got = [tuple(r) for r in through_all(spark).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected()))


def test_the_query_takes_the_suite_through_all_and_counts_the_records(spark):
    got = catalog.queries()["edge_cases"](spark, "/root/testdata/sf0.001").select("case", "start", "end", "type", "polarity", "text", "records").collect()
    assert sorted(repr(tuple(r)[:6]) for r in got if r.records is None) == sorted(map(repr, expected()))
    assert len([r for r in got if r.records is not None]) == 8
