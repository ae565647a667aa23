"""The annotation store's inputs, derived from the driver's tables the same way here and in SQL.

Texts of documents are records; every fifth token or so is labelled by a hash, and runs of one label are
gold spans. Predictions, annotators and probabilities are hashed changes of gold. Each function takes
(spark, sf_dir).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanweave.functions.hashing import bucket, bucket_of, hash32_of, uniform
from spanweave.functions.plan import deal, spread
from spanweave.functions.text import CleanConfig, clean
from spanweave.operators.templates import generate
from spanweave.operators.tokens import bio_encode, whitespace_tokens
from spanweave.operators.whole import Piece, Table, encode, runs, take
from spanweave.sources.pools import in_memory, pool_table

# Our own example templates (template, weight) and decoys (slot, value, weight).
TEMPLATES = (
    ("{PERSON} of {ORG} confirms {COMMODITY}.", 3.0),
    ("Invoice {decoy:number}: {COMMODITY#1} and {COMMODITY#2} for {ORG}, {ADDRESS}", 2.0),
    ("{ORG} ships {COMMODITY}; {decoy:neg_cue} {NEG_COMMODITY} aboard", 2.0),
    ("{decoy:neg_cue} {NEG_COMMODITY#1}{decoy:contrast_cue} {COMMODITY#2}.", 1.0),
    ("deliver to {ADDRESS} - attention {person}", 1.0),
    ("payload: {{ \"buyer\": \"{ORG}\" }} ref {decoy:number}", 0.5),
    ("{PERSON#1} | {PERSON#2} | {ORG}", 1.0),
    ("Weather was fine, nothing was loaded ({decoy:number}).", 0.5),
    ("Route: {ADDRESS#1} - {ADDRESS#2} - {ADDRESS#3} - {ADDRESS#4}, {decoy:neg_cue} {NEG_COMMODITY#1}, {COMMODITY#2}, {COMMODITY#3}", 0.5),
)
DECOYS = (
    ("number", "A-17", 1.0), ("number", "2024/55", 2.0), ("number", "no. 9", 1.0),
    ("neg_cue", "without", 1.0), ("neg_cue", "does not contain", 2.0), ("neg_cue", "no", 1.0),
    ("contrast_cue", ", only", 1.0), ("contrast_cue", "; instead", 1.0),
)
# Templates that break the contract with the pools, and the decoys that it declares.
ODD_TEMPLATES = (("{decoy} of {ORG}", 1.0), ("{THING} and {neg_thing#2} for {PERSON}", 1.0), ("{decoy:gone} {decoy:number}", 1.0))
DECLARED = ("number", "neg_cue", "title")
SEED = 42
# Wanted shares of some sources; the others have none.
SOURCE_TARGETS = {"src0": 0.04, "src3": 0.06, "src5": 0.05}
# Cleaning with one switch off, and with all off.
SWITCHES = {
    "no_trim": CleanConfig(trim=False), "no_collapse": CleanConfig(collapse_whitespace=False), "no_control": CleanConfig(strip_control_chars=False),
    "no_zero_width": CleanConfig(strip_zero_width=False), "bare": CleanConfig(collapse_whitespace=False, normalize_whitespace=False, trim=False), "none": CleanConfig(False, False, False, False, False),
}
KINDS = (("PERSON", "POS"), ("ORG", "POS"), ("ADDRESS", "POS"), ("COMMODITY", "POS"), ("COMMODITY", "NEG"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """(record_id, raw, text, source, lang, split): text is cleaned. dealt: by record; else only where files are few."""
    b = bucket(10, "split", F.col("doc_id"))
    raw = F.coalesce("text", F.lit(""))
    split = F.when(b < 5, "dev").when(b < 9, "test").otherwise("edge_case")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return (deal(docs, "doc_id") if dealt else spread(docs, "doc_id")).select(F.col("doc_id").alias("record_id"), raw.alias("raw"), clean(raw).alias("text"), "source", "lang", split.alias("split"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitespace_tokens(records(spark, sf_dir, dealt=True), dealt=True)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record_id, start, end, type, polarity, text)."""
    by = Window.partitionBy("record_id").orderBy("tok_idx")
    k = tokens(spark, sf_dir).withColumn("k", bucket(20, "ent", F.col("record_id"), F.col("tok_idx")))
    runs = k.withColumn("fresh", (F.coalesce(F.lag("k").over(by), F.lit(-1)) != F.col("k")).cast("int")).withColumn("run", F.sum("fresh").over(by))
    spans = runs.filter("k < 5").groupBy("record_id", "run").agg(
        F.min("c0").alias("start"), F.max("c1").alias("end"), F.first("k").alias("k"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tok_idx", "token"))), lambda x: x["token"]), " ").alias("text")
    )
    kind = F.array(*(F.lit(t) for t, _ in KINDS))
    return spans.select("record_id", "start", "end", F.get(kind, F.col("k").cast("int")).alias("type"), F.when(F.col("k") == 4, "NEG").otherwise("POS").alias("polarity"), "text")


def leaked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records, and every third benchmark item without its last word."""
    items = table(spark, sf_dir, "benchmark").filter("item_id % 3 = 0").select((-1 - F.col("item_id")).alias("record_id"), F.regexp_replace("text", r"\s+\S+\s*$", "").alias("text"))
    return records(spark, sf_dir).select("record_id", "text").unionByName(items)


def earlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as they were: some not there yet, some with another text, some that are gone now."""
    r = records(spark, sf_dir).select("record_id", "split", "text", bucket(10, "state", F.col("record_id")).alias("b"))
    old = r.filter("b <> 0").withColumn("text", F.when(F.col("b") == 1, F.concat("text", F.lit(" then"))).otherwise(F.col("text")))
    return old.unionByName(r.filter("b = 2").withColumn("record_id", F.col("record_id") + 1_000_000_000)).drop("b")


def overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gold and, for every fifth span, an ORG that begins one character later and reaches six further."""
    g = gold(spark, sf_dir).drop("text")
    more = g.filter(bucket(5, "over", F.col("record_id"), F.col("start")) == 0)
    return g.unionByName(more.select("record_id", (F.col("start") + 1).alias("start"), (F.col("end") + 6).alias("end"), F.lit("ORG").alias("type"), F.lit("POS").alias("polarity")))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gold(spark, sf_dir).drop("text").withColumn("m", bucket(20, "pred", F.col("record_id"), F.col("start")))
    end = F.when((F.col("m") == 1) & (F.col("end") - F.col("start") > 1), F.col("end") - 1).otherwise(F.col("end"))
    polarity = F.when((F.col("m") == 2) & (F.col("type") == "COMMODITY"), F.when(F.col("polarity") == "NEG", "POS").otherwise("NEG")).otherwise(F.col("polarity"))
    return g.filter("m > 0").select("record_id", "start", end.cast("int").alias("end"), "type", polarity.alias("polarity"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tokens with label_id."""
    return bio_encode(tokens(spark, sf_dir), gold(spark, sf_dir))


def annotator(label_id: Column, who: str) -> Column:
    """An annotator's label: every thirtieth is left out."""
    return F.when(bucket(30, who, F.col("record_id"), F.col("tok_idx")) == 0, 0).otherwise(label_id)


#: Annotators of a panel, each of whom leaves every seventh token out.
PANEL = ("A", "B", "C", "D")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(v): the votes of PANEL on each token, missing ones left out."""
    vote = lambda who: F.when(bucket(7, F.lit("miss"), F.lit(who), F.col("record_id"), F.col("tok_idx")) != 0, F.struct(F.lit(who).alias("annotator"), annotator(F.col("label_id"), who).alias("label")))
    return labels(spark, sf_dir).select(F.filter(F.array(*map(vote, PANEL)), lambda x: x.isNotNull()).alias("v"))


def broken_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels where some B became I, some tokens are ignored, and some ids are unknown."""
    b = bucket(12, "break", F.col("record_id"), F.col("tok_idx"))
    odd = F.when((b == 0) & (F.col("label_id") % 2 == 1), F.col("label_id") + 1).when(b == 1, -100).when(b == 2, 99).otherwise(F.col("label_id"))
    return labels(spark, sf_dir).withColumn("label_id", odd.cast("int"))


def probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tokens with probs: mostly the label is on top, sometimes its neighbour."""
    shift = F.when(bucket(8, "peak", F.col("record_id"), F.col("tok_idx")) == 0, 1).otherwise(0)
    top = F.round(0.5 + uniform("prob", F.col("record_id"), F.col("tok_idx")) * 0.49, 6)
    peaked = labels(spark, sf_dir).withColumn("peak", (F.col("label_id") + shift) % 11).withColumn("top", top)
    rest = F.round((1 - F.col("top")) / 10, 6)
    return peaked.withColumn("probs", F.transform(F.sequence(F.lit(0), F.lit(10)), lambda i: F.when(i == F.col("peak"), F.col("top")).otherwise(rest).cast("float"))).drop("peak", "top", "label_id")


def gold_of(piece: Piece, tokens: Table) -> Table:
    """gold of a piece of records, with the bytes of each span's text; KINDS are in the order of schema.BUCKETS."""
    r = runs(tokens, bucket_of(20, "ent", piece.ids, tokens["owner"], tokens["tok_idx"]))
    spans = take(r, np.flatnonzero(r["k"] < len(KINDS)))
    return spans | {"kind": spans["k"]}


def overlapping_of(piece: Piece, gold: Table) -> Table:
    """overlapping."""
    more = take(gold, np.flatnonzero(bucket_of(5, "over", piece.ids, gold["owner"], gold["start"]) == 0))
    more |= {"start": more["start"] + 1, "end": more["end"] + 6, "kind": np.full(len(more["kind"]), 1)}
    return {c: np.concatenate([gold[c], more[c]]) for c in ("owner", "start", "end", "kind")}


def predictions_of(piece: Piece, gold: Table) -> Table:
    """predictions."""
    m = bucket_of(20, "pred", piece.ids, gold["owner"], gold["start"])
    end = gold["end"] - ((m == 1) & (gold["end"] - gold["start"] > 1))
    kind = np.where((m == 2) & (gold["kind"] >= 3), 7 - gold["kind"], gold["kind"])
    return take(gold | {"end": end, "kind": kind}, np.flatnonzero(m > 0))


def labels_of(piece: Piece, tokens: Table) -> np.ndarray:
    """The label_id of labels."""
    return encode(tokens, gold_of(piece, tokens))


def annotator_of(piece: Piece, tokens: Table, label: np.ndarray, who: str) -> np.ndarray:
    """annotator."""
    return np.where(bucket_of(30, who, piece.ids, tokens["owner"], tokens["tok_idx"]) == 0, 0, label)


def votes_of(piece: Piece, tokens: Table, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """panel: (labels, given) by annotator and token."""
    given = [bucket_of(7, f"miss|{who}", piece.ids, tokens["owner"], tokens["tok_idx"]) != 0 for who in PANEL]
    return np.array([annotator_of(piece, tokens, label, who) for who in PANEL]), np.array(given)


def broken_of(piece: Piece, tokens: Table) -> np.ndarray:
    """The label_id of broken_labels."""
    label, b = labels_of(piece, tokens), bucket_of(12, "break", piece.ids, tokens["owner"], tokens["tok_idx"])
    return np.select([(b == 0) & (label % 2 == 1), b == 1, b == 2], [label + 1, -100, 99], label)


def probs_of(piece: Piece, tokens: Table, label: np.ndarray) -> np.ndarray:
    """The probs of probs, a row for each token."""
    at = (tokens["owner"], tokens["tok_idx"])
    top = np.rint((0.5 + (hash32_of("prob", piece.ids, *at) + 0.5) / 2**32 * 0.49) * 1e6) / 1e6
    out = np.repeat((np.rint((1 - top) / 10 * 1e6) / 1e6).astype(np.float32)[:, None], 11, axis=1)
    out[np.arange(len(top)), (label + (bucket_of(8, "peak", piece.ids, *at) == 0)) % 11] = top
    return out


def entity_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity_type, value, weight): customers, suppliers, nations with regions, and part names by how often they are used."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    parts = (
        table(spark, sf_dir, "customer").select(F.lit("PERSON").alias("entity_type"), F.col("c_name").alias("value")),
        table(spark, sf_dir, "supplier").select(F.lit("ORG").alias("entity_type"), F.col("s_name").alias("value")),
        n.select(F.lit("ADDRESS").alias("entity_type"), F.concat_ws(", ", "n_name", "r_name").alias("value")),
        table(spark, sf_dir, "part").select(F.lit("COMMODITY").alias("entity_type"), F.col("p_name").alias("value")),
    )
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return every.groupBy("entity_type", "value").agg(F.count("*").cast("double").alias("weight"))


def decoy_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_memory(spark, "decoy_pools", list(DECOYS))


def templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_memory(spark, "templates", list(TEMPLATES))


def part_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(template, weight): a template for each part, of three forms."""
    name, form = F.col("p_name"), F.col("p_partkey") % 3
    text = (
        F.when(form == 0, F.concat(F.lit("{PERSON} orders "), name, F.lit(" from {ORG}")))
        .when(form == 1, F.concat(name, F.lit(" for {person}: {decoy:number}, {NEG_COMMODITY#1} and {COMMODITY#2}.")))
        .otherwise(F.concat(F.lit("{{ "), name, F.lit(" }} to {ADDRESS#1} - {ADDRESS#2}")))
    )
    return table(spark, sf_dir, "part").groupBy(text.alias("template")).agg(F.count("*").cast("double").alias("weight"))


def pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pool_table(entity_pools(spark, sf_dir), decoy_pools(spark, sf_dir))


def order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record_id) of every order."""
    return spread(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record_id")), "record_id")


def generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A synthetic record for each order."""
    return generate(order_ids(spark, sf_dir), templates(spark, sf_dir), pools(spark, sf_dir), SEED)
