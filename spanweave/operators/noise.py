"""Noise that keeps labels: lower case, lost punctuation, typing errors, lost ends.

Each step is a gate by a hash of seed and record_id, then an expression over the characters of the
text. Characters in entities (if asked) and in protected ranges never change, except for case; spans
are moved to what survives of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.functions.hashing import hash32, uniform
from spanweave.functions.plan import barrier
from spanweave.functions.text import PUNCTUATION, lower_in_place, span_text


@dataclass(frozen=True)
class NoiseConfig:
    p_lowercase: float = 0.25
    p_drop_punct: float = 0.25
    drop_punct_rate: float = 0.5
    p_typo: float = 0.15
    typo_rate: float = 0.02
    p_truncate: float = 0.05
    truncate_max_chars: int = 8
    preserve_entity_surface: bool = True


DEFAULT = NoiseConfig()


def _gate(p: float, seed: int, step: str, only: str | None) -> Column:
    hit = uniform(seed, F.col("record_id"), step) < p
    return hit & F.col(only) if only else hit


def _guarded(config: NoiseConfig) -> Column:
    """All ranges of a row that noise leaves alone."""
    own = F.transform("entities", lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end")))
    cues = F.coalesce("meta.preserve_spans", F.array().cast("array<struct<start:int,end:int>>"))
    return F.concat(own, cues) if config.preserve_entity_surface else cues


def _resliced(records: DataFrame) -> DataFrame:
    """Entity texts taken from the text again."""
    return records.withColumn("entities", F.transform("entities", lambda e: e.withField("text", span_text(F.col("text"), e["start"], e["end"]))))


def delete_and_reproject(records: DataFrame, dropped: str) -> DataFrame:
    """Delete the sorted positions in the array column `dropped`; spans keep their surviving characters."""
    before = lambda p: F.size(F.filter(dropped, lambda d: d < p))
    move = lambda x: F.struct((x["start"] - before(x["start"])).alias("start"), (x["end"] - before(x["end"])).alias("end"))
    kept = F.array_join(F.filter(F.split("text", ""), lambda c, i: ~F.array_contains(F.col(dropped), i)), "")
    entities = F.transform(
        "entities", lambda e: F.struct(e["type"].alias("type"), e["text"].alias("text"), move(e)["start"].alias("start"), move(e)["end"].alias("end"), e["polarity"].alias("polarity"))
    )
    cues = F.filter(F.transform("meta.preserve_spans", move), lambda x: x["start"] < x["end"])
    moved = records.select(
        *[c for c in records.columns if c not in ("text", "entities", "meta", dropped)],
        F.when(F.size(dropped) > 0, kept).otherwise(F.col("text")).alias("text"),
        F.filter(entities, lambda e: e["start"] < e["end"]).alias("entities"),
        F.col("meta").withField("preserve_spans", cues).alias("meta"),
    )
    return _resliced(moved).select(*[c for c in records.columns if c != dropped])


def lowercase(records: DataFrame, seed: int, config: NoiseConfig = DEFAULT, only: str | None = None) -> DataFrame:
    lower = F.when(_gate(config.p_lowercase, seed, "lowercase", only), lower_in_place(F.col("text"))).otherwise(F.col("text"))
    return _resliced(records.withColumn("text", lower))


def drop_punctuation(records: DataFrame, seed: int, config: NoiseConfig = DEFAULT, only: str | None = None) -> DataFrame:
    marked = records.withColumn("__guarded", _guarded(config))
    at = F.transform(F.split("text", ""), lambda c, i: F.when(F.instr(F.lit(PUNCTUATION), c) > 0, i))
    hit = F.filter(
        at,
        lambda i: i.isNotNull()
        & (uniform(seed, F.col("record_id"), "punct", i) < config.drop_punct_rate)
        & ~F.exists("__guarded", lambda g: (g["start"] <= i) & (i < g["end"])),
    )
    gate = _gate(config.p_drop_punct, seed, "drop_punct", only) & (F.length("text") > 0)
    marked = marked.withColumn("__dropped", F.when(gate, hit).otherwise(F.array().cast("array<int>"))).drop("__guarded")
    return delete_and_reproject(barrier(marked), "__dropped")


def typos(records: DataFrame, seed: int, config: NoiseConfig = DEFAULT, only: str | None = None) -> DataFrame:
    marked = records.withColumn("__guarded", _guarded(config))
    letters = F.lit("abcdefghijklmnopqrstuvwxyz")

    def typed(c: Column, i: Column) -> Column:
        free = ~F.exists("__guarded", lambda g: (g["start"] <= i) & (i < g["end"]))
        hit = c.rlike(r"\p{L}") & (uniform(seed, F.col("record_id"), "typo", i) < config.typo_rate) & free
        return F.when(hit, F.substring(letters, (F.pmod(hash32(seed, F.col("record_id"), "letter", i), F.lit(26)) + 1).cast("int"), F.lit(1))).otherwise(c)

    text = F.when(_gate(config.p_typo, seed, "typo", only), F.array_join(F.transform(F.split("text", ""), typed), "")).otherwise(F.col("text"))
    return _resliced(marked.withColumn("text", text).drop("__guarded"))


def truncate(records: DataFrame, seed: int, config: NoiseConfig = DEFAULT, only: str | None = None) -> DataFrame:
    """Up to truncate_max_chars characters off the end, unless the cut is inside an entity or a protected range."""
    n = F.length("text")
    cut = (n - 1 - F.pmod(hash32(seed, F.col("record_id"), "cut"), F.lit(config.truncate_max_chars))).cast("int")
    marked = records.withColumn("__cut", cut)
    held = F.exists("entities", lambda e: (e["start"] < F.col("__cut")) & (F.col("__cut") < e["end"])) | F.exists(
        F.coalesce("meta.preserve_spans", F.array().cast("array<struct<start:int,end:int>>")), lambda p: (p["start"] <= F.col("__cut")) & (F.col("__cut") < p["end"])
    )
    gate = _gate(config.p_truncate, seed, "truncate", only) & (n > 10) & ~held
    marked = marked.withColumn("__dropped", F.when(gate, F.sequence(F.col("__cut"), n - 1)).otherwise(F.array().cast("array<int>"))).drop("__cut")
    return delete_and_reproject(barrier(marked), "__dropped")


def apply_noise(records: DataFrame, seed: int, config: NoiseConfig = DEFAULT, only: str | None = None) -> DataFrame:
    """The four steps in their order; only: a boolean column that says which rows take part."""
    for step in (lowercase, drop_punctuation, typos, truncate):
        records = barrier(step(records, seed, config, only))
    return records
