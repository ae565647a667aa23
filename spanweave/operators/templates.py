"""Slot grammar, weighted draws and filled templates with exact offsets.

A slot is {kind}, {kind#number} or {kind:sub}. Kinds name an entity type (any case; NEG_ in front
makes it negative), or decoy with a sub-name. Everything else, doubled braces too, is literal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.functions.hashing import uniform
from spanweave.functions.plan import barrier, deal

SLOT = r"\{([A-Za-z_]+)(?:#(\d+))?(?::([A-Za-z_]+))?\}"
#: Decoys whose place noise must not touch.
PROTECTED = ("neg_cue", "contrast_cue")
#: Least number of cells that a pool's weights are laid over.
CELLS = 4096
_USED = "array<struct<lo:double,hi:double,value:string>>"


def slot_array(template: Column) -> Column:
    """The slots of a template in order: slot_idx, before, pool, entity_type, polarity, sub.

    before is the literal text in front of the slot; pool is the key of its values.
    """
    pieces = F.split(template, SLOT, -1)
    found = [F.regexp_extract_all(template, F.lit(SLOT), F.lit(g)) for g in (1, 3)]
    zipped = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(pieces) - 1).alias("before"), found[0].alias("kind"), found[1].alias("sub"))

    def slot(s: Column, i: Column) -> Column:
        upper, decoy = F.upper(s["kind"]), s["kind"] == "decoy"
        kind = F.when(~decoy, F.regexp_replace(upper, "^NEG_", ""))
        return F.struct(
            i.alias("slot_idx"), s["before"].alias("before"), F.when(decoy, F.concat(F.lit("decoy:"), s["sub"])).otherwise(kind).alias("pool"), kind.alias("entity_type"),
            F.when(~decoy, F.when(upper.startswith("NEG_"), "NEG").otherwise("POS")).alias("polarity"), F.when(decoy, s["sub"]).alias("sub"),
        )

    return F.transform(zipped, slot)


def template_slots(templates: DataFrame) -> DataFrame:
    """(template, slot_idx, before, pool, entity_type, polarity, sub): one row a slot, in order."""
    return templates.select("template", F.explode(slot_array(F.col("template"))).alias("s")).select("template", "s.*")


def unresolved_slots(templates: DataFrame, pools: DataFrame) -> DataFrame:
    """Slots without a pool of values."""
    return template_slots(templates).join(pools.select("pool").distinct(), "pool", "left_anti")


def cumulative(pools: DataFrame) -> DataFrame:
    """pools(pool, value, weight) with the interval [lo, hi) of each value in its pool, and the pool's sum and count.

    Values stand in the order of (first three digits of their md5, value), so that no pool is one window:
    a window holds one of 4,096 parts, and the sums of the parts are added up before them.
    """
    rows = pools.select("pool", "value", "weight", F.substring(F.md5("value"), 1, 3).alias("part"))
    parts = rows.groupBy("pool", "part").agg(F.sum("weight").alias("w"), F.count("*").alias("k"))
    order, whole = Window.partitionBy("pool").orderBy("part"), Window.partitionBy("pool")
    before = parts.select("pool", "part", (F.sum("w").over(order) - F.col("w")).alias("before"), F.sum("w").over(whole).alias("total"), F.sum("k").over(whole).alias("n"))
    hi = F.col("before") + F.sum("weight").over(Window.partitionBy("pool", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    return rows.join(before, ["pool", "part"]).select("pool", "value", "weight", (hi - F.col("weight")).alias("lo"), hi.alias("hi"), "total", "n")


def _cell(x: Column, total: Column, n: Column) -> Column:
    m = F.greatest(n, F.lit(CELLS))
    return F.least(F.floor(x / total * m), m - 1)


class Pools:
    """Pools prepared for draws: the intervals by cell, and the sum and count of each pool.

    Intervals are laid over as many equal cells as the pool has values, or CELLS if that is more. A draw
    meets the values of its cell only, about one, and the draws of a small pool are spread over many keys.
    """

    def __init__(self, pools: DataFrame) -> None:
        table = cumulative(pools)
        self.sizes = table.groupBy("pool").agg(F.max("n").alias("n"), F.max("total").alias("total"))  # one row a pool
        cells = F.sequence(_cell(F.col("lo"), F.col("total"), F.col("n")), _cell(F.col("hi"), F.col("total"), F.col("n")))
        self.cells = table.filter("weight > 0").select("pool", F.explode(cells).alias("cell"), "value", "lo", "hi", (F.col("hi") == F.col("total")).alias("last"))

    def look_up(self, rows: DataFrame) -> DataFrame:
        """rows(pool, at, total, n) with the value whose interval holds `at`, and its bounds; nulls where `at` is null."""
        apart = -1 - F.pmod(F.xxhash64("record_id"), F.lit(CELLS))  # rows without a draw meet no cell, and do not meet in one task
        placed = rows.withColumn("cell", F.coalesce(_cell(F.col("at"), F.col("total"), F.col("n")), apart))
        c = self.cells.withColumnRenamed("pool", "__pool").withColumnRenamed("cell", "__cell")
        fits = (F.col("pool") == F.col("__pool")) & (F.col("cell") == F.col("__cell")) & (F.col("lo") <= F.col("at")) & ((F.col("at") < F.col("hi")) | F.col("last"))
        return placed.join(c, fits, "left").drop("cell", "last", "__pool", "__cell")


def weighted_draw(draws: DataFrame, pools: DataFrame) -> DataFrame:
    """draws(record_id, pool, u) with the value whose interval holds u * total."""
    table = Pools(pools)
    placed = draws.join(table.sizes, "pool").withColumn("at", F.col("u") * F.col("total"))
    return table.look_up(placed).drop("n", "total", "lo", "hi", "at")


def draw_templates(ids: DataFrame, templates: DataFrame, seed: int) -> DataFrame:
    """ids(record_id) with a weighted template each."""
    pool = templates.select(F.lit("template").alias("pool"), F.col("template").alias("value"), "weight")
    draws = ids.select("record_id", F.lit("template").alias("pool"), uniform(seed, F.col("record_id"), "template").alias("u"))
    return weighted_draw(draws, pool).select("record_id", F.col("value").alias("template"))


def most_of_a_kind(templates: DataFrame) -> int:
    """The largest number of slots of one entity type in a template."""
    kinds = template_slots(templates.select("template").distinct()).filter("entity_type IS NOT NULL")
    return kinds.groupBy("template", "pool").count().agg(F.max("count")).first()[0] or 0


def _groups(slots: Column, distinct: bool) -> Column:
    """(pool, idxs): slots that are drawn without replacement from the same pool; decoys stand alone."""
    alone = F.transform(F.filter(slots, lambda s: s["entity_type"].isNull() | F.lit(not distinct)), lambda s: F.struct(s["pool"].alias("pool"), F.array(s["slot_idx"]).alias("idxs")))
    if not distinct:
        return alone
    named = F.filter(slots, lambda s: s["entity_type"].isNotNull())
    own = lambda p: F.transform(F.filter(named, lambda s: s["pool"] == p), lambda s: s["slot_idx"])
    return F.concat(alone, F.transform(F.array_distinct(F.transform(named, lambda s: s["pool"])), lambda p: F.struct(p.alias("pool"), own(p).alias("idxs"))))


def choose_values(drawn: DataFrame, pools: DataFrame, seed: int, rounds: int, distinct: bool = True) -> DataFrame:
    """drawn(record_id, template) with chosen, the values of the template's slots in order.

    The k-th value of a type is drawn by weight from those that the record does not have yet: its draw
    runs over the weight that is left, and steps over the intervals of the values before it. Once a
    pool is used up, draws are from all of it again. Each round draws one value for every type that
    has so many slots; a round is a join on (pool, cell), whatever the size of the pool.
    """
    table = Pools(pools)
    slots = deal(drawn, "record_id").select("record_id", "template", F.explode_outer(_groups(slot_array(F.col("template")), distinct)).alias("g")).select("record_id", "template", "g.pool", "g.idxs")
    known = slots.join(table.sizes, "pool", "left")
    missing = F.raise_error(F.concat(F.lit("no values for slot "), "pool")).cast("double")
    made = known.withColumn("total", F.when(F.col("idxs").isNull(), 0.0).otherwise(F.coalesce("total", missing))).withColumn("used", F.array().cast(_USED))
    for r in range(1, rounds + 1):
        taken = F.aggregate("used", F.lit(0.0), lambda a, x: a + (x["hi"] - x["lo"]))
        over = F.lit(r > 1) & (F.lit(r) > F.col("n"))  # the pool is used up
        u = uniform(seed, F.col("record_id"), F.try_element_at("idxs", F.lit(r)))
        step = lambda a, x: F.when(a >= x["lo"], F.greatest(a + (x["hi"] - x["lo"]), x["hi"])).otherwise(a)
        at = F.when(over, u * F.col("total")).otherwise(F.aggregate(F.array_sort("used"), u * (F.col("total") - taken), step))
        made = table.look_up(barrier(made.withColumn("at", F.when(F.size("idxs") >= r, at))))
        made = made.withColumn("used", F.when(F.col("at").isNull(), F.col("used")).otherwise(F.concat("used", F.array(F.struct("lo", "hi", "value"))))).drop("at", "lo", "hi", "value")
    got = F.zip_with("idxs", "used", lambda i, x: F.struct(i.alias("idx"), x["value"].alias("value")))
    every = made.groupBy("record_id", "template").agg(F.flatten(F.collect_list(got)).alias("got"))
    return every.select("record_id", "template", F.transform(F.array_sort("got"), lambda x: x["value"]).alias("chosen"))


def slot_fill(drawn: DataFrame, pools: DataFrame, seed: int, distinct: bool = True, rounds: int | None = None) -> DataFrame:
    """Records of drawn(record_id, template): text, entities, and the protected ranges in meta.

    rounds: at least most_of_a_kind of the templates; found from drawn if it is not given. A slot without
    values is an error.
    """
    if rounds is None:
        rounds = most_of_a_kind(drawn)
    chosen = choose_values(drawn, pools, seed, max(1, rounds if distinct else 1), distinct).withColumn("slots", slot_array(F.col("template")))
    placed = F.aggregate(
        F.arrays_zip("slots", "chosen"),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("text"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda a, x: F.struct(
            (a["at"] + F.length(x["slots"]["before"]) + F.length(x["chosen"])).alias("at"),
            F.concat(a["text"], x["slots"]["before"], x["chosen"]).alias("text"),
            F.concat(
                a["spans"],
                F.array(F.struct((a["at"] + F.length(x["slots"]["before"])).alias("start"), (a["at"] + F.length(x["slots"]["before"]) + F.length(x["chosen"])).alias("end"))),
            ).alias("spans"),
        ),
    )
    tail = F.element_at(F.split("template", SLOT, -1), F.lit(-1))
    built = chosen.withColumn("placed", placed)
    parts = F.arrays_zip("slots", "chosen", F.col("placed.spans").alias("spans"))
    entities = F.transform(
        F.filter(parts, lambda x: x["slots"]["entity_type"].isNotNull()),
        lambda x: F.struct(
            x["slots"]["entity_type"].alias("type"), x["chosen"].alias("text"), x["spans"]["start"].alias("start"), x["spans"]["end"].alias("end"), x["slots"]["polarity"].alias("polarity")
        ),
    )
    cues = F.transform(F.filter(parts, lambda x: x["slots"]["sub"].isin(*PROTECTED)), lambda x: x["spans"])
    meta = F.struct("template", cues.alias("preserve_spans"), F.array().cast("array<struct<type:string,text:string,reason:string>>").alias("skipped"))
    return built.select("record_id", F.concat("placed.text", tail).alias("text"), entities.alias("entities"), meta.alias("meta"))


def generate(ids: DataFrame, templates: DataFrame, pools: DataFrame, seed: int, distinct: bool = True) -> DataFrame:
    """A record for each id: a weighted template, filled."""
    return slot_fill(draw_templates(ids, templates, seed), pools, seed, distinct, most_of_a_kind(templates))
